"""A training corpus from raw documents in five stages.

language     documents without letters, or of which no language holds half, go
near_copies  one document of each group of near copies stays, the smallest doc_id
repeats      passages that a document with a smaller doc_id has are cut out;
             documents of which nothing is left go
benchmark    documents that hold a passage of a benchmark item go
pieces       the texts that are left become ids

Each stage reads what its predecessor wrote. The tables a stage keeps on the side
are deleted when the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from aisleflow.llm import decontaminate, languages, near_copies, repeats, sentencepieces
from aisleflow.llm.common import materialised, reach_package, read_table, recorded_tables, remove_tables, row_key

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
LEAST_SHARE = 0.5
ORACLE_SQL = None

_side_tables: list[str] = []


def _stage(run: Callable) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Give ``run`` doc_id, text and the rest as one struct, so that no column name of the input can clash."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_tables(spark, _side_tables)
        _side_tables.clear()
        reach_package(spark)
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        others = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.lit(None).cast("int")
        with recorded_tables() as folders:
            try:
                out = run(spark, docs.select("doc_id", "text", others.alias("others")), sf_dir)
            finally:
                _side_tables.extend(folders)
        if "others" not in out.columns:
            return out
        return out.select(*(F.col("others")[c].alias(c) if c in rest else F.col(c) for c in docs.columns))

    stage.__name__, stage.__doc__ = run.__name__, run.__doc__
    return stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one language holds at least half of the letters."""
    model = languages.learn(docs.withColumn("lang", F.col("others")["lang"]), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)
    return languages.keep_identified(docs, model, LEAST_SHARE)


@_stage
def near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_copies.keep_one(docs)


@_stage
def repeat(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; n_chars is counted anew."""
    cut = repeats.remove_repeats(docs, as_text=True).filter((F.col("rep_kept") != "") | (F.col("rep_bytes") == 0))
    others, kind = F.col("others"), docs.schema["others"].dataType
    if isinstance(kind, StructType) and "n_chars" in kind.names:
        size = F.length("rep_kept").cast(kind["n_chars"].dataType)
        others = others.withField("n_chars", F.when(F.col("rep_removed") > 0, size).otherwise(others["n_chars"]))
    return cut.select("doc_id", F.col("rep_kept").alias("text"), others.alias("others"))


@_stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    keyed = docs.withColumn("_key", row_key())
    found = decontaminate.contamination(keyed.select(F.col("_key").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(hit, "_key", "left_anti").select(docs.columns)


@_stage
def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of its text, their number, and whether they decode to the text."""
    encoded = sentencepieces.encode(docs, PIECES)
    return encoded.select("doc_id", "ids", F.when(F.col("ids").isNotNull(), F.size("ids")).alias("n_ids"), "round_trip")


STAGES = [
    ("language", language),
    ("near_copies", near_copy),
    ("repeats", repeat),
    ("benchmark", benchmark),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage gives for the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialised(docs, name)
    return docs
