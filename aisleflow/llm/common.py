"""What the operators share: tables that cut lineage, and words and windows as arrays."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aisleflow.session import work_folder

U64 = np.uint64
CACHE_WORDS = 300_000


def bucketed(df: DataFrame, purpose: str, column: str) -> DataFrame:
    """Like ``materialised``, as a table that joins and groups by ``column`` read without a shuffle."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    if _recorded is not None:
        _recorded.append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(_table_name(path))
    return spark.table(_table_name(path))


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


_recorded: list[str] | None = None


@contextmanager
def recorded_tables():
    """Collects the folders that ``materialised`` writes meanwhile, for ``remove_tables``."""
    global _recorded
    before, _recorded = _recorded, []
    try:
        yield _recorded
    finally:
        _recorded = before


def remove_tables(spark: SparkSession, folders: list[str]) -> None:
    """Delete tables that ``materialised`` wrote, on whatever file system they are."""
    context = spark.sparkContext
    for folder in folders:
        spark.sql(f"DROP TABLE IF EXISTS `{_table_name(folder)}`")
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back.

    It cuts lineage with a table every executor can read again, so a lost
    executor costs no more than the tasks it was running. Generated ids are
    fixed from then on.
    """
    path = work_folder(df.sparkSession, purpose)
    if _recorded is not None:
        _recorded.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reach_package(spark: SparkSession) -> None:
    """Put this package on the path of Python workers that are started in another folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """A text key of a document row's doc_id and text; equal rows have equal keys."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\x00"))
    return F.md5(F.concat(told("doc_id"), F.lit("\x01"), told("text")))


def work_groups(sizes, most: int):
    """Neighbouring items as (start, end) groups of about ``most`` units; a larger item stands alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


class WordHashes(dict):
    """64-bit hashes of byte words. A bounded memo; forgetting a word costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose every bit depends on every bit of the input."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` neighbouring values, by doubling; empty if there are fewer."""
    if len(values) < k:
        return np.zeros(0, U64)
    power, span, part = 0x9E3779B97F4A7C15, 1, mixed(values)
    done, length = None, 0
    while True:
        if k & span:
            if done is None:
                done, length = part, span
            else:
                n = len(values) - length - span + 1
                done = done[:n] * U64(power) + part[length : length + n]
                length += span
        if span * 2 > k:
            return mixed(done)
        n = len(part) - span
        part = part[:n] * U64(power) + part[span : span + n]
        power, span = power * power % 2**64, span * 2


def sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over each run of ``width`` neighbours, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return op(out[: len(out) - rest], out[rest:]) if rest else out
