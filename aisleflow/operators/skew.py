"""Joins and row expansion that stay even when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join row-grain facts with a lookup by equality, facts being the kept side.

    The strategy is found when the join runs, from what was measured by then: a lookup that is
    small is broadcast, and of a shuffled join adaptive execution cuts partitions that a hot
    key (or rows without a key) made large into pieces of the advisory size, each joined with the
    same lookup rows. Facts are the side that may be cut in each of the kinds allowed here. Nothing is looked
    at while the plan is built, and no list of hot keys has a limit.
    ``session.ENGINE_CONF`` lets the cut cost another shuffle where a grouping follows.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"facts must be the kept side, not {how}")
    return facts.join(lookup, on, how)


def repeat_rows(df: DataFrame, count_column: str, chunk: int = 10_000) -> DataFrame:
    """Each row as often as its count says.

    Large counts are cut into chunks that are dealt out before they are
    written out, so a count of any size never lands in one task.
    """
    others = [c for c in df.columns if c != count_column]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(count_column) - 1, F.lit(chunk).cast("bigint"))
    chunks = (
        df.filter(F.col(count_column) > 0)
        .select("*", F.explode(starts).alias("_start"))
        .select(*others, "_start", F.least(F.lit(chunk), F.col(count_column) - F.col("_start")).alias("_n"))
        .repartition(partitions, *others, "_start")
    )
    return chunks.select(*others, F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int")))).select(*others)
