"""State logs: what each micro-batch added, kept as parquet by batch and event day.

A batch writes its own folder and overwrites it when it is run again, so a
replayed batch changes nothing. Reading as of a batch takes folders up to it, and
what a compaction merged. All facts of a batch are one log, written by one job.
Beside the log, the facts of each day are kept merged, so that a batch reads one
version of a day instead of everything the log has of it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from aisleflow.model import FACT_VIEWS, STATE_TABLES, with_text_ids
from aisleflow.plans.facts import merged
from aisleflow.sources.tables import overwrite_table, read_table

NO_BATCH = -1

# How the rows of several batches of a log become fewer rows of the same meaning.
MERGE = {
    "facts": merged,
    "userIndicatorPurchases": lambda df: df.groupBy("userId", "time").agg(
        F.sum("purchasedCount").alias("purchasedCount")
    ),
    "userProfile": lambda df: df,
}


def _time_column(table: str) -> str:
    return "orderTimestamp" if table == "userProfile" else "time"


def _columns(table: str) -> list[str]:
    return [part.split()[0] for part in STATE_TABLES[table].split(", ")]


class StateLog:
    """One log below a folder all executors can reach.

    A compacted folder holds the merged rows of all batches up to
    ``compacted_to`` in a base of its own. A batch up to there, run again, writes
    nothing: the base has its rows.
    """

    def __init__(self, spark: SparkSession, folder: str, table: str, text_ids: bool = False, compacted_to: int = NO_BATCH):
        self.spark = spark
        self.table = table
        self.schema = with_text_ids(STATE_TABLES[table]) if text_ids else STATE_TABLES[table]
        self.tags = ["table"] if table == "facts" else []
        self.columns = [*self.tags, *_columns(table)]
        if self.tags:
            self.schema += ", table STRING"
        self.path = f"{folder}/{table}"
        self.base = f"{folder}/base/{table}"
        self.compacted_to = compacted_to

    def _write(self, df: DataFrame, path: str) -> None:
        dated = df.select(*self.columns).withColumn("event_date", F.to_date(_time_column(self.table)))
        # Rebalancing by day gives few files per day and splits a day too large for one; tags lie together.
        laid = dated.hint("rebalance", "event_date").sortWithinPartitions("event_date", *self.tags)
        laid.write.mode("overwrite").partitionBy("event_date").parquet(path)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        if batch_id > self.compacted_to:
            self._write(df, f"{self.path}/batch_id={batch_id}")

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of one batch, with ``event_date``; no other batch's folder is listed."""
        rows = read_table(self.spark, f"{self.path}/batch_id={batch_id}", f"{self.schema}, event_date DATE")
        return rows.select(*self.columns, "event_date")

    def as_of(self, batch_id: int) -> DataFrame:
        """All rows of the batches up to and including this one, with ``event_date``."""
        rows = read_table(self.spark, self.path, f"{self.schema}, batch_id BIGINT, event_date DATE")
        rows = rows.filter(F.col("batch_id").between(self.compacted_to + 1, batch_id))
        base = read_table(self.spark, self.base, f"{self.schema}, event_date DATE")
        return rows.select(*self.columns, "event_date").unionByName(base.select(*self.columns, "event_date"))

    def compact(self, batch_id: int, folder: str) -> None:
        """Merge the batches up to this one into the base of a new folder; the old one is left as it is."""
        merged = MERGE[self.table](self.as_of(batch_id).select(*self.columns))
        self._write(merged, StateLog(self.spark, folder, self.table).base)


class DayState:
    """The facts of each day, merged over the batches so far.

    A day has two slots, and a batch writes the one that does not hold the newest
    version before it: what a batch reads is never what it writes. The log stays the
    truth. A batch run again, one older than a version, and one that a compaction
    holds are made from the log; a version newer than the batch is left as it is.
    ``versions`` says which batch wrote which slot, two entries a calendar day at most.
    """

    SLOTS = (0, 1)

    def __init__(self, log: StateLog, folder: str):
        self.log, self.spark, self.path = log, log.spark, f"{folder}/days"
        self.versions: dict[date, dict[int, int]] = {}
        for r in self._rows().groupBy("event_date", "slot").agg(F.max("batch").alias("batch")).collect():
            self.versions.setdefault(r.event_date, {})[r.slot] = r.batch

    def _rows(self) -> DataFrame:
        return read_table(self.spark, self.path, f"{self.log.schema}, batch BIGINT, event_date DATE, slot INT")

    def seed(self, batch_id: int) -> None:
        """Merge what the log has of earlier batches where there is no state yet, as after a compaction."""
        if not self.versions and batch_id > max(self.log.compacted_to, 0):
            before = self.log.as_of(batch_id - 1)
            days = [r.event_date for r in before.select("event_date").distinct().collect()]
            self.write(before, [d for d in days if d], batch_id - 1)

    def follows(self, batch_id: int) -> bool:
        """Whether all versions are of earlier batches, so that they and the batch's own facts are everything."""
        versions = (b for slots in self.versions.values() for b in slots.values())
        return batch_id > self.log.compacted_to and all(b < batch_id for b in versions)

    def newest(self) -> DataFrame:
        """The newest version of every day; files of other versions are not read."""
        held = F.lit(False)
        for slot in self.SLOTS:
            days = [d for d, slots in self.versions.items() if max(slots, key=slots.get) == slot]
            if days:
                held |= (F.col("slot") == slot) & F.col("event_date").isin(days)
        return self._rows().filter(held).select(*self.log.columns, "event_date")

    def _slot(self, day: date, batch_id: int) -> int:
        """Where a batch writes a day: its own slot again, or the one without the newest version."""
        slots = self.versions.get(day, {})
        own = [s for s, b in slots.items() if b == batch_id]
        return own[0] if own else 1 - max(slots, key=slots.get) if slots else 0

    def write(self, facts: DataFrame, days: list[date], batch_id: int) -> None:
        """The days' facts up to the batch as its version, but for days that have a newer one."""
        slot_of = {
            d: self._slot(d, batch_id) for d in days if all(b <= batch_id for b in self.versions.get(d, {}).values())
        }
        if not slot_of:
            return
        rows = merged(only_days(facts, list(slot_of)).select(*self.log.columns)).select(*self.log.columns)
        day = F.to_date(_time_column(self.log.table))
        in_second = day.isin([d for d, s in slot_of.items() if s == 1])
        versioned = rows.withColumns({
            "batch": F.lit(batch_id).cast("bigint"), "event_date": day, "slot": F.when(in_second, 1).otherwise(0)
        })
        laid = versioned.hint("rebalance", "event_date").sortWithinPartitions("event_date", *self.log.tags)
        overwrite_table(laid, self.path, ["event_date", "slot"])
        for d, slot in slot_of.items():
            self.versions.setdefault(d, {})[slot] = batch_id


def fact_rows(facts: DataFrame, table: str) -> DataFrame:
    """The rows of one fact table, with ``event_date``; row groups of other facts are skipped."""
    tag, columns = FACT_VIEWS[table]
    return facts.filter(F.col("table") == tag).selectExpr(*columns, "event_date")


class FactView:
    """One fact table as if it had a log of its own."""

    def __init__(self, facts: StateLog, table: str):
        self.facts, self.table = facts, table

    def as_of(self, batch_id: int) -> DataFrame:
        return fact_rows(self.facts.as_of(batch_id), self.table)


def mark_compacted(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Say up to which batch the bases of a folder reach; written when all of them are."""
    spark.createDataFrame([(batch_id,)], "batch_id BIGINT").write.mode("overwrite").parquet(f"{folder}/compacted")


def last_compacted(spark: SparkSession, folder: str) -> int:
    last = read_table(spark, f"{folder}/compacted", "batch_id BIGINT").agg(F.max("batch_id")).first()[0]
    return NO_BATCH if last is None else last


def only_days(log: DataFrame, days: list[date]) -> DataFrame:
    """Log rows of the given days; they are the log's partitions, so other days' files are not read."""
    return log.filter(F.col("event_date").isin(days))
