"""The retail stream: messages in, daily products out, one micro-batch at a time.

A batch archives its lines, parses them once and writes what it adds to the state
logs under its batch id in one job. From the merged facts of the days it touched and its
own it then rewrites those days' products, and beside that their merged facts. Log folders
are overwritten by a replay, which is made from the logs up to the batch, so each event
counts once however often the batch is run. A late event changes the products of its own day.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aisleflow.model import EVENTS_TABLE, FACT_VIEWS, MONTHLY_VISIT, PRODUCT_COLUMNS, PRODUCT_TABLES, STORE_USER, with_text_ids
from aisleflow.plans import allergens, sales, visitors
from aisleflow.plans.facts import batch_facts
from aisleflow.plans.products import daily_products
from aisleflow.sources.events import (
    CURRENT,
    Generation,
    checkout_rows,
    dead_letter,
    location_rows,
    parse_messages,
    to_current_checkout,
    to_current_location,
)
from aisleflow.sources.tables import overwrite_table, read_table
from aisleflow.streaming.state import DayState, FactView, StateLog, fact_rows, last_compacted, mark_compacted, only_days

TRIGGER = "3 seconds"
ARCHIVE_ROW_GROUP = 16 << 20  # bytes before compression

INDICATOR_LOGS = ["userProfile", "userIndicatorPurchases"]


def run_together(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Independent writes as concurrent Spark jobs; a failure of any is raised."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        for running in [pool.submit(in_session(job)) for job in jobs]:
            running.result()


def _names(fields: str) -> list[str]:
    return [part.split()[0] for part in fields.split(", ")]


def _trigger(available_now: bool, every: str) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": every}


def for_each_batch(
    lines: DataFrame, run, checkpoint: str, available_now: bool = False, every: str = TRIGGER
) -> StreamingQuery:
    """Run ``run(batch_df, batch_id)`` per micro-batch; progress is kept in the checkpoint."""
    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, every)).start()


def archive_raw_messages(lines: DataFrame, root: str, batch_id: int) -> str:
    """Keep every line as it came, before anything is parsed; gives the archive's folder.

    Small row groups let many tasks parse a large file.
    """
    folder = f"{root}/message/batch_id={batch_id}"
    kept = lines.select(F.col("value").alias("msg")).write.mode("overwrite")
    kept.option("parquet.block.size", ARCHIVE_ROW_GROUP).parquet(folder)
    return folder


def raw_messages(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/message", "msg STRING, batch_id BIGINT").select("msg")


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/dead_letter", "value STRING, problem STRING, batch_id BIGINT").drop("batch_id")


@dataclass(frozen=True)
class RetailStream:
    """Where a stream keeps its tables and how it counts.

    First visits come from the visits this stream has seen and, if named, the
    ``events_path`` table another system fills. Visits are stored untyped and
    typed when a product is made, so an event that moves a user's first visit
    also corrects the day it was on before. ``indicators`` switches
    allergy notifications on. ``state`` names the folder of the state logs when
    it is not the one below ``root``, as after a compaction. ``generation`` is
    that of the messages; where its ids are text they stay text in every table.
    ``monthly`` adds visit counts per user and month; a batch rewrites the months it touched.
    """

    spark: SparkSession
    root: str
    dims: DataFrame
    events_path: str | None = None
    entry_only: bool = True
    legacy: bool = False
    indicators: DataFrame | None = None
    state: str | None = None
    generation: Generation = CURRENT
    monthly: bool = False

    @property
    def state_folder(self) -> str:
        return self.state or f"{self.root}/state"

    @cached_property
    def compacted_to(self) -> int:
        return last_compacted(self.spark, self.state_folder)

    @cached_property
    def days(self) -> DayState:
        return DayState(self.log("facts"), self.state_folder)

    @cached_property
    def own_dims(self) -> DataFrame:
        """The dimension with ids of the messages' kind."""
        if not self.generation.text_ids:
            return self.dims
        return self.dims.withColumns({c: F.col(c).cast("string") for c in ("rackId", "categoryId")})

    def _typed(self, fields: str) -> str:
        return with_text_ids(fields) if self.generation.text_ids else fields

    def log(self, table: str) -> StateLog | FactView:
        own = "facts" if table in FACT_VIEWS else table
        log = StateLog(self.spark, self.state_folder, own, self.generation.text_ids, self.compacted_to)
        return FactView(log, table) if table in FACT_VIEWS else log

    def product(self, name: str) -> DataFrame:
        """A product's rows; none if no batch has written any yet."""
        rows = read_table(self.spark, f"{self.root}/product", f"{self._typed(PRODUCT_COLUMNS)}, product STRING, event_date DATE")
        return rows.filter(F.col("product") == name).select(*_names(PRODUCT_TABLES[name]))

    def start(self, lines: DataFrame, available_now: bool = False, every: str = TRIGGER) -> StreamingQuery:
        return for_each_batch(lines, self.process, f"{self.root}/checkpoint", available_now, every)

    def start_archive(self, lines: DataFrame, available_now: bool = False, every: str = TRIGGER) -> StreamingQuery:
        """Keep every line by a query of its own, which never waits for products."""
        kept = lines.select(F.col("value").alias("msg")).writeStream.format("parquet")
        kept = kept.option("checkpointLocation", f"{self.root}/archive-checkpoint").trigger(**_trigger(available_now, every))
        return kept.start(f"{self.root}/archive")

    def start_from_archive(self, available_now: bool = False, every: str = TRIGGER) -> StreamingQuery:
        """Make products from what ``start_archive`` has kept, at their own pace and with their own checkpoint."""
        kept = self.spark.readStream.schema("msg STRING").parquet(f"{self.root}/archive").withColumnRenamed("msg", "value")
        return for_each_batch(kept, self.process_kept, f"{self.root}/checkpoint", available_now, every)

    def archived(self) -> DataFrame:
        """The lines that ``start_archive`` has kept."""
        return read_table(self.spark, f"{self.root}/archive", "msg STRING")

    def process(self, lines: DataFrame, batch_id: int) -> None:
        # Parsing reads the archive, so the source is read once per batch.
        archive = archive_raw_messages(lines, self.root, batch_id)
        self.process_kept(read_table(self.spark, archive, "msg STRING").withColumnRenamed("msg", "value"), batch_id)

    def process_kept(self, lines: DataFrame, batch_id: int) -> None:
        """Products from lines that are archived already."""
        parsed = parse_messages(lines, self.generation)
        # Only dead letters need their text; the other lines are kept by their fields alone.
        parsed = parsed.withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value"))).persist()
        try:
            # One job alone parses and fills the cache; jobs side by side would wait for each other or parse twice.
            self._write_dead_letters(parsed, batch_id)
            stamp = F.coalesce("location.createdStamp", "checkout.createdStamp")
            usable = parsed.filter(F.col("problem").isNull() & stamp.isNotNull())
            location, checkouts = self._events(parsed)
            self.days.seed(batch_id)
            follows = self.days.follows(batch_id)
            before = self.days.newest() if follows else self.log("facts").as_of(batch_id - 1)
            touched = self._touched_days(usable.select(F.to_date(stamp).alias("event_date")), location, before)
            items = sales.order_items(checkouts)
            found: list = []  # at most the calendar's days
            run_together(self.spark, [
                lambda: found.extend(touched.collect()),
                lambda: self.log("facts").write_batch(batch_facts(location, items, self.own_dims), batch_id),
                *self._indicator_writes(items, batch_id),
            ])
            days, own_days = sorted(r.event_date for r in found), [r.event_date for r in found if r.own]
            facts = before.unionByName(self.log("facts").batch(batch_id)) if follows else self.log("facts").as_of(batch_id)
            run_together(self.spark, [
                lambda: self._write_products(facts, days),
                *([lambda: self.days.write(facts, own_days, batch_id)] if batch_id > self.compacted_to else []),
                *([lambda: self._write_months(facts, days)] if self.monthly and days else []),
                *self._notification_writes(items, batch_id),
            ])
        finally:
            parsed.unpersist()

    def _events(self, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
        location = location_rows(parsed, self.generation)
        checkouts = checkout_rows(parsed, self.generation)
        if self.generation is not CURRENT:
            location, checkouts = to_current_location(location), to_current_checkout(checkouts)
        return visitors.entry_events(location) if self.entry_only else location, checkouts

    def _write_dead_letters(self, parsed: DataFrame, batch_id: int) -> None:
        dead_letter(parsed).write.mode("overwrite").parquet(f"{self.root}/dead_letter/batch_id={batch_id}")

    def _indicator_writes(self, items: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        if self.indicators is None:
            return []
        logs = {
            "userProfile": allergens.user_profile(items, self.own_dims, self.legacy),
            "userIndicatorPurchases": allergens.indicator_facts(items, self.own_dims, self._own_indicators()),
        }
        return [lambda t=t, df=df: self.log(t).write_batch(df, batch_id) for t, df in logs.items()]

    def _own_indicators(self) -> DataFrame:
        kind = "string" if self.generation.text_ids else "bigint"
        return self.indicators.withColumn("productId", F.col("productId").cast(kind))

    def _touched_days(self, own: DataFrame, location: DataFrame, before: DataFrame) -> DataFrame:
        """The batch's own days, and the first day so far of each user whose first visit it moves back."""
        first = visitors.user_first_visit(location).withColumnRenamed("firstTime", "new_first")
        known = fact_rows(before, "userFirstVisit").groupBy(*STORE_USER).agg(F.min("firstTime").alias("old_first"))
        moved = first.join(known, STORE_USER).filter(F.to_date("new_first") < F.to_date("old_first"))
        days = own.withColumn("own", F.lit(True)).unionByName(
            moved.select(F.to_date("old_first").alias("event_date"), F.lit(False).alias("own"))
        )
        return days.groupBy("event_date").agg(F.max("own").alias("own"))

    def _visits_seen(self, facts: DataFrame) -> DataFrame:
        """Times of visits that may be a user's first, by this stream's facts and the events table."""
        seen = fact_rows(facts, "userFirstVisit").drop("event_date")
        if self.events_path:
            events = read_table(self.spark, self.events_path, self._typed(EVENTS_TABLE))
            events = visitors.entry_events(events) if self.entry_only else events
            seen = seen.unionByName(events.select(*STORE_USER, F.col("createdStamp").alias("firstTime")))
        return seen

    def _write_products(self, facts: DataFrame, days: list[date]) -> None:
        """All products of the touched days, by one job from one reading of the facts."""
        if not days:
            return
        rows = daily_products(only_days(facts, days), self._visits_seen(facts), self.legacy)
        dated = rows.withColumn("event_date", F.to_date("time"))
        names = [c for c in [*_names(PRODUCT_COLUMNS), "product", "event_date"] if c in dated.columns]
        # One file per day holds all products, by product, so that a reader skips the row groups of others.
        laid = dated.select(*names).hint("rebalance", "event_date").sortWithinPartitions("event_date", "product")
        overwrite_table(laid, f"{self.root}/product", ["event_date"])

    def _write_months(self, facts: DataFrame, days: list[date]) -> None:
        """Visit counts per store, user and month of the months the days are in."""
        visits = fact_rows(facts, "userVisit")
        months = sorted({d.replace(day=1) for d in days})
        month = F.trunc("event_date", "month")
        own = visits.filter(month.isin(months)).withColumn("event_month", month).drop("event_date")
        counts = visitors.counted_by_grain(own, "month", self.legacy)
        dated = counts.withColumn("event_month", F.make_date(*self._month_start()))
        overwrite_table(dated.hint("rebalance", "event_month"), f"{self.root}/monthlyVisit", ["event_month"])

    def monthly_visits(self) -> DataFrame:
        """Visit counts per store, user and month, as the batches so far have them."""
        fields = self._typed(MONTHLY_VISIT)
        return read_table(self.spark, f"{self.root}/monthlyVisit", f"{fields}, event_month DATE").drop("event_month")

    def _month_start(self) -> tuple[Column, Column, Column]:
        """The day a monthly row is filed under, from its year and month."""
        back = 1900 if self.legacy else 0
        return F.col("year") + F.lit(back), F.col("month") + F.lit(1 if self.legacy else 0), F.lit(1)

    def _notification_writes(self, items: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        """Notifications for the users who bought something in this batch."""
        if self.indicators is None:
            return []
        users = items.select("userId").distinct()
        counted = self.log("userIndicatorPurchases").as_of(max(batch_id, self.compacted_to))
        rows = allergens.notifications_of(counted.join(users, "userId", "left_semi"))
        path = f"{self.root}/notification/batch_id={batch_id}"
        return [lambda: rows.write.mode("overwrite").parquet(path)]

    def notifications(self) -> DataFrame:
        return read_table(
            self.spark,
            f"{self.root}/notification",
            "userId STRING, purchasedCount BIGINT, Allergy STRING, batch_id BIGINT",
        )

    def compact(self, batch_id: int, state: str) -> RetailStream:
        """This stream with its logs up to the batch merged into a new state folder."""
        tables = ["facts"] if self.indicators is None else ["facts", *INDICATOR_LOGS]
        run_together(self.spark, [lambda t=t: self.log(t).compact(batch_id, state) for t in tables])
        mark_compacted(self.spark, state, batch_id)
        return replace(self, state=state)


def distinct_daily_visitors(location: DataFrame, late_by: str = "1 day") -> DataFrame:
    """Distinct visitors per store and day, counted by the stream itself and not from logs.

    Exact for events no later than ``late_by`` of at least a day: a user's key is forgotten
    that long after the user's first event of the day, when any other event of that day is
    too late to be taken. To be written in complete mode.
    """
    ts = F.col("createdStamp").cast("timestamp")
    visits = location.filter(F.col("userId").isNotNull()).withColumns({"ts": ts, "time": F.date_trunc("day", "createdStamp").cast("timestamp_ntz")})
    once = visits.withWatermark("ts", late_by).dropDuplicatesWithinWatermark([*STORE_USER, "time"])
    return once.groupBy("orgId", "storeId", "time").agg(F.count(F.lit(1)).alias("visitors"))


def write_complete(counts: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = TRIGGER) -> StreamingQuery:
    """Rewrite a table with all counts so far, batch by batch."""
    keep = lambda batch, _: overwrite_table(batch, path)
    writer = counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, every)).start()


def footfall_30s_counts(location: DataFrame, late_by: str = "1 minute") -> DataFrame:
    """Footfall per rack and 30-second bucket on a stream, closed once ``late_by`` has passed."""
    events = location.withColumn("ts", F.col("createdStamp").cast("timestamp")).withWatermark("ts", late_by)
    return events.groupBy(F.window("ts", "30 seconds").alias("w"), "rackId").count().select(
        "rackId", F.col("w.start").alias("bucket"), F.col("count").alias("footfall")
    )
