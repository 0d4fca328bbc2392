"""Every query by name: (spark, star schema folder) to a DataFrame over whole tables.

Amounts are rounded to cents here, at the edge, because sums of doubles depend
on their order in the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aisleflow.functions import dates, retail
from aisleflow.model import EVENTS_TABLE, STORE_DAY, STORE_USER
from aisleflow.operators import aggregates, joins
from aisleflow.plans import allergens, conversion, footfall, sales, visitors
from aisleflow.session import work_folder
from aisleflow.sources import events as messages
from aisleflow.sources import star_schema as star
from aisleflow.sources.dimensions import load_dimensions
from aisleflow.sources.streams import read_event_stream
from aisleflow.sources.tables import append_table, overwrite_table, read_table
from aisleflow.streaming.retail import (
    RetailStream,
    dead_letters,
    distinct_daily_visitors,
    footfall_30s_counts,
    for_each_batch,
    raw_messages,
    write_complete,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
MIN_ORDERS = 10


def named(name: str):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def query(run: Query) -> Query:
    return named(run.__name__)(run)


def _cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


def _dims(spark, d):
    return joins.rack_category_dim(star.racks(spark, d), star.category(spark, d))


def _location(spark, d):
    """Location events as (history, current)."""
    return star.split_time(star.location_events(spark, d))


def _purchases(spark, d):
    """Purchase events as (history, current)."""
    return star.split_time(star.purchase_items(spark, d))


def _events(spark, d):
    return star.table(spark, d, "events")


# --- sources, sinks and streams ------------------------------------------------

_streamed: dict[tuple[str, str], RetailStream] = {}


def _files_per_quarter(spark) -> int:
    """So many files that four times as many keep all cores busy."""
    return -(-spark.sparkContext.defaultParallelism // 4)


def _message_folder(spark, d) -> str:
    """Message lines as four times ``_files_per_quarter`` text files, as a folder would receive them."""
    folder = work_folder(spark, "messages")
    star.message_lines(spark, d, 4 * _files_per_quarter(spark)).write.text(folder)
    return folder


def _dealt(spark, lines: DataFrame, n: int) -> list[DataFrame]:
    """Lines in n parts by their hash, made once and stored for all of them."""
    folder = work_folder(spark, "dealt")
    lines.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(n)).cast("int")).write.partitionBy("part").parquet(folder)
    stored = read_table(spark, folder, "value STRING, part INT")
    return [stored.filter(F.col("part") == k).select("value") for k in range(n)]


def _stream(spark, d) -> RetailStream:
    """The retail stream run over all messages, half of the files a batch; once per session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _streamed:
        root = work_folder(spark, "retail")
        events = f"{root}/events"
        whole_seconds = F.substring(F.col("createdStamp").cast("string"), 1, 19).cast("timestamp_ntz")
        star.to_location_events(star.spread_events(spark, d)).withColumn("createdStamp", whole_seconds).write.parquet(events)
        dims = load_dimensions(star.racks(spark, d), star.category(spark, d))
        stream = RetailStream(
            spark, root, dims, events_path=events, indicators=star.rack_indicators(spark, d), monthly=True
        )
        lines = read_event_stream(spark, _message_folder(spark, d), max_files_per_trigger=2 * _files_per_quarter(spark))
        stream.start(lines, available_now=True).awaitTermination()
        _streamed[key] = stream
    return _streamed[key]


def _last_batch(stream: RetailStream) -> int:
    return stream.spark.read.parquet(f"{stream.root}/message").agg(F.max("batch_id")).first()[0]


@named("read_event_stream")
def read_event_stream_lines(spark, d):
    root = work_folder(spark, "lines")
    lines = read_event_stream(spark, _message_folder(spark, d))
    running = (
        lines.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/lines")
    )
    running.awaitTermination()
    return read_table(spark, f"{root}/lines", "value STRING")


@query
def micro_batch(spark, d):
    """Lines per event type, counted batch by batch."""
    root = work_folder(spark, "counts")

    def count_types(lines, batch_id):
        counts = messages.event_type(lines).groupBy("eventType").count()
        counts.write.mode("overwrite").parquet(f"{root}/counts/batch_id={batch_id}")

    lines = read_event_stream(spark, _message_folder(spark, d), max_files_per_trigger=_files_per_quarter(spark))
    for_each_batch(lines, count_types, f"{root}/checkpoint", available_now=True).awaitTermination()
    counts = read_table(spark, f"{root}/counts", "eventType STRING, count BIGINT, batch_id BIGINT")
    return counts.groupBy("eventType").agg(F.sum("count").alias("lines"))


@named("raw_messages")
def raw_message_archive(spark, d):
    return raw_messages(spark, _stream(spark, d).root)


@query
def stream_dead_letters(spark, d):
    """Problems of lines of which most are unusable, found by the stream."""
    stream = RetailStream(spark, work_folder(spark, "damaged"), _dims(spark, d))
    stream.process(star.damaged_lines(spark, d), 0)
    return dead_letters(spark, stream.root).groupBy("problem").agg(F.count("*").alias("lines"))


@query
def stream_string_ids(spark, d):
    """Footfall of messages with text ids: organisations 1 and org1 stay apart."""
    stream = RetailStream(spark, work_folder(spark, "texts"), _dims(spark, d), generation=messages.STRING_IDS)
    stream.process(star.string_id_lines(spark, d), 0)
    return stream.product("dailyCategoryFootfall")


@query
def stream_compacted_replay(spark, d):
    """Visits after two batches, a compaction, the second batch again, and a third one."""
    parts = _dealt(spark, star.message_lines(spark, d), 3)
    root = work_folder(spark, "compacted")
    stream = RetailStream(spark, root, _dims(spark, d))
    stream.process(parts[0], 0)
    stream.process(parts[1], 1)
    stream = stream.compact(1, f"{root}/state-2")
    stream.process(parts[1], 1)
    stream.process(parts[2], 2)
    return stream.product("dailyVisit")


@query
def stream_new_repeat_daily(spark, d):
    return _stream(spark, d).product("newRepeatDaily")


@query
def stream_monthly_repeat_visitors(spark, d):
    """Users seen more than once in a month, from the table the stream rewrites by month."""
    return visitors.repeat_by_count(_stream(spark, d).monthly_visits())


@query
def stream_monthly_new_visitors(spark, d):
    return visitors.new_by_count(_stream(spark, d).monthly_visits())


@query
def stream_legacy(spark, d):
    """Visits from messages of the oldest generation, in two batches."""
    stream = RetailStream(spark, work_folder(spark, "oldest"), _dims(spark, d), generation=messages.LEGACY)
    for batch_id, part in enumerate(_dealt(spark, star.legacy_lines(spark, d), 2)):
        stream.process(part, batch_id)
    return stream.product("dailyVisit")


@query
def stream_mixed_generations(spark, d):
    """Visits and sales of one stream whose batches hold lines of all three generations."""
    stream = RetailStream(spark, work_folder(spark, "mixed"), _dims(spark, d), generation=messages.MIXED)
    for batch_id, part in enumerate(_dealt(spark, star.mixed_lines(spark, d), 2)):
        stream.process(part, batch_id)
    visits = stream.product("dailyVisit").select(
        F.lit("visits").alias("product"), "orgId", "storeId", "time", F.col("userId").alias("key"), F.col("VisitCount").alias("n")
    )
    sold = stream.product("dailyCategorySaleWithCountAgg").select(
        F.lit("units").alias("product"), "orgId", "storeId", "time", F.col("categoryId").alias("key"), F.col("saleCountAgg").alias("n")
    )
    return visits.unionAll(sold)


@query
def stream_footfall_30s(spark, d):
    """Footfall per rack and 30 seconds, of buckets that closed behind the watermark."""
    root = work_folder(spark, "buckets")
    lines = read_event_stream(spark, _message_folder(spark, d))
    counts = footfall_30s_counts(messages.parse_location_events(lines))
    running = (
        counts.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/counts")
    )
    running.awaitTermination()
    return read_table(spark, f"{root}/counts", "rackId INT, bucket TIMESTAMP_NTZ, footfall BIGINT")


@query
def stream_distinct_visitors(spark, d):
    """Distinct visitors per store and day, of messages that all come twice, by native streaming distinct."""
    root = work_folder(spark, "distinct")
    folder = f"{root}/messages"
    twice = F.explode(F.array(F.col("value"), F.col("value"))).alias("value")
    star.message_lines(spark, d, 4 * _files_per_quarter(spark)).select(twice).write.text(folder)
    counts = distinct_daily_visitors(messages.parse_location_events(read_event_stream(spark, folder)))
    write_complete(counts, f"{root}/counts", f"{root}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{root}/counts", "orgId INT, storeId INT, time TIMESTAMP_NTZ, visitors BIGINT")


@query
def stream_chained(spark, d):
    """Visits per user and day by a second stream, which reads the archive that the first one writes."""
    stream = RetailStream(spark, work_folder(spark, "chained"), _dims(spark, d))
    lines = read_event_stream(spark, _message_folder(spark, d), max_files_per_trigger=2 * _files_per_quarter(spark))
    stream.start_archive(lines, available_now=True).awaitTermination()
    stream.start_from_archive(available_now=True).awaitTermination()
    return stream.product("dailyVisit")


@named("for_each_batch")
def for_each_batch_products(spark, d):
    return _stream(spark, d).product("dailyVisit")


@query
def stream_daily_category_footfall(spark, d):
    return _stream(spark, d).product("dailyCategoryFootfall")


@query
def stream_daily_category_sale_summary(spark, d):
    return _cents(_stream(spark, d).product("dailyCategorySaleWithCountAgg"), "saleAmountAgg")


@query
def stream_daily_visitors(spark, d):
    return _stream(spark, d).product("dailyVisitors")


@query
def stream_daily_visitors_category_wise(spark, d):
    return _stream(spark, d).product("dailyVisitorsCategoryWise")


@query
def stream_user_profile(spark, d):
    stream = _stream(spark, d)
    profile = stream.log("userProfile").as_of(_last_batch(stream)).drop("event_date")
    return profile.select("userId", "orderId", "productId", "quantity", "categoryId", "orderTimestamp")


@query
def stream_allergy_notifications(spark, d):
    """The last notification of each user."""
    latest = F.max_by(F.struct("purchasedCount", "Allergy"), "batch_id").alias("n")
    return _stream(spark, d).notifications().groupBy("userId").agg(latest).select("userId", "n.*")


@named("read_table")
def read_table_rows(spark, d):
    path = work_folder(spark, "events")
    overwrite_table(star.location_events(spark, d), path)
    return read_table(spark, path, EVENTS_TABLE)


@named("append_table")
def append_table_rows(spark, d):
    path = work_folder(spark, "append")
    for part in _location(spark, d):
        append_table(footfall.footfall_facts(part, _dims(spark, d)), path)
    return aggregates.daily_category_totals(read_table(spark, path), footfallCount="footfall")


@named("overwrite_table")
def overwrite_table_days(spark, d):
    """Days counted from all events, then the current days' partitions replaced by their entries."""
    path = work_folder(spark, "overwrite")
    whole = visitors.daily_visit(star.location_events(spark, d))
    entries = visitors.daily_visit(visitors.entry_events(_location(spark, d)[1]))
    for rows in (whole, entries):
        overwrite_table(rows.withColumn("event_date", F.to_date("time")), path, ["event_date"])
    return read_table(spark, path).drop("event_date")


@named("load_dimensions")
def load_dimension_rows(spark, d):
    return load_dimensions(star.racks(spark, d), star.category(spark, d))


# --- parsing and routing -------------------------------------------------------

@query
def event_type(spark, d):
    return messages.event_type(star.message_lines(spark, d))


@query
def route_location(spark, d):
    return messages.route_location(star.message_lines(spark, d))


@query
def route_checkout(spark, d):
    return messages.route_checkout(star.message_lines(spark, d))


@query
def parse_location_events(spark, d):
    return messages.parse_location_events(star.message_lines(spark, d))


def _flat(checkouts: DataFrame) -> DataFrame:
    """Checkouts with their only item's fields beside them, its price as a number."""
    item = F.col("orderItems")[0]
    return checkouts.withColumns(
        {
            "items": F.size("orderItems"),
            "productId": item["productId"],
            "quantity": item["quantity"],
            "categoryId": item["categoryId"],
            "unitPrice": item["unitPrice"].try_cast("double"),
        }
    ).drop("orderItems")


@query
def parse_checkout_events(spark, d):
    return _flat(messages.parse_checkout_events(star.message_lines(spark, d)))


@query
def parse_string_id_events(spark, d):
    return messages.to_current_location(messages.parse_string_id_location(star.string_id_lines(spark, d)))


@query
def parse_string_id_checkouts(spark, d):
    rows = messages.parse_string_id_checkout(star.string_id_lines(spark, d))
    return _flat(messages.to_current_checkout(rows))


@query
def parse_legacy_events(spark, d):
    return messages.parse_legacy_location(star.legacy_lines(spark, d))


@query
def parse_legacy_checkouts(spark, d):
    return _flat(messages.parse_legacy_checkout(star.legacy_lines(spark, d)))


@query
def dead_letter(spark, d):
    return messages.dead_letter(messages.parse_messages(star.damaged_lines(spark, d)))


# --- projections ---------------------------------------------------------------

@query
def select_columns(spark, d):
    return star.location_events(spark, d).select("userId", "orgId", "createdStamp")


@query
def struct_field_access(spark, d):
    items = star.checkouts(spark, d).select("orderId", F.explode("orderItems").alias("Products"))
    return items.select("orderId", F.col("Products.productId"), F.col("Products.quantity"))


@query
def rename_column(spark, d):
    """The order's time keeps its name, the item's becomes orderTimestamp."""
    outer = star.checkouts(spark, d).withColumnRenamed("createdStamp", "outerStamp")
    items = outer.select("orderId", "outerStamp", F.explode("orderItems").alias("item"))
    return (
        items.select("orderId", "outerStamp", "item.productId", "item.createdStamp")
        .withColumnRenamed("createdStamp", "orderTimestamp")
        .withColumnRenamed("outerStamp", "createdStamp")
    )


@query
def constant_column(spark, d):
    return star.location_events(spark, d).select("eventId", F.lit(1).alias("footfall"))


@query
def derived_column(spark, d):
    items = star.checkout_items(spark, d)
    amount = F.round(retail.sale_amount("unitPrice", "quantity"), 2)
    return items.withColumn("saleAmount", amount).select("orderId", "productId", "saleAmount")


@query
def drop_columns(spark, d):
    return joins.location_with_category(star.location_events(spark, d), _dims(spark, d)).drop(
        "rackId", "categoryName"
    )


@query
def drop_side_column(spark, d):
    racks, category = star.racks(spark, d), star.category(spark, d)
    return racks.join(category, racks["rackId"] == category["rackId"]).drop(category["rackId"])


# --- filters -------------------------------------------------------------------

@query
def filter_entry_events(spark, d):
    return visitors.entry_events(star.location_events(spark, d))


def _typed_visits(spark, d):
    location = star.location_events(spark, d)
    return visitors.typed_visit_days(location, visitors.user_first_visit(location))


@query
def filter_visit_type(spark, d):
    return _typed_visits(spark, d).filter(F.col("visitType") == retail.REPEAT)


@query
def filter_min_orders(spark, d):
    return allergens.profile_users(star.allergen_purchases(spark, d), MIN_ORDERS)


@query
def filter_repeat_by_count(spark, d):
    return visitors.repeat_by_count(visitors.daily_visit(star.location_events(spark, d)))


@query
def filter_new_by_count(spark, d):
    return visitors.new_by_count(visitors.daily_visit(star.location_events(spark, d)))


@query
def null_guard(spark, d):
    """A missing text stays null where the function would fail on it."""
    text = F.when(F.col("event_id") % 5 != 0, F.col("text"))
    guarded = F.when(text.isNull(), F.lit(None)).otherwise(F.length(text))
    return star.visit_date_text(spark, d).select("event_id", guarded.alias("length"))


# --- joins ---------------------------------------------------------------------

@query
def rack_category_dim(spark, d):
    return _dims(spark, d)


@query
def location_with_category(spark, d):
    return joins.location_with_category(star.location_events(spark, d), _dims(spark, d))


def _sold(items):
    return items.select("userId", "storeId", "orderId", "productId", "categoryId", "quantity", "createdStamp")


@query
def items_with_category(spark, d):
    return _sold(joins.items_with_category(star.checkout_items(spark, d), _dims(spark, d)))


@query
def items_with_category_fanout(spark, d):
    return _sold(joins.items_with_category(star.checkout_items(spark, d), _dims(spark, d), fanout=True))


@query
def sale_count_with_amount(spark, d):
    items, dims = star.checkout_items(spark, d), _dims(spark, d)
    counts = sales.daily_category_sale_count(items, dims)
    amounts = sales.daily_category_sale_amount(items, dims)
    return _cents(joins.sale_count_with_amount(counts, amounts), "saleAmountAgg")


@query
def visits_with_first_visit(spark, d):
    location = star.location_events(spark, d)
    visits = location.select(*STORE_USER, F.col("createdStamp").alias("time"))
    return joins.visits_with_first_visit(visits, visitors.user_first_visit(location))


def _of_type(visit_types, kind, alias):
    return aggregates.distinct_users(visit_types.filter(F.col("visitType") == kind), STORE_DAY, alias)


@query
def new_repeat_outer(spark, d):
    types = _typed_visits(spark, d)
    return joins.new_repeat_outer(
        _of_type(types, retail.REPEAT, "repeated_visitors"), _of_type(types, retail.NEW, "new_visitors")
    )


@query
def total_converted_outer(spark, d):
    dims = _dims(spark, d)
    total = footfall.category_footfall(star.location_events(spark, d), dims)
    converted = conversion.converted_users(star.purchase_items(spark, d), dims)
    return joins.total_converted_outer(total.withColumnRenamed("footfallCount", "total"), converted)


@query
def store_conversion_join(spark, d):
    return conversion.store_conversion(
        star.location_events(spark, d), star.purchase_items(spark, d), _dims(spark, d)
    )


@query
def profiled_users(spark, d):
    profile = star.allergen_purchases(spark, d)
    rows = joins.profiled_users(allergens.profile_users(profile, MIN_ORDERS), profile)
    return rows.select("orgId", "storeId", "userId", "Allergens")


@query
def allergen_products(spark, d):
    purchases = star.checkout_items(spark, d).select("userId", "orderId", "productId", "quantity")
    return joins.allergen_products(purchases, star.allergen_indicators(spark, d))


@query
def allergen_profile_input(spark, d):
    return allergens.user_allergen_profile_input(
        star.checkout_items(spark, d), star.store_products(spark, d)
    )


QUERIES["user_allergen_profile_input"] = allergen_profile_input


@query
def minor_to_rack(spark, d):
    return joins.minor_to_rack(star.beacon_events(spark, d), star.beacons(spark, d))


@query
def minor_unknown(spark, d):
    return joins.unknown_codes(minor_to_rack(spark, d), "rackId").select("eventId", "minorId")


@query
def product_code_lookup(spark, d):
    return joins.product_code_lookup(star.coded_items(spark, d), star.product_codes(spark, d))


# --- aggregates ----------------------------------------------------------------

@query
def user_first_visit(spark, d):
    return visitors.user_first_visit(star.location_events(spark, d))


@query
def user_first_visit_entries(spark, d):
    return visitors.user_first_visit(star.location_events(spark, d), entry_only=True)


@query
def user_first_visit_incremental(spark, d):
    history, current = _location(spark, d)
    return aggregates.user_first_visit_incremental(current, visitors.user_first_visit(history))


@query
def daily_category_sale_lines(spark, d):
    return sales.daily_category_sale_lines(star.checkout_items(spark, d), _dims(spark, d))


@query
def converted_users(spark, d):
    history, current = _purchases(spark, d)
    dims = _dims(spark, d)
    return conversion.converted_users(current, dims, conversion.converted_facts(history, dims))


@query
def store_daily_visitors(spark, d):
    return conversion.store_daily_visitors(star.location_events(spark, d))


@query
def store_daily_converted(spark, d):
    return conversion.store_daily_converted(star.purchase_items(spark, d), _dims(spark, d))


@query
def user_order_count(spark, d):
    return aggregates.user_order_count(star.allergen_purchases(spark, d))


@query
def daily_visits_per_user(spark, d):
    return visitors.visits_by_grain(star.location_events(spark, d), "day")


@query
def monthly_visits_per_user(spark, d):
    return visitors.visits_by_grain(star.location_events(spark, d), "month")


@query
def yearly_visits_per_user(spark, d):
    return visitors.visits_by_grain(star.location_events(spark, d), "year")


@query
def yearly_visits_per_user_legacy(spark, d):
    return visitors.visits_by_grain(star.location_events(spark, d), "year_legacy", legacy=True)


@query
def new_repeat_flags_daily(spark, d):
    return aggregates.new_repeat_flag_totals(visitors.new_repeat_daily(star.location_events(spark, d)))


def _indicator_purchases(spark, d):
    return aggregates.indicator_purchases(allergen_products(spark, d))


@query
def indicator_purchases(spark, d):
    return _indicator_purchases(spark, d)


@query
def indicator_total(spark, d):
    return aggregates.indicator_total(_indicator_purchases(spark, d))


@query
def visit_type_pivot(spark, d):
    return aggregates.visit_type_pivot(_typed_visits(spark, d))


@query
def group_rows_by_user(spark, d):
    """One row per user and allergy text of the notified purchases."""
    flagged = _indicator_purchases(spark, d).withColumn("Allergy", retail.allergy_flag("count"))
    return flagged.select("userId", "Allergy").dropDuplicates(["userId", "Allergy"])


@query
def daily_product_count(spark, d):
    return aggregates.daily_product_count(star.checkout_items(spark, d))


@query
def distinct_rows(spark, d):
    profile = star.allergen_purchases(spark, d).select("orgId", "storeId", "userId", "Allergens")
    return allergens.explode_allergens(profile).distinct()


# --- set operations ------------------------------------------------------------

@query
def union_history(spark, d):
    history, current = (
        part.select(*STORE_USER, dates.trim_time("createdStamp").alias("time")) for part in _location(spark, d)
    )
    return aggregates.union_history(current, history)


@query
def union_profile(spark, d):
    """Stored purchases (events) before the current ones (line items)."""
    stored, current = star.purchase_items(spark, d), star.checkout_items(spark, d)
    return aggregates.union_history(stored.select(*allergens.PURCHASE), current)


# --- scalar functions ----------------------------------------------------------

def _on_events(name: str, **columns) -> None:
    """A query of one or more expressions over the events' time."""

    def run(spark, d):
        return _events(spark, d).select("event_id", *[make().alias(c) for c, make in columns.items()])

    QUERIES[name] = run


_spread_day = lambda: F.col("ts") + F.make_dt_interval((F.col("event_id") % 366).cast("int"))
_on_events("day_of", day=lambda: dates.day_of("ts"))
_on_events("month_of", month=lambda: dates.month_of(_spread_day()), legacy=lambda: dates.month_of(_spread_day(), True))
_on_events("year_of", year=lambda: dates.year_of(_spread_day()), legacy=lambda: dates.year_of(_spread_day(), True))
_on_events(
    "quarter_of",
    quarter=lambda: dates.quarter_of(_spread_day()),
    legacy=lambda: dates.quarter_of(_spread_day(), True),
)
_on_events("week_of_month", week=lambda: dates.week_of_month(_spread_day()))
_on_events("trim_time", time=lambda: dates.trim_time("ts"), legacy=lambda: dates.trim_time("ts", True))
_on_events(
    "time_delta_ms",
    delta=lambda: dates.time_delta_ms(
        F.col("ts") + F.expr("make_dt_interval(0, 0, 0, cast((event_id % 1999) / 1000000 as decimal(18, 6)))"),
        F.lit("2024-01-01 00:00:00.000900").cast("timestamp_ntz"),
    ),
)
_on_events("add_24h", next=lambda: dates.add_24h("ts"))
_on_events("new_flag", flag=lambda: retail.new_flag(F.col("event_id") % 4 - 1))
_on_events("repeat_flag", flag=lambda: retail.repeat_flag(F.col("event_id") % 4 - 1))
_on_events("allergy_flag", flag=lambda: retail.allergy_flag(F.col("event_id") % 4 - 1))
_on_events("cast_int", amount=lambda: F.floor("value").cast("int"))
_on_events(
    "visit_type",
    visitType=lambda: retail.visit_type(_spread_day(), "ts"),
    legacy=lambda: retail.visit_type(_spread_day(), "ts", True),
)


@query
def sale_amount(spark, d):
    items = star.checkout_items(spark, d)
    price = F.when(F.col("productId") % 10 == 0, "no price").otherwise(F.col("unitPrice"))
    amount = F.round(retail.sale_amount(price, "quantity"), 2)
    return items.select("orderId", "productId", "quantity", amount.alias("saleAmount"))


@query
def date_as_int(spark, d):
    text = F.when(F.col("event_id") % 5 != 0, F.col("text"))
    return star.visit_date_text(spark, d).select("event_id", retail.date_as_int(text).alias("day"))


@query
def explode_items(spark, d):
    items = sales.order_items(star.checkouts(spark, d))
    return items.select("userId", "storeId", "orderId", "orderItemId", "productId", "categoryId", "quantity")


@query
def explode_allergens(spark, d):
    profile = star.allergen_purchases(spark, d).select("userId", "orderId", "Allergens")
    return allergens.explode_allergens(profile)


@query
def fill_zero(spark, d):
    """Zero for missing counts; the keys of the outer join stay as they are."""
    return new_repeat_outer(spark, d).select("time", "storeId", "new_visitors", "repeated_visitors")


@query
def arithmetic(spark, d):
    counts = new_repeat_outer(spark, d)
    return counts.select(
        "time",
        "storeId",
        (F.col("new_visitors") + F.col("repeated_visitors")).alias("total"),
        (F.col("repeated_visitors") - F.col("new_visitors")).alias("difference"),
    )


# --- products ------------------------------------------------------------------

@query
def daily_category_footfall(spark, d):
    history, current = _location(spark, d)
    dims = _dims(spark, d)
    return footfall.daily_category_footfall(current, dims, footfall.footfall_facts(history, dims))


@query
def daily_category_footfall_legacy(spark, d):
    return footfall.daily_category_footfall(star.location_events(spark, d), _dims(spark, d), legacy=True)


@query
def daily_category_sale_count(spark, d):
    history, current = _purchases(spark, d)
    dims = _dims(spark, d)
    return sales.daily_category_sale_count(current, dims, sales.sale_facts(history, dims))


@query
def daily_category_sale_amount(spark, d):
    history, current = _purchases(spark, d)
    dims = _dims(spark, d)
    amounts = sales.daily_category_sale_amount(current, dims, sales.sale_facts(history, dims))
    return _cents(amounts, "saleAmountAgg")


@query
def daily_category_sale_summary(spark, d):
    summary = sales.daily_category_sale_summary(star.checkout_items(spark, d), _dims(spark, d))
    return _cents(summary, "saleAmountAgg")


@query
def daily_category_sale_summary_history(spark, d):
    history, current = _purchases(spark, d)
    dims = _dims(spark, d)
    summary = sales.daily_category_sale_summary(current, dims, sales.sale_facts(history, dims))
    return _cents(summary, "saleAmountAgg")


@query
def daily_category_sale_summary_fanout(spark, d):
    items, dims = star.checkout_items(spark, d), _dims(spark, d)
    return _cents(sales.daily_category_sale_summary(items, dims, fanout=True), "saleAmountAgg")


@query
def user_visit_type(spark, d):
    location = star.location_events(spark, d)
    return visitors.user_visit_type(location, visitors.user_first_visit(location))


@query
def user_visit_type_legacy(spark, d):
    """First visits a month before the visits: only the day number decides."""
    location = star.location_events(spark, d)
    first = visitors.user_first_visit(location)
    month_before = first.withColumn("firstTime", F.expr("firstTime - INTERVAL 31 DAYS"))
    return visitors.user_visit_type(location, month_before, legacy=True)


@query
def daily_visitors(spark, d):
    location = star.location_events(spark, d)
    return visitors.daily_visitors(location, location)


@query
def daily_visitors_all_events(spark, d):
    """Exits counted too, the visit types of history read from its log."""
    location = star.location_events(spark, d)
    history, current = _location(spark, d)
    logged = visitors.typed_visit_days(history, visitors.user_first_visit(location))
    return visitors.daily_visitors(current, location, logged, entry_only=False)


@query
def daily_visitors_category_wise(spark, d):
    dims = _dims(spark, d)
    location_history, location = _location(spark, d)
    purchase_history, purchases = _purchases(spark, d)
    return conversion.daily_visitors_category_wise(
        location,
        purchases,
        dims,
        footfall.footfall_facts(location_history, dims),
        conversion.converted_facts(purchase_history, dims),
    )


@query
def store_conversion(spark, d):
    history, current = _location(spark, d)
    visits = history.select(*STORE_USER, dates.trim_time("createdStamp").alias("time"))
    return conversion.store_conversion(current, star.purchase_items(spark, d), _dims(spark, d), visits)


@query
def daily_visit(spark, d):
    history, current = _location(spark, d)
    return visitors.daily_visit(current, visitors.visit_facts(history))


@query
def new_repeat_daily(spark, d):
    return visitors.new_repeat_daily(star.location_events(spark, d))


@query
def daily_visitors_by_count(spark, d):
    return visitors.daily_visitors_by_count(star.location_events(spark, d))


def _by_count(name: str, grain: str, keep, visits) -> None:
    QUERIES[name] = lambda spark, d: keep(visitors.visits_by_grain(visits(spark, d), grain))


# Every user has several events a month; single visits in longer spans are those of orders.
for _grain, _name in (("day", "daily"), ("month", "monthly"), ("year", "yearly")):
    _by_count(
        f"{_name}_new_visitors", _grain, visitors.new_by_count,
        star.location_events if _grain == "day" else star.order_visits,
    )
    _by_count(f"{_name}_repeat_visitors", _grain, visitors.repeat_by_count, star.location_events)


@query
def user_profile(spark, d):
    return allergens.user_profile(star.checkout_items(spark, d), _dims(spark, d))


@query
def allergy_notifications(spark, d):
    """Current purchases are line items, stored ones purchase events."""
    return allergens.allergy_notifications(
        star.checkout_items(spark, d),
        star.allergen_indicators(spark, d),
        star.purchase_items(spark, d).select(*allergens.PURCHASE),
    )


@query
def allergen_profile(spark, d):
    return allergens.allergen_profile(star.allergen_purchases(spark, d))


@query
def allergen_profile_min_orders(spark, d):
    return allergens.allergen_profile(star.allergen_purchases(spark, d), MIN_ORDERS)


@query
def footfall_30s(spark, d):
    return footfall.footfall_30s(star.location_events(spark, d))


@query
def daily_category_footfall_by_name(spark, d):
    return footfall.daily_category_footfall_by_name(star.location_events(spark, d), _dims(spark, d))


@query
def category_footfall_by_second(spark, d):
    return footfall.category_footfall_by_second(star.location_events(spark, d), _dims(spark, d))


@query
def category_sale_amount_by_second(spark, d):
    amounts = sales.category_sale_amount_by_second(star.checkout_items(spark, d), _dims(spark, d))
    return _cents(amounts, "saleAmountAgg")


@query
def daily_category_sales_by_name(spark, d):
    return _cents(sales.daily_category_sales_by_name(star.checkout_items(spark, d), _dims(spark, d)), "saleAmountAgg")
