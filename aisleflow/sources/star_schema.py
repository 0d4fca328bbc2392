"""The model's frames from a star schema of orders, line items and click events.

Events become location events and purchases, line items become checkout items,
nations give the rack dimension and parts the product tables. Racks 0 to 74 are
known and events name racks 0 to 99, categories 1 to 45 are known and sales name
1 to 50, so unknown keys occur on both sides; 30 categories have two racks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aisleflow.functions.dates import trim_time

# First day of the current part of the events; earlier ones are the stored history.
EVENTS_SPLIT = "2024-01-16"
ORG = 1


# Known schemas spare each read the job that would infer them from file footers.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread_events(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Events dealt evenly over tasks, for costly work on each row.

    A file is read by no more tasks than it has row groups, which may be one. Adaptive execution
    finds the number of parts unless it is given; the ids may be null or repeated, so the time helps to deal.
    """
    keys = ["event_id", "user_id", "ts"]
    events = table(spark, sf_dir, "events")
    return events.repartition(parts, *keys) if parts else events.repartition(*keys)


def split_time(df: DataFrame, day: str = EVENTS_SPLIT) -> tuple[DataFrame, DataFrame]:
    """Rows before the day and rows from it on."""
    start = F.lit(day).cast("timestamp_ntz")
    return df.filter(F.col("createdStamp") < start), df.filter(F.col("createdStamp") >= start)


def _store(key) -> Column:
    return (F.col(key) % 3).cast("int")


def _k() -> Column:
    """The number in an event's properties, -1 where there is none.

    Never null, so that joins on it add no null check that would read the JSON twice.
    """
    return F.coalesce(F.get_json_object("props", "$.k").cast("int"), F.lit(-1))


def racks(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_nation = F.sequence(F.col("n_nationkey") * 3, F.col("n_nationkey") * 3 + 2)
    return table(spark, sf_dir, "nation").select(F.explode(per_nation).alias("rackId"))


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    category_id = F.col("rackId") % 45 + 1
    return racks(spark, sf_dir).select(
        "rackId", category_id.alias("categoryId"), F.concat(F.lit("cat"), category_id).alias("categoryName")
    )


def location_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_location_events(table(spark, sf_dir, "events"))


def to_location_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") != "purchase").select(
        F.col("event_id").cast("string").alias("eventId"),
        F.lit(ORG).alias("orgId"),
        _store("event_id").alias("storeId"),
        F.col("user_id").cast("string").alias("userId"),
        _k().alias("rackId"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("locEventType"),
        F.col("ts").alias("createdStamp"),
    )


def purchase_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as one-item sales."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return events.select(
        F.col("user_id").cast("string").alias("userId"),
        F.lit(ORG).alias("orgId"),
        _store("event_id").alias("storeId"),
        F.col("event_id").alias("orderId"),
        F.col("ts").alias("createdStamp"),
        _k().cast("bigint").alias("productId"),
        F.lit(1).alias("quantity"),
        (_k() % 50 + 1).alias("categoryId"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("unitPrice"),
    )


def checkout_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sold items of their order's customer and day."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, "o_orderkey").select(
        F.col("o_custkey").cast("string").alias("userId"),
        F.lit(ORG).alias("orgId"),
        _store("o_custkey").alias("storeId"),
        F.col("o_orderkey").alias("orderId"),
        F.col("o_orderdate").alias("createdStamp"),
        F.col("l_partkey").alias("productId"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_partkey") % 50 + 1).cast("int").alias("categoryId"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("unitPrice"),
        F.col("l_discount").alias("discountApplied"),
        F.col("l_linenumber").cast("bigint").alias("orderItemId"),
        F.col("l_shipdate").alias("orderTimestamp"),
    )


def order_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as visits of their customers."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("eventId"),
        F.lit(ORG).alias("orgId"),
        _store("o_custkey").alias("storeId"),
        F.col("o_custkey").cast("string").alias("userId"),
        F.lit(0).alias("rackId"),
        F.lit(0).alias("locEventType"),
        F.col("o_orderdate").alias("createdStamp"),
    )


def checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as nested checkouts of none, one or two items (line number mod 3)."""
    item = lambda n: F.struct(
        F.lit(n).cast("bigint").alias("orderItemId"),
        (F.col("l_partkey") + n).alias("productId"),
        ((F.col("l_partkey") + n) % 50 + 1).cast("int").alias("categoryId"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("unitPrice"),
        F.col("l_discount").alias("discountApplied"),
        F.col("l_shipdate").alias("createdStamp"),
    )
    size = (F.col("l_linenumber") % 3).cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("userId"),
        F.lit(ORG).alias("orgId"),
        _store("l_suppkey").alias("storeId"),
        F.col("l_orderkey").alias("orderId"),
        F.slice(F.array(item(0), item(1)), F.lit(1), size).alias("orderItems"),
        F.col("l_extendedprice").alias("invoiceAmount"),
        F.col("l_quantity").cast("int").alias("invoiceQuantity"),
        F.col("l_shipdate").alias("createdStamp"),
    )


def allergen_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with a list of allergens, as a customer allergen profile holds them."""
    items = checkout_items(spark, sf_dir)
    group = lambda n: F.concat(F.lit("A"), F.col("productId") % n)
    trailing = F.when(F.col("productId") % 3 == 0, ",,").otherwise("")
    return items.select(
        "orgId",
        "storeId",
        "userId",
        "orderId",
        F.col("createdStamp").alias("time"),
        F.col("productId").cast("string").alias("products"),
        F.concat(group(7), F.lit(","), group(11), trailing).alias("Allergens"),
    )


def allergen_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO")
    return parts.select(F.col("p_partkey").alias("productId"), F.col("p_brand").alias("indicator"))


def store_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products each store carries (two stores in three), with their allergens."""
    stores = F.filter(
        F.array(F.lit(0), F.lit(1), F.lit(2)), lambda s: s != (F.col("p_partkey") % 3).cast("int")
    )
    return table(spark, sf_dir, "part").select(
        F.lit(ORG).alias("orgId"),
        F.explode(stores).alias("storeId"),
        F.col("p_partkey").alias("productId"),
        F.concat_ws(",", "p_brand", "p_type").alias("Allergens"),
    )


def product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the products whose key is even."""
    parts = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 2 == 0)
    return parts.select(
        F.concat(F.lit("P-"), F.col("p_partkey")).alias("productCode"),
        F.col("p_partkey").alias("productId"),
        (F.col("p_partkey") % 75).cast("int").alias("rackId"),
        (F.col("p_partkey") % 50 + 1).cast("int").alias("categoryId"),
        F.col("p_retailprice").alias("unitPrice"),
    )


def coded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold items known by their product code only."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderId"),
        F.concat(F.lit("P-"), F.col("l_partkey")).alias("productCode"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def beacons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return racks(spark, sf_dir).select((F.col("rackId") + 20000).cast("string").alias("minorId"), "rackId")


def beacon_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return location_events(spark, sf_dir).select("eventId", (F.col("rackId") + 20000).cast("string").alias("minorId"))


def _json(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _second() -> Column:
    return F.substring(F.col("ts").cast("string"), 1, 19)


def _message_line() -> Column:
    """The line of an event as tills and sensors send it."""
    head = (
        '"userId":"', F.col("user_id").cast("string"), '","orgId":0', F.lit(str(ORG)),
        ',"storeId":', _store("event_id").cast("string"),
    )
    location = _json(
        '{"event":{"eventId":', F.col("event_id").cast("string"), ",", *head,
        ',"rackId":', _k().cast("string"),
        ',"locEventType":', F.when(F.col("event_type") == "error", "1").otherwise("0"),
        ',"createdStamp":"', _second(), '"},"eventType":"LocationEvent"}',
    )
    price = F.col("value").cast("decimal(18,2)").cast("string")
    checkout = _json(
        '{"event":{"orderId":', F.col("event_id").cast("string"), ",", *head,
        ',"orderItems":[{"orderItemId":1,"productId":', _k().cast("string"),
        ',"categoryId":', (_k() % 50 + 1).cast("string"), ',"quantity":1,"unitPrice":', price,
        ',"discountApplied":0.0,"createdStamp":"', _second(), '"}],"invoiceAmount":', price,
        ',"invoiceQuantity":1,"createdStamp":"', _second(), '"},"eventType":"CheckOutEvent"}',
    )
    return F.when(F.col("event_type") == "purchase", checkout).otherwise(location)


def message_lines(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Events as the JSON lines tills and sensors send, ids with leading zeros."""
    return spread_events(spark, sf_dir, parts).select(_message_line().alias("value"))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lines of which most are unusable, each in one of seven ways by event id."""
    events = spread_events(spark, sf_dir)
    event_id = F.col("event_id").cast("string")
    good = _json(
        '{"eventType":"LocationEvent","event":{"eventId":', event_id,
        ',"userId":"u","orgId":1,"storeId":1,"rackId":2,"locEventType":0,"createdStamp":"', _second(), '"}}',
    )
    kind = F.col("event_id") % 8
    line = (
        F.when(kind == 0, good)
        .when(kind == 1, _json("note ", event_id))
        .when(kind == 2, F.replace(good, F.lit('"event":'), F.lit('"Event":')))
        .when(kind == 3, F.replace(good, F.lit('"rackId":2'), F.lit('"rackId":"r2"')))
        .when(kind == 4, F.replace(good, F.lit('"eventType":"LocationEvent",'), F.lit("")))
        .when(kind == 5, F.replace(good, F.lit('"createdStamp":"20'), F.lit('"createdStamp":"day ')))
        .when(kind == 6, F.replace(good, F.lit('"userId":"u",'), F.lit("")))
        .otherwise(F.lit(" "))
    )
    return events.select(line.alias("value"))


def _string_id_line() -> Column:
    """The line of an event in the string-id generation."""
    org = F.when(F.col("event_id") % 2 == 0, "1").otherwise("org1")
    head = (
        '"userId":"u', F.col("user_id").cast("string"), '","orgId":"', org,
        '","storeId":"', _store("event_id").cast("string"), '"',
    )
    location = _json(
        '{"eventType":"LocationEvent","event":{"eventId":"', F.col("event_id").cast("string"), '",', *head,
        ',"rackId":"', _k().cast("string"), '","locEventType":"0","createdStamp":"', _second(), '"}}',
    )
    checkout = _json(
        '{"eventType":"CheckOutEvent","event":{', *head, ',"orderId":"', F.col("event_id").cast("string"),
        '","orderItems":[{"productId":"', _k().cast("string"), '","categoryId":"c', _k().cast("string"),
        '","quantity":"2","unitPrice":', F.col("value").cast("decimal(18,2)").cast("string"),
        '}],"createdStamp":"', _second(), '"}}',
    )
    return F.when(F.col("event_type") == "purchase", checkout).otherwise(location)


def string_id_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location events and checkouts of the string-id generation; some ids are no numbers."""
    return spread_events(spark, sf_dir).select(_string_id_line().alias("value"))


def _legacy_line() -> Column:
    """The line of an event in the oldest generation."""
    head = (
        '"userId":"u', F.col("user_id").cast("string"), '","orgId":"org1","storeId":"s',
        _store("event_id").cast("string"), '"',
    )
    location = _json(
        '{"eventType":"LocationEvent","Event":{', *head, ',"rackId":"r', _k().cast("string"),
        '","time":"', _second(), '"}}',
    )
    spelling = F.when(F.col("event_id") % 2 == 0, "checkOutTime").otherwise("checkOuttime")
    checkout = _json(
        '{"eventType":"CheckOutEvent","Event":{', *head, ',"orderId":"o', F.col("event_id").cast("string"),
        '","cart":[{"productId":"p', _k().cast("string"), '","quantity":2,"categoryId":"c1","price":',
        F.col("value").cast("decimal(18,2)").cast("string"), '}],"', spelling, '":"', _second(), '"}}',
    )
    return F.when(F.col("event_type") == "purchase", checkout).otherwise(location)


def legacy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location events and checkouts of the oldest generation, in both time spellings."""
    return spread_events(spark, sf_dir).select(_legacy_line().alias("value"))


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a line of all three generations, so that every task has as many of each."""
    lines = F.array(_message_line(), _string_id_line(), _legacy_line())
    return spread_events(spark, sf_dir).select(F.explode(lines).alias("value"))


def visit_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", trim_time("ts").cast("string").alias("text"))


def rack_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third rack's product as an allergen indicator, for the event purchases."""
    return racks(spark, sf_dir).filter(F.col("rackId") % 3 == 0).select(F.col("rackId").cast("bigint").alias("productId"))
