"""The facts of a batch from one grouping: what every log keeps, as tagged rows.

A location event is a footfall of its rack and a visit of its user, an item a sale of its
category and a buyer of it. One generator per event writes those rows, one grouping sums them
(the map-side combine takes out hot racks and categories), and one join with the
dimension names the category of what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aisleflow.functions.dates import trim_time
from aisleflow.functions.retail import sale_amount

FOOTFALL, SALE, BUYER, VISIT = "footfall", "sale", "buyer", "visit"
KEYS = ["table", "orgId", "storeId", "userId", "categoryId", "time"]


def _row(table: str, place: Column | None, user: Column | None, n: Column, amount: Column | None, first: Column | None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(table).alias("table"),
        (none if place is None else place).alias("place"),
        (none.cast("string") if user is None else user).alias("userId"),
        n.cast("bigint").alias("n"),
        (none.cast("double") if amount is None else amount).alias("amount"),
        (none.cast("timestamp_ntz") if first is None else first).alias("firstTime"),
    )


def _tagged(events: DataFrame, *rows: Column) -> DataFrame:
    return events.select("orgId", "storeId", trim_time("createdStamp").alias("time"), F.inline(F.array(*rows)))


def batch_facts(location: DataFrame, items: DataFrame, dims: DataFrame) -> DataFrame:
    """table, orgId, storeId, userId, categoryId, time, n, amount, firstTime of a batch.

    ``n`` counts footfall, units or visits; a buyer of a category is a row without a count.
    Events at unknown racks have a visit but no footfall, items of unknown categories no row.
    """
    rack, user, category = F.col("rackId"), F.col("userId"), F.col("categoryId")
    nowhere = F.lit(None).cast(location.schema["rackId"].dataType)
    seen = _tagged(
        location, _row(FOOTFALL, rack, None, F.lit(1), None, None), _row(VISIT, nowhere, user, F.lit(1), None, F.col("createdStamp"))
    )
    amount = sale_amount("unitPrice", "quantity").cast("double")
    sold = _tagged(items, _row(SALE, category, None, F.col("quantity"), amount, None), _row(BUYER, category, user, F.lit(0), None, None))
    sums = merged(seen.unionByName(sold), ["table", "orgId", "storeId", "userId", "place", "time"])
    racks = dims.select(F.lit(FOOTFALL).alias("table"), F.col("rackId").alias("place"), "categoryId")
    known = dims.select("categoryId").distinct()
    categories = known.select(F.explode(F.array(F.lit(SALE), F.lit(BUYER))).alias("table"), F.col("categoryId").alias("place"), "categoryId")
    places = racks.unionByName(categories).withColumn("known", F.lit(True))
    found = sums.join(places, ["table", "place"], "left").filter((F.col("table") == VISIT) | F.col("known"))
    return found.select(*KEYS, "n", "amount", "firstTime")


def merged(facts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Facts of several batches as one row per key: counts and amounts add up, the first time is the earliest."""
    return facts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"), F.min("firstTime").alias("firstTime"))
