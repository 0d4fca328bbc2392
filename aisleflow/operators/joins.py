"""The joins of the data model.

Dimensions carry no hint here: Catalyst broadcasts them when their files, or the
measured rows of ``load_dimensions``, are small and shuffles them otherwise.
Joins of row-grain facts go through ``lookup_join``, where a hot key is cut when
the join runs and its other side is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aisleflow.model import CALENDAR, CATEGORY_DAY, STORE_DAY, STORE_USER
from aisleflow.operators.skew import lookup_join


def rack_category_dim(racks: DataFrame, category: DataFrame) -> DataFrame:
    return racks.join(category, "rackId").select("rackId", "categoryId", "categoryName")


def location_with_category(location: DataFrame, dims: DataFrame) -> DataFrame:
    """Location events with their categories; events at unknown racks drop out."""
    return lookup_join(location, dims, ["rackId"])


def items_with_category(items: DataFrame, dims: DataFrame, fanout: bool = False) -> DataFrame:
    """Items of a known category, once each.

    ``fanout`` repeats an item for every rack of its category, as a plain join
    with the rack dimension does.
    """
    known = dims.select("categoryId")
    if fanout:
        return lookup_join(items, known, ["categoryId"]).select(items.columns)
    return lookup_join(items, known.distinct(), ["categoryId"], "left_semi").select(items.columns)


def sums_of_known_category(sums: DataFrame, dims: DataFrame, fanout: bool = False) -> DataFrame:
    """The same check on sums per store, day and category, of which no category has many."""
    known = dims.select("categoryId")
    if fanout:
        return sums.join(known, "categoryId").select(sums.columns)
    return sums.join(known.distinct(), "categoryId", "left_semi").select(sums.columns)


def sale_count_with_amount(counts: DataFrame, amounts: DataFrame) -> DataFrame:
    keys = ["orgId", "storeId", *CALENDAR, "time", "categoryId"]
    return counts.join(amounts, keys).select(*keys, "saleAmountAgg", "saleCountAgg")


def visits_with_first_visit(visits: DataFrame, first_visits: DataFrame) -> DataFrame:
    """Visits with the user's first visit to the store; unknown users drop out."""
    return lookup_join(visits, first_visits, STORE_USER)


def new_repeat_outer(repeated: DataFrame, new: DataFrame) -> DataFrame:
    joined = repeated.join(new, STORE_DAY, "outer")
    return joined.fillna(0, subset=["new_visitors", "repeated_visitors"])


def total_converted_outer(total: DataFrame, converted: DataFrame) -> DataFrame:
    joined = total.join(converted, CATEGORY_DAY, "outer")
    return joined.fillna(0, subset=["total", "converted"])


def store_conversion_join(total: DataFrame, converted: DataFrame) -> DataFrame:
    joined = total.join(converted, STORE_DAY)
    return joined.withColumn("failed", F.col("total") - F.col("converted"))


def profiled_users(qualifying: DataFrame, profile: DataFrame) -> DataFrame:
    """Profile rows of qualifying users, matched on the user alone across stores."""
    users = qualifying.select("userId").distinct()
    return lookup_join(profile, users, ["userId"], "left_semi")


def allergen_products(purchases: DataFrame, indicators: DataFrame) -> DataFrame:
    return lookup_join(purchases, indicators, ["productId"])


def allergen_profile_input(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the allergens of their product.

    The older form paired every item with every product of its store; the
    product id in the key keeps each item to its own product.
    """
    return lookup_join(items, products, ["orgId", "storeId", "productId"])


def minor_to_rack(beacon_events: DataFrame, beacons: DataFrame) -> DataFrame:
    """Beacon events with the rack of their beacon; unknown beacons keep a null rack."""
    return lookup_join(beacon_events, beacons, ["minorId"], "left")


def product_code_lookup(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items sold by code with the product behind it; unknown codes keep null ids."""
    return lookup_join(items, products, ["productCode"], "left")


def unknown_codes(looked_up: DataFrame, found: str) -> DataFrame:
    """Rows a lookup had no answer for."""
    return looked_up.filter(F.col(found).isNull())
