"""How many visits and visitors ended in a sale."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aisleflow.functions.dates import trim_time, with_calendar
from aisleflow.model import CATEGORY_DAY, STORE_DAY, STORE_USER
from aisleflow.operators.aggregates import daily_category_totals, distinct_users, union_history
from aisleflow.operators.joins import items_with_category, store_conversion_join, total_converted_outer
from aisleflow.plans.footfall import footfall_facts


def converted_facts(items: DataFrame, dims: DataFrame) -> DataFrame:
    """Each buyer of a known category once per store and day."""
    buyers = items.select(*STORE_USER, "categoryId", trim_time("createdStamp").alias("time"))
    return items_with_category(buyers, dims).distinct()


def converted_users(items: DataFrame, dims: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return distinct_users(union_history(converted_facts(items, dims), history), CATEGORY_DAY, "converted")


def visitors_category_wise(footfall: DataFrame, converted: DataFrame, legacy: bool = False) -> DataFrame:
    """Conversion from footfall facts (orgId … footfall) and buyer facts (orgId … userId).

    ``total`` counts visits and ``converted`` counts users, so ``failed`` is
    negative where there are more buyers than visits.
    """
    total = daily_category_totals(footfall, total="footfall")
    stats = total_converted_outer(total, distinct_users(converted, CATEGORY_DAY, "converted"))
    stats = stats.withColumn("failed", F.col("total") - F.col("converted"))
    return with_calendar(stats.select(*CATEGORY_DAY, "converted", "failed", "total"), legacy)


def daily_visitors_category_wise(
    location: DataFrame,
    items: DataFrame,
    dims: DataFrame,
    footfall_history: DataFrame | None = None,
    converted_history: DataFrame | None = None,
    legacy: bool = False,
) -> DataFrame:
    footfall = union_history(footfall_facts(location, dims), footfall_history)
    converted = union_history(converted_facts(items, dims), converted_history)
    return visitors_category_wise(footfall, converted, legacy)


def store_daily_visitors(location: DataFrame, history: DataFrame | None = None) -> DataFrame:
    visits = location.select(*STORE_USER, trim_time("createdStamp").alias("time"))
    return distinct_users(union_history(visits, history), STORE_DAY, "total")


def store_daily_converted(items: DataFrame, dims: DataFrame) -> DataFrame:
    return distinct_users(converted_facts(items, dims), STORE_DAY, "converted")


def store_conversion(
    location: DataFrame, items: DataFrame, dims: DataFrame, history: DataFrame | None = None
) -> DataFrame:
    """Users per store and day, those who bought, and those who did not."""
    joined = store_conversion_join(store_daily_visitors(location, history), store_daily_converted(items, dims))
    return joined.select(*STORE_DAY, "total", "converted", "failed")
