"""Visits per category and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aisleflow.functions.dates import day_of, month_of, trim_time, with_calendar, year_of
from aisleflow.operators.aggregates import daily_category_totals, union_history


def footfall_facts(location: DataFrame, dims: DataFrame) -> DataFrame:
    """Footfall per store, day, rack and category.

    Events are counted per rack before the dimension is joined, so a rack with
    most of the events is one row per store and day by then, and the join moves
    no event rows however large the dimension is.
    """
    per_rack = location.groupBy("orgId", "storeId", trim_time("createdStamp").alias("time"), "rackId").agg(
        F.count(F.lit(1)).alias("footfall")
    )
    return per_rack.join(dims, "rackId").select("orgId", "storeId", "time", "categoryId", "footfall")


def category_footfall(location: DataFrame, dims: DataFrame, history: DataFrame | None = None) -> DataFrame:
    facts = union_history(footfall_facts(location, dims), history)
    return daily_category_totals(facts, footfallCount="footfall")


def daily_category_footfall(
    location: DataFrame, dims: DataFrame, history: DataFrame | None = None, legacy: bool = False
) -> DataFrame:
    return with_calendar(category_footfall(location, dims, history), legacy)


def daily_category_footfall_by_name(location: DataFrame, dims: DataFrame, legacy: bool = False) -> DataFrame:
    """Older grain: calendar columns and the category's name instead of its id."""
    day = trim_time("createdStamp")
    per_rack = location.groupBy("orgId", "storeId", day.alias("time"), "rackId").agg(
        F.count(F.lit(1)).alias("footfall")
    )
    return per_rack.join(dims, "rackId").groupBy(
        "orgId",
        "storeId",
        day_of("time").alias("day"),
        month_of("time", legacy).alias("month"),
        year_of("time", legacy).alias("year"),
        F.col("categoryName").alias("category"),
    ).agg(F.sum("footfall").alias("FootFallCount"))


def category_footfall_by_second(location: DataFrame, dims: DataFrame) -> DataFrame:
    """Older grain: the event's own time, not its day."""
    per_rack = location.groupBy("orgId", "storeId", F.col("createdStamp").alias("time"), "rackId").agg(
        F.count(F.lit(1)).alias("footfall")
    )
    return per_rack.join(dims, "rackId").groupBy(
        "orgId", "storeId", "time", "categoryId", "categoryName"
    ).agg(F.sum("footfall").alias("FootFallCount"))


def footfall_30s(location: DataFrame) -> DataFrame:
    """Each event with the start of its 30-second bucket."""
    return location.select(
        "userId",
        "rackId",
        F.col("createdStamp").alias("ts"),
        F.window("createdStamp", "30 seconds")["start"].alias("bucket"),
    )
