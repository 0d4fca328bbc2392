"""The groupings of the data model.

Sums, counts and minima combine on the map side. Distinct counts first reduce to
one row per (group, value), which spreads a hot group over all its values, and
then count those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aisleflow.functions.retail import NEW, REPEAT
from aisleflow.model import CATEGORY_DAY, STORE_DAY, STORE_USER


def union_history(current: DataFrame, history: DataFrame | None) -> DataFrame:
    """The batch's rows and the stored ones, matched by column name."""
    if history is None:
        return current
    return current.unionByName(history.select(*current.columns))


def daily_category_totals(facts: DataFrame, **measures: str) -> DataFrame:
    """Sums per store, day and category: output name = measure column."""
    return facts.groupBy(*CATEGORY_DAY).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def distinct_users(rows: DataFrame, keys: list[str], alias: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count_distinct("userId").alias(alias))


def user_first_visit(events: DataFrame, time: str = "createdStamp") -> DataFrame:
    return events.groupBy(*STORE_USER).agg(F.min(time).alias("firstTime"))


def user_first_visit_incremental(current: DataFrame, stored: DataFrame | None) -> DataFrame:
    """First visits of the batch merged with the stored ones."""
    seen = user_first_visit(current)
    return user_first_visit(union_history(seen, stored), "firstTime")


def visits_per_user_day(visit_types: DataFrame) -> DataFrame:
    """One row per store, day and user, flagged with the visit types seen."""
    is_type = lambda t: F.max(F.when(F.col("visitType") == t, 1).otherwise(0))
    return (
        visit_types.filter(F.col("visitType").isin(NEW, REPEAT))
        .groupBy(*STORE_DAY, "userId")
        .agg(is_type(NEW).alias("is_new"), is_type(REPEAT).alias("is_repeat"))
    )


def new_and_repeated_users(visit_types: DataFrame) -> DataFrame:
    """Distinct NEW and REPEAT users per store and day, in one pass over the rows."""
    known = F.col("userId").isNotNull()
    count = lambda flag: F.sum(F.when(known, F.col(flag)).otherwise(0))
    return visits_per_user_day(visit_types).groupBy(*STORE_DAY).agg(
        count("is_new").alias("new_visitors"), count("is_repeat").alias("repeated_visitors")
    )


def user_order_count(profile: DataFrame) -> DataFrame:
    return profile.groupBy(*STORE_USER).agg(F.count_distinct("orderId").alias("OrderCount"))


def visits_per_user(visits: DataFrame, keys: list[str]) -> DataFrame:
    return visits.groupBy(*keys).agg(F.sum("visitCount").alias("VisitCount"))


def new_repeat_flag_totals(flags: DataFrame) -> DataFrame:
    return flags.groupBy(*STORE_DAY).agg(
        F.sum("New").alias("new_visitors"), F.sum("Repeat").alias("repeated_visitors")
    )


def indicator_purchases(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("userId", "orderId").count()


def indicator_total(per_order: DataFrame) -> DataFrame:
    return per_order.groupBy("userId").agg(F.sum("count").alias("purchasedCount"))


def visit_type_pivot(visit_days: DataFrame) -> DataFrame:
    """Visits (not users) of each type per store and day, from typed visit days."""
    visits_of = lambda t: F.sum(F.when(F.col("visitType") == t, F.col("visits")).otherwise(0))
    return visit_days.groupBy(*STORE_DAY).agg(
        visits_of(REPEAT).alias("repeated_visitors"), visits_of(NEW).alias("new_visitors")
    )


def daily_product_count(items: DataFrame) -> DataFrame:
    return items.groupBy(F.to_date("createdStamp").alias("day"), "productId").agg(
        F.sum("quantity").alias("quantity")
    )
