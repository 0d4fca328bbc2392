"""New and repeat visitors, by first visit and by visit count."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aisleflow.functions.dates import day_of, month_of, trim_time, with_calendar, year_of
from aisleflow.functions.retail import new_flag, repeat_flag, visit_type
from aisleflow.model import STORE_USER
from aisleflow.operators import aggregates
from aisleflow.operators.aggregates import union_history, visits_per_user
from aisleflow.operators.skew import repeat_rows


def entry_events(location: DataFrame) -> DataFrame:
    """Events that mark an entry."""
    return location.filter(F.col("locEventType") == 0)


def user_first_visit(events: DataFrame, entry_only: bool = False) -> DataFrame:
    return aggregates.user_first_visit(entry_events(events) if entry_only else events)


def first_visits_of(visitors: DataFrame, events: DataFrame, entry_only: bool = False) -> DataFrame:
    """First visits of the given visitors only, where they are few beside the history."""
    wanted = visitors.select(*STORE_USER).distinct()
    return user_first_visit(events.join(wanted, STORE_USER, "left_semi"), entry_only)


def visit_days(location: DataFrame) -> DataFrame:
    """Visits per store, user and day: what a first-visit test needs of an event."""
    return location.groupBy(*STORE_USER, trim_time("createdStamp").alias("time")).agg(
        F.count(F.lit(1)).alias("visits")
    )


def typed_visit_days(location: DataFrame, first_visits: DataFrame, legacy: bool = False) -> DataFrame:
    """Visit days of known users as NEW or REPEAT.

    Both sides hold at most one row per user and day, so a user with most of
    the events joins as lightly as any other.
    """
    return typed_days(visit_days(location), first_visits, legacy)


def typed_days(days: DataFrame, first_visits: DataFrame, legacy: bool = False) -> DataFrame:
    """Rows of a user and day with their type beside them."""
    typed = days.join(first_visits, STORE_USER)
    return typed.withColumn("visitType", visit_type("time", "firstTime", legacy)).drop("firstTime")


def user_visit_type(location: DataFrame, first_visits: DataFrame, legacy: bool = False) -> DataFrame:
    """One row per visit, with its day and type."""
    return repeat_rows(typed_visit_days(location, first_visits, legacy), "visits")


def daily_visitors_of(visit_types: DataFrame, history: DataFrame | None = None, legacy: bool = False) -> DataFrame:
    """Distinct new and repeat users per store and day, from typed visits."""
    current = visit_types.select(*STORE_USER, "time", "visitType")
    counts = aggregates.new_and_repeated_users(union_history(current, history))
    return with_calendar(_with_total(counts), legacy)


def daily_visitors(
    location: DataFrame, events: DataFrame, history: DataFrame | None = None,
    entry_only: bool = True, legacy: bool = False,
) -> DataFrame:
    """New and repeat visitors per store and day.

    ``entry_only`` counts entry events alone, in the batch and in ``events``.
    """
    current = entry_events(location) if entry_only else location
    typed = typed_visit_days(current, user_first_visit(events, entry_only), legacy)
    return daily_visitors_of(typed, history, legacy)


def _with_total(counts: DataFrame) -> DataFrame:
    return counts.withColumn("total", F.col("new_visitors") + F.col("repeated_visitors"))


def visit_facts(location: DataFrame) -> DataFrame:
    """Visit counts per store, user and day, as the visit log stores them."""
    return visit_days(location).withColumnRenamed("visits", "visitCount")


def _visits(location: DataFrame, history: DataFrame | None) -> DataFrame:
    rows = location.select(
        *STORE_USER, trim_time("createdStamp").alias("time"), F.lit(1).cast("bigint").alias("visitCount")
    )
    return union_history(rows, history)


def daily_visit(location: DataFrame, history: DataFrame | None = None) -> DataFrame:
    counts = visits_per_user(_visits(location, history), [*STORE_USER, "time"])
    return counts.select("orgId", "storeId", "time", "userId", "VisitCount")


def new_repeat_daily(location: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return with_new_and_repeat(daily_visit(location, history))


def with_new_and_repeat(counts: DataFrame) -> DataFrame:
    """Visit counts with the flags of the older definition."""
    return counts.withColumns({"New": new_flag("VisitCount"), "Repeat": repeat_flag("VisitCount")})


def daily_visitors_by_count(
    location: DataFrame, history: DataFrame | None = None, legacy: bool = False
) -> DataFrame:
    """Older definition: a user seen once in a day is new, seen more often repeat."""
    counts = aggregates.new_repeat_flag_totals(new_repeat_daily(location, history))
    return with_calendar(_with_total(counts), legacy)


# Grains of the visit-count products. The older yearly product kept the month in
# its grouping and so equalled the monthly one; "year_legacy" is that form.
GRAINS = {
    "day": ["day", "month", "year"],
    "month": ["month", "year"],
    "year": ["year"],
    "year_legacy": ["month", "year"],
}


def visits_by_grain(
    location: DataFrame, grain: str, history: DataFrame | None = None, legacy: bool = False
) -> DataFrame:
    return counted_by_grain(_visits(location, history), grain, legacy)


def counted_by_grain(visits: DataFrame, grain: str, legacy: bool = False) -> DataFrame:
    """Visit counts (visitCount of a user and time) by the calendar parts of a grain."""
    parts = {
        "day": day_of("time"),
        "month": month_of("time", legacy),
        "year": year_of("time", legacy),
    }
    visits = visits.select(
        "orgId", "storeId", "userId", "visitCount", *[parts[p].alias(p) for p in GRAINS[grain]]
    )
    return visits_per_user(visits, ["orgId", "storeId", *GRAINS[grain], "userId"])


def new_by_count(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("VisitCount") == 1)


def repeat_by_count(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("VisitCount") > 1)
