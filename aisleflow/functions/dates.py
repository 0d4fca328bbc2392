"""Calendar functions.

``legacy=True`` reproduces the numbers older stored tables hold: months from 0,
years from 1900, quarters with gaps, day trimming that keeps fractions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def day_of(t) -> Column:
    return F.dayofmonth(_col(t))


def month_of(t, legacy: bool = False) -> Column:
    return F.month(_col(t)) - 1 if legacy else F.month(_col(t))


def year_of(t, legacy: bool = False) -> Column:
    return F.year(_col(t)) - 1900 if legacy else F.year(_col(t))


def quarter_of(t, legacy: bool = False) -> Column:
    if not legacy:
        return F.quarter(_col(t))
    # Quarter stored for months 1 to 12.
    by_month = F.array(*[F.lit(q) for q in (1, 1, 1, 4, 2, 2, 4, 3, 3, 4, 4, 4)])
    return F.element_at(by_month, F.month(_col(t)))


def week_of_month(t) -> Column:
    """Week of the month, weeks starting on Sunday, a partial first week being 1."""
    first_weekday = F.dayofweek(F.trunc(_col(t), "MM"))
    return (F.floor((F.dayofmonth(_col(t)) + first_weekday - 2) / 7) + 1).cast("int")


def trim_time(t, legacy: bool = False) -> Column:
    """Midnight of the event's day."""
    t = _col(t)
    if not legacy:
        return F.to_date(t).cast("timestamp_ntz")
    whole_seconds = F.make_dt_interval(F.lit(0), F.hour(t), F.minute(t), F.floor(F.second(t)))
    return t.cast("timestamp_ntz") - whole_seconds


def time_delta_ms(t1, t2) -> Column:
    """Difference in whole milliseconds of each time, so that both are cut, not their difference."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = lambda t: F.floor((_col(t).cast("timestamp_ntz") - start).cast("interval second").cast("decimal(20,6)") * 1000)
    return (whole(t1) - whole(t2)).cast("bigint")


def add_24h(t) -> Column:
    return _col(t) + F.expr("INTERVAL 24 HOURS")


def with_calendar(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Add day, month and year of ``time`` in front of it, as products list them."""
    measures = [c for c in df.columns if c not in ("orgId", "storeId", "time")]
    return df.select(
        "orgId",
        "storeId",
        day_of("time").alias("day"),
        month_of("time", legacy).alias("month"),
        year_of("time", legacy).alias("year"),
        "time",
        *measures,
    )
