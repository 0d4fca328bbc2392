from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aisleflow.functions import dates, retail
from tests.conftest import at, rows


@pytest.fixture(scope="module")
def months(spark):
    times = [(m, datetime(2016, m, 11, 13, 5, 7, 250000)) for m in range(1, 13)]
    return spark.createDataFrame(times, "m INT, t TIMESTAMP_NTZ")


def test_calendar_parts(months):
    parts = months.filter("m = 12").select(
        dates.day_of("t"), dates.month_of("t"), dates.month_of("t", True), dates.year_of("t"), dates.year_of("t", True)
    )
    assert tuple(parts.first()) == (11, 12, 11, 2016, 116)


def test_quarters(months):
    both = months.orderBy("m").select(dates.quarter_of("t"), dates.quarter_of("t", True)).collect()
    assert [r[0] for r in both] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert [r[1] for r in both] == [1, 1, 1, 4, 2, 2, 4, 3, 3, 4, 4, 4]


def test_week_of_month_matches_a_sunday_calendar(spark):
    days = [datetime(2016, 1, 1) + timedelta(days=n) for n in range(731)]
    weeks = spark.createDataFrame([(d,) for d in days], "t TIMESTAMP_NTZ").select("t", dates.week_of_month("t"))
    for day, week in weeks.collect():
        first = day.replace(day=1)
        sundays = sum((first + timedelta(days=n)).weekday() == 6 for n in range(1, day.day))
        assert week == 1 + sundays, day


def test_trim_time_keeps_fractions_only_in_legacy_form(months):
    trimmed = months.filter("m = 3").select(dates.trim_time("t"), dates.trim_time("t", legacy=True))
    assert tuple(trimmed.first()) == (at("2016-03-11"), at("2016-03-11 00:00:00.250000"))


def test_trim_time_ignores_the_session_time_zone(spark, months):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert months.filter("m = 3").select(dates.trim_time("t")).first()[0] == at("2016-03-11")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_differences_and_shifts(spark):
    df = spark.createDataFrame(
        [(at("2016-12-02 00:00:00.5"), at("2016-12-01 23:59:59"))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ"
    )
    row = df.select(dates.time_delta_ms("a", "b"), dates.time_delta_ms("b", "a"), dates.add_24h("b")).first()
    assert tuple(row) == (1500, -1500, at("2016-12-02 23:59:59"))


def test_visit_type(spark):
    pairs = [
        (1, at("2016-12-01 20:00:00"), at("2016-12-01 08:00:00")),
        (2, at("2016-12-02 08:00:00"), at("2016-12-01 08:00:00")),
        (3, at("2016-12-01 08:00:00"), at("2016-11-01 08:00:00")),
        (4, at("2016-12-01 08:00:00"), None),
    ]
    df = spark.createDataFrame(pairs, "n INT, t TIMESTAMP_NTZ, f TIMESTAMP_NTZ")
    types = df.select("n", retail.visit_type("t", "f"), retail.visit_type("t", "f", legacy=True))
    assert rows(types) == [
        (1, "NEW", "NEW"), (2, "REPEAT", "REPEAT"), (3, "REPEAT", "NEW"), (4, None, None)
    ]


def test_count_flags(spark):
    df = spark.createDataFrame([(c,) for c in (-1, 0, 1, 2, None)], "c INT")
    flags = df.select("c", retail.new_flag("c"), retail.repeat_flag("c"), retail.allergy_flag("c")).collect()
    quiet = retail.ALLERGY_NOT_DETECTED
    assert [tuple(f) for f in flags] == [
        (-1, 0, 1, quiet), (0, 0, 1, quiet), (1, 1, 0, quiet), (2, 0, 1, retail.ALLERGY_DETECTED),
        (None, None, None, None),
    ]


def test_sale_amount_of_text(spark):
    df = spark.createDataFrame([("440.0", 2), ("no price", 1), (None, 3)], "p STRING, q INT")
    assert [r[0] for r in df.select(retail.sale_amount("p", "q")).collect()] == [880.0, None, None]


def test_date_as_int(spark):
    df = spark.createDataFrame([("2016-12-01 08:00:00",), (None,), ("soon",)], "d STRING")
    assert [r[0] for r in df.select(retail.date_as_int("d")).collect()] == [20161201, None, None]


def test_allergen_list_drops_trailing_empty_parts(spark):
    texts = ["A1,A2", ",A2,,", "A1", "", ",,,", None]
    df = spark.createDataFrame([(t,) for t in texts], "a STRING")
    assert [r[0] for r in df.select(retail.allergen_list("a")).collect()] == [
        ["A1", "A2"], ["", "A2"], ["A1"], [""], [], None
    ]


def test_thirty_second_buckets(spark):
    from aisleflow.plans.footfall import footfall_30s

    times = [f"2020-05-06 09:17:{s}" for s in ("03", "29", "30", "44", "59")]
    df = spark.createDataFrame([("u1", 1, at(t)) for t in times], "userId STRING, rackId INT, createdStamp TIMESTAMP_NTZ")
    starts = [r.bucket for r in footfall_30s(df).orderBy("ts").collect()]
    assert starts == [at("2020-05-06 09:17:00")] * 2 + [at("2020-05-06 09:17:30")] * 3


def test_time_delta_cuts_each_time_to_milliseconds(spark):
    rows_ = [("2020-01-01 00:00:01.000100", "2020-01-01 00:00:00.000900"), ("1969-12-31 23:59:59.999500", "1969-12-31 23:59:59.000400")]
    df = spark.createDataFrame(rows_, "a STRING, b STRING").select(*(F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"))
    assert [r[0] for r in df.select(dates.time_delta_ms("a", "b")).collect()] == [1000, 999]


def test_new_flags_null_guard(spark):
    df = spark.createDataFrame([(1,), (None,)], "c INT").select(F.when(F.col("c").isNull(), None).otherwise(retail.new_flag("c")))
    assert [r[0] for r in df.collect()] == [1, None]
