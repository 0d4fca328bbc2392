"""The hand-computed scenarios: two users, two days, leading zeros, allergens."""

import pytest

from aisleflow.plans import allergens, conversion, footfall, sales, visitors
from aisleflow.sources.events import checkout_rows, location_rows, parse_messages
from tests.conftest import at, leading_zeros, lines_frame, rows, two_days, two_users_one_day

DAY_4, DAY_14, DAY_15 = at("2021-03-04"), at("2022-07-14"), at("2022-07-15")


def frames(spark, lines):
    parsed = parse_messages(lines_frame(spark, lines))
    return location_rows(parsed), sales.order_items(checkout_rows(parsed))


@pytest.fixture(scope="module")
def one_day(spark):
    return frames(spark, two_users_one_day())


def test_two_users_conversion(one_day, dims):
    stats = conversion.daily_visitors_category_wise(*one_day, dims)
    assert rows(stats, "categoryId", "total", "converted", "failed") == [(2, 3, 2, 1), (3, 1, 1, 0), (4, 1, 0, 1)]
    assert rows(stats, "day", "month", "year", "time") == [(4, 3, 2021, DAY_4)] * 3


def test_two_users_sales(one_day, dims):
    summary = sales.daily_category_sale_summary(one_day[1], dims)
    assert rows(summary, "categoryId", "saleCountAgg", "saleAmountAgg", "time") == [
        (2, 4, 50.0, DAY_4), (3, 1, 8.0, DAY_4)
    ]


def test_two_users_visitors_with_legacy_calendar(one_day):
    counts = visitors.daily_visitors(one_day[0], one_day[0], legacy=True)
    assert rows(counts) == [(1, 1, 4, 2, 121, DAY_4, 2, 0, 2)]


def test_fanout_multiplies_by_racks_of_the_category(spark, one_day, dims):
    doubled = dims.union(spark.createDataFrame([(9, 2, "cat2")], dims.schema))
    summary = sales.daily_category_sale_summary(one_day[1], doubled, fanout=True)
    assert rows(summary, "categoryId", "saleCountAgg", "saleAmountAgg") == [(2, 8, 100.0), (3, 1, 8.0)]
    once = sales.daily_category_sale_summary(one_day[1], doubled)
    assert rows(once, "categoryId", "saleCountAgg") == [(2, 4), (3, 1)]


@pytest.fixture(scope="module")
def days(spark):
    return frames(spark, two_days())[0]


def test_two_days_footfall(days, dims):
    counted = footfall.daily_category_footfall(visitors.entry_events(days), dims)
    assert rows(counted, "time", "categoryId", "footfallCount") == [
        (DAY_14, 1, 1), (DAY_14, 3, 2), (DAY_15, 1, 1), (DAY_15, 2, 1), (DAY_15, 3, 1), (DAY_15, 4, 1)
    ]
    unfiltered = footfall.daily_category_footfall(days, dims)
    assert unfiltered.filter("categoryId = 1 AND day = 14").first().footfallCount == 2


def test_two_days_first_visits_and_visitors(days):
    first = visitors.user_first_visit(days, entry_only=True)
    assert rows(first, "userId", "firstTime") == [("31", at("2022-07-14 13:10:44")), ("45", at("2022-07-14 12:00:05"))]
    counts = visitors.daily_visitors(days, days)
    assert rows(counts, "time", "new_visitors", "repeated_visitors", "total") == [(DAY_14, 2, 0, 2), (DAY_15, 0, 2, 2)]


def test_two_days_by_count(days):
    entries = visitors.entry_events(days)
    assert rows(visitors.daily_visit(entries), "userId", "time", "VisitCount") == [
        ("31", DAY_14, 1), ("31", DAY_15, 3), ("45", DAY_14, 2), ("45", DAY_15, 1)
    ]
    counts = visitors.daily_visitors_by_count(entries)
    assert rows(counts, "time", "new_visitors", "repeated_visitors") == [(DAY_14, 1, 1), (DAY_15, 1, 1)]
    monthly = visitors.visits_by_grain(entries, "month")
    assert rows(visitors.repeat_by_count(monthly), "userId", "month", "VisitCount") == [("31", 7, 4), ("45", 7, 3)]
    assert visitors.new_by_count(monthly).count() == 0


def test_visit_types_are_one_row_per_visit(days):
    entries = visitors.entry_events(days)
    types = visitors.user_visit_type(entries, visitors.user_first_visit(entries))
    assert rows(types, "userId", "time", "visitType") == (
        [("31", DAY_14, "NEW")] + [("31", DAY_15, "REPEAT")] * 3 + [("45", DAY_14, "NEW")] * 2 + [("45", DAY_15, "REPEAT")]
    )


def test_leading_zeros_three_days(spark, dims):
    seen, items = frames(spark, leading_zeros())
    stats = conversion.daily_visitors_category_wise(seen, items, dims)
    assert rows(stats, "day", "categoryId", "total", "converted", "failed") == [(10, 2, 1, 1, 0), (13, 2, 2, 1, 1)]
    summary = sales.daily_category_sale_summary(items, dims)
    assert rows(summary, "day", "saleCountAgg", "saleAmountAgg") == [(10, 5, 40.0), (13, 5, 40.0)]
    counts = visitors.daily_visitors(seen, seen)
    assert rows(counts, "day", "new_visitors", "repeated_visitors") == [(10, 1, 0), (12, 0, 1), (13, 0, 1)]


def test_failed_is_negative_without_footfall(spark, dims, one_day):
    nobody = one_day[0].limit(0)
    stats = conversion.daily_visitors_category_wise(nobody, one_day[1], dims)
    assert rows(stats, "categoryId", "total", "converted", "failed") == [(2, 0, 2, -2), (3, 0, 1, -1)]


def test_store_conversion_drops_days_without_a_sale(spark, dims):
    seen, items = frames(spark, leading_zeros())
    stats = conversion.store_conversion(seen, items, dims)
    assert rows(stats, "time", "total", "converted", "failed") == [
        (at("2023-02-10"), 1, 1, 0), (at("2023-02-13"), 1, 1, 0)
    ]


PROFILE = [
    ("north", "k1", "kim", "b1", "milk"), ("north", "k1", "kim", "b2", "egg,nuts"), ("north", "k1", "kim", "b3", "milk,soy"),
    ("north", "k1", "lee", "b4", "fish"), ("north", "k1", "lee", "b5", "egg"),
]


def test_allergen_profile(spark):
    profile = spark.createDataFrame(PROFILE, "orgId STRING, storeId STRING, userId STRING, orderId STRING, Allergens STRING")
    assert rows(allergens.allergen_profile(profile)) == [("north", "k1", "kim", a) for a in ("egg", "milk", "nuts", "soy")]
    elsewhere = profile.union(spark.createDataFrame([("south", "k9", "kim", "b9", "rye")], profile.schema))
    assert ("south", "k9", "kim", "rye") in rows(allergens.allergen_profile(elsewhere))


def test_allergy_notifications_count_listings(spark):
    bought = spark.createDataFrame(
        [("u1", 1, 10, 1), ("u1", 2, 10, 5), ("u2", 3, 10, 1), ("u3", 4, 11, 1)],
        "userId STRING, orderId BIGINT, productId BIGINT, quantity INT",
    )
    indicators = spark.createDataFrame([(10, "milk")], "productId BIGINT, allergen STRING")
    notified = allergens.allergy_notifications(bought, indicators)
    assert rows(notified) == [("u1", 2, "allergy detected"), ("u2", 1, "no allergy detected uptil now")]
    twice = indicators.union(spark.createDataFrame([(10, "egg")], indicators.schema))
    assert rows(allergens.allergy_notifications(bought, twice), "userId", "purchasedCount") == [("u1", 4), ("u2", 2)]
