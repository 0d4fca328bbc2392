"""The daily products of a stream from its facts, by few groupings instead of one plan per product.

Footfall, sales, buyers and typed visitors become contributions to the products they
count in and are summed by one grouping. Visits are dealt by user once: merging them per day, asking
for first visits and joining those all use that partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from aisleflow.functions.dates import with_calendar
from aisleflow.functions.retail import NEW, REPEAT, visit_type
from aisleflow.model import STORE_DAY, STORE_USER
from aisleflow.operators.aggregates import user_first_visit
from aisleflow.plans.facts import BUYER, FOOTFALL, SALE, VISIT, merged
from aisleflow.plans.visitors import with_new_and_repeat

FOOTFALLS, SALES, CONVERSION, VISITORS = "dailyCategoryFootfall", "dailyCategorySaleWithCountAgg", "dailyVisitorsCategoryWise", "dailyVisitors"
# What a fact counts in, as sums: product -> {column: (fact, value)}.
MEASURES = {
    FOOTFALLS: {"footfallCount": (FOOTFALL, "n")},
    SALES: {"saleAmountAgg": (SALE, "amount"), "saleCountAgg": (SALE, "n")},
    CONVERSION: {"total": (FOOTFALL, "n"), "converted": (BUYER, "1L")},
    VISITORS: {"new_visitors": (VISIT, "is_new"), "repeated_visitors": (VISIT, "is_repeat")},
}


def merged_visits(facts: DataFrame) -> DataFrame:
    """Visits of a store, user and day as one row, rows of a user together."""
    own = facts.filter(F.col("table") == VISIT).select(*STORE_USER, "time", "n", "amount", "firstTime")
    return merged(own.repartition(*STORE_USER), [*STORE_USER, "time"])


def first_visits(visits: DataFrame, seen: DataFrame) -> DataFrame:
    """First visits of the visitors, from all visits ever seen (STORE_USER, firstTime)."""
    wanted = visits.select(*STORE_USER).distinct()
    return user_first_visit(seen.join(wanted, STORE_USER, "left_semi"), "firstTime")


def _contributions(facts: DataFrame, typed: DataFrame) -> DataFrame:
    """One row per fact and product that it counts in."""
    counted = facts.filter(F.col("table").isin(FOOTFALL, SALE))
    buyers = merged(facts.filter(F.col("table") == BUYER))
    kinds = ["table", *STORE_DAY, "categoryId", "n", "amount"]
    rows = counted.select(*kinds).unionByName(buyers.select(*kinds))
    flag = lambda kind: F.when(F.col("userId").isNotNull() & (F.col("visitType") == kind), 1).otherwise(0).cast("bigint")
    visits = typed.filter(F.col("visitType").isin(NEW, REPEAT)).select(
        F.lit(VISIT).alias("table"), *STORE_DAY, flag(NEW).alias("is_new"), flag(REPEAT).alias("is_repeat")
    )
    rows = rows.unionByName(visits, allowMissingColumns=True)

    def products_of(fact: str) -> Column:
        return F.array(*[F.lit(p) for p, sums in MEASURES.items() if any(kind == fact for kind, _ in sums.values())])

    facts_of = [FOOTFALL, SALE, BUYER, VISIT]
    product = reduce(lambda c, kind: c.when(F.col("table") == kind, products_of(kind)), facts_of[1:], F.when(F.col("table") == facts_of[0], products_of(facts_of[0])))
    return rows.withColumn("product", F.explode(product))


def daily_products(facts: DataFrame, seen: DataFrame, legacy: bool = False) -> DataFrame:
    """All daily products of some days as tagged rows, from the facts of those days and all first visits seen."""
    visits = merged_visits(facts)
    typed = visits.drop("firstTime", "amount").join(first_visits(visits, seen), STORE_USER)
    typed = typed.withColumn("visitType", visit_type("time", "firstTime", legacy))
    sums = {
        column: F.sum(F.when((F.col("product") == product) & (F.col("table") == kind), F.expr(value))).alias(column)
        for product, own in MEASURES.items()
        for column, (kind, value) in own.items()
    }
    totals = _contributions(facts, typed).groupBy("product", *STORE_DAY, "categoryId").agg(*sums.values())
    of = lambda product, value: F.when(F.col("product") == product, value)
    none_is_zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    totals = totals.withColumns({
        "total": of(CONVERSION, none_is_zero("total")).when(F.col("product") == VISITORS, F.col("new_visitors") + F.col("repeated_visitors")),
        "converted": of(CONVERSION, none_is_zero("converted")),
    }).withColumn("failed", F.col("total") - F.col("converted"))
    counts = visits.select("orgId", "storeId", "time", "userId", F.col("n").alias("VisitCount"))
    flagged = with_new_and_repeat(counts)
    both = F.array(F.lit("dailyVisit"), F.lit("newRepeatDaily"))
    by_user = flagged.withColumn("product", F.explode(both)).withColumns(
        {c: F.when(F.col("product") == "newRepeatDaily", F.col(c)) for c in ("New", "Repeat")}
    )
    return with_calendar(totals, legacy).unionByName(by_user, allowMissingColumns=True)
