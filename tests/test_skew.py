"""One key holding a third of all rows: same results, even work."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from aisleflow.model import STORE_USER
from aisleflow.operators import joins
from aisleflow.operators.skew import lookup_join, repeat_rows
from tests.conftest import rows

N = 60_000


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows are equal copies of one key, some keys are null."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 1000 == 1, None).otherwise(n % 5000)
    return spark.range(0, N, 1, 32).select(key.cast("bigint").alias("k"), (n % 2).alias("g"))


@pytest.fixture(scope="module")
def lookup(spark):
    n = F.col("id")
    return spark.range(0, 4000).select(n.alias("k"), (n % 2).alias("g"), (n * 10).alias("v"))


@pytest.fixture
def large_lookups(spark):
    """No lookup counts as small, as at full scale."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def counted(df):
    return rows(df.groupBy(*df.columns).count())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("on", [["k"], ["k", "g"]])
def test_same_rows_as_a_plain_join(facts, lookup, large_lookups, how, on):
    side = lookup if len(on) == 2 else lookup.select("k", "v")
    assert counted(lookup_join(facts, side, on, how)) == counted(facts.join(side, on, how))


def test_lookup_rows_may_repeat(facts, lookup, large_lookups):
    side = lookup.select("k", "v")
    side = side.union(side.filter("k < 10"))
    assert counted(lookup_join(facts, side, ["k"])) == counted(facts.join(side, "k"))


def test_only_kept_fact_joins(facts, lookup):
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, ["k"], "full")


@pytest.fixture
def small_scale(spark, large_lookups):
    """Adaptive execution at the size of these rows."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("grouped", [False, True])
def test_hot_rows_are_dealt_to_many_tasks(spark, facts, lookup, small_scale, how, grouped):
    """The plan that ran cuts the hot partition, also where a grouping by the key follows."""
    joined = lookup_join(facts.withColumn("n", F.rand(3)), lookup.select("k", "v"), ["k"], how)
    if grouped:
        joined = joined.groupBy("k").agg(F.sum("n").alias("n"))
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_spreads_over_partitions(spark, facts, lookup, small_scale):
    joined = lookup_join(facts.withColumn("n", F.rand(3)), lookup.select("k", "v"), ["k"])
    tasks = Counter(r.p for r in joined.select("k", "n", F.spark_partition_id().alias("p")).collect() if r.k == 7)
    assert len(tasks) >= 4 and max(tasks.values()) <= 0.5 * sum(tasks.values())


def test_building_plans_starts_no_job(spark, facts, lookup, dims):
    """Every row-grain join, from frames that exist."""
    one = spark.createDataFrame([("u", 1, 1, 2, 1, 1, "x", 3, "a")], "userId STRING, orgId INT, storeId INT, rackId INT, categoryId INT, productId INT, productCode STRING, minorId INT, Allergens STRING")
    spark.sparkContext.setJobGroup("building", "plans")
    try:
        for build in (
            lambda: joins.location_with_category(one, dims.select("rackId", "categoryName")), lambda: joins.items_with_category(one, dims),
            lambda: joins.items_with_category(one, dims, fanout=True), lambda: joins.visits_with_first_visit(one, one.select(*STORE_USER)),
            lambda: joins.profiled_users(one, one), lambda: joins.allergen_products(one, one.select("productId")),
            lambda: joins.allergen_profile_input(one, one.select("orgId", "storeId", "productId")),
            lambda: joins.minor_to_rack(one, one.select("minorId")), lambda: joins.product_code_lookup(one, one.select("productCode")),
            lambda: lookup_join(facts, lookup, ["k", "g"], "left"),
        ):
            build()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_small_lookup_is_broadcast(facts, lookup):
    tree = lookup_join(facts, lookup.select("k", "v"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in tree


def test_repeat_rows_cuts_large_counts(spark):
    df = spark.createDataFrame([("a", 25_001), ("b", 1), ("c", 0), ("d", 10_000)], "k STRING, n BIGINT")
    repeated = repeat_rows(df, "n", chunk=1000)
    assert rows(repeated.groupBy("k").count()) == [("a", 25_001), ("b", 1), ("d", 10_000)]
    spread = repeated.filter("k = 'a'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1
