"""What the plans must and must not hold."""

import contextlib
import io
import re

import pytest

from aisleflow.catalog import QUERIES
from aisleflow.plans import allergens, footfall, sales
from aisleflow.sources import star_schema as star
from aisleflow.sources.dimensions import load_dimensions

SF = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith("stream_") and n not in (
    "read_event_stream", "micro_batch", "raw_messages", "for_each_batch", "read_table", "append_table",
    "overwrite_table", "load_dimensions",
)]


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


def test_time_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["daily_category_footfall"](spark, SF))
    assert "LessThan(ts,2024-01-16T00:00)" in text and "GreaterThanOrEqual(ts,2024-01-16T00:00)" in text
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert schemas and all("value" not in s for s in schemas)


def test_small_dimension_is_broadcast_without_a_hint(spark):
    dims = star.category(spark, SF)
    text = plan(footfall.daily_category_footfall(star.location_events(spark, SF), dims))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_dimension_joins_sums_not_events(spark, no_broadcast):
    """Below every shuffle of facts sits a partial aggregate: raw events are never moved."""
    dims = star.category(spark, SF)
    location = star.location_events(spark, SF)
    tree = footfall.daily_category_footfall(location, dims)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in tree
    lines = tree.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    of_facts = [i for i in exchanges if "storeId" in lines[i + 1]]
    assert len(of_facts) == 3 and all("HashAggregate" in lines[i + 1] for i in of_facts)


def test_category_check_moves_below_the_sums_when_small(spark):
    text = sales.sale_facts(star.checkout_items(spark, SF), star.category(spark, SF))
    tree = text._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("sum(quantity") < tree.index("LeftSemi")


def test_category_check_stays_above_the_sums_when_large(spark, no_broadcast):
    facts = sales.sale_facts(star.checkout_items(spark, SF), star.category(spark, SF))
    tree = facts._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("LeftSemi") < tree.index("sum(quantity")


def test_dimension_is_measured_and_not_hinted(spark):
    dims = load_dimensions(star.racks(spark, SF), star.category(spark, SF))
    assert "ResolvedHint" not in dims._jdf.queryExecution().analyzed().toString()
    assert dims.storageLevel.useMemory
    dims.unpersist()


def test_allergen_profile_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "profile")
    fields = "orgId INT, storeId INT, userId STRING, orderId BIGINT, Allergens STRING"
    spark.createDataFrame([(1, 1, "a", n, "egg,milk") for n in range(3)], fields).write.parquet(path)
    found = allergens.allergen_profile(spark.read.parquet(path))
    assert plan(found).count("Scan parquet") == 2  # once in the tree, once in the list of nodes
    assert sorted(r.Allergen for r in found.collect()) == ["egg", "milk"]
