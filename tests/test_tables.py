import pytest

from aisleflow.session import work_folder
from aisleflow.sources.tables import append_table, jdbc_options, overwrite_table, read_table
from tests.conftest import rows


def test_missing_table_is_empty_only_with_a_schema(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "none"), "a INT").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "none"))


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "n INT, p STRING")
    append_table(first, path)
    append_table(first, path)
    assert read_table(spark, path).count() == 4
    overwrite_table(first.filter("n = 1"), path)
    assert rows(read_table(spark, path)) == [(1, "a")]


def test_overwrite_replaces_only_the_partitions_it_has(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "n INT, p STRING"), path, ["p"])
    overwrite_table(spark.createDataFrame([(3, "b")], "n INT, p STRING"), path, ["p"])
    assert rows(read_table(spark, path)) == [(1, "a"), (3, "b")]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x://h/db", "racks", driver="d")
    assert plain == {
        "url": "jdbc:x://h/db", "dbtable": "racks", "driver": "d", "fetchsize": "10000", "preferTimestampNTZ": "true",
    }
    parts = jdbc_options("u", "events", partition_column="createdStamp", bounds=("2016-01-01", "2017-01-01"), num_partitions=8)
    assert (parts["partitionColumn"], parts["lowerBound"], parts["upperBound"], parts["numPartitions"]) == (
        "createdStamp", "2016-01-01", "2017-01-01", "8"
    )
    with pytest.raises(ValueError):
        jdbc_options("u", "events", partition_column="eventId")


def test_work_folder_is_below_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second
