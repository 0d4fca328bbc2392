"""Relational tables: whole reads, appends and overwrites."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A parquet table; with a schema given, a table never written yet is empty."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if schema and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table, or, when it is partitioned, only the partitions ``df`` has."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of one JDBC read.

    With a partition column, Spark reads ranges of it in parallel; without one, a
    table passes through a single task, which suits dimensions only.
    """
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
        **extra,
    }
    if driver:
        options["driver"] = driver
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return options


def read_jdbc_table(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()


def write_jdbc_table(df: DataFrame, url: str, table: str, mode: str, **options: str) -> None:
    """Append to or overwrite a JDBC table; overwriting truncates and so keeps its DDL."""
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    writer.option("truncate", "true").options(**options).save()
