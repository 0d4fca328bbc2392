"""Unbounded sources of message lines: each gives one ``value`` string column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Newline-delimited messages from files arriving in a folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages from a topic; needs Spark's Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    return reader.options(**options).load().selectExpr("CAST(value AS STRING) AS value")


def read_socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. Spark cannot replay a socket, so this is for demos only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
