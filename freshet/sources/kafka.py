"""Kafka topics. Needs the spark-sql-kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.codecs import decode_person


def read_options(servers: str, topics: str, group: str | None = None, starting: str = "earliest") -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
    }
    if group:
        options["kafka.group.id"] = group
    return options


def _messages(
    spark: SparkSession, servers: str, topics: str, group: str | None, max_offsets: int | None, starting: str
) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**read_options(servers, topics, group, starting))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value")


def read_strings(
    spark: SparkSession,
    servers: str,
    topics: str,
    group: str | None = None,
    max_offsets: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """Message payloads of a topic as text; ``max_offsets`` bounds a micro-batch.

    ``starting`` is where a new query begins: ``earliest``, ``latest`` or offsets as JSON.
    """
    return _messages(spark, servers, topics, group, max_offsets, starting).select(F.col("value").cast("string").alias("value"))


def read_people(
    spark: SparkSession,
    servers: str,
    topics: str,
    group: str | None = None,
    max_offsets: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """Topic of ``"name, age"`` messages as (name, age)."""
    return decode_person(_messages(spark, servers, topics, group, max_offsets, starting)).select("name", "age")
