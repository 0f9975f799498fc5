"""Kafka, JDBC and other connectors. Each needs its connector on the class path."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from freshet.functions.codecs import encode_person


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def people_to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """A stream of (name, age) as ``"name, age"`` messages."""
    messages = encode_person(df).select("value")
    writer = messages.writeStream.format("kafka").options(**kafka_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint)


def jdbc_options(url: str, table: str, driver: str, user: str, password: str, batch: int = 1000) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "user": user,
        "password": password,
        "batchsize": str(batch),
    }


def connector_sink(
    format: str, options: Mapping[str, str], columns: Sequence[str], batch_column: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends chosen columns through any connector.

    ``format`` is ``"jdbc"`` or the name of an installed connector. A failed
    batch is written again; with ``batch_column`` the rows carry their batch id,
    so the target can drop the repeat by a unique key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns)
        if batch_column:
            rows = rows.withColumn(batch_column, F.lit(batch_id).cast("bigint"))
        rows.write.format(format).options(**options).mode("append").save()

    return write
