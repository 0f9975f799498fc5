"""Streams that run by the clock, into several sinks, through connectors; parallelism per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog import multi
from freshet.catalog import state as batch_state
from freshet.catalog import windows as batch_win
from freshet.functions.times import utc_wall_clock
from freshet.operators import windows as win
from freshet.plans.scratch import fresh_folder
from freshet.sinks import external, files
from freshet.sources import events as src
from freshet.streaming import batches
from freshet.streaming.run import start_updating

ORDER = ["ts", "event_id"]


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    return src.event_stream(spark, f"{folder}/{{events}}.parquet")


def _drain(df: DataFrame, write, path: str) -> None:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


def stream_clock_firing(spark: SparkSession, folder: str) -> DataFrame:
    """Windows fire by the clock, every second, also while they are open; the last result of each counts.

    The watermark, half a second behind the newest event, moves with the same clock."""
    timed = src.event_time(_stream(spark, folder), F.col("ts"), "500 milliseconds")
    counted = win.tumbling(timed, "ts", "3 hours", {"n": win.count(F.col("event_type") == "signup")})
    path = fresh_folder(spark, "clock")
    query = start_updating(counted, files.replace_batch(f"{path}/fired"), f"{path}/checkpoint", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    fired = spark.read.parquet(f"{path}/fired").groupBy("window_start", "window_end").agg(F.max_by("n", "batch_id").alias("n"))
    return fired.select(*[utc_wall_clock(F.col(c)).alias(c) for c in ("window_start", "window_end")], "n")


def stream_reduce_hot(spark: SparkSession, folder: str) -> DataFrame:
    """A running sum for two keys, each half of the stream: every micro-batch is cut into slots, sums are carried."""
    numbers = _stream(spark, folder).select("event_id", "ts", (F.col("event_id") % 2 == 0).alias("even"))
    path = fresh_folder(spark, "reduce-hot")
    _drain(numbers, batches.running_counts(path, ["even"], ORDER, {}, sums={"total": F.col("event_id")}), path)
    return spark.read.parquet(f"{path}/rows").select("event_id", "even", "total")


def stream_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """A running stream into two sinks, read back from both."""
    cart = src.cart_events(_stream(spark, folder)).select("event_id", "user_id", "quantity")
    path = fresh_folder(spark, "fan-out")
    text = files.replace_batch(f"{path}/text", "text")
    sinks = {
        "table": files.replace_batch(f"{path}/table"),
        "text": lambda batch, batch_id: text(batch.select(F.concat_ws(",", *batch.columns)), batch_id),
    }
    _drain(cart, files.fan_out(sinks), path)
    table = spark.read.parquet(f"{path}/table").select(F.lit("table").alias("sink"), F.concat_ws(",", *cart.columns).alias("line"))
    return table.unionByName(spark.read.text(f"{path}/text").select(F.lit("text").alias("sink"), F.col("value").alias("line")))


def sink_connector(spark: SparkSession, folder: str) -> DataFrame:
    """Cart events as tuples of chosen columns, inserted batch by batch through a connector, with the batch's number."""
    path = fresh_folder(spark, "connector")
    write = external.connector_sink("parquet", {"path": f"{path}/target"}, ["user_id", "sku"], "batch")
    _drain(src.cart_events(_stream(spark, folder)), write, path)
    return spark.read.parquet(f"{path}/target")


def step_parallelism(spark: SparkSession, folder: str) -> DataFrame:
    """A map on eight partitions, a filter on two, whatever the job runs on; with the partition each row ended in."""
    numbers = src.events(spark, folder).select("event_id").repartition(8)
    scaled = numbers.select((F.col("event_id") * 10).alias("n")).coalesce(2)
    placed = scaled.where("n % 20 = 0").select("n", F.spark_partition_id().alias("part"))
    return placed.select("n", (F.col("part") < 2).alias("within"))


QUERIES = {
    "stream_clock_firing": stream_clock_firing,
    "stream_reduce_hot": stream_reduce_hot,
    "stream_fan_out": stream_fan_out,
    "sink_connector": sink_connector,
    "step_parallelism": step_parallelism,
}

_LINE = f"event_id || ',' || user_id || ',' || {multi._QUANTITY}"
_ADDED = "FROM events WHERE event_type IN ('purchase', 'error')"

SQL = {
    "stream_clock_firing": batch_win.SQL["tumble_count"],
    "stream_reduce_hot": batch_state.SQL["reduce_running"],
    "stream_fan_out": f"SELECT 'table' AS sink, {_LINE} AS line {_ADDED} UNION ALL SELECT 'text', {_LINE} {_ADDED}",
    "sink_connector": f"SELECT user_id, {multi._SKU} AS sku, CAST(0 AS BIGINT) AS batch {_ADDED}",
    "step_parallelism": "SELECT event_id * 10 AS n, true AS within FROM events WHERE event_id % 2 = 0",
}
