"""Keyed state on streams whose rows arrive out of order.

The event table is dealt into files by arrival, up to two hours after the event, so that every
micro-batch holds rows older than some of the one before. With a delay of two hours nothing is
late, and results are those of the batch operator over the rows the watermark has passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog import multi
from freshet.catalog import state as batch_state
from freshet.catalog import windows as batch_win
from freshet.functions.times import utc_wall_clock
from freshet.operators.state import count_map_text
from freshet.plans.scratch import fresh_folder
from freshet.sinks import committed
from freshet.sources import events as src
from freshet.sources.schemas import EVENT_STREAM
from freshet.streaming import batches, ordered
from freshet.streaming import windows as stream_win
from freshet.streaming.run import drain, drained_table

DELAY = "2 hours"
FILES = 3
ORDER = ["ts", "event_id"]
USER = ["user_id"]


def arrival_files(spark: SparkSession, folder: str, parts: int = FILES) -> str:
    """The event table as a folder of files in the order of arrival, each written after the one before."""
    path = fresh_folder(spark, "arrivals")
    table = spark.read.schema(EVENT_STREAM).parquet(f"{folder}/events.parquet")
    clock = F.unix_micros(src.arrival())
    shares = [i / parts for i in range(1, parts)]
    cuts = table.agg(F.percentile_approx(clock, shares, 10_000)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in zip(bounds, bounds[1:]):
        chosen = table if low is None else table.where(clock > low)
        chosen = chosen if high is None else chosen.where(clock <= high)
        # A file by mapping task: files are read in the order they were finished, parts one after the other.
        chosen.write.mode("append").parquet(path)
    return path


def _arrivals(spark: SparkSession, folder: str, delay: str | None = DELAY) -> DataFrame:
    # All files of one part belong to one micro-batch when they are as many as the table has.
    path = arrival_files(spark, folder)
    count = len(spark.read.schema(EVENT_STREAM).parquet(path).inputFiles())
    stream = src.event_stream(spark, path, max(1, -(-count // FILES)))
    return src.event_time(stream, F.col("ts"), delay)


def _shown(df: DataFrame) -> DataFrame:
    times = {name for name, kind in df.dtypes if kind == "timestamp"}
    return df.select([utc_wall_clock(F.col(c)).alias(c) if c in times else F.col(c) for c in df.columns])


def _users(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("event_id", "ts", "user_id", *extra)


def _ordered(spark: SparkSession, folder: str, label: str, program, *extra: str) -> DataFrame:
    found = ordered.in_order(_users(_arrivals(spark, folder), *extra), USER, ORDER, program)
    return _shown(ordered.drained_in_order(spark, found, label))


def stream_ordered_value(spark: SparkSession, folder: str) -> DataFrame:
    """Events per user so far, on every event."""
    return _ordered(spark, folder, "ordered-value", ordered.CountSoFar()).drop("ts")


def stream_ordered_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "ordered-sum", ordered.SumSoFar("event_id")).drop("ts")


def stream_state_list(spark: SparkSession, folder: str) -> DataFrame:
    """The whole history of the user on every event; only new items are written."""
    listed = _ordered(spark, folder, "ordered-list", ordered.History("event_id"))
    return listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))


def stream_ordered_list_clear(spark: SparkSession, folder: str) -> DataFrame:
    listed = _ordered(spark, folder, "ordered-clear", ordered.History("event_id", 11))
    return listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))


def stream_ordered_ttl(spark: SparkSession, folder: str) -> DataFrame:
    table = src.events(spark, folder)
    listed = _ordered(spark, folder, "ordered-ttl", ordered.RecentHistory(table, "event_id", "4 hours"))
    return listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))


def stream_ordered_map(spark: SparkSession, folder: str) -> DataFrame:
    counted = _ordered(spark, folder, "ordered-map", ordered.CountMap("event_type"), "event_type")
    return counted.select("event_id", "user_id", count_map_text().alias("counts"))


def stream_category_count(spark: SparkSession, folder: str) -> DataFrame:
    """The user's events of the event's own type so far: one map entry is touched."""
    counted = _ordered(spark, folder, "category-count", ordered.CategoryCount("event_type"), "event_type")
    return counted.drop("ts")


def stream_count_per_day(spark: SparkSession, folder: str) -> DataFrame:
    """Events per user since midnight: the state is cleared by the clock of the events."""
    table = src.events(spark, folder)
    return _ordered(spark, folder, "count-per-day", ordered.CountPerPeriod(table, "1 day")).drop("ts")


def stream_state_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's count, read from the checkpoint of a finished stream."""
    out = fresh_folder(spark, "read-back")
    counted = ordered.in_order(_users(_arrivals(spark, folder)), USER, ORDER, ordered.CountSoFar())
    with ordered.rocksdb(spark):
        drain(counted, f"{out}/data", f"{out}/checkpoint")
    return ordered.state_rows(spark, f"{out}/checkpoint", "n", "user_id bigint")


HALF = "TIMESTAMP_NTZ'2024-01-02 00:00:00'"


def stream_state_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a batch over the first day are where the stream over the rest goes on."""
    first = src.events(spark, folder).where(f"ts < {HALF}").groupBy(*USER).agg(F.count(F.lit(1)).alias("n"))
    rest = _users(_arrivals(spark, folder)).where(utc_wall_clock(F.col("ts")) >= F.expr(HALF))
    counted = ordered.in_order(rest, USER, ORDER, ordered.CountSoFar(), initial=first)
    return ordered.drained_in_order(spark, counted, "resume").drop("ts")


def stream_control_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases above the threshold that signups set; both come as streams, out of order."""
    both = _arrivals(spark, folder, None)
    added = src.of_type(both, "purchase").select("event_id", "ts", src.quantity().alias("quantity"))
    control = src.of_type(both, "signup").select("ts", F.col("event_id").alias("seq"), src.quantity().alias("setting"))
    found = ordered.controlled(added, control, "ts", "event_id", "quantity", "setting", "seq", DELAY, copies=8)
    shown = _shown(ordered.drained_in_order(spark, found, "control"))
    return shown.withColumn("threshold", F.col("threshold").cast("int"))


def stream_best_window(spark: SparkSession, folder: str) -> DataFrame:
    """The busiest two hours of signups of each day."""
    signups = _arrivals(spark, folder).where("event_type = 'signup'")
    return _shown(drained_table(spark, stream_win.busiest_per_period(signups, "ts", "2 hours", "1 hour", "1 day"), "best-window"))


def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events more than an hour behind the newest that arrived before them, put aside."""
    path = fresh_folder(spark, "late-aside")
    stream = _arrivals(spark, folder, None).withColumn("arrival_ts", src.arrival()).select("event_id", "ts", "arrival_ts")
    aside = batches.late_rows_aside(path, "ts", ["arrival_ts", "event_id"], "1 hour")
    stream.writeStream.foreachBatch(aside).option("checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return _shown(spark.read.parquet(f"{path}/late").select("event_id", "ts"))


def sink_committed(spark: SparkSession, folder: str) -> DataFrame:
    """Events that every fifteenth number names, through a sink that opens and closes per task and commits per batch."""
    path = fresh_folder(spark, "sink-committed")
    chosen = _arrivals(spark, folder, None).where("event_id % 15 = 0")
    committed.text_stream(chosen, F.col("event_id"), f"{path}/data", f"{path}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return committed.committed_text(spark, f"{path}/data")


QUERIES = {
    "sink_committed": sink_committed,
    "stream_ordered_value": stream_ordered_value,
    "stream_ordered_sum": stream_ordered_sum,
    "stream_state_list": stream_state_list,
    "stream_ordered_list_clear": stream_ordered_list_clear,
    "stream_ordered_ttl": stream_ordered_ttl,
    "stream_ordered_map": stream_ordered_map,
    "stream_category_count": stream_category_count,
    "stream_count_per_day": stream_count_per_day,
    "stream_state_read_back": stream_state_read_back,
    "stream_state_resume": stream_state_resume,
    "stream_control_threshold": stream_control_threshold,
    "stream_best_window": stream_best_window,
    "stream_late_events": stream_late_events,
}


def _newest(types: str = "") -> str:
    """The last watermark: the newest event, in milliseconds, minus the delay."""
    return f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events {types})"


def _passed(sql: str, key: str = "event_id", types: str = "") -> str:
    return f"SELECT q.* FROM ({sql}) q JOIN events e USING ({key}) WHERE e.ts <= {_newest(types)}"


_CHANGES = "WHERE event_type IN ('purchase', 'signup')"

SQL = {
    "sink_committed": "SELECT CAST(event_id AS VARCHAR) AS value FROM events WHERE event_id % 15 = 0",
    "stream_ordered_value": _passed(batch_state.SQL["state_value"]),
    "stream_ordered_sum": _passed(
        """SELECT event_id, user_id, CAST(sum(event_id) OVER (
               PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events"""
    ),
    "stream_state_list": _passed(batch_state.SQL["state_list"]),
    "stream_ordered_list_clear": _passed(batch_state.SQL["state_list_clear"]),
    "stream_ordered_ttl": _passed(batch_state.SQL["state_ttl"]),
    "stream_ordered_map": _passed(batch_state.SQL["state_map"]),
    "stream_category_count": _passed(
        """SELECT event_id, user_id, event_type, row_number() OVER (
               PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events"""
    ),
    "stream_count_per_day": _passed(
        """SELECT event_id, user_id, row_number() OVER (
               PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS n FROM events"""
    ),
    "stream_state_read_back": f"SELECT user_id, count(*) AS n FROM events WHERE ts <= {_newest()} GROUP BY user_id",
    "stream_state_resume": _passed(
        f"""SELECT event_id, user_id, n FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
            WHERE ts >= {HALF.replace('_NTZ', '')}"""
    ),
    "stream_control_threshold": _passed(multi.SQL["changing_threshold_stream"], types=_CHANGES),
    "stream_best_window": f"""
        WITH counted AS (
            SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, count(*) AS n FROM (
                SELECT time_bucket(INTERVAL 1 HOUR, ts) - k * INTERVAL 1 HOUR AS ws
                FROM events, range(2) r(k) WHERE event_type = 'signup') GROUP BY ws),
        ranked AS (
            SELECT *, date_trunc('day', window_end - INTERVAL 1 MICROSECOND) AS period_start FROM counted)
        SELECT period_start, window_start, window_end, n FROM ranked
        WHERE period_start + INTERVAL 1 DAY <= {_newest("WHERE event_type = 'signup'")}
        QUALIFY row_number() OVER (PARTITION BY period_start ORDER BY n DESC, window_start) = 1""",
    "stream_late_events": batch_win.SQL["late_events"],
}
