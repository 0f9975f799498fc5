"""The operators run as Structured Streaming jobs over the event files.

Each query drains the whole event table through a stream into the shared folder
and reads the result back. Windows and sessions still open when the stream ends
(behind the watermark) are not emitted, which the SQL says too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.columns import fizzbuzz, share_percent
from freshet.functions.times import utc_wall_clock
from freshet.operators import joins, routing
from freshet.operators import windows as win
from freshet.operators.state import count_map_text
from freshet.plans.scratch import fresh_folder
from freshet.sinks import files
from freshet.sources import events as src
from freshet.streaming import batches, state
from freshet.streaming import windows as stream_win
from freshet.streaming.run import drained_table

DELAY = "1 hour"
BATCH_BYTES = 4 << 30
"""Size of a micro-batch: a key's share of one must fit in a Python task."""

ORDER = ["ts", "event_id"]
USER = ["user_id"]


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, so that one file and a folder of files both serve as the source.
    return src.event_stream(spark, f"{folder}/{{events}}.parquet", max_bytes_per_trigger=BATCH_BYTES)


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    return src.event_time(_stream(spark, folder), F.col("ts"), DELAY)


def _wall_clock(df: DataFrame) -> DataFrame:
    times = {name for name, kind in df.dtypes if kind == "timestamp"}
    return df.select([utc_wall_clock(F.col(c)).alias(c) if c in times else F.col(c) for c in df.columns])


def _drained(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    return _wall_clock(drained_table(spark, df, label))


def _is_signup():
    return F.col("event_type") == "signup"


def stream_tumble_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = win.tumbling(_timed(spark, folder), "ts", "3 hours", {"n": win.count(_is_signup())})
    return _drained(spark, counted, "tumble")


def stream_tumble_by_type(spark: SparkSession, folder: str) -> DataFrame:
    counted = win.tumbling(_timed(spark, folder), "ts", "3 hours", {"n": win.count()}, ["event_type"])
    return _drained(spark, counted, "tumble-by-type")


def stream_slide_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = win.sliding(_timed(spark, folder), "ts", "3 hours", "1 hour", {"n": _is_signup()})
    return _drained(spark, counted, "slide")


def stream_session_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = stream_win.sessions(_timed(spark, folder), "ts", "10 minutes", {"signups": _is_signup(), "n": None})
    return _drained(spark, counted, "session")


def stream_session_by_user(spark: SparkSession, folder: str) -> DataFrame:
    counted = stream_win.sessions(_timed(spark, folder), "ts", "4 hours", {"n": None}, USER)
    return _drained(spark, counted, "session-by-user")


def _side(spark: SparkSession, folder: str, event_type: str) -> DataFrame:
    return src.of_type(_timed(spark, folder), event_type).select("event_id", "ts", "user_id")


def stream_window_join(spark: SparkSession, folder: str) -> DataFrame:
    pairs = joins.window_join(_side(spark, folder, "purchase"), _side(spark, folder, "view"), USER, "ts", "5 hours")
    return _drained(spark, pairs, "window-join")


def stream_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    pairs = joins.interval_join(
        _side(spark, folder, "purchase"),
        _side(spark, folder, "view"),
        USER,
        "ts",
        "-2 hours",
        "2 hours",
        False,
        False,
    )
    return _drained(spark, pairs, "interval-join")


def stream_union(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(_stream(spark, folder))
    first = routing.with_source(cart.where(F.col("event_type") == "added"), "kafka")
    second = routing.with_source(cart.where(F.col("event_type") == "removed"), "files")
    return _drained(spark, routing.union_streams(first, second), "union")


def stream_side_tagged(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(_stream(spark, folder))
    return _drained(spark, routing.side_output(cart, F.col("user_id") == 7)[1], "side")


def _user_stream(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return _stream(spark, folder).select("event_id", "ts", "user_id", *extra)


def stream_state_value(spark: SparkSession, folder: str) -> DataFrame:
    counted = state.count_so_far(_user_stream(spark, folder), USER, ORDER)
    return _drained(spark, counted.drop("ts"), "state-value")


def stream_reduce_running(spark: SparkSession, folder: str) -> DataFrame:
    numbers = _stream(spark, folder).select("event_id", "ts", "user_id")
    return _drained(spark, state.reduce_running(numbers, USER, ORDER, "event_id").drop("ts"), "reduce-running")


def stream_state_list_clear(spark: SparkSession, folder: str) -> DataFrame:
    listed = state.history(_user_stream(spark, folder), USER, ORDER, "event_id", chunk=11)
    text = listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))
    return _drained(spark, text, "state-list-clear")


def stream_state_ttl(spark: SparkSession, folder: str) -> DataFrame:
    df = _timed(spark, folder).select("event_id", "ts", "user_id")
    listed = state.recent_history(df, USER, ORDER, "event_id", "4 hours", evict=True)
    text = listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))
    return _drained(spark, text, "state-ttl")


def stream_state_map(spark: SparkSession, folder: str) -> DataFrame:
    counted = state.count_map(_user_stream(spark, folder, "event_type"), USER, ORDER, "event_type")
    text = counted.select("event_id", "user_id", count_map_text().alias("counts"))
    return _drained(spark, text, "state-map")


def _window_firings(spark: SparkSession, folder: str, label: str, purge: bool) -> DataFrame:
    """A firing after every fifth event of a six-hour window. A backlog is one or two windows, so the
    rows of a micro-batch are counted by the batch operator, which cuts hot windows, and totals are carried."""
    keys, every = ["window_start", "window_end"], 5
    windowed = win.with_window(_stream(spark, folder).select("event_id", "ts"), "ts", "6 hours")

    def fired(rows: DataFrame) -> DataFrame:
        n = F.lit(every).cast("bigint") if purge else F.col("n")
        firing = (F.col("n") / every).cast("bigint").alias("firing")
        return rows.where(F.col("n") % every == 0).select(*keys, firing, n.alias("n"))

    counts, closing = {"n": F.lit(True)}, batches.Closing("window_end", "ts", DELAY)
    return _batched(
        spark, windowed, label, lambda path: batches.running_counts(path, keys, ORDER, counts, fired, closing=closing)
    )


def stream_count_trigger(spark: SparkSession, folder: str) -> DataFrame:
    return _window_firings(spark, folder, "count-trigger", purge=False)


def stream_purging_trigger(spark: SparkSession, folder: str) -> DataFrame:
    return _window_firings(spark, folder, "purging-trigger", purge=True)


def sink_stream_text(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "sink-stream-text")
    numbers = _stream(spark, folder).select(F.col("event_id").alias("n"))
    chosen = numbers.where(fizzbuzz(F.col("n")) == "fizzbuzz")
    writer = files.stream_to_text(chosen, F.col("n"), f"{path}/data", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.text(f"{path}/data")


def _batched(spark: SparkSession, df: DataFrame, label: str, make) -> DataFrame:
    """Drain a stream through a ``foreachBatch`` function that ``make`` builds for a folder."""
    path = fresh_folder(spark, label)
    writer = df.writeStream.foreachBatch(make(path)).option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return _wall_clock(spark.read.parquet(f"{path}/rows").drop("batch_id"))


def stream_connect_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """The share of each stream in all events so far, carried from micro-batch to micro-batch."""
    both = src.of_type(_stream(spark, folder), "purchase", "view").select("event_id", "ts", "event_type")
    is_cart = F.col("event_type") == "purchase"

    def percent(rows: DataFrame) -> DataFrame:
        own, other = (F.when(is_cart, F.col(a)).otherwise(F.col(b)) for a, b in (("cart", "catalog"), ("catalog", "cart")))
        name = F.when(is_cart, "cart").otherwise("catalog").alias("stream")
        return rows.select("event_id", name, share_percent(own, other).alias("percent"))

    counts = {"cart": is_cart, "catalog": ~is_cart}
    return _batched(spark, both, "connect-ratio", lambda path: batches.running_counts(path, [], ORDER, counts, percent))


def stream_global_count_trigger(spark: SparkSession, folder: str) -> DataFrame:
    """One global window that fires after every tenth event, with the signups so far."""
    events = _stream(spark, folder).select("event_id", "ts", "event_type")

    def fired(rows: DataFrame) -> DataFrame:
        shown = rows.where(F.col("n") % 10 == 0)
        return shown.select((F.col("n") / 10).cast("bigint").alias("firing"), "n", "signups")

    counts = {"n": F.lit(True), "signups": _is_signup()}
    return _batched(spark, events, "global-trigger", lambda path: batches.running_counts(path, [], ORDER, counts, fired))


def stream_count_below_threshold(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(_stream(spark, folder)).where("event_type = 'added' and quantity < 5")
    few = cart.select("event_id", "ts", "user_id")

    def shown(rows: DataFrame) -> DataFrame:
        return rows.select("event_id", "user_id", "n")

    counts = {"n": F.lit(True)}
    return _batched(spark, few, "below-threshold", lambda path: batches.running_counts(path, USER, ORDER, counts, shown))


def stream_changing_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases above the threshold that signups set, pinned per micro-batch."""
    added = src.cart_events(_stream(spark, folder)).where("event_type = 'added'")
    added = added.select("event_id", utc_wall_clock(F.col("ts")).alias("ts"), "quantity")

    def control() -> DataFrame:
        signups = src.of_type(src.events(spark, folder), "signup")
        return signups.select("ts", F.col("event_id").alias("seq"), src.quantity().alias("threshold"))

    return _batched(spark, added, "threshold", lambda path: batches.thresholds_now(path, control, control_order=["seq"]))


QUERIES = {
    "stream_connect_ratio": stream_connect_ratio,
    "stream_global_count_trigger": stream_global_count_trigger,
    "stream_count_below_threshold": stream_count_below_threshold,
    "stream_changing_threshold": stream_changing_threshold,
    "stream_tumble_count": stream_tumble_count,
    "stream_tumble_by_type": stream_tumble_by_type,
    "stream_slide_count": stream_slide_count,
    "stream_session_count": stream_session_count,
    "stream_session_by_user": stream_session_by_user,
    "stream_window_join": stream_window_join,
    "stream_interval_join": stream_interval_join,
    "stream_union": stream_union,
    "stream_side_tagged": stream_side_tagged,
    "stream_state_value": stream_state_value,
    "stream_reduce_running": stream_reduce_running,
    "stream_state_list_clear": stream_state_list_clear,
    "stream_state_ttl": stream_state_ttl,
    "stream_state_map": stream_state_map,
    "stream_count_trigger": stream_count_trigger,
    "stream_purging_trigger": stream_purging_trigger,
    "sink_stream_text": sink_stream_text,
}


def _sql() -> dict[str, str]:
    from freshet.catalog import multi
    from freshet.catalog import state as batch_state
    from freshet.catalog import windows as batch_win

    def closed(sql: str, end: str) -> str:
        # What the watermark has passed: newest event, in milliseconds, minus the delay.
        newest = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)"
        return f"SELECT * FROM ({sql}) WHERE {end} <= {newest}"

    cart = multi._CART
    return {
        "stream_tumble_count": closed(batch_win.SQL["tumble_count"], "window_end"),
        "stream_tumble_by_type": closed(batch_win.SQL["tumble_by_type"], "window_end"),
        "stream_slide_count": closed(batch_win.SQL["slide_count"], "window_end"),
        "stream_session_count": closed(batch_win.SQL["session_count"], "session_end"),
        "stream_session_by_user": closed(batch_win.SQL["session_by_user"], "session_end"),
        "stream_window_join": multi.SQL["window_join"],
        "stream_interval_join": multi.SQL["interval_join"],
        "stream_union": f"""
            SELECT * REPLACE (CASE event_type WHEN 'added' THEN 'kafka_' ELSE 'files_' END || sku AS sku)
            FROM ({cart})""",
        "stream_side_tagged": multi.SQL["side_tagged"],
        "stream_state_value": batch_state.SQL["state_value"],
        "stream_reduce_running": """
            SELECT event_id, user_id, CAST(sum(event_id) OVER (
                PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events""",
        "stream_state_list_clear": batch_state.SQL["state_list_clear"],
        "stream_state_ttl": batch_state.SQL["state_ttl"],
        "stream_state_map": batch_state.SQL["state_map"],
        "stream_count_trigger": batch_win.SQL["count_trigger"],
        "stream_purging_trigger": batch_win.SQL["purging_trigger"],
        "stream_connect_ratio": multi.SQL["connect_ratio"],
        "stream_global_count_trigger": """
            SELECT n // 10 AS firing, n, signups FROM (
                SELECT row_number() OVER w AS n, count(*) FILTER (event_type = 'signup') OVER w AS signups
                FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
            WHERE n % 10 = 0""",
        "stream_count_below_threshold": batch_state.SQL["count_below_threshold"],
        "stream_changing_threshold": multi.SQL["changing_threshold_stream"],
        "sink_stream_text": "SELECT CAST(event_id AS VARCHAR) AS value FROM events WHERE event_id % 15 = 0",
    }


SQL = _sql()
