"""Windows, sessions, triggers, late rows and aggregates over windows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators import windows as win
from freshet.sources import events as src

ORDER = ["ts", "event_id"]


def _is_signup():
    return F.col("event_type") == "signup"


def tumble_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.tumbling(src.events(spark, folder), "ts", "3 hours", {"n": win.count(_is_signup())})


def tumble_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return win.tumbling(src.events(spark, folder), "ts", "3 hours", {"n": win.count()}, ["event_type"])


def slide_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.sliding(src.events(spark, folder), "ts", "3 hours", "1 hour", {"n": _is_signup()})


def session_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.sessions(src.events(spark, folder), "ts", "10 minutes", {"signups": _is_signup(), "n": None})


def session_by_user(spark: SparkSession, folder: str) -> DataFrame:
    return win.sessions(src.events(spark, folder), "ts", "4 hours", {"n": None}, ["user_id"])


def tumble_ingest(spark: SparkSession, folder: str) -> DataFrame:
    arrived = src.events(spark, folder).select(src.arrival().alias("ingest_ts"))
    return win.tumbling(arrived, "ingest_ts", "3 hours", {"n": win.count()})


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    df = src.events(spark, folder).select("event_id", "ts", src.arrival().alias("arrival_ts"))
    return win.late_rows(df, "ts", ["arrival_ts", "event_id"], "1 hour").select("event_id", "ts")


def window_median_gap(spark: SparkSession, folder: str) -> DataFrame:
    """The median time between a user's events of a day: a function over all rows of a window, in order."""
    df = src.events(spark, folder).select("event_id", "ts", "user_id")
    output = "user_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, n bigint, median_gap double"
    names = ["user_id", "window_start", "window_end"]
    return win.apply_in_order(df, "ts", "1 day", win.median_gap("ts", names), output, ORDER, ["user_id"])


def global_count_trigger(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_trigger(src.events(spark, folder), [], ORDER, 10, {"signups": _is_signup()})


def _in_windows(spark: SparkSession, folder: str) -> DataFrame:
    return win.with_window(src.events(spark, folder).select("event_id", "ts", "event_type"), "ts", "6 hours")


def count_trigger(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_trigger(_in_windows(spark, folder), ["window_start", "window_end"], ORDER, 5)


def purging_trigger(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_trigger(_in_windows(spark, folder), ["window_start", "window_end"], ORDER, 5, purge=True)


def purging_signups(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_trigger(
        _in_windows(spark, folder), ["window_start", "window_end"], ORDER, 5, {"signups": _is_signup()}, purge=True
    )


def best_window(spark: SparkSession, folder: str) -> DataFrame:
    signups = src.events(spark, folder).where(_is_signup())
    return win.busiest(win.sliding(signups, "ts", "2 hours", "1 hour", {"n": None}))


def agg_count_if(spark: SparkSession, folder: str) -> DataFrame:
    counts = {"signups": win.count(_is_signup()), "others": win.count(~_is_signup())}
    return win.tumbling(src.events(spark, folder), "ts", "3 hours", counts)


def window_apply(spark: SparkSession, folder: str) -> DataFrame:
    aggs = {
        "n": win.count(),
        "signups": win.count(_is_signup()),
        "users": F.countDistinct("user_id"),
        "largest": F.max("value"),
        "first_event": F.min("event_id"),
    }
    return win.tumbling(src.events(spark, folder), "ts", "3 hours", aggs)


def agg_accumulator(spark: SparkSession, folder: str) -> DataFrame:
    df = win.with_window(src.events(spark, folder).select("ts", "event_type"), "ts", "3 hours")

    def add(state: int | None, rows: pd.DataFrame) -> int:
        return (state or 0) + int((rows["event_type"] == "signup").sum())

    return win.accumulate(
        df.select("window_start", "event_type"), ["window_start"], add, lambda a, b: a + b, lambda a: a, "bigint", "n"
    )


QUERIES = {
    "tumble_count": tumble_count,
    "tumble_by_type": tumble_by_type,
    "slide_count": slide_count,
    "session_count": session_count,
    "session_by_user": session_by_user,
    "tumble_ingest": tumble_ingest,
    "late_events": late_events,
    "window_median_gap": window_median_gap,
    "global_count_trigger": global_count_trigger,
    "count_trigger": count_trigger,
    "purging_trigger": purging_trigger,
    "purging_signups": purging_signups,
    "best_window": best_window,
    "agg_count_if": agg_count_if,
    "window_apply": window_apply,
    "agg_accumulator": agg_accumulator,
}


def _bucket(hours: int, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL {hours} HOUR, {ts}, TIMESTAMP '1970-01-01')"


def _sessions(gap: str, key: str = "") -> str:
    by = f"PARTITION BY {key} " if key else ""
    keys = f"{key}, " if key else ""
    return f"""
        WITH marked AS (
            SELECT *, CASE WHEN ts - lag(ts) OVER ({by}ORDER BY ts, event_id) <= INTERVAL {gap} THEN 0 ELSE 1 END AS begins
            FROM events),
        numbered AS (
            SELECT *, sum(begins) OVER ({by}ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM marked)
        SELECT {keys}min(ts) AS session_start, max(ts) + INTERVAL {gap} AS session_end,
               COUNTS count(*) AS n
        FROM numbered GROUP BY {keys}session_no"""


_NUMBERED = f"""
    SELECT *, {_bucket(6)} AS ws, row_number() OVER (PARTITION BY {_bucket(6)} ORDER BY ts, event_id) AS rn FROM events"""
_ARRIVED = "SELECT *, ts + to_seconds((event_id * 7919) % 7200) AS arrival_ts FROM events"

SQL = {
    "tumble_count": f"""
        SELECT {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL 3 HOUR AS window_end,
               count(*) FILTER (event_type = 'signup') AS n FROM events GROUP BY 1, 2""",
    "tumble_by_type": f"""
        SELECT event_type, {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL 3 HOUR AS window_end,
               count(*) AS n FROM events GROUP BY 1, 2, 3""",
    "slide_count": f"""
        SELECT ws AS window_start, ws + INTERVAL 3 HOUR AS window_end, count(*) FILTER (event_type = 'signup') AS n
        FROM (SELECT event_type, {_bucket(1)} - k * INTERVAL 1 HOUR AS ws FROM events, range(3) r(k)) GROUP BY 1, 2""",
    "session_count": _sessions("10 MINUTE").replace("COUNTS", "count(*) FILTER (event_type = 'signup') AS signups,"),
    "session_by_user": _sessions("4 HOUR", "user_id").replace("COUNTS", ""),
    "tumble_ingest": f"""
        SELECT {_bucket(3, "arrival_ts")} AS window_start, {_bucket(3, "arrival_ts")} + INTERVAL 3 HOUR AS window_end,
               count(*) AS n FROM ({_ARRIVED}) GROUP BY 1, 2""",
    "late_events": f"""
        SELECT event_id, ts FROM (
            SELECT *, max(ts) OVER (ORDER BY arrival_ts, event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
            FROM ({_ARRIVED})) WHERE ts < newest - INTERVAL 1 HOUR""",
    "window_median_gap": """
        SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
               count(*) AS n, median(gap) / 1e6 AS median_gap
        FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (
                  PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS gap FROM events)
        GROUP BY 1, 2, 3""",
    "global_count_trigger": """
        SELECT CAST(rn // 10 AS BIGINT) AS firing, rn AS n, signups FROM (
            SELECT row_number() OVER w AS rn, count(*) FILTER (event_type = 'signup') OVER w AS signups
            FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) WHERE rn % 10 = 0""",
    "count_trigger": f"""
        SELECT ws AS window_start, ws + INTERVAL 6 HOUR AS window_end, CAST(rn // 5 AS BIGINT) AS firing, rn AS n
        FROM ({_NUMBERED}) WHERE rn % 5 = 0""",
    "purging_trigger": f"""
        SELECT ws AS window_start, ws + INTERVAL 6 HOUR AS window_end, CAST((rn - 1) // 5 + 1 AS BIGINT) AS firing,
               count(*) AS n FROM ({_NUMBERED}) GROUP BY 1, 2, 3 HAVING count(*) = 5""",
    "purging_signups": f"""
        SELECT ws AS window_start, ws + INTERVAL 6 HOUR AS window_end, CAST((rn - 1) // 5 + 1 AS BIGINT) AS firing,
               count(*) AS n, count(*) FILTER (event_type = 'signup') AS signups
        FROM ({_NUMBERED}) GROUP BY 1, 2, 3 HAVING count(*) = 5""",
    "best_window": f"""
        SELECT ws AS window_start, ws + INTERVAL 2 HOUR AS window_end, count(*) AS n
        FROM (SELECT {_bucket(1)} - k * INTERVAL 1 HOUR AS ws FROM events, range(2) r(k) WHERE event_type = 'signup')
        GROUP BY 1, 2 ORDER BY n DESC, window_start LIMIT 1""",
    "agg_count_if": f"""
        SELECT {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL 3 HOUR AS window_end,
               count(*) FILTER (event_type = 'signup') AS signups,
               count(*) FILTER (event_type <> 'signup') AS others FROM events GROUP BY 1, 2""",
    "window_apply": f"""
        SELECT {_bucket(3)} AS window_start, {_bucket(3)} + INTERVAL 3 HOUR AS window_end, count(*) AS n,
               count(*) FILTER (event_type = 'signup') AS signups, count(DISTINCT user_id) AS users,
               max(value) AS largest, min(event_id) AS first_event FROM events GROUP BY 1, 2""",
    "agg_accumulator": f"""
        SELECT {_bucket(3)} AS window_start, count(*) FILTER (event_type = 'signup') AS n FROM events GROUP BY 1""",
}
