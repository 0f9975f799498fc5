"""Per-key state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators import state
from freshet.sources import events as src
from freshet.sources.schemas import EVENT_TYPES

ORDER = ["ts", "event_id"]
USER = ["user_id"]


def _numbers(spark: SparkSession, folder: str) -> DataFrame:
    return src.events(spark, folder).select("event_id", "ts", (F.col("event_id") % 2 == 0).alias("even"))


def _user_events(spark: SparkSession, folder: str) -> DataFrame:
    return src.events(spark, folder).select("event_id", "ts", "user_id")


def reduce_final(spark: SparkSession, folder: str) -> DataFrame:
    return state.reduce_final(_numbers(spark, folder), ["even"], "event_id")


def reduce_running(spark: SparkSession, folder: str) -> DataFrame:
    return state.reduce_running(_numbers(spark, folder), ["even"], ORDER, "event_id").drop("ts")


def count_below_threshold(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(src.events(spark, folder))
    few = (F.col("event_type") == "added") & (F.col("quantity") < 5)
    return state.count_so_far(cart, USER, ORDER, few).select("event_id", "user_id", "n")


def state_value(spark: SparkSession, folder: str) -> DataFrame:
    return state.count_so_far(_user_events(spark, folder), USER, ORDER).drop("ts")


def state_list(spark: SparkSession, folder: str) -> DataFrame:
    listed = state.history(_user_events(spark, folder), USER, ORDER, F.col("event_id").cast("string"))
    return listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))


def state_list_clear(spark: SparkSession, folder: str) -> DataFrame:
    item = F.col("event_id").cast("string")
    listed = state.chunked_history(_user_events(spark, folder), USER, ORDER, item, 11)
    return listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))


def state_ttl(spark: SparkSession, folder: str) -> DataFrame:
    item = F.col("event_id").cast("string")
    listed = state.recent_history(_user_events(spark, folder), "user_id", ORDER, item, "4 hours")
    return listed.select("event_id", "user_id", F.array_join("history", ", ").alias("history"))


def state_map(spark: SparkSession, folder: str) -> DataFrame:
    df = src.events(spark, folder).select("event_id", "ts", "user_id", "event_type")
    counted = state.count_map(df, USER, ORDER, "event_type")
    return counted.select("event_id", "user_id", state.count_map_text().alias("counts"))


QUERIES = {
    "reduce_final": reduce_final,
    "reduce_running": reduce_running,
    "count_below_threshold": count_below_threshold,
    "state_value": state_value,
    "state_list": state_list,
    "state_list_clear": state_list_clear,
    "state_ttl": state_ttl,
    "state_map": state_map,
}

_COUNTS = ", ".join(
    f"CASE WHEN count(*) FILTER (event_type = '{t}') OVER w > 0 "
    f"THEN '{t}=' || count(*) FILTER (event_type = '{t}') OVER w END"
    for t in EVENT_TYPES
)

SQL = {
    "reduce_final": """
        SELECT event_id % 2 = 0 AS even, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1""",
    "reduce_running": """
        SELECT event_id, event_id % 2 = 0 AS even,
               CAST(sum(event_id) OVER (PARTITION BY event_id % 2 ORDER BY ts, event_id
                                        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events""",
    "count_below_threshold": """
        SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM events WHERE event_type = 'purchase' AND floor(value) % 10 < 5""",
    "state_value": """
        SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events""",
    "state_list": """
        SELECT event_id, user_id, array_to_string(list(event_id) OVER (
            PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), ', ') AS history FROM events""",
    "state_list_clear": """
        SELECT event_id, user_id, array_to_string(list(event_id) OVER (
            PARTITION BY user_id, rn // 11 ORDER BY rn ROWS UNBOUNDED PRECEDING), ', ') AS history
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events)""",
    "state_ttl": """
        SELECT event_id, user_id, array_to_string(list(event_id ORDER BY ts) OVER (
            PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW), ', ') AS history
        FROM events""",
    "state_map": f"""
        SELECT event_id, user_id, concat_ws(', ', {_COUNTS}) AS counts FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
}
