"""Unions, joins, shares of two streams, changing control values and side outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators import joins, routing
from freshet.sources import events as src

ORDER = ["ts", "event_id"]
USER = ["user_id"]

# Thresholds in the order they take effect.
THRESHOLDS = (2, 0, 4, 5, 6, 3)
SIDE_USER = 7


def _added(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(src.events(spark, folder))
    return cart.where(F.col("event_type") == "added").drop("event_type")


def _timed(spark: SparkSession, folder: str, event_type: str) -> DataFrame:
    return src.of_type(src.events(spark, folder), event_type).select("event_id", "ts", "user_id")


def union_streams(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(src.events(spark, folder))
    first = routing.with_source(cart.where(F.col("event_type") == "added"), "kafka")
    second = routing.with_source(cart.where(F.col("event_type") == "removed"), "files")
    return routing.union_streams(first, second, first)


def window_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.window_join(
        _timed(spark, folder, "purchase"), _timed(spark, folder, "view"), USER, "ts", "5 hours"
    )


def _interval_join(spark: SparkSession, folder: str, inclusive: bool) -> DataFrame:
    return joins.interval_join(
        _timed(spark, folder, "purchase"),
        _timed(spark, folder, "view"),
        USER,
        "ts",
        "-2 hours",
        "2 hours",
        inclusive,
        inclusive,
    )


def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    return _interval_join(spark, folder, False)


def interval_join_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    return _interval_join(spark, folder, True)


def connect_ratio(spark: SparkSession, folder: str) -> DataFrame:
    shares = joins.running_share(
        _timed(spark, folder, "purchase"), _timed(spark, folder, "view"), ORDER, ("cart", "catalog")
    )
    return shares.select("event_id", "stream", "percent")


def changing_threshold(spark: SparkSession, folder: str) -> DataFrame:
    start = F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00"))
    steps = src.literal(spark, list(enumerate(THRESHOLDS)), "step int, threshold int")
    control = steps.select(
        (start + F.make_dt_interval(days=F.col("step") * 5)).alias("ts"), "threshold"
    )
    return joins.changing_threshold(_added(spark, folder), control)


def changing_threshold_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every signup event sets a new threshold: a control stream that grows with the data."""
    signups = src.of_type(src.events(spark, folder), "signup")
    control = signups.select("ts", F.col("event_id").alias("seq"), src.quantity().alias("threshold"))
    added = _added(spark, folder).select("event_id", "ts", "quantity")
    return joins.changing_threshold(added, control, control_order=["seq"])


def side_main(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(src.events(spark, folder))
    return routing.side_output(cart, F.col("user_id") == SIDE_USER)[0]


def side_tagged(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(src.events(spark, folder))
    return routing.side_output(cart, F.col("user_id") == SIDE_USER)[1]


QUERIES = {
    "union_streams": union_streams,
    "window_join": window_join,
    "interval_join": interval_join,
    "interval_join_inclusive": interval_join_inclusive,
    "connect_ratio": connect_ratio,
    "changing_threshold": changing_threshold,
    "changing_threshold_stream": changing_threshold_stream,
    "side_main": side_main,
    "side_tagged": side_tagged,
}

_QUANTITY = "CAST(floor(value) % 10 AS INTEGER)"
_SKU = "json_extract_string(props, '$.k')"
_CART = f"""
    SELECT event_id, ts, user_id, CASE event_type WHEN 'purchase' THEN 'added' ELSE 'removed' END AS event_type,
           {_SKU} AS sku, {_QUANTITY} AS quantity FROM events WHERE event_type IN ('purchase', 'error')"""
_PAIRS = """
    SELECT a.user_id, a.event_id AS left_event_id, a.ts AS left_ts, b.event_id AS right_event_id, b.ts AS right_ts"""


def _near(below: str, above: str) -> str:
    return f"""{_PAIRS} FROM events a JOIN events b ON a.user_id = b.user_id
        AND b.ts {below} a.ts - INTERVAL 2 HOUR AND b.ts {above} a.ts + INTERVAL 2 HOUR
        WHERE a.event_type = 'purchase' AND b.event_type = 'view'"""


_BUCKET = "time_bucket(INTERVAL 5 HOUR, {}.ts, TIMESTAMP '1970-01-01')"

SQL = {
    "union_streams": f"""
        WITH cart AS ({_CART})
        SELECT * REPLACE ('kafka_' || sku AS sku) FROM cart WHERE event_type = 'added'
        UNION ALL SELECT * REPLACE ('files_' || sku AS sku) FROM cart WHERE event_type = 'removed'
        UNION ALL SELECT * REPLACE ('kafka_' || sku AS sku) FROM cart WHERE event_type = 'added'""",
    "window_join": f"""{_PAIRS}, {_BUCKET.format("a")} AS window_start,
               {_BUCKET.format("a")} + INTERVAL 5 HOUR AS window_end
        FROM events a JOIN events b ON a.user_id = b.user_id AND {_BUCKET.format("a")} = {_BUCKET.format("b")}
        WHERE a.event_type = 'purchase' AND b.event_type = 'view'""",
    "interval_join": _near(">", "<"),
    "interval_join_inclusive": _near(">=", "<="),
    "connect_ratio": """
        SELECT event_id, CASE event_type WHEN 'purchase' THEN 'cart' ELSE 'catalog' END AS stream,
               (CASE event_type WHEN 'purchase' THEN count(*) FILTER (event_type = 'purchase') OVER w
                     ELSE count(*) FILTER (event_type = 'view') OVER w END) * CAST(100.0 AS DOUBLE)
               / count(*) OVER w AS percent
        FROM events WHERE event_type IN ('purchase', 'view')
        WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "changing_threshold": f"""
        WITH control AS (
            SELECT TIMESTAMP '2024-01-02' + i * INTERVAL 5 DAY AS ts, [2, 0, 4, 5, 6, 3][i + 1] AS threshold
            FROM range(6) r(i))
        SELECT e.event_id, e.ts, e.user_id, {_SKU} AS sku, {_QUANTITY} AS quantity,
               CAST(coalesce(c.threshold, 0) AS INTEGER) AS threshold
        FROM events e ASOF LEFT JOIN control c ON e.ts >= c.ts
        WHERE e.event_type = 'purchase' AND {_QUANTITY} > coalesce(c.threshold, 0)""",
    "changing_threshold_stream": f"""
        WITH control AS (SELECT ts, {_QUANTITY} AS threshold FROM events WHERE event_type = 'signup')
        SELECT e.event_id, e.ts, {_QUANTITY} AS quantity, coalesce(c.threshold, 0) AS threshold
        FROM events e ASOF LEFT JOIN control c ON e.ts >= c.ts
        WHERE e.event_type = 'purchase' AND {_QUANTITY} > coalesce(c.threshold, 0)""",
    "side_main": f"SELECT * FROM ({_CART}) WHERE user_id IS DISTINCT FROM {SIDE_USER}",
    "side_tagged": f"SELECT * FROM ({_CART}) WHERE user_id = {SIDE_USER}",
}
