"""Joins of two streams, also with hot keys, against plain-Python models."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.operators import joins, routing
from freshet.plans.skew import spread_join

BASE = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, BASE + timedelta(seconds=s), u) for i, (s, u) in enumerate(rows)], SCHEMA)


def pairs(df):
    return sorted((r["left_event_id"], r["right_event_id"]) for r in df.collect())


def skewed(seed, n=200):
    draw = random.Random(seed)
    return [(draw.randrange(100), 7 if draw.random() < 0.7 else draw.choice([1, 2, 3, None])) for _ in range(n)]


@pytest.mark.parametrize("hot", ["both", "left", "right", "none"])
def test_spread_join_gives_each_pair_once(spark, hot):
    left = [(0, 7)] * 300 + [(0, i) for i in range(50)] if hot in ("both", "left") else [(0, i % 50) for i in range(100)]
    right = [(0, 7)] * 40 + [(0, i) for i in range(20)] if hot in ("both", "right") else [(0, i % 25) for i in range(50)]
    a = frame(spark, left).select(F.col("event_id").alias("left_event_id"), "user_id")
    b = frame(spark, right).select(F.col("event_id").alias("right_event_id"), "user_id")
    joined = spread_join(a, b, ["user_id"], "left_event_id", "right_event_id", slot_rows=20)
    want = sorted((i, j) for i, (_, u) in enumerate(left) for j, (_, w) in enumerate(right) if u == w)
    assert pairs(joined) == want


def test_hot_rows_are_spread(spark):
    left = frame(spark, [(0, 7)] * 2000).select(F.col("event_id").alias("l"), "user_id")
    right = frame(spark, [(0, 7)] * 3).select(F.col("event_id").alias("r"), "user_id")
    plan = spread_join(left, right, ["user_id"], "l", "r", slot_rows=50)._jdf.queryExecution().toString()
    assert "__sl" in plan


@pytest.mark.parametrize("slot_rows", [None, 30])
def test_window_join(spark, slot_rows):
    left, right = skewed(1), skewed(2)
    got = pairs(joins.window_join(frame(spark, left), frame(spark, right), ["user_id"], "ts", "5 seconds", slot_rows=slot_rows))
    want = [
        (i, j) for i, (s, u) in enumerate(left) for j, (t, w) in enumerate(right) if u == w and u and s // 5 == t // 5
    ]
    assert got == sorted(want)


@pytest.mark.parametrize("inclusive", [(True, True), (True, False), (False, True), (False, False)])
def test_interval_join_bounds(spark, inclusive):
    left, right = skewed(3), skewed(4)
    got = pairs(
        joins.interval_join(
            frame(spark, left), frame(spark, right), ["user_id"], "ts", "-2 seconds", "3 seconds", *inclusive, slot_rows=30
        )
    )
    low, high = inclusive
    want = [
        (i, j)
        for i, (s, u) in enumerate(left)
        for j, (t, w) in enumerate(right)
        if u == w and u and (t - s >= -2 if low else t - s > -2) and (t - s <= 3 if high else t - s < 3)
    ]
    assert got == sorted(want)


def test_interval_join_of_one_instant(spark):
    rows = [(1, 1), (2, 1), (2, 1)]
    got = pairs(joins.interval_join(frame(spark, rows), frame(spark, rows), ["user_id"], "ts", "0 seconds", "0 seconds"))
    assert got == [(0, 0), (1, 1), (1, 2), (2, 1), (2, 2)]


def test_interval_join_refuses_reversed_bounds(spark):
    df = frame(spark, [(1, 1)])
    with pytest.raises(ValueError):
        joins.interval_join(df, df, ["user_id"], "ts", "2 seconds", "-2 seconds")


times = st.lists(st.tuples(st.integers(0, 12), st.sampled_from([1, 2])), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=times, right=times)
def test_interval_join_property(spark, left, right):
    got = pairs(
        joins.interval_join(
            frame(spark, left), frame(spark, right), ["user_id"], "ts", "-2 seconds", "2 seconds", False, False
        )
    )
    assert got == sorted(
        (i, j) for i, (s, u) in enumerate(left) for j, (t, w) in enumerate(right) if u == w and abs(t - s) < 2
    )


def test_running_share(spark):
    first, second = frame(spark, [(1, 1), (4, 1)]), frame(spark, [(2, 1), (3, 1)])
    shared = joins.running_share(first, second, ["ts", "event_id"], ("cart", "catalog"))
    got = [(r["stream"], round(r["percent"], 6)) for r in shared.orderBy("ts").collect()]
    assert got == [("cart", 100.0), ("catalog", 50.0), ("catalog", round(200 / 3, 6)), ("cart", 50.0)]


@pytest.mark.parametrize("limit", [joins.CONTROL_LIMIT, 2])
def test_changing_threshold(spark, limit):
    # Changes at 10, 20 and (twice) 30; the later of two at one time counts.
    control = spark.createDataFrame(
        [(BASE + timedelta(seconds=s), n, th) for s, n, th in [(10, 0, 2), (20, 1, 0), (30, 3, 5), (30, 2, 9)]],
        "ts timestamp_ntz, seq bigint, threshold int",
    )
    rows = [(i, BASE + timedelta(seconds=s), q) for i, (s, q) in enumerate(
        [(5, 0), (5, 1), (10, 2), (10, 3), (19, 2), (20, 1), (30, 5), (30, 6), (99, 5), (99, 7)]
    )]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, quantity int")
    alerts = joins.changing_threshold(df, control, control_order=["seq"], limit=limit, slot_rows=3)
    got = sorted((r["event_id"], r["threshold"]) for r in alerts.collect())
    assert got == [(1, 0), (3, 2), (5, 0), (7, 5), (9, 5)]


def test_changing_threshold_without_changes(spark):
    df = spark.createDataFrame([(1, BASE, 1), (2, BASE, 0)], "event_id bigint, ts timestamp_ntz, quantity int")
    control = spark.createDataFrame([], "ts timestamp_ntz, threshold int")
    assert [r["event_id"] for r in joins.changing_threshold(df, control).collect()] == [1]


def test_side_output_covers_every_row_once(spark):
    df = frame(spark, [(1, 7), (2, 8), (3, None)])
    main, tagged = routing.side_output(df, F.col("user_id") == 7)
    assert [r["event_id"] for r in tagged.collect()] == [0]
    assert sorted(r["event_id"] for r in main.collect()) == [1, 2]


def test_union_keeps_duplicates(spark):
    df = frame(spark, [(1, 7)])
    assert routing.union_streams(df, df, df).count() == 3
