"""Running aggregates: hot keys, no key, ties and nulls against a plain-Python model."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.operators import state
from freshet.operators import windows as win
from freshet.plans import ordering
from freshet.plans.ordering import collected, count_if, highest, plan_slots, running, total

BASE = datetime(2024, 1, 1)
ORDER = ["ts", "id"]


def make(spark, n=600, seed=1, hot_share=0.6, tie_share=0.3):
    """One key holds most rows and one instant holds many of them."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if draw.random() < hot_share else draw.choice(["a", "b", None, "c"])
        second = 500 if draw.random() < tie_share else draw.randrange(1000)
        rows.append((i, BASE + timedelta(seconds=second), key, draw.randrange(100)))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "id bigint, ts timestamp_ntz, k string, v bigint").repartition(5).cache()
    return rows, df


def model(rows, keyed=True):
    """Per row id: rows seen, sum, largest value before, values, in (ts, id) order."""
    state, out = {}, {}
    for i, ts, key, v in sorted(rows, key=lambda r: (r[1], r[0])):
        seen = state.setdefault(key if keyed else "all", [])
        before = max(seen) if seen else None
        seen.append(v)
        out[i] = (len(seen), sum(seen), before, list(seen))
    return out


@pytest.mark.parametrize("keyed", [True, False])
def test_running_equals_model(spark, keyed):
    rows, df = make(spark)
    keys = ["k"] if keyed else []
    v = F.col("v")
    measures = {"n": count_if(), "s": total(v), "items": collected(v)}
    got = {r["id"]: r for r in running(df, keys, ORDER, measures, slot_rows=50).collect()}
    before = running(df, keys, ORDER, {"m": highest(v)}, include_current=False, slot_rows=50)
    largest = {r["id"]: r["m"] for r in before.collect()}
    want = model(rows, keyed)
    assert len(got) == len(rows)
    for i, (n, s, m, items) in want.items():
        assert (got[i]["n"], got[i]["s"], got[i]["items"], largest[i]) == (n, s, items, m)


def test_hot_key_is_cut_into_even_slots(spark):
    rows, df = make(spark, n=4000, tie_share=0.0)
    slots = plan_slots(df, ["k"], ORDER, slot_rows=200)
    sizes = {r["slot"]: r["n"] for r in slots.assign(df, "slot").groupBy("slot").agg(F.count("*").alias("n")).collect()}
    cold = sizes.pop(ordering.COLD, 0)
    assert cold + sum(sizes.values()) == 4000
    assert len(sizes) >= 10 and max(sizes.values()) <= 400


def test_one_instant_is_cut_by_the_second_order_column(spark):
    rows, df = make(spark, n=4000, tie_share=1.0)
    slots = plan_slots(df, [], ORDER, slot_rows=200)
    per = slots.assign(df, "slot").groupBy("slot").count().collect()
    assert len(per) >= 15 and max(r["count"] for r in per) <= 400


def test_no_hot_key_gives_one_plain_window(spark):
    df = spark.range(1000).select("id", F.timestamp_seconds("id").alias("ts"), (F.col("id") % 100).alias("k"))
    assert plan_slots(df, ["k"], ORDER) is None


def test_slots_follow_the_order_whatever_the_session_zone(spark):
    df = spark.range(0, 400_000, 7).select(
        "id", (F.timestamp_seconds(F.lit(1_709_980_000) + F.col("id"))).cast("timestamp_ntz").alias("ts")
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = running(df, [], ORDER, {"n": count_if()}, slot_rows=1000)
        assert rows.where(F.col("n") != F.floor(F.col("id") / 7) + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_input(spark):
    df = spark.createDataFrame([], "id bigint, ts timestamp_ntz, k string, v bigint")
    assert running(df, ["k"], ORDER, {"n": count_if()}).count() == 0
    assert running(df, [], ORDER, {"n": count_if()}).count() == 0


@pytest.mark.parametrize("slot_rows", [None, 40])
def test_chunked_history(spark, slot_rows):
    rows, df = make(spark)
    got = {r["id"]: r["history"] for r in state.chunked_history(df, ["k"], ORDER, F.col("v"), 11, slot_rows=slot_rows).collect()}
    for i, (n, _, _, items) in model(rows).items():
        size = (n - 1) % 11 + 1
        assert got[i] == items[-size:]


@pytest.mark.parametrize("slot_rows", [None, 40])
def test_recent_history_with_ties(spark, slot_rows):
    rows, df = make(spark, n=300)
    recent = state.recent_history(df, "k", ORDER, F.col("id"), "30 seconds", slot_rows=slot_rows)
    got = {r["id"]: r["history"] for r in recent.collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    for at, (i, ts, key, _) in enumerate(ordered):
        want = [j for j, t, k, _ in ordered[: at + 1] if k == key and t >= ts - timedelta(seconds=30)]
        assert got[i] == want
    assert len(got) == 300


@pytest.mark.parametrize("wide", [1000, 3])
@pytest.mark.parametrize("slot_rows", [None, 40])
def test_count_map_counts_every_category(spark, wide, slot_rows):
    """Side by side or in groups: the same columns and rows, with no list of categories."""
    rows, df = make(spark)
    odd = F.when(F.col("v") % 7 != 0, F.col("v").cast("string"))
    counted = state.count_map(df.withColumn("c", odd), ["k"], ORDER, "c", slot_rows=slot_rows, wide=wide)
    assert counted.columns == [*df.columns, "c", "counts"] and dict(counted.dtypes)["counts"] == "map<string,bigint>"
    want = model(rows)
    found = counted.collect()
    assert len(found) == len(rows)
    for r in found:
        items = [str(i) for i in want[r["id"]][3] if i % 7]
        assert r["counts"] == {c: items.count(c) for c in items}


@pytest.mark.parametrize("kind", ["decimal(10,2)", "int", "double", "bigint"])
def test_sums_have_one_type_and_value_on_either_path(spark, kind):
    _, df = make(spark)
    values = df.withColumn("x", (F.col("v") / 7 + F.col("id")).cast(kind))
    plain = values.select("id", F.sum("x").over(Window.partitionBy("k").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)).alias("total"))
    cut = state.reduce_running(values, ["k"], ORDER, "x", slot_rows=40).select("id", "total")
    assert cut.schema["total"].dataType == plain.schema["total"].dataType
    want = {r["id"]: r["total"] for r in plain.collect()}
    for r in cut.collect():
        assert r["total"] == (pytest.approx(want[r["id"]], rel=1e-12) if kind == "double" else want[r["id"]])


@pytest.mark.parametrize("purge", [False, True])
def test_count_trigger_in_hot_window(spark, purge):
    rows, df = make(spark)
    fired = win.count_trigger(
        df.select("k", "ts", "id", (F.col("v") > 50).alias("big")), ["k"], ORDER, 5, {"big": F.col("big")}, purge, 40
    )
    got = sorted((str(r["k"]), r["firing"], r["n"], r["big"]) for r in fired.collect())
    want = []
    by_key = {}
    for i, ts, key, v in sorted(rows, key=lambda r: (r[1], r[0])):
        by_key.setdefault(key, []).append(v)
    for key, items in by_key.items():
        for firing in range(1, len(items) // 5 + 1):
            shown = items[5 * firing - 5 : 5 * firing] if purge else items[: 5 * firing]
            want.append((str(key), firing, len(shown), sum(v > 50 for v in shown)))
    assert got == sorted(want)


def test_late_rows(spark):
    rows, df = make(spark)
    late = win.late_rows(df, "ts", ["id"], "100 seconds", slot_rows=50)
    newest, want = None, set()
    for i, ts, _, _ in sorted(rows):
        if newest and ts < newest - timedelta(seconds=100):
            want.add(i)
        newest = max(newest or ts, ts)
    assert {r["id"] for r in late.collect()} == want
