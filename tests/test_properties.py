"""Random event lists against plain-Python models."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.operators import joins, state
from freshet.operators import windows as win

BASE = datetime(2024, 1, 1)
ORDER = ["ts", "id"]
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
seconds = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["a", "b"])), min_size=1, max_size=60)


def frame(spark, rows):
    data = [(i, BASE + timedelta(seconds=s), k) for i, (s, k) in enumerate(rows)]
    return spark.createDataFrame(data, "id bigint, ts timestamp_ntz, k string")


@few
@given(rows=seconds)
def test_sessions(spark, rows):
    got = sorted(
        (r["k"], (r["session_start"] - BASE).seconds, (r["session_end"] - BASE).seconds, r["n"])
        for r in win.sessions(frame(spark, rows), "ts", "3 seconds", {"n": None}, ["k"]).collect()
    )
    want = []
    for key in {k for _, k in rows}:
        last = None
        for s in sorted(s for s, k in rows if k == key):
            if last is None or s - last > 3:
                want.append([key, s, s + 3, 0])
            want[-1][2], want[-1][3], last = s + 3, want[-1][3] + 1, s
    assert got == sorted(map(tuple, want))


@few
@given(rows=seconds, every=st.integers(1, 4))
def test_count_and_purging_trigger(spark, rows, every):
    windowed = win.with_window(frame(spark, rows), "ts", "10 seconds")
    sizes = {}
    for s, _ in rows:
        sizes[s // 10 * 10] = sizes.get(s // 10 * 10, 0) + 1
    firings = [(w, f) for w, n in sizes.items() for f in range(1, n // every + 1)]
    for purge in (False, True):
        fired = win.count_trigger(windowed, ["window_start"], ORDER, every, purge=purge, slot_rows=7).collect()
        got = sorted(((r["window_start"] - BASE).seconds, r["firing"], r["n"]) for r in fired)
        assert got == sorted((w, f, every if purge else every * f) for w, f in firings)


@few
@given(rows=seconds, chunk=st.integers(1, 5))
def test_cleared_list(spark, rows, chunk):
    listed = state.chunked_history(frame(spark, rows), ["k"], ORDER, F.col("id"), chunk, slot_rows=9)
    held = {}
    want = {}
    for i, (s, k) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[0])):
        items = held.setdefault(k, [])
        items.append(i)
        want[i] = list(items)
        if len(items) == chunk:
            held[k] = []
    assert {r["id"]: r["history"] for r in listed.collect()} == want


@few
@given(rows=seconds, changes=st.lists(st.tuples(st.integers(0, 40), st.integers(0, 9)), max_size=6))
def test_changing_threshold(spark, rows, changes):
    df = frame(spark, rows).withColumn("quantity", (F.col("id") % 10).cast("int"))
    data = [(BASE + timedelta(seconds=s), n, th) for n, (s, th) in enumerate(changes)]
    control = spark.createDataFrame(data, "ts timestamp_ntz, seq bigint, threshold int")
    want = []
    for i, (s, _) in enumerate(rows):
        before = [(t, n, th) for n, (t, th) in enumerate(changes) if t <= s]
        if i % 10 > (max(before)[2] if before else 0):
            want.append(i)
    for limit in (100, 1):
        alerts = joins.changing_threshold(df, control, row_id="id", control_order=["seq"], limit=limit, slot_rows=9)
        assert sorted(r["id"] for r in alerts.collect()) == want
