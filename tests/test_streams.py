"""Streams: late data, recovery, several files, state across micro-batches."""

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from freshet.functions.times import utc_wall_clock
from freshet.operators import joins
from freshet.operators import state as batch_state
from freshet.operators import windows as win
from freshet.plans.ordering import count_if, running
from freshet.plans.scratch import fresh_folder
from freshet.sources import events as src
from freshet.streaming import batches, state
from freshet.streaming import windows as stream_win
from freshet.streaming.run import ProgressLog, drain, drained_table, latest_progress, start_continuous, start_updating

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
ORDER = ["ts", "event_id"]
SMALL = "event_id bigint, ts timestamp"


def write_file(spark, folder, rows):
    """Add one file to a source folder; files are read in the order they were written."""
    df = spark.createDataFrame([(i, BASE + timedelta(seconds=s)) for s, i in rows], SMALL)
    df.coalesce(1).write.mode("append").parquet(folder)


def small_stream(spark, folder):
    from pyspark.sql.types import StructType

    return src.event_stream(spark, folder, 1, StructType.fromDDL(SMALL))


def split_events(spark, data, parts):
    """The event table in time order as several files; returns the folder."""
    folder = fresh_folder(spark, "split-events")
    table = spark.read.schema(src.EVENT_STREAM).parquet(f"{data}/events.parquet")
    size = table.count() // parts + 1
    for part in range(parts):
        chosen = table.where(F.floor(F.col("event_id") / size) == part)
        chosen.coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.fixture(scope="module")
def split(spark, data):
    return split_events(spark, data, 3)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_late_rows_are_dropped_per_micro_batch(spark):
    folder, out = fresh_folder(spark, "late"), fresh_folder(spark, "late-out")
    # Fixed values: (second, id) per file.
    for rows in ([(0, 1), (10, 2)], [(1, 3), (20, 4)], [(30, 5)], [(2, 6), (40, 7)]):
        write_file(spark, folder, rows)
    timed = src.event_time(small_stream(spark, folder), F.col("ts"), "5 seconds")
    ids = win.tumbling(timed, "ts", "3 seconds", {"ids": F.sort_array(F.collect_list("event_id"))})
    query = drain(ids, f"{out}/data", f"{out}/checkpoint")
    got = {r["window_start"].second: r["ids"] for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == {0: [1, 3], 9: [2], 18: [4], 30: [5]}
    assert sum(p["late_rows"] for p in latest_progress(query)) == 1


def test_without_watermark_nothing_is_late(spark):
    folder = fresh_folder(spark, "no-watermark")
    for rows in ([(50, 1)], [(0, 2)]):
        write_file(spark, folder, rows)
    df = src.event_time(small_stream(spark, folder), F.col("ts"))
    assert drained_table(spark, df, "no-watermark-out").count() == 2


def test_state_survives_a_restart(spark, data):
    folder, out = fresh_folder(spark, "restart"), fresh_folder(spark, "restart-out")
    table = spark.read.schema(src.EVENT_STREAM).parquet(f"{data}/events.parquet").select("event_id", "ts", "user_id")

    def run():
        stream = src.event_stream(spark, folder, schema=table.schema)
        drain(state.count_so_far(stream, ["user_id"], ORDER), f"{out}/data", f"{out}/checkpoint")

    table.where("event_id < 400").coalesce(1).write.mode("append").parquet(folder)
    run()
    assert spark.read.parquet(f"{out}/data").count() == 400
    table.where("event_id >= 400").coalesce(1).write.mode("append").parquet(folder)
    run()
    run()
    got = spark.read.parquet(f"{out}/data")
    assert rows_of(got) == rows_of(batch_state.count_so_far(table, ["user_id"], ORDER).select(got.columns))


def test_keyed_state_over_several_files_equals_batch(spark, data, split):
    table = spark.read.schema(src.EVENT_STREAM).parquet(f"{data}/events.parquet")
    table = table.select("event_id", "ts", "user_id", "event_type")
    stream = src.event_stream(spark, split, 1).select(table.columns)
    item = F.col("event_id").cast("string")
    cases = {
        "value": (
            state.count_so_far(stream, ["user_id"], ORDER),
            batch_state.count_so_far(table, ["user_id"], ORDER),
        ),
        "list": (
            state.history(stream, ["user_id"], ORDER, "event_id"),
            batch_state.history(table, ["user_id"], ORDER, item),
        ),
        "clear": (
            state.history(stream, ["user_id"], ORDER, "event_id", chunk=11),
            batch_state.chunked_history(table, ["user_id"], ORDER, item, 11),
        ),
        "ttl": (
            state.recent_history(stream, ["user_id"], ORDER, "event_id", "4 hours"),
            batch_state.recent_history(table, "user_id", ORDER, item, "4 hours"),
        ),
        "trigger": (
            state.count_trigger(stream, ["user_id"], ORDER, 5),
            win.count_trigger(table, ["user_id"], ORDER, 5),
        ),
        "purging": (
            state.count_trigger(stream, ["user_id"], ORDER, 5, purge=True),
            win.count_trigger(table, ["user_id"], ORDER, 5, purge=True),
        ),
    }
    for name, (streamed, batch) in cases.items():
        got = drained_table(spark, streamed, f"files-{name}")
        assert rows_of(got) == rows_of(batch.select(got.columns)), name


def test_closed_window_state_is_dropped(spark, split):
    timed = src.event_time(src.event_stream(spark, split, 1), F.col("ts"), "1 hour")
    windowed = win.with_window(timed.select("event_id", "ts"), "ts", "6 hours")
    fired = state.count_trigger(windowed, ["window_start", "window_end"], ORDER, 5, window_end="window_end")
    out = fresh_folder(spark, "evict")
    query = drain(fired, f"{out}/data", f"{out}/checkpoint")
    steps = latest_progress(query)
    assert steps[-1]["state_rows"] <= 2 < max(p["state_rows"] for p in steps)


def test_windows_over_several_files_equal_closed_batch_windows(spark, data, split):
    table = spark.read.schema(src.EVENT_STREAM).parquet(f"{data}/events.parquet")
    timed = src.event_time(src.event_stream(spark, split, 1), F.col("ts"), "1 hour")
    newest = table.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    for streamed, batch, end in (
        (
            stream_win.sessions(timed, "ts", "4 hours", {"n": None}, ["user_id"]),
            win.sessions(table, "ts", "4 hours", {"n": None}, ["user_id"]),
            "session_end",
        ),
        (
            win.sliding(timed, "ts", "3 hours", "1 hour", {"n": None}, ["event_type"]),
            win.sliding(table, "ts", "3 hours", "1 hour", {"n": None}, ["event_type"]),
            "window_end",
        ),
    ):
        got = drained_table(spark, streamed, "closed")
        assert rows_of(got) == rows_of(batch.where(F.col(end) <= F.lit(newest)).select(got.columns))


def test_stream_joins_over_several_files_equal_batch(spark, data, split):
    table = spark.read.schema(src.EVENT_STREAM).parquet(f"{data}/events.parquet")

    def sides(df):
        return [src.of_type(df, kind).select("event_id", "ts", "user_id") for kind in ("purchase", "view")]

    def timed():
        return src.event_time(src.event_stream(spark, split, 1), F.col("ts"), "1 hour")

    streams = [sides(timed())[0], sides(timed())[1]]
    bounds = (["user_id"], "ts", "-2 hours", "2 hours", False, False)
    got = drained_table(spark, joins.interval_join(*streams, *bounds), "interval")
    assert rows_of(got) == rows_of(joins.interval_join(*sides(table), *bounds).select(got.columns))
    got = drained_table(spark, joins.window_join(*streams, ["user_id"], "ts", "5 hours"), "window")
    want = joins.window_join(*sides(table), ["user_id"], "ts", "5 hours").select(got.columns)
    assert got.count() > 0 and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("keys", [[], ["even"]])
def test_counts_carried_over_micro_batches(spark, data, keys):
    table = src.events(spark, data).select("event_id", "ts", "event_type", (F.col("event_id") % 2 == 0).alias("even"))
    is_cart, is_catalog = F.col("event_type") == "purchase", F.col("event_type") == "view"
    both = table.where(is_cart | is_catalog)
    path = fresh_folder(spark, "carried")
    write = batches.running_counts(path, keys, ORDER, {"cart": is_cart, "catalog": is_catalog}, slot_rows=20)
    for part in range(3):
        batch = both.where(F.floor(F.col("event_id") / 400) == part)
        write(batch, part)
        write(batch, part)
    got = spark.read.parquet(f"{path}/rows").select("event_id", "cart", "catalog")
    want = running(both, keys, ORDER, {"cart": count_if(is_cart), "catalog": count_if(is_catalog)})
    assert rows_of(got) == rows_of(want.select(got.columns))


def test_thresholds_read_again_for_each_micro_batch(spark):
    path = fresh_folder(spark, "thresholds")
    at = datetime(2024, 1, 1)
    known = [(at, 5)]
    control = lambda: spark.createDataFrame(known, "ts timestamp_ntz, threshold int")
    write = batches.thresholds_now(path, control)
    rows = spark.createDataFrame([(1, at + timedelta(seconds=9), 4)], "event_id bigint, ts timestamp_ntz, quantity int")
    write(rows, 0)
    known.append((at + timedelta(seconds=5), 3))
    write(rows, 1)
    known.append((at + timedelta(seconds=6), 9))
    write(rows, 1)  # a repeated batch sees what its first attempt saw
    got = spark.read.parquet(f"{path}/rows")
    assert [(r["batch_id"], r["threshold"]) for r in got.collect()] == [(1, 3)]


def test_arrival_stamp_and_console(spark, split):
    stamped = stream_win.stamp_arrival(src.event_stream(spark, split, 1).select("event_id"))
    out = drained_table(spark, stamped, "stamped")
    assert out.where("ingest_ts is null").count() == 0 and out.select("ingest_ts").distinct().count() == 3
    assert "ts" in utc_wall_clock(F.col("ts"))._jc.toString()


def test_running_on_the_engine_clock(spark, data, split):
    """A processing-time trigger fires by the clock; update mode shows open windows too."""
    timed = src.event_time(src.event_stream(spark, split, 1), F.col("ts"), "500 milliseconds")
    out = fresh_folder(spark, "continuous")
    query = start_continuous(timed.select("event_id"), f"{out}/data", f"{out}/checkpoint", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{out}/data").count() == 1000

    counted = win.tumbling(timed, "ts", "3 hours", {"n": win.count()})
    writer = counted.writeStream.format("memory").queryName("open_windows").outputMode("update")
    query = writer.trigger(processingTime="1 second").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    shown = spark.table("open_windows").groupBy("window_start").agg(F.max("n").alias("n"))
    want = win.tumbling(src.events(spark, data), "ts", "3 hours", {"n": win.count()})
    got = shown.select(utc_wall_clock(F.col("window_start")).alias("window_start"), "n")
    assert rows_of(got) == rows_of(want.select("window_start", "n"))


def test_progress_of_a_long_run_is_complete(spark):
    """More micro-batches than the engine remembers."""
    folder, out = fresh_folder(spark, "many"), fresh_folder(spark, "many-out")
    spark.range(0, 1300, 1, 130).selectExpr(
        "id as event_id", "timestamp'2024-01-01' as ts", "id as user_id", "'view' as event_type", "0d as value", "'' as props"
    ).write.parquet(folder)
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        query = drain(src.event_stream(spark, folder, 1).select("event_id"), f"{out}/data", f"{out}/checkpoint")
        steps = log.of(query)
    finally:
        spark.streams.removeListener(log)
    assert sum(p["rows"] for p in steps) == 1300 and len(latest_progress(query)) < len(steps)


NULLS = [(i, (i * 37) % 101, None if i % 5 == 0 else 1 + i % 2, None if i % 3 == 0 else (1 << 53) + i, None if i % 4 == 0 else "abc"[i % 3]) for i in range(240)]


@pytest.fixture(scope="module")
def holey(spark):
    """(folder of three time-ordered files, the same rows as a table), with nulls in every column but the order."""
    folder = fresh_folder(spark, "holey")
    table = spark.createDataFrame(NULLS, "event_id long, s int, user_id long, v long, c string")
    table = table.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id"))).drop("s").persist()
    for part in range(3):
        table.where(F.floor(F.col("event_id") / 80) == part).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    return folder, table


@pytest.mark.parametrize("name", ["reduce", "map", "history", "chunks", "recent"])
def test_streams_treat_nulls_as_batches_do(spark, holey, name):
    folder, table = holey
    stream = src.event_stream(spark, folder, 1, schema=table.schema)
    keys, value = ["user_id"], F.col("v").cast("string")
    streamed, batch = {
        "reduce": (state.reduce_running(stream, keys, ORDER, "v"), batch_state.reduce_running(table, keys, ORDER, "v")),
        "map": (state.count_map(stream, keys, ORDER, "c"), batch_state.count_map(table, keys, ORDER, "c")),
        "history": (state.history(stream, keys, ORDER, "v"), batch_state.history(table, keys, ORDER, value)),
        "chunks": (state.history(stream, keys, ORDER, "v", 7), batch_state.chunked_history(table, keys, ORDER, value, 7)),
        "recent": (
            state.recent_history(stream, keys, ORDER, "v", "20 seconds"),
            batch_state.recent_history(table, keys, ORDER, value, "20 seconds"),
        ),
    }[name]
    got = drained_table(spark, streamed, f"holey-{name}")
    shown = lambda df: sorted((r[0], str(r[1])) for r in df.select("event_id", F.col(df.columns[-1]).cast("string")).collect())
    assert len(shown(got)) == len(NULLS) and shown(got) == shown(batch)


def test_update_mode_writer(spark, split):
    timed = src.event_time(src.event_stream(spark, split, 1), F.col("ts"), "1 hour")
    counted = win.tumbling(timed, "ts", "3 hours", {"n": win.count()})
    out, seen = fresh_folder(spark, "updating"), {}

    def write(batch, batch_id):
        seen.update({r["window_start"]: r["n"] for r in batch.collect()})

    query = start_updating(counted, write, f"{out}/checkpoint")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(seen.values()) == 1000


def test_byte_limit_bounds_a_micro_batch(spark, split):
    df = src.event_stream(spark, split, max_bytes_per_trigger=1).select("event_id")
    out = fresh_folder(spark, "bytes")
    query = drain(df, f"{out}/data", f"{out}/checkpoint")
    assert [p["rows"] for p in latest_progress(query) if p["rows"]] == [334, 334, 332]
