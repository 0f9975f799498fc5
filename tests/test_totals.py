"""Counts carried from micro-batch to micro-batch: only the batch's keys are written, closed windows go."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from freshet.operators import state as batch_state
from freshet.operators import windows as win
from freshet.plans.scratch import fresh_folder
from freshet.streaming import batches

BASE = datetime(2024, 1, 1)
ORDER = ["ts", "event_id"]
FEW = "event_id bigint, ts timestamp_ntz, user_id bigint"


def rows_of(df):
    return sorted(map(str, df.collect()))


def versions(path):
    return sorted(int(v.split("=")[1]) for v in os.listdir(f"{path}/totals") if v.startswith("version="))


def stored(spark, path, version):
    return spark.read.parquet(f"{path}/totals/version={version}")


def test_a_batch_writes_its_own_keys(spark):
    rows = [(i, BASE + timedelta(seconds=i), None if i % 7 == 0 else i % 90 if i < 300 else 3) for i in range(400)]
    table = spark.createDataFrame(rows, FEW)
    path = fresh_folder(spark, "own-keys")
    write = batches.running_counts(path, ["user_id"], ORDER, {"n": F.lit(True)}, compact=4, buckets=5)
    for part in range(10):
        batch = table.where(F.floor(F.col("event_id") / 40) == part)
        write(batch, part)
        if part in (4, 9):
            write(batch, part)
    got = spark.read.parquet(f"{path}/rows").select("event_id", "n")
    assert rows_of(got) == rows_of(batch_state.count_so_far(table, ["user_id"], ORDER).select("event_id", "n"))
    # The ninth batch has two keys; the whole version before it has all of them, and older ones are gone.
    assert stored(spark, path, 9).count() == 2 and stored(spark, path, 8).count() > 80
    assert versions(path) == [8, 9] or versions(path) == [4, 5, 6, 7, 8, 9]
    assert min(versions(path)) == 8


def test_closed_windows_are_forgotten_and_late_rows_dropped(spark):
    rows = [(i, BASE + timedelta(minutes=i), 1) for i in range(600)]
    windowed = win.with_window(spark.createDataFrame(rows, FEW), "ts", "30 minutes")
    keys = ["window_start", "window_end"]
    path = fresh_folder(spark, "closing")
    closing = batches.Closing("window_end", "ts", "10 minutes")
    write = batches.running_counts(path, keys, ORDER, {"n": F.lit(True)}, closing=closing, compact=3)
    for part in range(10):
        write(windowed.where(F.floor(F.col("event_id") / 60) == part), part)
    got = spark.read.parquet(f"{path}/rows").select("event_id", "n")
    assert rows_of(got) == rows_of(batch_state.count_so_far(windowed, keys, ORDER).select("event_id", "n"))
    # Twenty windows have come; the last whole version knows the open one only.
    assert stored(spark, path, 9).count() <= 2 and versions(path) == [6, 7, 8, 9]
    late = windowed.where("event_id = 5")
    write(late.withColumn("event_id", F.lit(1000).cast("long")), 10)
    assert spark.read.parquet(f"{path}/rows").where("event_id = 1000").count() == 0


def test_without_keys_and_with_empty_batches(spark):
    table = spark.createDataFrame([(i, BASE + timedelta(seconds=i), 1) for i in range(50)], FEW)
    path = fresh_folder(spark, "no-keys")
    write = batches.running_counts(path, [], ORDER, {"n": F.lit(True)}, compact=2)
    for part in range(6):
        write(table.where(F.floor(F.col("event_id") / 10) == part), part)
    write(table.limit(0), 6)
    write(table.where("event_id < 3").withColumn("event_id", F.col("event_id") + 900), 7)
    got = spark.read.parquet(f"{path}/rows").where("event_id < 900").select("event_id", "n")
    assert rows_of(got) == rows_of(batch_state.count_so_far(table, [], ORDER).select("event_id", "n"))
    assert spark.read.parquet(f"{path}/rows").agg(F.max("n")).first()[0] == 53


def test_first_batch_may_be_empty(spark):
    table = spark.createDataFrame([(i, BASE + timedelta(seconds=i), i % 2) for i in range(20)], FEW)
    path = fresh_folder(spark, "empty-first")
    write = batches.running_counts(path, ["user_id"], ORDER, {"n": F.lit(True)})
    write(table.limit(0), 0)
    write(table, 1)
    got = spark.read.parquet(f"{path}/rows/batch_id=1").select("event_id", "n")
    assert rows_of(got) == rows_of(batch_state.count_so_far(table, ["user_id"], ORDER).select("event_id", "n"))


def test_sums_are_carried_and_a_key_may_be_hot(spark):
    rows = [(i, BASE + timedelta(seconds=i), 1 if i % 10 else None, None if i % 4 == 0 or i < 40 else (1 << 53) + i) for i in range(200)]
    table = spark.createDataFrame(rows, FEW + ", amount bigint")
    path = fresh_folder(spark, "sums")
    is_odd = F.col("event_id") % 2 == 1
    write = batches.running_counts(path, ["user_id"], ORDER, {"odd": is_odd}, slot_rows=10, sums={"total": F.col("amount")})
    for part in range(5):
        write(table.where(F.floor(F.col("event_id") / 40) == part), part)
    got = spark.read.parquet(f"{path}/rows").select("event_id", "odd", "total")
    want = batch_state.reduce_running(table, ["user_id"], ORDER, "amount")
    assert rows_of(got.select("event_id", "total")) == rows_of(want.select("event_id", "total"))
    assert got.where("event_id = 199").first()["odd"] == 100
