"""Sinks with a life cycle and a commit; functions over whole windows in order."""

import os
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freshet.operators import windows as win
from freshet.plans.scratch import fresh_folder
from freshet.sinks import committed
from freshet.sources import events as src


def recording(path):
    # Local, so that workers get the class itself and need not import this file.
    class Recording(committed.TextFiles):
        """Notes its life in a folder; fails where a file tells it to."""

        def note(self, what):
            os.makedirs(f"{self.path}-life", exist_ok=True)
            with open(f"{self.path}-life/{self.name}", "a") as out:
                out.write(f"{what}\n")

        def open(self, partition, attempt):
            committed.TextFiles.open(self, partition, attempt)
            self.note("open")

        def write(self, batch):
            committed.TextFiles.write(self, batch)
            self.note("write")
            if os.path.exists(f"{self.path}-fail") and "13" in batch.column(0).to_pylist():
                raise RuntimeError("told to fail")

        def close(self):
            self.note("close")
            return committed.TextFiles.close(self)

    return Recording(path)


def lines(spark, path):
    return sorted(int(r.value) for r in committed.committed_text(spark, path).collect())


def start(spark, folder, out, sink):
    df = src.event_stream(spark, folder, 1, spark.read.parquet(folder).schema).select(F.col("id").cast("string").alias("value"))
    writer = df.writeStream.format(committed.register(spark, sink)).option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


def test_a_failed_batch_leaves_each_row_once(spark):
    folder, out = fresh_folder(spark, "numbers"), fresh_folder(spark, "committed")
    path = f"{out}/data"
    os.makedirs(out)
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).repartition(2).write.mode("append").parquet(folder)
    sink = recording(path)
    open(f"{path}-fail", "w").close()
    with pytest.raises(Exception, match="told to fail"):
        start(spark, folder, out, sink)
    before = lines(spark, path)
    assert 13 not in before and before == sorted(set(before))
    assert os.listdir(f"{path}/_staging") == []
    os.rename(f"{path}-fail", f"{path}-failed")
    start(spark, folder, out, sink)
    assert lines(spark, path) == list(range(30))
    lives = [open(f"{path}-life/{name}").read().split() for name in os.listdir(f"{path}-life")]
    whole = [life for life in lives if life[-1] == "close"]
    assert all(life.count("open") == life.count("close") == 1 for life in whole) and len(lives) > len(whole)
    start(spark, folder, out, sink)
    assert lines(spark, path) == list(range(30))


def test_a_batch_committed_twice_counts_once(spark):
    path = fresh_folder(spark, "twice")
    for _ in range(2):
        sink = committed.TextFiles(path)
        sink.open(0, 0)
        sink.write(pa.RecordBatch.from_pydict({"value": ["1", "2", None]}))
        sink.commit([sink.close()], "batch-0")
    assert sorted(r.value for r in committed.committed_text(spark, path).collect()) == ["", "1", "2"]
    assert os.listdir(f"{path}/_staging") == []


def test_uncommitted_files_are_not_read(spark):
    path = fresh_folder(spark, "loose")
    assert committed.committed_text(spark, path).count() == 0
    committed.write_text(spark.range(5), F.col("id"), path)
    committed.write_text(spark.range(5, 8), F.col("id"), path)
    committed.write_text(spark.range(0), F.col("id"), path)
    with open(f"{path}/part-lost.txt", "w") as out:
        out.write("99\n")
    assert lines(spark, path) == list(range(8))


BASE = datetime(2024, 1, 1)


def test_a_window_is_read_in_order_and_in_parts(spark):
    rows = [(i, BASE + timedelta(seconds=(i * 7919) % 5000), None if i % 3 == 0 else i % 2) for i in range(3000)]
    rows += [(5000, None, 1), (5001, BASE, 1), (5002, BASE, 1)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")

    def told(key, batches):
        last, n, parts, sound = (-1, -1), 0, 0, True
        for batch in batches:
            parts += 1
            for at in zip(batch.column("ts").cast(pa.int64()).to_pylist(), batch.column("event_id").to_pylist()):
                sound, last, n = sound and at > last, at, n + 1
        yield pa.RecordBatch.from_pydict({"user_id": pa.array([key[0].as_py()], pa.int64()), "n": [n], "parts": [parts], "sound": [sound]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = win.apply_in_order(df, "ts", "1 hour", told, "user_id bigint, n bigint, parts bigint, sound boolean", ["ts", "event_id"], ["user_id"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sum(r.n for r in got) == 3002 and all(r.sound for r in got) and max(r.parts for r in got) > 3
    assert len(got) == 6


def test_median_gaps_of_ties_and_single_rows(spark):
    seconds = {1: [0, 10, 10, 40], 2: [5], None: [0, 1, 3]}
    rows = [(i, BASE + timedelta(seconds=s), u) for u, times in seconds.items() for i, s in enumerate(times)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
    output = "user_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, n bigint, median_gap double"
    gaps = win.median_gap("ts", ["user_id", "window_start", "window_end"])
    got = {r.user_id: (r.n, r.median_gap) for r in win.apply_in_order(df, "ts", "1 hour", gaps, output, ["ts", "event_id"], ["user_id"]).collect()}
    assert got == {u: (len(t), float(np.median(np.diff(t))) if len(t) > 1 else None) for u, t in seconds.items()}


def test_the_order_costs_one_sort(spark, data):
    df = src.events(spark, data).select("event_id", "ts", "user_id")
    output = "user_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, n bigint, median_gap double"
    gaps = win.median_gap("ts", ["user_id", "window_start", "window_end"])
    found = win.apply_in_order(df, "ts", "1 day", gaps, output, ["ts", "event_id"], ["user_id"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == 1 and text.count("Exchange ") == 1


def test_windows_of_a_partition_come_back_in_few_batches(spark):
    """Groups are cut from the batches of a partition, also where a group goes on in the next batch."""
    table = pa.table({"k": [None, None, float("nan"), float("nan"), 1.0, 1.0, 1.0, 2.0], "w": [1, 1, 1, 1, 1, 1, 2, 2]})
    parts = list(win._cut_by(["k", "w"], iter(table.to_batches(max_chunksize=3))))
    assert [(n, p.num_rows) for n, p in parts] == [(0, 2), (1, 1), (1, 1), (2, 2), (3, 1), (4, 1)]
    rows = [(i, BASE + timedelta(minutes=i), i % 500) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
    output = "user_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, n bigint, median_gap double"
    gaps = win.median_gap("ts", output.replace(",", "").split()[:6:2])
    found = win.apply_in_order(df, "ts", "1 hour", gaps, output, ["ts", "event_id"], ["user_id"])
    sizes = found.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint").collect()
    assert sum(r.n for r in sizes) == 3000 and len(sizes) < 50
