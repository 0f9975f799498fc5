"""Keyed state in event-time order: shuffled files, expiry, read-back, initial state, control streams."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from freshet.functions.times import utc_wall_clock
from freshet.operators import joins
from freshet.operators import state as batch_state
from freshet.operators import windows as win
from freshet.plans.scratch import fresh_folder
from freshet.sources import events as src
from freshet.streaming import batches, ordered
from freshet.streaming import windows as stream_win
from freshet.streaming.run import drain, drained_table

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, kind string, amount bigint"
ORDER = ["ts", "event_id"]
DELAY = "100 seconds"


def rows_of(df):
    return sorted(map(str, df.collect()))


def write(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def made(seconds, seed=1):
    """(event_id, ts, user_id, kind, amount): ties, null keys, null values."""
    rng = random.Random(seed)
    return [
        (i, BASE + timedelta(seconds=s), rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, "a", "b", "c"]), rng.choice([None, 5, 1 << 54]))
        for i, s in enumerate(seconds)
    ]


@pytest.fixture(scope="module")
def shuffled(spark):
    """(folder, table): three files whose rows are up to 100 seconds out of order, and the rows as a table."""
    rng = random.Random(4)
    rows = made(sorted(rng.randrange(0, 600) // 3 for _ in range(240)))
    late = sorted(rows, key=lambda r: (r[1] + timedelta(seconds=rng.randrange(0, 95)), rng.random()))
    folder = fresh_folder(spark, "shuffled")
    for part in range(3):
        write(spark, folder, late[part * 80 : (part + 1) * 80])
    table = spark.createDataFrame(rows, SCHEMA).persist()
    newest = max(r[1] for r in rows)
    assert any(a[1] > b[1] for a, b in zip(late, late[1:]))
    return folder, table, table.where(F.col("ts") <= F.lit(newest - timedelta(seconds=100)))


def stream(spark, folder, delay=DELAY, schema=None, files=1):
    from pyspark.sql.types import StructType

    df = src.event_stream(spark, folder, files, StructType.fromDDL(schema or SCHEMA))
    return src.event_time(df, F.col("ts"), delay)


def passed(batch, passed_rows):
    return batch.join(passed_rows.select("event_id"), "event_id", "left_semi")


@pytest.mark.parametrize("name", ["value", "sum", "list", "clear", "ttl", "map", "category"])
def test_shuffled_files_give_the_batch_rows(spark, shuffled, name):
    folder, table, done = shuffled
    keys, item = ["user_id"], F.col("amount").cast("string")
    program, batch = {
        "value": (ordered.CountSoFar(), batch_state.count_so_far(table, keys, ORDER)),
        "sum": (ordered.SumSoFar("amount"), batch_state.reduce_running(table, keys, ORDER, "amount")),
        "list": (ordered.History("amount"), batch_state.history(table, keys, ORDER, item)),
        "clear": (ordered.History("amount", 7), batch_state.chunked_history(table, keys, ORDER, item, 7)),
        "ttl": (ordered.RecentHistory(table, "amount", "20 seconds"), batch_state.recent_history(table, keys, ORDER, item, "20 seconds")),
        "map": (ordered.CountMap("kind"), batch_state.count_map(table, keys, ORDER, "kind")),
        "category": (
            ordered.CategoryCount("kind"),
            batch_state.count_so_far(table, ["user_id", "kind"], ORDER).withColumn("n", F.when(F.col("kind").isNotNull(), F.col("n"))),
        ),
    }[name]
    got = ordered.drained_in_order(spark, ordered.in_order(stream(spark, folder), keys, ORDER, program), f"ordered-{name}")
    value = F.col(got.columns[-1])
    shown = F.to_json(F.array_sort(F.map_entries(value))) if name == "map" else value
    pick = [*SCHEMA.split()[::2], "x"]

    def rows(df):
        return rows_of(df.withColumn("x", shown).select(*[c.strip(",") for c in pick]))

    assert got.count() == done.count() > 100
    assert rows(got) == rows(passed(batch.withColumnRenamed(batch.columns[-1], got.columns[-1]), done))


def test_rows_behind_the_watermark_are_dropped(spark):
    folder, out = fresh_folder(spark, "behind"), fresh_folder(spark, "behind-out")
    for part in ([(0, 0), (1, 200)], [(2, 201), (3, 150)], [(4, 20), (5, 400)]):
        write(spark, folder, [(i, BASE + timedelta(seconds=s), 1, "a", 1) for i, s in part])
    found = ordered.in_order(stream(spark, folder), ["user_id"], ORDER, ordered.CountSoFar())
    with ordered.rocksdb(spark):
        drain(found, f"{out}/data", f"{out}/checkpoint")
    got = {r.event_id: r.n for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == {0: 1, 3: 2, 1: 3, 2: 4}  # 4 came too late, 5 still waits
    waiting = ordered.state_rows(spark, f"{out}/checkpoint", "waiting", "user_id bigint")
    assert [r.user_id for r in waiting.collect()] == [1]
    names = ordered.state_variables(spark, f"{out}/checkpoint").first()
    assert "waiting" in str(names) and names.operatorName.startswith("transformWithState")


def test_restart_goes_on_and_the_setting_is_put_back(spark, shuffled):
    folder, table, done = shuffled
    out = fresh_folder(spark, "again")
    files = sorted(spark.read.schema(SCHEMA).parquet(folder).inputFiles())
    assert len(files) == 3
    before = spark.conf.get(ordered.PROVIDER, None)
    growing = fresh_folder(spark, "growing")
    ordered_files = [spark.read.schema(SCHEMA).parquet(f).collect() for f in files]
    ordered_files.sort(key=lambda rows: max(r.ts for r in rows))
    for rows in ordered_files:
        write(spark, growing, rows)
        with ordered.rocksdb(spark):
            drain(ordered.in_order(stream(spark, growing), ["user_id"], ORDER, ordered.CountSoFar()), f"{out}/data", f"{out}/checkpoint")
    assert spark.conf.get(ordered.PROVIDER, None) == before
    got = spark.read.parquet(f"{out}/data")
    want = passed(batch_state.count_so_far(table, ["user_id"], ORDER), done)
    assert rows_of(got.select("event_id", "n")) == rows_of(want.select("event_id", "n"))
    counts = ordered.state_rows(spark, f"{out}/checkpoint", "n", "user_id bigint")
    assert rows_of(counts) == rows_of(done.groupBy("user_id").agg(F.count("*").alias("n")))


def test_a_key_with_ten_thousand_categories(spark):
    folder, out = fresh_folder(spark, "wide"), fresh_folder(spark, "wide-out")
    spark.range(10_000).select(
        F.col("id").alias("event_id"), F.lit(BASE).alias("ts"), F.lit(1).cast("bigint").alias("user_id"),
        F.concat(F.lit("c"), "id").alias("kind"), F.lit(1).cast("bigint").alias("amount"),
    ).coalesce(1).write.parquet(folder)
    for i, s in ((10_000, 200), (10_001, 400)):
        write(spark, folder, [(i, BASE + timedelta(seconds=s), 1, "c77", 1)])
    found = ordered.in_order(stream(spark, folder), ["user_id"], ORDER, ordered.CategoryCount("kind"))
    with ordered.rocksdb(spark):
        query = drain(found, f"{out}/data", f"{out}/checkpoint")
    got = {r.event_id: r.n for r in spark.read.parquet(f"{out}/data").collect()}
    assert got[77] == 1 and got[10_000] == 2 and len(got) == 10_001
    assert ordered.state_rows(spark, f"{out}/checkpoint", "counts", "user_id bigint").count() == 10_000
    # The batch that saw one category again read and wrote a few entries, not ten thousand.
    puts = [int(s["customMetrics"].get("rocksdbPutCount", 0)) for p in query.recentProgress for s in p["stateOperators"]]
    assert max(puts) > 9_000 and puts[-1] < 100


def test_lists_are_appended_to(spark):
    """What a micro-batch writes follows its own rows, not the list."""
    folder, out = fresh_folder(spark, "appended"), fresh_folder(spark, "appended-out")
    at = 0
    for size, start in ((3_000, 0), (5, 200), (5, 400), (5, 600)):
        write(spark, folder, [(at + i, BASE + timedelta(seconds=start), 1, "x" * 50, 1) for i in range(size)])
        at += size
    program = ordered.History("kind", name="items")
    found = ordered.in_order(stream(spark, folder), ["user_id"], ORDER, program).select("event_id", F.size("items").alias("n"))
    with ordered.rocksdb(spark):
        query = drain(found, f"{out}/data", f"{out}/checkpoint")
    # Rows 400 seconds in still wait for the watermark to pass 500.
    assert spark.read.parquet(f"{out}/data").agg(F.max("n")).first()[0] == 3_010
    written = [int(s["customMetrics"]["rocksdbTotalBytesWritten"]) for p in query.recentProgress for s in p["stateOperators"]]
    assert max(written) > 100_000 and written[-1] < 10_000


def test_entries_of_silent_keys_leave_the_state(spark):
    folder, out = fresh_folder(spark, "silent"), fresh_folder(spark, "silent-out")
    write(spark, folder, [(i, BASE + timedelta(seconds=i), 1, "a", 1) for i in range(20)])
    write(spark, folder, [(100, BASE + timedelta(seconds=130), 2, "a", 1)])
    write(spark, folder, [(101, BASE + timedelta(seconds=1000), 3, "a", 1)])
    rows = stream(spark, folder)
    found = ordered.in_order(rows, ["user_id"], ORDER, ordered.RecentHistory(rows, "event_id", "15 seconds"))
    with ordered.rocksdb(spark):
        drain(found, f"{out}/data", f"{out}/checkpoint")
    got = {r.event_id: r.history for r in spark.read.parquet(f"{out}/data").collect()}
    assert got[19] == [str(i) for i in range(4, 20)] and got[100] == ["100"]
    # Users 1 and 2 have been silent for longer than a time to live; user 3 still waits.
    assert ordered.state_rows(spark, f"{out}/checkpoint", "entries", "user_id bigint").count() == 0
    assert ordered.state_rows(spark, f"{out}/checkpoint", "edge", "user_id bigint").count() == 0


def test_counts_cleared_by_the_clock_of_the_events(spark, shuffled):
    folder, table, done = shuffled
    out = fresh_folder(spark, "periods")
    found = ordered.in_order(stream(spark, folder), ["user_id"], ORDER, ordered.CountPerPeriod(table, "30 seconds"))
    with ordered.rocksdb(spark):
        drain(found, f"{out}/data", f"{out}/checkpoint")
    period = F.floor(F.unix_seconds("ts") / 30)
    batch = batch_state.count_so_far(table.withColumn("p", period), ["user_id", "p"], ORDER)
    got = spark.read.parquet(f"{out}/data").select("event_id", "n")
    assert rows_of(got) == rows_of(passed(batch, done).select("event_id", "n"))
    newest = done.agg(F.max("ts")).first()[0]
    held = ordered.state_rows(spark, f"{out}/checkpoint", "period_count", "user_id bigint").collect()
    open_period = int(newest.replace(tzinfo=timezone.utc).timestamp()) // 30
    assert all(r.period >= open_period for r in held)


def test_a_batch_is_the_start_of_a_stream(spark, shuffled):
    folder, table, done = shuffled
    first = spark.createDataFrame([(1, 1000), (None, 7), (9, 3)], "user_id bigint, n bigint")
    found = ordered.in_order(stream(spark, folder), ["user_id"], ORDER, ordered.CountSoFar(), initial=first)
    got = {r.event_id: r.n for r in ordered.drained_in_order(spark, found, "started").collect()}
    before = {1: 1000, None: 7}
    want = {r.event_id: r.n + before.get(r.user_id, 0) for r in passed(batch_state.count_so_far(table, ["user_id"], ORDER), done).collect()}
    assert got == want


@pytest.mark.parametrize("copies", [1, 5])
def test_control_rows_from_a_stream(spark, shuffled, copies):
    folder, table, done = shuffled

    def sides(df):
        rows = df.where("kind IN ('a', 'b')").select("event_id", "ts", (F.col("event_id") % 10).alias("quantity"))
        control = df.where("kind = 'c'").select("ts", F.col("event_id").alias("seq"), (F.col("user_id") * 2).alias("threshold"))
        return rows, control

    rows, control = sides(stream(spark, folder, None))
    found = ordered.controlled(rows, control, "ts", "event_id", "quantity", "threshold", "seq", DELAY, copies)
    got = ordered.drained_in_order(spark, found, "controlled").select("event_id", "quantity", F.col("threshold").cast("int"))
    rows, control = sides(table)
    want = joins.changing_threshold(rows, control, control_order=["seq"])
    newest = table.where("kind = 'a' OR kind = 'b' OR (kind = 'c' AND user_id IS NOT NULL)").agg(F.max("ts")).first()[0]
    want = want.where(F.col("ts") <= F.lit(newest - timedelta(seconds=100)))
    want = want.select("event_id", "quantity", F.col("threshold").cast("int"))
    assert want.count() > 20 and rows_of(got) == rows_of(want)


def test_late_rows_are_put_aside(spark):
    rng = random.Random(6)
    rows = [(i, BASE + timedelta(seconds=max(0, 10 * i - rng.randrange(0, 400))) if i % 9 else None, i) for i in range(120)]
    table = spark.createDataFrame(rows, "event_id bigint, ts timestamp, arrival bigint")
    path = fresh_folder(spark, "aside")
    aside = batches.late_rows_aside(path, "ts", ["arrival"], "60 seconds", slot_rows=10)
    for part in range(3):
        batch = table.where(F.floor(F.col("arrival") / 40) == part)
        aside(batch, part)
        aside(batch, part)
    late = spark.read.parquet(f"{path}/late")
    want = win.late_rows(table, "ts", ["arrival"], "60 seconds")
    assert want.count() > 10 and rows_of(late.select(*want.columns)) == rows_of(want)
    assert spark.read.parquet(f"{path}/rows").count() + late.count() == 120


def test_busiest_window_per_period(spark, shuffled):
    folder, table, done = shuffled
    args = ("ts", "20 seconds", "10 seconds", "60 seconds")
    got = drained_table(spark, stream_win.busiest_per_period(stream(spark, folder), *args), "busiest")
    counts = {}
    for r in table.collect():
        second = int(r.ts.replace(tzinfo=timezone.utc).timestamp())
        for start in (second // 10 * 10, second // 10 * 10 - 10):
            counts[start] = counts.get(start, 0) + 1
    best = {}
    for start, n in sorted(counts.items()):
        period = (start + 19) // 60 * 60
        if period not in best or n > best[period][1]:
            best[period] = (start, n)
    newest = max(r.ts for r in table.collect()).replace(tzinfo=timezone.utc).timestamp() - 100
    want = {(p, s, n) for p, (s, n) in best.items() if p + 60 <= newest}
    seconds = [F.unix_seconds(c).alias(c) for c in ("period_start", "window_start")]
    assert {tuple(r) for r in got.select(*seconds, "n").collect()} == want and want


def test_rows_travel_whole(spark):
    """Every type comes back as it went in."""
    folder = fresh_folder(spark, "types")
    schema = (
        "event_id bigint, ts timestamp, day date, wall timestamp_ntz, price decimal(20,4), ratio double, ok boolean, raw binary, "
        "tags array<string>, deep struct<a: int, b: map<string, bigint>>, `odd name` string"
    )
    at = BASE + timedelta(microseconds=123456)
    full = (1, at, at.date(), at.replace(tzinfo=None), None, float("inf"), True, b"\x00\xff", ["x", None], (1, {"k": 2}), "q\"\n\\")
    empty = (2, at + timedelta(seconds=1), *[None] * 9)
    last = (3, at + timedelta(seconds=500), *[None] * 9)
    write(spark, folder, [full, empty, last], schema)
    found = ordered.in_order(stream(spark, folder, schema=schema), ["odd name"], ORDER, ordered.CountSoFar("count of rows"))
    got = ordered.drained_in_order(spark, found, "types")
    want = spark.createDataFrame([full, empty], schema).withColumn("count of rows", F.lit(1))
    assert rows_of(got) == rows_of(want)
    assert utc_wall_clock(F.col("ts")) is not None


def test_state_read_back_starts_another_stream(spark, shuffled):
    """A checkpoint's counts, read as a table, are where a new query with a new checkpoint goes on."""
    folder, table, done = shuffled
    out, more = fresh_folder(spark, "first-life"), fresh_folder(spark, "more")
    with ordered.rocksdb(spark):
        drain(ordered.in_order(stream(spark, folder), ["user_id"], ORDER, ordered.CountSoFar()), f"{out}/data", f"{out}/checkpoint")
    counts = ordered.state_rows(spark, f"{out}/checkpoint", "n", "user_id bigint")
    later = BASE + timedelta(days=1)
    write(spark, more, [(9000 + i, later + timedelta(seconds=i), 1 + i % 3, "a", 1) for i in range(9)])
    write(spark, more, [(9100, later + timedelta(seconds=500), 1, "a", 1)])
    found = ordered.in_order(stream(spark, more), ["user_id"], ORDER, ordered.CountSoFar(), initial=counts)
    got = {r.event_id: r.n for r in ordered.drained_in_order(spark, found, "second-life").collect()}
    before = {r.user_id: r.n for r in done.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert got == {9000 + i: before[1 + i % 3] + 1 + i // 3 for i in range(9)}


def test_rows_of_a_key_and_batch_wait_as_one_entry(spark):
    folder, out = fresh_folder(spark, "packed"), fresh_folder(spark, "packed-out")
    write(spark, folder, [(i, BASE + timedelta(seconds=i), 1, "a", 1) for i in range(30)])
    write(spark, folder, [(30 + i, BASE + timedelta(seconds=30 + i), 1, "a", 1) for i in range(5)])
    with ordered.rocksdb(spark):
        drain(ordered.in_order(stream(spark, folder), ["user_id"], ORDER, ordered.CountSoFar()), f"{out}/data", f"{out}/checkpoint")
    assert ordered.state_rows(spark, f"{out}/checkpoint", "waiting", "user_id bigint").count() == 2


def test_control_groups_are_read_slice_by_slice(spark):
    """Rows wait by slices of an eighth of the delay; what is written early comes back whole."""
    folder, out = fresh_folder(spark, "sliced"), fresh_folder(spark, "sliced-out")
    # Every third row is a control row; two files, and a last row that lets all of them pass.
    rows = [(i, BASE + timedelta(seconds=i), i % 7, "c" if i % 3 == 0 else "a", i) for i in range(200)]
    write(spark, folder, rows[1::2])
    write(spark, folder, rows[::2])
    write(spark, folder, [(900, BASE + timedelta(seconds=900), 1, "a", 1)])

    def sides(df):
        return df.where("kind = 'a'").select("event_id", "ts", "amount"), df.where("kind = 'c'").select("ts", F.col("event_id").alias("seq"), F.col("user_id").alias("setting"))

    data, control = sides(stream(spark, folder, None))
    found = ordered.controlled(data, control, "ts", "event_id", "amount", "setting", "seq", "200 seconds", 2)
    with ordered.rocksdb(spark):
        drain(found, f"{out}/data", f"{out}/checkpoint")
    got = {r.event_id: r.threshold for r in spark.read.parquet(f"{out}/data").collect()}
    want, now = {}, 0
    for i, _, user, kind, amount in rows:
        now = user if kind == "c" else now
        if kind == "a" and amount > now:
            want[i] = now
    assert got == want and len(want) > 100
    first = spark.read.format("statestore").option("stateVarName", "waiting").option("batchId", 0).load(f"{out}/checkpoint")
    assert first.select("user_map_key.slice").distinct().count() == 8
