"""Sources, codecs, sinks, placement and Python with a life cycle."""

import pytest
from pyspark.sql import functions as F

from freshet.functions import codecs
from freshet.functions.columns import fizzbuzz, key_partition, up_to
from freshet.operators import partitioning, rows
from freshet.plans.scratch import fresh_folder, shared_folder
from freshet.sinks import external, files
from freshet.sources import events as src
from freshet.sources import kafka

# Fixed values.
LINES = [
    "A beck runs down from the fell.",
    "After rain it is in spate,",
    "and the ford cannot be crossed.",
]
PEOPLE = [("Una", 51), ("Odd", 8), ("Ivo", 30), ("Pia", 19), ("Ivo", 30)]


def people(spark):
    return src.literal(spark, PEOPLE, "name string, age int")


def test_sequence_has_both_ends(spark):
    numbers = [r["n"] for r in src.sequence(spark, 1, 100).collect()]
    assert numbers == list(range(1, 101))


def test_person_round_trip(spark):
    messages = codecs.encode_person(people(spark)).select("value")
    assert dict(messages.dtypes) == {"value": "binary"}
    assert bytes(messages.first()["value"]) == b"Una, 51"
    back = codecs.decode_person(messages).select("name", "age")
    assert sorted(map(tuple, back.collect())) == sorted(PEOPLE)


@pytest.mark.parametrize("raw", [b"Ann,\t3", b"\n Ann\r,\x0b 3 \n", b"Ann,3"])
def test_white_space_around_fields(spark, raw):
    df = spark.createDataFrame([(bytearray(raw),)], "value binary")
    for strict in (True, False):
        row = codecs.decode_person(df, strict=strict).first()
        assert (row["name"], row["age"]) == ("Ann", 3)


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(bytearray(b"A\xff, 3"),), (bytearray(b"Ann, 3"),), (None,)], "value binary")
    good, bad = codecs.split_malformed(df)
    assert [r["name"] for r in good.collect()] == ["Ann"] and bad.count() == 2
    with pytest.raises(Exception, match="(?i)utf"):
        codecs.decode_person(df.limit(1)).collect()


def test_a_null_message_has_no_name(spark):
    df = spark.createDataFrame([(None,), (bytearray(b"Ann, 3"),)], "value binary")
    got = codecs.decode_person(df).select("name", "age").collect()
    assert sorted(map(tuple, got), key=str) == [("Ann", 3), (None, None)]


@pytest.mark.parametrize("text", ["Bob", "Bob, x", "Bob,", ""])
def test_malformed_person(spark, text):
    df = src.literal(spark, [("Ann , 3",), (text,)], "value string").select(F.encode("value", "UTF-8").alias("value"))
    with pytest.raises(Exception, match="person message"):
        codecs.decode_person(df).collect()
    good, bad = codecs.split_malformed(df)
    assert [tuple(r) for r in good.select("name", "age").collect()] == [("Ann", 3)]
    assert [bytes(r["value"]).decode() for r in bad.collect()] == [text]


def test_fizzbuzz_numbers(spark):
    words = src.sequence(spark, 1, 100).withColumn("w", fizzbuzz(F.col("n")))
    got = [r["n"] for r in words.where("w = 'fizzbuzz'").collect()]
    assert got == [15, 30, 45, 60, 75, 90]
    assert words.where("w = ''").count() == 100 - 33 - 20 + 6


def test_expand_range_excludes_the_end(spark):
    df = src.literal(spark, [(0,), (1,), (2,), (4,)], "n bigint")
    assert sorted((r["n"], r["v"]) for r in rows.expand_range(df, "n").collect()) == [(2, 1), (4, 1), (4, 2), (4, 3)]
    assert df.select(F.size(up_to(F.col("n"))).alias("s")).agg(F.sum("s")).first()[0] == 4


def test_expand_quantity(spark):
    df = src.literal(spark, [("boots", 2), ("phone", 1), ("hat", 0)], "sku string, q int")
    assert sorted(r["item"] for r in rows.expand_quantity(df, "sku", "q").collect()) == ["boots", "boots", "phone"]


def test_lifecycle_opens_and_closes_once_per_task(spark):
    folder = fresh_folder(spark, "lifecycle")

    def setup():
        import os

        os.makedirs(folder, exist_ok=True)
        return {"rows": 0}

    def transform(resource, batch):
        resource["rows"] += len(batch)
        return batch.assign(n=batch["n"] * 10)

    def teardown(resource):
        import uuid

        with open(f"{folder}/{uuid.uuid4()}", "w") as out:
            out.write(str(resource["rows"]))

    df = src.sequence(spark, 1, 60).repartition(3)
    got = rows.with_lifecycle(df, setup, transform, teardown, "n bigint").collect()
    assert sorted(r["n"] for r in got) == list(range(10, 601, 10))
    closed = [int(r["value"]) for r in spark.read.text(folder).collect()]
    assert len(closed) == 3 and sum(closed) == 60


def test_custom_partitions_are_exact(spark):
    df = src.literal(spark, [(f"user{i % 9}",) for i in range(90)], "user string")
    placed = partitioning.partition_by_key(df, "user", 4)
    wrong = placed.where(F.spark_partition_id() != key_partition(F.col("user"), 4)).count()
    assert placed.rdd.getNumPartitions() == 4 and wrong == 0


def test_skew_report_and_rebalance(spark):
    df = src.sequence(spark, 1, 800)
    (line,) = partitioning.skew_report(df, F.lit(3), 4).collect()
    assert tuple(line) == (3, 800, 100.0, 4.0)
    sizes = [r["rows"] for r in partitioning.rows_per_partition(partitioning.rebalance(df, 4)).collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 8


def test_append_text(spark):
    path = fresh_folder(spark, "append")
    df = src.literal(spark, [(line,) for line in LINES], "line string")
    files.append_text(df, F.col("line"), path)
    files.append_text(df, F.col("line"), path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == sorted(LINES * 2)


def test_repeated_batch_leaves_no_duplicate(spark):
    path = fresh_folder(spark, "fan-out")
    write = files.fan_out({"a": files.replace_batch(f"{path}/a"), "b": files.replace_batch(f"{path}/b", "json")})
    for batch in (0, 1, 1):
        write(people(spark), batch)
    assert spark.read.parquet(f"{path}/a").count() == 10
    assert spark.read.schema("name string, age int").json(f"{path}/b").count() == 10


def test_connector_sink_projects_and_marks_the_batch(spark):
    path = fresh_folder(spark, "connector")
    sink = external.connector_sink("parquet", {"path": path}, ["name", "age"], batch_column="batch")
    sink(people(spark).withColumn("extra", F.lit(1)), 3)
    back = spark.read.parquet(path)
    assert back.columns == ["name", "age", "batch"]
    assert {r["batch"] for r in back.collect()} == {3}


def test_connector_options():
    assert kafka.read_options("host:9092", "events", "events-group") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "kafka.group.id": "events-group",
    }
    assert external.kafka_options("host:9092", "people") == {"kafka.bootstrap.servers": "host:9092", "topic": "people"}
    assert external.jdbc_options("jdbc:x", "people", "d", "u", "p")["dbtable"] == "people"


def test_unknown_game_type_fails(spark):
    good = src.literal(spark, [("OneVsOne",), (None,)], "game_type string")
    assert src.require_game_type(good).count() == 2
    with pytest.raises(Exception, match="unknown game type"):
        src.require_game_type(src.literal(spark, [("FiveVsFive",)], "game_type string")).collect()


def test_stored_wall_clock_is_read_as_utc(spark, data):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        instants = spark.read.schema(src.EVENT_STREAM).parquet(f"{data}/events.parquet")
        from freshet.functions.times import micros, utc_wall_clock

        table = src.events(spark, data)
        a = instants.select("event_id", utc_wall_clock(F.col("ts")).alias("wall"), micros(instants, "ts").alias("us"))
        b = table.select("event_id", F.col("ts").alias("wall"), micros(table, "ts").alias("us"))
        assert a.exceptAll(b).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


class _Session:
    """Just what the scratch folder asks of a session."""

    def __init__(self, master, named=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: named or default)})()


def test_scratch_folder_is_the_one_the_cluster_names():
    assert shared_folder(_Session("spark://host:7077", "hdfs:///scratch/")) == "hdfs:///scratch"
    assert shared_folder(_Session("local[2]")) == shared_folder(_Session("local[2]"))
    with pytest.raises(ValueError):
        shared_folder(_Session("spark://host:7077"))


def test_typed_events_hold_the_three_views(spark, data):
    df = src.events(spark, data)
    wide = src.typed_events(df)
    for domain, view in (("cart", src.cart_events(df)), ("catalog", src.catalog_events(df)), ("game", src.game_events(df))):
        chosen = wide.where(F.col("domain") == domain).select(view.columns)
        assert chosen.exceptAll(view).count() == 0 and chosen.count() == view.count()
