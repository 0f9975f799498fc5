"""Sources, codecs, row operators, placement and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.codecs import decode_person, encode_person
from freshet.functions.columns import entity_id, fizzbuzz, key_partition
from freshet.functions.times import interval, millis
from freshet.operators import partitioning, rows
from freshet.plans.scratch import fresh_folder
from freshet.sinks import files
from freshet.sources import events as src

PARTITIONS = 8


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return src.events(spark, folder)


def _numbers(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select(F.col("event_id").alias("n"))


def src_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return src.sequence(spark, 1, _events(spark, folder).count())


def event_views(spark: SparkSession, folder: str) -> DataFrame:
    return src.typed_events(_events(spark, folder))


def _people(spark: SparkSession, folder: str) -> DataFrame:
    age = (F.col("c_custkey") % 90).cast("int")
    return src.table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("name"), age.alias("age"))


def encode_people(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode_person(_people(spark, folder))
    return encoded.select("c_custkey", F.decode("value", "UTF-8").alias("message"))


def decode_people(spark: SparkSession, folder: str) -> DataFrame:
    messages = encode_person(_people(spark, folder)).select("c_custkey", "value")
    return decode_person(messages).select("c_custkey", "name", "age")


def map_scale(spark: SparkSession, folder: str) -> DataFrame:
    return rows.scale(_numbers(spark, folder), "n", 2, "doubled")


def map_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    def setup() -> dict:
        return {"factor": 10}

    def transform(resource: dict, batch):
        return batch.assign(scaled=batch["n"] * resource["factor"])

    def teardown(resource: dict) -> None:
        resource.clear()

    return rows.with_lifecycle(_numbers(spark, folder), setup, transform, teardown, "n bigint, scaled bigint")


def flatmap_pair(spark: SparkSession, folder: str) -> DataFrame:
    return rows.expand_pair(_numbers(spark, folder), "n")


def flatmap_range(spark: SparkSession, folder: str) -> DataFrame:
    numbers = _events(spark, folder).select("event_id", src.sku().cast("bigint").alias("n"))
    return rows.expand_range(numbers, "n")


def filter_even(spark: SparkSession, folder: str) -> DataFrame:
    return _numbers(spark, folder).where(F.col("n") % 2 == 0)


def filter_type(spark: SparkSession, folder: str) -> DataFrame:
    cart = src.cart_events(_events(spark, folder))
    return cart.where(F.col("event_type") == "added").select("event_id", "user_id", "sku", "quantity")


def case_fizzbuzz(spark: SparkSession, folder: str) -> DataFrame:
    words = _numbers(spark, folder).withColumn("word", fizzbuzz(F.col("n")))
    return words.where(F.col("word") == "fizzbuzz")


def explode_quantity(spark: SparkSession, folder: str) -> DataFrame:
    items = _events(spark, folder).select("event_id", src.sku().alias("sku"), src.quantity().alias("quantity"))
    return rows.expand_quantity(items, "sku", "quantity").select("event_id", "item")


def static_threshold(spark: SparkSession, folder: str) -> DataFrame:
    added = src.cart_events(_events(spark, folder)).where(F.col("event_type") == "added")
    return rows.quantity_alerts(added, 2).select("event_id", "quantity", "message")


def format_event(spark: SparkSession, folder: str) -> DataFrame:
    text = F.format_string("User %d - %s", "user_id", "event_type")
    return _events(spark, folder).select("event_id", text.alias("text"))


def ts_arith(spark: SparkSession, folder: str) -> DataFrame:
    df = _events(spark, folder)
    return df.select(
        "event_id",
        millis(df, "ts").alias("epoch_ms"),
        (F.col("ts") + interval("90 seconds")).alias("plus_seconds"),
        (F.col("ts") + interval("250 milliseconds")).alias("plus_ms"),
    )


def entity_ids(spark: SparkSession, folder: str) -> DataFrame:
    nickname = F.concat(F.lit("player"), F.col("user_id").cast("string"))
    parts = {
        ("signup", "click"): ("player", [F.col("user_id"), nickname]),
        ("view",): ("player", [F.col("user_id")]),
        ("purchase", "error"): ("game", [src.sku()]),
    }
    return _events(spark, folder).select("event_id", entity_id(F.col("event_type"), parts).alias("entity"))


def partition_custom(spark: SparkSession, folder: str) -> DataFrame:
    placed = partitioning.partition_by_key(_events(spark, folder).select("user_id"), "user_id", PARTITIONS)
    return (
        placed.select("user_id", F.spark_partition_id().cast("bigint").alias("partition"))
        .groupBy("user_id", "partition")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def partition_skew(spark: SparkSession, folder: str) -> DataFrame:
    report = partitioning.skew_report(_events(spark, folder), F.lit(PARTITIONS - 1), PARTITIONS)
    return report.withColumn("partition", F.col("partition").cast("bigint"))


def partition_key_skew(spark: SparkSession, folder: str) -> DataFrame:
    target = key_partition(F.col("user_id"), PARTITIONS)
    report = partitioning.skew_report(_events(spark, folder), target, PARTITIONS)
    return report.select(F.col("partition").cast("bigint").alias("partition"), "rows")


def rebalance(spark: SparkSession, folder: str) -> DataFrame:
    spread = partitioning.rebalance(_events(spark, folder), PARTITIONS)
    per = partitioning.rows_per_partition(spread)
    return per.agg(
        F.sum("rows").alias("all_rows"),
        F.count(F.lit(1)).alias("partitions"),
        (F.max("rows") <= 2 * F.min("rows")).alias("balanced"),
    )


def sink_text(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "sink-text")
    numbers = rows.expand_pair(_numbers(spark, folder), "n")
    files.write_text(numbers, F.col("v"), path)
    return spark.read.text(path)


def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "sink-append")
    df = _events(spark, folder)
    files.append_text(df.where(F.col("event_type") == "view"), F.col("event_id"), path)
    files.append_text(df.where(F.col("event_type") != "view"), F.col("event_id"), path)
    return spark.read.text(path)


def sink_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "sink-fan-out")
    words = _numbers(spark, folder).withColumn("word", fizzbuzz(F.col("n")))
    everything = files.replace_batch(f"{path}/all")
    chosen = files.replace_batch(f"{path}/fizzbuzz")
    write = files.fan_out(
        {"all": everything, "fizzbuzz": lambda batch, i: chosen(batch.where(F.col("word") == "fizzbuzz"), i)}
    )
    write(words, 0)
    write(words, 0)
    back = spark.read.parquet(f"{path}/all").withColumn("sink", F.lit("all"))
    other = spark.read.parquet(f"{path}/fizzbuzz").withColumn("sink", F.lit("fizzbuzz"))
    return back.unionByName(other).select("n", "word", "sink")


QUERIES = {
    "src_sequence": src_sequence,
    "event_views": event_views,
    "encode_person": encode_people,
    "decode_person": decode_people,
    "map_scale": map_scale,
    "map_lifecycle": map_lifecycle,
    "flatmap_pair": flatmap_pair,
    "flatmap_range": flatmap_range,
    "filter_even": filter_even,
    "filter_type": filter_type,
    "case_fizzbuzz": case_fizzbuzz,
    "explode_quantity": explode_quantity,
    "static_threshold": static_threshold,
    "format_event": format_event,
    "ts_arith": ts_arith,
    "entity_id": entity_ids,
    "partition_custom": partition_custom,
    "partition_skew": partition_skew,
    "partition_key_skew": partition_key_skew,
    "rebalance": rebalance,
    "sink_text": sink_text,
    "sink_append": sink_append,
    "sink_fan_out": sink_fan_out,
}

_QUANTITY = "CAST(floor(value) % 10 AS INTEGER)"
_SKU = "json_extract_string(props, '$.k')"
_PARTITION = "CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS BIGINT)"

SQL = {
    "src_sequence": "SELECT unnest(range(1, (SELECT count(*) FROM events) + 1)) AS n",
    "event_views": f"""
        SELECT event_id, ts, CASE WHEN event_type IN ('purchase', 'error', 'view') THEN user_id END AS user_id,
               CASE event_type WHEN 'purchase' THEN 'added' WHEN 'error' THEN 'removed' WHEN 'view' THEN 'viewed'
                               WHEN 'signup' THEN 'registered' ELSE 'online' END AS event_type,
               CASE WHEN event_type IN ('purchase', 'error') THEN {_SKU} END AS sku,
               CASE WHEN event_type IN ('purchase', 'error') THEN {_QUANTITY} END AS quantity,
               CASE WHEN event_type IN ('purchase', 'error') THEN 'cart' WHEN event_type = 'view' THEN 'catalog'
                    ELSE 'game' END AS domain,
               CASE WHEN event_type = 'view' THEN {_SKU} END AS product_id,
               CASE WHEN event_type IN ('signup', 'click') THEN user_id END AS player_id,
               CASE WHEN event_type IN ('signup', 'click') THEN 'player' || user_id END AS nickname
        FROM events WHERE event_type IN ('purchase', 'error', 'view', 'signup', 'click')""",
    "encode_person": "SELECT c_custkey, c_name || ', ' || (c_custkey % 90) AS message FROM customer",
    "decode_person": "SELECT c_custkey, c_name AS name, CAST(c_custkey % 90 AS INTEGER) AS age FROM customer",
    "map_scale": "SELECT event_id AS n, event_id * 2 AS doubled FROM events",
    "map_lifecycle": "SELECT event_id AS n, event_id * 10 AS scaled FROM events",
    "flatmap_pair": "SELECT event_id AS n, unnest([event_id, event_id + 1]) AS v FROM events",
    "flatmap_range": f"""
        SELECT event_id, n, unnest(range(1, n)) AS v
        FROM (SELECT event_id, CAST({_SKU} AS BIGINT) AS n FROM events)""",
    "filter_even": "SELECT event_id AS n FROM events WHERE event_id % 2 = 0",
    "filter_type": f"""
        SELECT event_id, user_id, {_SKU} AS sku, {_QUANTITY} AS quantity FROM events WHERE event_type = 'purchase'""",
    "case_fizzbuzz": "SELECT event_id AS n, 'fizzbuzz' AS word FROM events WHERE event_id % 3 = 0 AND event_id % 5 = 0",
    "explode_quantity": f"""
        SELECT event_id, {_SKU} AS item FROM events, range(10) r(i) WHERE i < floor(value) % 10""",
    "static_threshold": f"""
        SELECT event_id, {_QUANTITY} AS quantity,
               'User ' || user_id || ' attempting to purchase ' || {_QUANTITY} || ' items of ' || {_SKU}
               || ' when threshold is 2' AS message
        FROM events WHERE event_type = 'purchase' AND {_QUANTITY} > 2""",
    "format_event": "SELECT event_id, 'User ' || user_id || ' - ' || event_type AS text FROM events",
    "ts_arith": """
        SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, ts + INTERVAL 90 SECOND AS plus_seconds,
               ts + INTERVAL 250 MILLISECOND AS plus_ms FROM events""",
    "entity_id": f"""
        SELECT event_id, CASE WHEN event_type IN ('signup', 'click') THEN 'player|' || user_id || '|player' || user_id
                              WHEN event_type = 'view' THEN 'player|' || user_id
                              WHEN event_type IN ('purchase', 'error') THEN 'game|' || {_SKU} END AS entity
        FROM events""",
    "partition_custom": f"SELECT user_id, {_PARTITION} AS partition, count(*) AS n FROM events GROUP BY ALL",
    "partition_skew": """
        SELECT CAST(7 AS BIGINT) AS partition, count(*) AS rows, CAST(100.0 AS DOUBLE) AS percent,
               CAST(8.0 AS DOUBLE) AS times_even FROM events""",
    "partition_key_skew": f"SELECT {_PARTITION} AS partition, count(*) AS rows FROM events GROUP BY ALL",
    "rebalance": "SELECT count(*) AS all_rows, CAST(8 AS BIGINT) AS partitions, true AS balanced FROM events",
    "sink_text": "SELECT CAST(unnest([event_id, event_id + 1]) AS VARCHAR) AS value FROM events",
    "sink_append": "SELECT CAST(event_id AS VARCHAR) AS value FROM events",
    "sink_fan_out": """
        WITH words AS (
            SELECT event_id AS n, CASE WHEN event_id % 15 = 0 THEN 'fizzbuzz' WHEN event_id % 3 = 0 THEN 'fizz'
                                       WHEN event_id % 5 = 0 THEN 'buzz' ELSE '' END AS word FROM events)
        SELECT n, word, 'all' AS sink FROM words
        UNION ALL SELECT n, word, 'fizzbuzz' FROM words WHERE word = 'fizzbuzz'""",
}
