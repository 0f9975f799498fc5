"""Tables and event streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.sources.schemas import EVENT_STREAM, EVENTS, GAME_TYPES


def literal(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A frame of rows given in the program; for fixtures and control values."""
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """Integers ``first`` .. ``last``, both ends included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event table with its declared schema."""
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def event_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    schema: T.StructType = EVENT_STREAM,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Event files as an unbounded stream, oldest file first.

    Either limit bounds a micro-batch, also when a backlog is drained.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def event_time(df: DataFrame, column: Column, delay: str | None = None, name: str = "ts") -> DataFrame:
    """Choose the event-time column and, with ``delay``, bound its disorder.

    Rows more than ``delay`` behind the newest event seen may be dropped by
    later stateful steps; without a delay nothing is ever late.
    """
    timed = df.withColumn(name, column)
    return timed.withWatermark(name, delay) if delay else timed


def quantity() -> Column:
    """Item count 0-9 of an event."""
    return (F.floor("value") % 10).cast("int")


def sku() -> Column:
    """Item an event is about."""
    return F.get_json_object("props", "$.k")


def arrival(name: str = "ts") -> Column:
    """A repeatable arrival clock, up to two hours after the event, out of order."""
    lag = (F.col("event_id") * 7919) % 7200
    return F.col(name) + F.make_dt_interval(secs=lag.cast("decimal(18,6)"))


def of_type(df: DataFrame, *types: str) -> DataFrame:
    """Keep only some variants of the wide event row."""
    return df.where(F.col("event_type").isin(*types))


def cart_events(df: DataFrame) -> DataFrame:
    """Items added to and removed from carts."""
    kind = F.when(F.col("event_type") == "purchase", "added").otherwise("removed")
    return of_type(df, "purchase", "error").select(
        "event_id", "ts", "user_id", kind.alias("event_type"), sku().alias("sku"), quantity().alias("quantity")
    )


def catalog_events(df: DataFrame) -> DataFrame:
    """Product pages viewed."""
    return of_type(df, "view").select(
        "event_id", "ts", "user_id", F.lit("viewed").alias("event_type"), sku().alias("product_id")
    )


def game_events(df: DataFrame) -> DataFrame:
    """Players registering and coming online."""
    kind = F.when(F.col("event_type") == "signup", "registered").otherwise("online")
    return of_type(df, "signup", "click").select(
        "event_id",
        "ts",
        kind.alias("event_type"),
        F.col("user_id").alias("player_id"),
        F.concat(F.lit("player"), F.col("user_id").cast("string")).alias("nickname"),
    )


def typed_events(df: DataFrame) -> DataFrame:
    """The three views above as one wide row per event, from a single scan.

    ``domain`` tells the view; columns of other views are null.
    """
    kind = F.col("event_type")
    cart, game = kind.isin("purchase", "error"), kind.isin("signup", "click")
    # Domain and name of each event type.
    names = {
        "purchase": ("cart", "added"),
        "error": ("cart", "removed"),
        "view": ("catalog", "viewed"),
        "signup": ("game", "registered"),
        "click": ("game", "online"),
    }

    def named(at: int) -> Column:
        chosen = F
        for stored, texts in names.items():
            chosen = chosen.when(kind == stored, F.lit(texts[at]))
        return chosen

    return of_type(df, *names).select(
        "event_id",
        "ts",
        F.when(~game, F.col("user_id")).alias("user_id"),
        named(1).alias("event_type"),
        F.when(cart, sku()).alias("sku"),
        F.when(cart, quantity()).alias("quantity"),
        named(0).alias("domain"),
        F.when(kind == "view", sku()).alias("product_id"),
        F.when(game, F.col("user_id")).alias("player_id"),
        F.when(game, F.concat(F.lit("player"), F.col("user_id").cast("string"))).alias("nickname"),
    )


def require_game_type(df: DataFrame, column: str = "game_type") -> DataFrame:
    """Fail the job on a game type outside the allowed values."""
    known = F.col(column).isNull() | F.col(column).isin(*GAME_TYPES)
    return df.withColumn(
        column,
        F.when(known, F.col(column)).otherwise(
            F.raise_error(F.concat(F.lit("unknown game type "), F.col(column)))
        ),
    )
