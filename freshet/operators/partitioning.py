"""Placement of rows on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.columns import key_partition


def partition_by_key(df: DataFrame, key: str, partitions: int, target: Column | None = None) -> DataFrame:
    """Place rows exactly where ``target`` says; by default hash of key mod n."""
    where = key_partition(F.col(key), partitions) if target is None else target
    return df.repartitionById(partitions, where.cast("int"))


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows evenly, whatever their keys."""
    return df.repartition(partitions)


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows on each partition of a frame, counted where they are."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def skew_report(df: DataFrame, target: Column, partitions: int) -> DataFrame:
    """What a placement would do, without moving a row.

    One line per partition that would get rows: the rows, their share of the
    table and the ratio to an even spread.
    """
    per = df.groupBy(target.cast("int").alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
    # A window over the aggregate: at most one row per partition.
    all_rows = F.sum("rows").over(Window.partitionBy())
    return per.select(
        "partition",
        "rows",
        (F.col("rows") * F.lit(100.0) / all_rows).alias("percent"),
        (F.col("rows") * F.lit(1.0) * partitions / all_rows).alias("times_even"),
    )
