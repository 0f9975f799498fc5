"""Union of streams and split into several outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_streams(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept; columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def with_source(df: DataFrame, source: str, column: str = "sku") -> DataFrame:
    """Carry the source in front of a text column."""
    return df.withColumn(column, F.concat_ws("_", F.lit(source), F.col(column)))


def side_output(df: DataFrame, tagged: Column) -> tuple[DataFrame, DataFrame]:
    """Split into (main, tagged). Each row is in exactly one; null counts as not tagged."""
    chosen = F.coalesce(tagged, F.lit(False))
    return df.where(~chosen), df.where(chosen)
