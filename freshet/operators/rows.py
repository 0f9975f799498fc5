"""Row-at-a-time operators: map, filter, expand, and Python with a life cycle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.columns import up_to, warning_text


def scale(df: DataFrame, column: str, factor: int, name: str | None = None) -> DataFrame:
    """Multiply a column."""
    return df.withColumn(name or column, F.col(column) * factor)


def with_lifecycle(
    df: DataFrame,
    setup: Callable[[], Any],
    transform: Callable[[Any, pd.DataFrame], pd.DataFrame],
    teardown: Callable[[Any], None],
    schema: T.StructType | str,
) -> DataFrame:
    """Run Python over Arrow batches with one set-up and tear-down per task.

    For code that needs a resource (a model, a connection). ``transform`` may
    return any number of rows per batch. Plain arithmetic belongs in columns.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield transform(resource, batch)
        finally:
            teardown(resource)

    return df.mapInPandas(task, schema)


def expand(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One output row per element of an array expression; none for an empty array."""
    return df.select("*", F.explode(items).alias(name))


def expand_pair(df: DataFrame, n: str, name: str = "v") -> DataFrame:
    """n becomes n and n + 1."""
    return expand(df, F.array(F.col(n), F.col(n) + 1), name)


def expand_range(df: DataFrame, n: str, name: str = "v") -> DataFrame:
    """n becomes 1 .. n-1; n = 1 gives no rows."""
    return expand(df.where(F.col(n) > 1), up_to(F.col(n)), name)


def expand_quantity(df: DataFrame, item: str, quantity: str, name: str = "item") -> DataFrame:
    """(item, q) becomes q copies of item; q = 0 gives none."""
    return expand(df, F.array_repeat(F.col(item), F.col(quantity)), name)


def quantity_alerts(df: DataFrame, threshold: int) -> DataFrame:
    """Rows whose ``quantity`` exceeds a fixed threshold, with a message."""
    text = warning_text(F.col("user_id"), F.col("quantity"), F.col("sku"), F.lit(threshold))
    return df.where(F.col("quantity") > threshold).withColumn("message", text)
