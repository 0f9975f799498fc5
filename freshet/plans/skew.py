"""Equi-joins whose hot keys are spread over several tasks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.plans.ordering import SAMPLE_ROWS_PER_SLOT, slot_count


def hot_hashes(df: DataFrame, keys: Sequence[str], rows: int, shares: int) -> dict[int, int]:
    """Hashes of the keys that hold more than ``1/shares`` of the rows (sampled), with the even shares each fills."""
    if rows == 0 or shares < 2:
        return {}
    sample = df.select(F.xxhash64(*keys).alias("h"))
    fraction = min(1.0, SAMPLE_ROWS_PER_SLOT * shares / rows)
    if fraction < 1:
        sample = sample.sample(fraction=fraction, seed=17)
    heavy = sample.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    share = fraction * rows / shares
    return {row["h"]: math.ceil(row["n"] / share) for row in heavy.where(F.col("n") > share).orderBy("h").collect()}


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    slot_rows: int | None = None,
) -> DataFrame:
    """Inner join on ``keys``; each pair comes out once however hot its key is.

    Rows of a key that is hot on one side get a salt from their id, and the
    other side's rows of that key are copied to every salt; a key gets as many salts as
    it fills even shares. Keys that are hot on
    no side keep the single salt 0. Columns other than ``keys`` must differ.
    """
    hot = {}
    for side, df in (("left", left), ("right", right)):
        rows = df.count()
        shares = slot_count(df, rows, slot_rows)
        hot[side] = hot_hashes(df, keys, rows, shares)
    if not hot["left"] and not hot["right"]:
        return left.join(right, list(keys))

    def salts(side: str) -> Column:
        # As many salts as even shares; keys with equally many share one branch.
        by_parts: dict[int, list[int]] = {}
        for value, parts in hot[side].items():
            by_parts.setdefault(1 << (parts - 1).bit_length(), []).append(value)
        found = F.lit(1)
        for parts, values in sorted(by_parts.items()):
            found = F.when(F.xxhash64(*keys).isin(values), F.lit(parts)).otherwise(found)
        return found

    def own(side: str, row_id: str) -> Column:
        return F.pmod(F.xxhash64(row_id), salts(side)).cast("int")

    def every(side: str) -> Column:
        return F.explode(F.sequence(F.lit(0), salts(side) - 1))

    salted_left = left.select("*", own("left", left_id).alias("__sl"), every("right").alias("__sr"))
    salted_right = right.select("*", every("left").alias("__sl"), own("right", right_id).alias("__sr"))
    return salted_left.join(salted_right, [*keys, "__sl", "__sr"]).drop("__sl", "__sr")
