"""What several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.plans.scratch import materialize

#: Words of every contract: runs of anything but a blank and the ASCII controls 9 to 13.
NOT_WORD = r"[ \t\n\x0B\f\r]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, lineage cut."""
    return materialize(df, label)


def words(text: Column) -> Column:
    """The words of a text in order; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD), lambda w: w != "")


def packed(bucket: Column, rank: Column) -> Column:
    """One integer of a bucket below 2^20 and a rank below 2^40."""
    return F.shiftleft(bucket.cast("long"), 40) + rank


def row_marks(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes over all columns, 128 bits together, by which rows are told apart."""
    plain = [F.to_json(c) if "map<" in kind or kind == "variant" else F.col(f"`{c}`") for c, kind in df.dtypes]
    # Hashing leaves out nulls, so the places they stand in are hashed too.
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    return F.xxhash64(nulls, *plain), F.xxhash64(F.lit(1), nulls, *reversed(plain))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found
