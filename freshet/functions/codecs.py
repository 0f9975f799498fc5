"""Text message codecs as column jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode_person(df: DataFrame, name: str = "name", age: str = "age") -> DataFrame:
    """Add ``value``: the UTF-8 bytes of ``"name, age"``."""
    return df.withColumn("value", F.encode(F.concat(F.col(name), F.lit(", "), F.col(age).cast("string")), "UTF-8"))


def _trimmed(text: Column) -> Column:
    """Without any character up to U+0020 at either end."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def decode_person(df: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """Add ``name`` and ``age`` read from a ``"name, age"`` message.

    With ``strict`` a message without an age, with an age that is no number, or that is not
    UTF-8 fails the job; otherwise both columns are null and ``malformed`` is true. A null message
    has a null name and age; it fails no job, and leniently it is malformed.
    """
    text = F.col(value).cast("string")
    fields = F.split(F.validate_utf8(text) if strict else F.try_validate_utf8(text), ",")
    if strict:
        whole = F.when(text.isNull() | (F.size(fields) >= 2), _trimmed(F.get(fields, 1))).otherwise(
            F.raise_error(F.lit("person message without an age"))
        )
        return df.select(
            "*",
            _trimmed(F.get(fields, 0)).alias("name"),
            F.when(whole.rlike(r"^[+-]?\d+$"), whole)
            .when(whole.isNull(), None)
            .otherwise(F.raise_error(F.lit("person message whose age is no number")))
            .cast("int")
            .alias("age"),
        )
    age = _trimmed(F.get(fields, 1)).try_cast("int")
    return df.select(
        "*",
        F.when(age.isNotNull(), _trimmed(F.get(fields, 0))).alias("name"),
        age.alias("age"),
        age.isNull().alias("malformed"),
    )


def split_malformed(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decode leniently and route: (decoded people, raw messages that failed)."""
    decoded = decode_person(df, value, strict=False)
    people = decoded.where(~F.col("malformed")).drop("malformed")
    return people, decoded.where("malformed").drop("malformed", "name", "age")
