"""Event-time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Names of the zone in which wall clock and instant agree.
UTC_NAMES = frozenset({"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "+00:00"})


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch of a timestamp column, as BIGINT.

    A TIMESTAMP_NTZ column is read as UTC wall clock whatever the session zone:
    a cast to TIMESTAMP, though cheaper, would not keep the order across a
    daylight-saving gap and is used in UTC only.
    """
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
            return F.unix_micros(F.col(name).cast("timestamp"))
        since = F.col(name) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("bigint")
    return F.unix_micros(F.col(name))


def millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since the epoch, as BIGINT."""
    return F.floor(micros(df, name) / F.lit(1000)).cast("bigint")


def interval(text: str) -> Column:
    """An interval literal such as ``interval("3 hours")``."""
    return F.expr(f"INTERVAL '{text}'")


def interval_micros(df: DataFrame, text: str) -> int:
    """Length of a day-time interval in microseconds, worked out by Spark."""
    epoch = "TIMESTAMP '1970-01-01 00:00:00+00:00'"
    return df.sparkSession.sql(
        f"SELECT unix_micros({epoch} + INTERVAL '{text}') - unix_micros({epoch}) AS us"
    ).first()["us"]


def utc_wall_clock(column: Column) -> Column:
    """Show an instant (TIMESTAMP) as the TIMESTAMP_NTZ a clock in UTC reads."""
    return F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz"))
