"""Column expressions used by more than one operator."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_percent(part: Column, rest: Column) -> Column:
    """``part`` as a percentage of ``part + rest``, as DOUBLE."""
    return part * F.lit(100.0) / (part + rest)


def fizzbuzz(n: Column) -> Column:
    """Word for a number; the cases are tried in this order."""
    # Fixed values.
    return (
        F.when(n % 15 == 0, "fizzbuzz").when(n % 3 == 0, "fizz").when(n % 5 == 0, "buzz").otherwise("")
    )


def up_to(n: Column) -> Column:
    """Array 1 .. n-1, empty when n is 1 or less (a bare sequence would count down)."""
    return F.when(n > 1, F.sequence(F.lit(1).cast("bigint"), n.cast("bigint") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def entity_id(event_type: Column, parts: Mapping[Sequence[str], tuple[str, Sequence[Column]]]) -> Column:
    """Composite id ``prefix|part|part`` chosen by event type."""
    chosen: Column | None = None
    for types, (prefix, columns) in parts.items():
        text = F.concat_ws("|", F.lit(prefix), *[c.cast("string") for c in columns])
        applies = event_type.isin(*types)
        chosen = F.when(applies, text) if chosen is None else chosen.when(applies, text)
    if chosen is None:
        raise ValueError("no event types given")
    return chosen


def key_partition(key: Column, partitions: int) -> Column:
    """Partition 0 .. partitions-1 of a key, from a hash that is never negative."""
    digest = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(digest, F.lit(partitions)).cast("int")


def warning_text(user: Column, quantity: Column, sku: Column, threshold: Column) -> Column:
    """Message of a quantity alert."""
    # Fixed format.
    return F.format_string(
        "User %s attempting to purchase %s items of %s when threshold is %s",
        user.cast("string"),
        quantity.cast("string"),
        sku,
        threshold.cast("string"),
    )
