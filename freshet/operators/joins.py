"""Operators over two streams: window join, interval join, shares, changing control."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.columns import share_percent
from freshet.functions.times import interval, interval_micros, micros
from freshet.operators.windows import with_window
from freshet.plans.ordering import count_if, latest, running
from freshet.plans.skew import spread_join

CONTROL_LIMIT = 4_096
"""Control rows that may be held as literals in the plan."""


def _side(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    return df.select([F.col(c).alias(c if c in keys else f"{prefix}_{c}") for c in df.columns])


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    row_id: str = "event_id",
    slot_rows: int | None = None,
) -> DataFrame:
    """All pairs with equal keys in the same fixed window.

    Non-key columns come back as ``left_*`` and ``right_*``. On streams both
    sides need a watermark on ``ts``.
    """
    if left.isStreaming or right.isStreaming:
        window = F.window(ts, size).alias("window")
        # The window becomes the event time; the row's own time goes on as a plain value.
        plain = (F.col(ts) + interval("0 seconds")).alias(ts)
        a, b = [
            df.select(*[plain if c == ts else F.col(c) for c in df.columns], window) for df in (left, right)
        ]
        a, b = _side(a, "left", [*keys, "window"]), _side(b, "right", [*keys, "window"])
        joined = a.join(b, [*keys, "window"])
        return joined.select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *[c for c in joined.columns if c not in {*keys, "window"}],
        )
    on = [*keys, "window_start"]
    a, b = [with_window(df, ts, size).drop("window_end") for df in (left, right)]
    pairs = spread_join(
        _side(a, "left", on), _side(b, "right", on), on, f"left_{row_id}", f"right_{row_id}", slot_rows
    )
    window_end = (F.col("window_start") + interval(size)).alias("window_end")
    return pairs.select(*on, window_end, *[c for c in pairs.columns if c not in on])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    lower: str,
    upper: str,
    lower_inclusive: bool = True,
    upper_inclusive: bool = True,
    row_id: str = "event_id",
    slot_rows: int | None = None,
) -> DataFrame:
    """Pairs with equal keys and ``lower`` to ``upper`` between left and right time.

    ``lower`` and ``upper`` are intervals added to the left time, such as
    ``"-2 hours"`` and ``"2 hours"``. A batch joins on key and time bucket: a
    left row is in one bucket, a right row in the one or two it can reach, so
    rows far apart in time never meet, however many a key has. On streams both sides need
    a watermark on ``ts``.
    """
    a, b = _side(left, "left", keys), _side(right, "right", keys)
    low, high = F.col(f"left_{ts}") + interval(lower), F.col(f"left_{ts}") + interval(upper)
    time = F.col(f"right_{ts}")
    near = (time >= low if lower_inclusive else time > low) & (time <= high if upper_inclusive else time < high)
    from_us, to_us = interval_micros(left, lower), interval_micros(left, upper)
    if to_us < from_us:
        raise ValueError("upper bound before lower bound")
    width = max(to_us - from_us, 1)

    def bucket(us: Column) -> Column:
        return us - F.pmod(us, F.lit(width))

    a = a.withColumn("bucket", bucket(micros(a, f"left_{ts}")))
    us = micros(b, f"right_{ts}")
    reach = F.sequence(bucket(us - F.lit(to_us)), bucket(us - F.lit(from_us)), F.lit(width).cast("bigint"))
    b = b.withColumn("bucket", F.explode(reach))
    if left.isStreaming or right.isStreaming:
        # The time range stays in the condition: it lets the engine drop old state.
        on = [*keys, "bucket"]
        b = b.select(*[F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in b.columns])
        same = near
        for key in on:
            same = same & (a[key] == b[f"__{key}"])
        joined = a.join(b, same)
        return joined.select(*keys, *[c for c in [*a.columns, *b.columns] if c not in on and c not in {f"__{k}" for k in on}])
    pairs = spread_join(a, b, [*keys, "bucket"], f"left_{row_id}", f"right_{row_id}", slot_rows)
    return pairs.where(near).drop("bucket")


def running_share(
    first: DataFrame, second: DataFrame, order: Sequence[str], tags: tuple[str, str], slot_rows: int | None = None
) -> DataFrame:
    """After each event, the percentage its own stream holds of all events so far."""
    a = first.withColumn("stream", F.lit(tags[0]))
    b = second.withColumn("stream", F.lit(tags[1]))
    both = a.unionByName(b, allowMissingColumns=True)
    is_first = F.col("stream") == tags[0]
    counted = running(both, [], order, {"n1": count_if(is_first), "n2": count_if(~is_first)}, slot_rows=slot_rows)
    own, other = (
        F.when(is_first, F.col("n1")).otherwise(F.col("n2")),
        F.when(is_first, F.col("n2")).otherwise(F.col("n1")),
    )
    return counted.withColumn("percent", share_percent(own, other)).drop("n1", "n2")


def latest_control(
    df: DataFrame,
    control: DataFrame,
    ts: str,
    row_id: str,
    value: str,
    default: Column,
    control_order: Sequence[str],
    limit: int = CONTROL_LIMIT,
    slot_rows: int | None = None,
) -> DataFrame:
    """Add the control value in force at each row's time, ``default`` before the first.

    ``control`` has ``ts``, ``value`` and columns that order changes made at
    one time, the last of which counts (``control_order``); a null value changes
    nothing. Up to ``limit`` changes are looked up in a literal list; a larger
    control stream is united with the rows and carried forward, whatever its size. Both
    ways give the same columns: the control's value in its own type, in place of any column
    of that name, last.
    """
    kind = control.schema[value].dataType
    df = df.drop(value)
    known = control.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).groupBy(ts)
    if not control_order:
        last = F.max(value)
    else:
        last = F.max_by(value, control_order[0] if len(control_order) == 1 else F.struct(*control_order))
    changes = known.agg(last.alias(value))
    if control.select(ts).limit(limit + 1).count() > limit:
        return _carry_control(df, changes, ts, row_id, value, default, slot_rows)

    found = changes.select(micros(changes, ts).alias("us"), F.col(value).alias("value")).collect()
    found.sort(key=lambda row: row["us"])
    values = F.array(default.cast(kind), *[F.lit(row["value"]).cast(kind) for row in found])
    if not found:
        return df.withColumn(value, default.cast(kind))
    # Microseconds fit a double exactly until the year 2255.
    timed = df.withColumn("__us", F.coalesce(micros(df, ts).cast("double"), F.lit(-math.inf)))
    splits = [-math.inf, *[float(row["us"]) for row in found], math.inf]
    placed = Bucketizer(splits=splits, inputCol="__us", outputCol="__at").transform(timed)
    return placed.withColumn(value, F.get(values, F.col("__at").cast("int"))).drop("__us", "__at")


def _carry_control(
    df: DataFrame, changes: DataFrame, ts: str, row_id: str, value: str, default: Column, slot_rows: int | None
) -> DataFrame:
    # The change made at a row's own time comes before the row.
    rows = df.withColumn("__rank", F.lit(1))
    marks = changes.select(ts, F.col(value).alias("__change"), F.lit(0).alias("__rank"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    carried = running(both, [], [ts, "__rank", row_id], {"__latest": latest(F.col("__change"))}, slot_rows=slot_rows)
    current = F.coalesce(F.col("__latest"), default).cast(changes.schema[value].dataType)
    return carried.where(F.col("__rank") == 1).select(*df.columns, current.alias(value))


def changing_threshold(
    df: DataFrame,
    control: DataFrame,
    ts: str = "ts",
    row_id: str = "event_id",
    quantity: str = "quantity",
    control_order: Sequence[str] = (),
    limit: int = CONTROL_LIMIT,
    slot_rows: int | None = None,
) -> DataFrame:
    """Rows whose quantity exceeds the threshold in force at their time (0 before the first)."""
    known = latest_control(
        df, control, ts, row_id, "threshold", F.lit(0), control_order, limit, slot_rows
    )
    return known.where(F.col(quantity) > F.col("threshold"))
