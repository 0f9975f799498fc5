"""Running aggregates over an order, safe for hot keys and for no key at all.

``sum(x) OVER (PARTITION BY k ORDER BY ts)`` puts all rows of one ``k`` in one
task. When a key holds a large share of the table (or there is no key) the rows
are cut along the order into *slots* instead:

1. a sampled pass finds the hot keys and the time bounds that split their rows
   evenly (both lists are bounded by the number of slots, never by the data);
2. per hot key and slot, partial aggregates give what the earlier slots
   contribute: one small *seed* row per key and slot;
3. seeds and rows are united and one window per (key, slot) runs over both, the
   seed first.

The bounds end up as literals in the plan, so a lost executor recomputes the
same slots. Sampling decides only the balance. Types are those of the plain
window on either path, and so are counts, maxima, lists and sums of integers and
decimals. A sum of DOUBLE or FLOAT values adds up slot by slot and may differ from the plain
window's in the last bits (relative 1e-12 in the tests), as the sum of a group does.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import micros

SLOT_ROWS = 1_000_000
"""Rows one task should sort; sets the number of slots on large tables."""

SLOTS_PER_TASK = 4
"""Slots are placed by hash; several per task even out."""

HOT_ROWS = SLOT_ROWS // 4
"""Rows of one key that a task takes without being cut, on any number of tasks."""

MIN_SLOT_ROWS = 1_000
"""Rows worth a slot of their own, however many tasks the session asks for."""

MAX_SLOTS = 32_768
"""Upper bound for slots, hot keys and therefore for everything collected."""

SAMPLE_ROWS_PER_SLOT = 256

COLD = -1
"""Slot of the rows whose key is not hot."""

_SLOT, _SEED, _HASH, _POSITION = "__slot", "__seed", "__hash", "__position"


def _last_known(name: str) -> Column:
    return F.last(name, ignorenulls=True)


@dataclass(frozen=True)
class Measure:
    """A running aggregate: the value a row adds and how values combine."""

    kind: str
    value: Column

    def combine(self, name: str, over: WindowSpec | None = None) -> Column:
        """Combine the values in column ``name``, of a group or of a window frame."""
        aggregates = {"count": F.sum, "sum": F.sum, "max": F.max, "list": F.collect_list, "latest": _last_known}
        aggregate = aggregates[self.kind](name)
        combined = aggregate if over is None else aggregate.over(over)
        return F.flatten(combined) if self.kind == "list" else combined

    def slot_total(self, name: str, order: Sequence[str]) -> Column:
        if self.kind == "latest":
            return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order[0])))
        if self.kind != "list":
            return self.combine(name)
        ordered = F.sort_array(F.collect_list(F.struct(*order, F.col(name).alias("items"))))
        return F.flatten(ordered["items"])

    def finish(self, column: Column) -> Column:
        return F.coalesce(column, F.lit(0)).cast("bigint") if self.kind == "count" else column


def _one_row(measure: Measure) -> Column:
    """The measure over one row: only its type is looked at."""
    over = Window.partitionBy(F.lit(0)).orderBy(F.lit(0))
    if measure.kind == "sum":
        return F.sum(measure.value).over(over)
    return measure.finish(measure.value)


def count_if(condition: Column | None = None) -> Measure:
    """Number of rows so far, or of rows that satisfy a condition."""
    one = F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)
    return Measure("count", one.cast("bigint"))


def total(value: Column) -> Measure:
    return Measure("sum", value)


def highest(value: Column) -> Measure:
    return Measure("max", value)


def latest(value: Column) -> Measure:
    """Last value that is not null; such values must differ in the first order column."""
    return Measure("latest", value)


def collected(value: Column) -> Measure:
    """All values so far, in order. Every output row holds its whole list."""
    return Measure("list", F.array(value))


@dataclass(frozen=True)
class Slots:
    """A cut of (key, order) into slots, held as literals."""

    order: tuple[str, ...]
    keys: tuple[str, ...]
    hot: tuple[int, ...]
    splits: tuple[float, ...]
    origin: int
    tie_low: float
    tie_span: float

    def position(self, df: DataFrame, shift: int = 0, last_of_tie: bool = False) -> Column:
        """A double that never decreases along the order (equal for near ties)."""
        return _position(df, self.order, self.origin - shift, self.tie_low, self.tie_span, last_of_tie)

    def is_hot(self) -> Column:
        if not self.keys:
            return F.lit(True)
        return F.xxhash64(*self.keys).isin(list(self.hot))

    def assign(
        self, df: DataFrame, name: str = _SLOT, shift: int = 0, last_of_tie: bool = False
    ) -> DataFrame:
        """Add the slot of each row; ``shift`` looks that much later in the order."""
        if not self.splits:
            return df.withColumn(name, F.when(self.is_hot(), 0).otherwise(COLD).cast("int"))
        bucketizer = Bucketizer(
            splits=[-math.inf, *self.splits, math.inf], inputCol=_POSITION, outputCol=name
        )
        placed = bucketizer.transform(df.withColumn(_POSITION, self.position(df, shift, last_of_tie)))
        slot = F.when(self.is_hot(), F.col(name)).otherwise(COLD).cast("int")
        return placed.withColumn(name, slot).drop(_POSITION)


def _whole(df: DataFrame, name: str) -> Column:
    """A timestamp, date or integer column as BIGINT."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(df, name)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    raise TypeError(f"order column {name} must be a timestamp, date or integer, not {kind}")


def _position(
    df: DataFrame,
    order: Sequence[str],
    origin: int,
    tie_low: float,
    tie_span: float,
    last_of_tie: bool = False,
) -> Column:
    main = (_whole(df, order[0]) - F.lit(origin).cast("bigint")).cast("double")
    if last_of_tie:
        main = main + F.lit(1.0)
    elif len(order) > 1 and tie_span > 0:
        # Ties on the first column are split by the second one, scaled to [0, 1].
        share = (_whole(df, order[1]).cast("double") - F.lit(tie_low)) / F.lit(tie_span)
        main = main + F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)), F.lit(0.0))
    return F.coalesce(main, F.lit(-math.inf))


def slot_count(df: DataFrame, rows: int, slot_rows: int | None = None, per_task: int = 1) -> int:
    """How many even shares ``rows`` should be cut into."""
    parallel = per_task * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    worthwhile = min(parallel, math.ceil(rows / MIN_SLOT_ROWS))
    wanted = max(worthwhile, math.ceil(rows / (slot_rows or SLOT_ROWS)))
    return max(1, min(rows, wanted, MAX_SLOTS))


def plan_slots(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slot_rows: int | None = None
) -> Slots | None:
    """Find the hot keys and the bounds that cut their rows; ``None`` if no key is hot.

    A key is hot when it holds more than an even share of the rows (with some room for the sample's error) and
    more rows than one task should order: ``HOT_ROWS``, or a quarter of all of them where that is less. The number of
    slots follows the largest hot key, not all of them together: smaller ones need fewer,
    and every (hot key, slot) costs a seed. Reads only the key and order columns, as a count and a sample.
    """
    wanted = [F.count(F.lit(1)).alias("rows"), F.min(_whole(df, order[0])).alias("origin")]
    if len(order) > 1:
        second = _whole(df, order[1])
        wanted += [F.min(second).alias("low"), F.max(second).alias("high")]
    stats = df.agg(*wanted).first()
    rows, origin = stats["rows"], stats["origin"] or 0
    low = high = None
    if len(order) > 1:
        low, high = stats["low"], stats["high"]
    tie_low = float(low or 0)
    tie_span = float(high - low + 1) if low is not None else 0.0

    shares = slot_count(df, rows, slot_rows)
    cuts = slot_count(df, rows, slot_rows, SLOTS_PER_TASK)
    if shares == 1:
        return None if keys else Slots(tuple(order), (), (), (), origin, tie_low, tie_span)

    sample = df.select(
        (F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")).alias(_HASH),
        _position(df, order, origin, tie_low, tie_span).alias(_POSITION),
    )
    fraction = SAMPLE_ROWS_PER_SLOT * cuts / rows
    if fraction < 1:
        sample = sample.sample(fraction=fraction, seed=17)

    hot: tuple[int, ...] = ()
    if keys:
        sampled = min(1.0, fraction) * rows
        most = max(1.25 * rows / shares, min(slot_rows or HOT_ROWS, rows / 4))
        heavy = sample.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most * sampled / rows)
        found = heavy.collect()
        if not found:
            return None
        hot = tuple(sorted(row[_HASH] for row in found))
        # Finer than it needs, since another key's rows may lie elsewhere in the order.
        cuts = min(cuts, math.ceil(SLOTS_PER_TASK * cuts * max(row["n"] for row in found) / sampled))
        sample = sample.where(F.col(_HASH).isin(list(hot)))

    splits: tuple[float, ...] = ()
    if cuts > 1:
        steps = [i / cuts for i in range(1, cuts)]
        found = sample.agg(F.percentile_approx(_POSITION, steps, max(10_000, 20 * cuts))).first()[0]
        splits = tuple(sorted({p for p in found or [] if math.isfinite(p)}))
    return Slots(tuple(order), tuple(keys), hot, splits, origin, tie_low, tie_span)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Measure],
    include_current: bool = True,
    slot_rows: int | None = None,
) -> DataFrame:
    """Add running aggregates per key (or over the whole frame) along ``order``.

    ``order`` must be unique within a key for a repeatable result.
    """
    slots = plan_slots(df, keys, order, slot_rows)
    inputs = {name: f"__in_{name}" for name in measures}
    # Sums of partial sums would widen decimals: the type is that of one sum over the values.
    plain = df.select(*[_one_row(m).alias(n) for n, m in measures.items()]).schema
    rows = df.select("*", *[m.value.alias(inputs[name]) for name, m in measures.items()])

    if slots is None:
        frame = Window.partitionBy(*keys).orderBy(*order)
    else:
        hot_rows = slots.assign(rows.where(slots.is_hot()) if keys else rows)
        rows = slots.assign(rows)
        totals = hot_rows.groupBy(*keys, _SLOT).agg(
            *[m.slot_total(inputs[name], order).alias(inputs[name]) for name, m in measures.items()]
        )
        earlier = Window.partitionBy(*keys).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
        seeds = totals.select(
            *keys,
            _SLOT,
            *[m.combine(inputs[name], earlier).alias(inputs[name]) for name, m in measures.items()],
            F.lit(0).alias(_SEED),
        )
        rows = rows.withColumn(_SEED, F.lit(1)).unionByName(seeds, allowMissingColumns=True)
        frame = Window.partitionBy(*keys, _SLOT).orderBy(_SEED, *order)

    frame = frame.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    result = rows.select(
        "*",
        *[
            m.finish(m.combine(inputs[name], frame)).cast(plain[name].dataType).alias(name)
            for name, m in measures.items()
        ],
    )
    if slots is not None:
        result = result.where(F.col(_SEED) == 1)
    return result.select(*df.columns, *measures)
