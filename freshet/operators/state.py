"""Per-key state along an order, as batch jobs. Rows of a key are ordered by ``order``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.times import interval_micros
from freshet.plans.ordering import COLD, collected, count_if, plan_slots, running, total


def reduce_final(df: DataFrame, keys: Sequence[str], value: str, name: str = "total") -> DataFrame:
    """Sum per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def reduce_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "total",
    slot_rows: int | None = None,
) -> DataFrame:
    """Sum per key so far, after every row."""
    return running(df, keys, order, {name: total(F.col(value))}, slot_rows=slot_rows)


def count_so_far(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    condition: Column | None = None,
    name: str = "n",
    slot_rows: int | None = None,
) -> DataFrame:
    """Rows per key so far, after every row (of those that satisfy ``condition``)."""
    rows = df if condition is None else df.where(condition)
    return running(rows, keys, order, {name: count_if()}, slot_rows=slot_rows)


WIDE = 64
"""Categories that are counted side by side in one pass; with more, each is a group of its own."""


def count_map(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    category: str,
    name: str = "counts",
    slot_rows: int | None = None,
    wide: int = WIDE,
) -> DataFrame:
    """Counts per category so far as a map, sorted by category; one not seen yet is absent.

    Every value of the column is counted; null is no category and has no entry. ``order`` must
    be unique within a key. ``wide`` decides the plan only, not the result.
    """
    found = df.where(F.col(category).isNotNull()).select(category).distinct().limit(wide + 1).collect()
    if len(found) > wide:
        return _count_map_long(df, keys, order, category, name, slot_rows)
    names = {row[0]: f"__n_{i}" for i, row in enumerate(sorted(found))}
    counted = running(
        df, keys, order, {n: count_if(F.col(category) == c) for c, n in names.items()}, slot_rows=slot_rows
    )
    kind = f"array<struct<key:{df.schema[category].dataType.simpleString()},value:bigint>>"
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(n).alias("value")) for c, n in names.items()]).cast(kind)
    seen = F.filter(entries, lambda entry: entry["value"] > 0)
    return counted.withColumn(name, F.map_from_entries(seen)).select(*df.columns, name)


def _count_map_long(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], category: str, name: str, slot_rows: int | None
) -> DataFrame:
    """One row per row and category of its key, counted per (key, category), then gathered again."""
    known = df.where(F.col(category).isNotNull()).groupBy(*keys, F.col(category).alias("__category")).agg(
        F.count(F.lit(1)).alias("__all")
    )
    row = F.struct(*df.columns).alias("__row")
    rows = df.select(*keys, *order, row).join(known.drop("__all").withColumnsRenamed({k: f"__{k}" for k in keys}), _same(keys), "left")
    hit = F.col("__row")[category].eqNullSafe(F.col("__category")) & F.col("__category").isNotNull()
    counted = running(rows.drop(*[f"__{k}" for k in keys]), [*keys, "__category"], order, {"__n": count_if(hit)}, slot_rows=slot_rows)
    entry = F.when(F.col("__n") > 0, F.struct(F.col("__category").alias("key"), F.col("__n").alias("value")))
    gathered = counted.groupBy(*keys, *order).agg(
        F.first("__row").alias("__row"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name)
    )
    return gathered.select("__row.*", name)


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return same


def count_map_text(name: str = "counts") -> Column:
    """A count map as ``category=n, ...``, sorted by category."""
    entries = F.array_sort(F.map_entries(F.col(name)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", "
    )


def history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "history",
    slot_rows: int | None = None,
) -> DataFrame:
    """All values of the key so far, on every row.

    The output grows with the square of a key's rows, as the operator asks. A
    hot key's rows are still spread over slots; a task holds its slot and one
    list of the length its output rows have anyway. Prefer ``chunked_history``
    or ``recent_history`` where keys are long-lived.
    """
    return running(df, keys, order, {name: collected(value)}, slot_rows=slot_rows)


def chunked_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    chunk: int,
    name: str = "history",
    slot_rows: int | None = None,
) -> DataFrame:
    """Values since the list was last cleared; it is cleared when it reaches ``chunk``.

    The row that fills the list still reports all ``chunk`` values; nulls are values. A group of
    the second step has at most ``chunk`` rows.
    """
    numbered = running(df, keys, order, {"__seen": count_if()}, slot_rows=slot_rows)
    numbered = numbered.withColumn("__chunk", F.floor((F.col("__seen") - 1) / F.lit(chunk)))
    so_far = Window.partitionBy(*keys, "__chunk").orderBy("__seen").rowsBetween(Window.unboundedPreceding, 0)
    return numbered.withColumn(name, F.flatten(F.collect_list(F.array(value)).over(so_far))).drop("__seen", "__chunk")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def recent_history(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    value: Column,
    ttl: str,
    name: str = "history",
    slot_rows: int | None = None,
) -> DataFrame:
    """Values of the key no older than ``ttl`` at each row, the row included.

    Rows of a hot key are cut into slots, and each is also copied to the later
    slots whose rows can still see it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ts, names = _quoted(order[0]), ", ".join(map(_quoted, keys))
    slots = plan_slots(df, keys, order, slot_rows)
    rows = df.withColumn("__entry", F.struct(*order, value.alias("item")))
    if slots is None:
        placed = rows.withColumn("__at", F.lit(COLD)).withColumn("__home", F.lit(COLD))
        group = names
    else:
        rows = slots.assign(rows, "__home")
        rows = slots.assign(rows, "__last", shift=interval_micros(df, ttl), last_of_tie=True)
        placed = rows.withColumn("__at", F.explode(F.sequence("__home", "__last"))).drop("__last")
        group = f"{names}, __at"
    window = (
        f"collect_list(__entry) OVER (PARTITION BY {group} ORDER BY {ts} "
        f"RANGE BETWEEN INTERVAL '{ttl}' PRECEDING AND CURRENT ROW)"
    )
    listed = placed.withColumn("__entries", F.expr(window)).where(F.col("__at") == F.col("__home"))
    # A range frame holds all rows of the current time, in any order: put them in
    # order and, where this row is not the last of them, leave out the later ones.
    listed = listed.withColumn("__entries", F.sort_array("__entries"))
    entries = F.col("__entries")
    this = F.struct(*order)

    def moment(entry: Column) -> Column:
        return F.struct(*[entry[c].alias(c) for c in order])

    kept = F.when(moment(F.element_at(entries, -1)) == this, entries).otherwise(
        F.filter(entries, lambda entry: moment(entry) <= this)
    )
    return listed.withColumn(name, kept["item"]).select(*df.columns, name)
