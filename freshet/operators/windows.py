"""Event-time windows and aggregates over them.

Window counts are partial aggregates: every map task combines its rows before
the shuffle, so a hot window or type costs one small row per task.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import interval, interval_micros
from freshet.plans.ordering import count_if as running_count
from freshet.plans.ordering import highest, running
from freshet.plans.scratch import materialize

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

MERGE_PARTS = 256
"""Groups in which the partial states of one key are merged first."""

CELL_LIMIT = 1_000_000
"""Cells per key that one task may order."""


def count(condition: Column | None = None) -> Column:
    """Number of rows, or of rows that satisfy a condition."""
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _bounds(df: DataFrame) -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def tumbling(
    df: DataFrame, ts: str, size: str, aggs: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregates per fixed window (and key). Works on batches and streams."""
    grouped = df.groupBy(*keys, F.window(ts, size)).agg(*[c.alias(n) for n, c in aggs.items()])
    return grouped.select(*keys, *_bounds(grouped), *aggs)


@dataclass(frozen=True)
class Merged:
    """An aggregate whose partial results the same or another aggregate merges: ``Merged(F.max("v"), F.max)``."""

    of_rows: Column
    of_parts: Callable[[str], Column]


def sum_of(value: str | Column) -> Merged:
    return Merged(F.sum(value), F.sum)


def min_of(value: str | Column) -> Merged:
    return Merged(F.min(value), F.min)


def max_of(value: str | Column) -> Merged:
    return Merged(F.max(value), F.max)


def merged(measure: Column | Merged | None) -> Merged:
    return measure if isinstance(measure, Merged) else Merged(count(measure), F.sum)


def sliding(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    counts: Mapping[str, Column | Merged | None],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Row counts (each with an optional condition) and other mergeable aggregates per overlapping window.

    A batch is first counted per pane of one slide and the few panes are then
    expanded to their windows, instead of copying every row to every window.
    """
    measures = {name: merged(measure) for name, measure in counts.items()}
    aggs = {name: measure.of_rows for name, measure in measures.items()}
    whole = interval_micros(df, size) % interval_micros(df, slide) == 0
    if df.isStreaming or not whole:
        grouped = df.groupBy(*keys, F.window(ts, size, slide)).agg(*[c.alias(n) for n, c in aggs.items()])
        return grouped.select(*keys, *_bounds(grouped), *aggs)
    panes = tumbling(df, ts, slide, aggs, keys)
    steps = interval_micros(df, size) // interval_micros(df, slide)
    back = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("back")
    placed = panes.select(*keys, "window_start", *aggs, back)
    start = F.col("window_start") - interval(slide) * F.col("back")
    return (
        placed.groupBy(*keys, start.alias("window_start"))
        .agg(*[measure.of_parts(name).alias(name) for name, measure in measures.items()])
        .select(*keys, "window_start", (F.col("window_start") + interval(size)).alias("window_end"), *aggs)
    )


def sessions(
    df: DataFrame, ts: str, gap: str, counts: Mapping[str, Column | Merged | None], keys: Sequence[str] = ()
) -> DataFrame:
    """Row counts and other mergeable aggregates per session: a run of events no more than ``gap`` apart.

    Rows within one cell of length ``gap`` always share a session, so rows are
    first combined to cells map-side; only cells are then put in order. A key,
    however hot, has at most (time span / gap) cells.
    """
    measures = {name: merged(measure) for name, measure in counts.items()}
    cells = df.groupBy(*keys, F.window(ts, gap).alias("cell")).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        *[measure.of_rows.alias(name) for name, measure in measures.items()],
    )
    cells = cells.where(F.col("cell").isNotNull()).drop("cell")
    span = df.agg(F.min(ts).alias("low"), F.max(ts).alias("high")).select(
        (F.col("high") - F.col("low")).cast("interval second").cast("decimal(20,6)").alias("seconds")
    )
    seconds = span.first()["seconds"] or 0
    begins = F.col("previous").isNull() | (F.col("first_ts") - interval(gap) > F.col("previous"))
    start = F.when(begins, F.col("first_ts"))
    if float(seconds) * 1e6 / interval_micros(df, gap) <= CELL_LIMIT:
        ordered = Window.partitionBy(*keys).orderBy("first_ts")
        marked = cells.withColumn("previous", F.lag("last_ts").over(ordered)).withColumn(
            "session_start", F.max(start).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        )
    else:
        cells = materialize(cells, "session-cells")
        marked = running(cells, keys, ["first_ts"], {"previous": highest(F.col("last_ts"))}, include_current=False)
        marked = materialize(marked, "session-cells")
        marked = running(marked, keys, ["first_ts"], {"session_start": highest(start)})
    return (
        marked.groupBy(*keys, "session_start")
        .agg((F.max("last_ts") + interval(gap)).alias("session_end"), *[m.of_parts(n).alias(n) for n, m in measures.items()])
        .select(*keys, "session_start", "session_end", *counts)
    )


def busiest(windows: DataFrame, n: str = "n", start: str = "window_start") -> DataFrame:
    """The window with the largest count; the earliest wins a tie."""
    return windows.orderBy(F.col(n).desc(), F.col(start)).limit(1)


def with_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Add the bounds of the fixed window each row falls in."""
    return df.select("*", F.window(ts, size).alias("window")).select(
        "*", *_bounds(df)
    ).drop("window")


def apply_in_order(
    df: DataFrame,
    ts: str,
    size: str,
    function: Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    output: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Call ``function(key, batches)`` with all rows of each fixed window (and key), in order.

    ``key`` holds the values of ``keys``, window_start and window_end as Arrow scalars. The rows come as an iterator
    of Arrow batches with the columns of ``df`` and those two, sorted by ``order`` (nulls first), so a window need not fit
    in memory, though one task reads all of it: prefer aggregates where the order plays no part. Rows
    without a time are in no window. One shuffle and one sort, which spills.
    """
    group = [*keys, "window_start", "window_end"]
    windowed = with_window(df, ts, size)
    # Sorted by the group first, so that grouping keeps the order.
    dealt = windowed.repartition(*group).sortWithinPartitions(*group, *order)

    names = T.StructType.fromDDL(output).names

    # One call a partition: its batches are cut where the group changes, which costs less than a batch a group.
    def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[pa.RecordBatch] = []
        for _, parts in groupby(_cut_by(group, batches), key=itemgetter(0)):
            first = next(parts)[1]
            key = tuple(first.column(first.schema.get_field_index(c))[0] for c in group)
            for out in function(key, chain([first], map(itemgetter(1), parts))):
                out = out.select(names)
                if made and (len(made) >= MADE_BATCHES or out.num_rows >= MADE_BATCHES or out.schema != made[0].schema):
                    yield _joined(made)
                    made = []
                made.append(out)
        if made:
            yield _joined(made)

    return dealt.mapInArrow(in_groups, output)


MADE_BATCHES = 5_000
"""Small results that are sent back as one batch; one of that many rows goes alone."""


def _joined(made: list[pa.RecordBatch]) -> pa.RecordBatch:
    return made[0] if len(made) == 1 else pa.concat_batches(made)


def _cut_by(group: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches sorted by ``group``, cut where it changes, with a number that is the same for all parts of a group."""
    number, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(c)) for c in group]
        ends = [pa.concat_arrays([before, column.slice(0, 1)]) for before, column in zip(last, columns)] if last else []
        if ends and _changes(ends)[0]:
            number += 1
        starts = [0, *(np.flatnonzero(_changes(columns)) + 1).tolist()]
        for at, end in zip(starts, [*starts[1:], batch.num_rows]):
            if at:
                number += 1
            yield number, batch.slice(at, end - at)
        last = [column.slice(batch.num_rows - 1) for column in columns]


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Whether each row but the first differs from the one before; nulls are alike, as are NaNs."""
    changed = np.zeros(len(columns[0]) - 1, dtype=bool)
    for column in columns:
        if pa.types.is_nested(column.type):
            values = column.to_pylist()
            changed |= np.array([a != b for a, b in zip(values, values[1:])], dtype=bool)
            continue
        one, two = column.slice(0, len(column) - 1), column.slice(1)
        alike = pc.fill_null(pc.equal(one, two), False)
        alike = pc.or_(alike, pc.and_(pc.is_null(one, nan_is_null=True), pc.is_null(two, nan_is_null=True)))
        if pa.types.is_floating(column.type):
            # A NaN is no null.
            alike = pc.and_(alike, pc.equal(pc.is_valid(one), pc.is_valid(two)))
        changed |= ~alike.to_numpy(zero_copy_only=False)
    return changed


def median_gap(ts: str, names: Sequence[str]) -> Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``apply_in_order``: the key under ``names``, n rows and the median seconds between one row and the next (null for one row).

    Keeps eight bytes a row.
    """

    def gaps(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, last = [np.empty(0, dtype=np.int64)], None
        n = 0
        for batch in batches:
            times = pc.cast(batch.column(batch.schema.get_field_index(ts)), pa.timestamp("us")).cast(pa.int64()).to_numpy()
            parts.append(np.diff(times) if last is None else np.diff(times, prepend=last))
            last, n = times[-1] if len(times) else last, n + len(times)
        found = np.concatenate(parts)
        middle = float(np.median(found)) / 1e6 if len(found) else None
        columns = [*(pa.array([k.as_py()], k.type) for k in key), pa.array([n], pa.int64()), pa.array([middle], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, [*names, "n", "median_gap"])

    return gaps


def count_trigger(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    every: int,
    counts: Mapping[str, Column] | None = None,
    purge: bool = False,
    slot_rows: int | None = None,
) -> DataFrame:
    """Fire after every ``every``-th row of a group, in order.

    ``keys`` are the group columns (a window, a key, both, or nothing for one
    global window). Each firing reports ``n`` rows and the optional conditional
    counts: of the whole group so far or, with ``purge``, of the rows since the
    last firing. The remainder after the last firing is not reported.
    """
    extra = dict(counts or {})
    narrow = df.select(*keys, *order, *[c.alias(f"__c_{name}") for name, c in extra.items()])
    measures = {"seen": running_count()}
    measures.update({name: running_count(F.col(f"__c_{name}")) for name in extra})
    numbered = running(narrow, keys, order, measures, slot_rows=slot_rows)
    if purge and extra:
        block = F.floor((F.col("seen") - 1) / F.lit(every)).cast("bigint") + 1
        return (
            numbered.groupBy(*keys, block.alias("firing"))
            .agg(F.count(F.lit(1)).alias("n"), *[count(F.col(f"__c_{name}")).alias(name) for name in extra])
            .where(F.col("n") == every)
        )
    fired = numbered.where(F.col("seen") % every == 0)
    firing = (F.col("seen") / F.lit(every)).cast("bigint").alias("firing")
    n = F.lit(every).cast("bigint") if purge else F.col("seen")
    return fired.select(*keys, firing, n.alias("n"), *extra)


def late_rows(
    df: DataFrame, ts: str, arrival: Sequence[str], delay: str, slot_rows: int | None = None
) -> DataFrame:
    """Rows that arrive more than ``delay`` behind the newest event seen before them.

    The exact, per-row audit of what a bounded-disorder watermark calls late.
    """
    seen = running(df, [], arrival, {"newest": highest(F.col(ts))}, include_current=False, slot_rows=slot_rows)
    return seen.where(F.col(ts) < F.col("newest") - interval(delay))


def accumulate(
    df: DataFrame,
    keys: Sequence[str],
    add: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    result: Callable[[Any], Any],
    result_type: str,
    name: str = "result",
    open_keys: int = 10_000,
) -> DataFrame:
    """Aggregate with a Python accumulator that has add, merge and result steps.

    For aggregates no column expression can give. ``add(None, rows)`` starts an
    accumulator. Each task folds its own rows first and keeps at most
    ``open_keys`` accumulators, so what is shuffled for a hot key is a few
    accumulators per task, never its rows.
    """
    keys = list(keys)
    # Keys travel as text made by Spark and are read back from it: pandas would turn integers
    # beside a null into floats.
    key_type = T.StructType([df.schema[k] for k in keys])
    written = F.to_json(F.struct(*keys), {"ignoreNullFields": "false", "timestampFormat": _MICROS, "timestampNTZFormat": _MICROS[:-3]})
    partial = T.StructType.fromDDL("__key string, part long, state binary")
    final = T.StructType([T.StructField("__key", T.StringType()), *T.StructType.fromDDL(f"`{name}` {result_type}")])

    def flush(states: dict) -> pd.DataFrame:
        part = TaskContext.get().partitionId() % MERGE_PARTS
        rows = [(key, part, pickle.dumps(state)) for key, state in states.items()]
        return pd.DataFrame(rows, columns=["__key", "part", "state"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        for batch in batches:
            for key, rows in batch.groupby("__key", sort=False):
                states[key] = add(states.get(key), rows.drop(columns="__key"))
            if len(states) > open_keys:
                yield flush(states)
                states = {}
        if states:
            yield flush(states)

    def whole(group: pd.DataFrame) -> Any:
        return reduce(merge, map(pickle.loads, group["state"]))

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        return group.head(1).assign(state=[pickle.dumps(whole(group))])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        return group[["__key"]].head(1).assign(**{name: [result(whole(group))]})

    folded = df.withColumn("__key", written).mapInPandas(fold, partial)
    # Two steps, so that the many partial states of a hot key do not meet in one task.
    combined = folded.groupBy("__key", "part").applyInPandas(combine, partial)
    finished = combined.groupBy("__key").applyInPandas(finish, final)
    read = F.from_json("__key", key_type, {"timestampFormat": _MICROS, "timestampNTZFormat": _MICROS[:-3]})
    return finished.select(read.alias("__key"), name).select(*[F.col("__key")[k].alias(k) for k in keys], name)
