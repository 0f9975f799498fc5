"""Per-key state on streams.

Rows of a micro-batch reach a key's function unordered and are put in
``order`` there; across micro-batches the stream is taken as it comes. A result
equals the batch operator's when files arrive in time order. State lives in the
checkpoint, per key, and what one call sees is bounded by the size of a
micro-batch (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``). For counts of
keys too hot even for that, see ``streaming.batches``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from freshet.functions.times import interval, interval_micros

_EXPIRES = "__expires"

Step = Callable[[tuple, pd.DataFrame], tuple[pd.DataFrame, tuple]]


def _schema(df: DataFrame, extra: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(extra).fields])


def keyed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    initial: tuple,
    state: str,
    output: T.StructType,
    expires: Column | None = None,
) -> DataFrame:
    """Apply ``step(state, rows) -> (output, state)`` per key and micro-batch.

    ``expires`` gives, per row, the event time until which the key's state is
    needed. Once the watermark is past it the state is dropped; the stream then
    needs a watermark.
    """
    order = list(order)
    names = [f.name for f in output]
    timeout = GroupStateTimeout.NoTimeout
    evicts = expires is not None
    if evicts:
        df = df.withColumn(_EXPIRES, F.unix_millis(expires))
        timeout = GroupStateTimeout.EventTimeTimeout

    def update(_key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        rows = pd.concat(list(batches), ignore_index=True).sort_values(order, ignore_index=True)
        result, new = step(held.get if held.exists else initial, rows)
        held.update(new)
        if evicts:
            held.setTimeoutTimestamp(int(rows[_EXPIRES].max()) + 1)
        yield result[names]

    return df.groupBy(*keys).applyInPandasWithState(update, output, state, "append", timeout)


def count_so_far(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """Rows of the key so far, after every row."""

    def step(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
        rows[name] = state[0] + np.arange(1, len(rows) + 1)
        return rows, (state[0] + len(rows),)

    return keyed(df, keys, order, step, (0,), "n bigint", _schema(df, f"{name} bigint"))


def reduce_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "total"
) -> DataFrame:
    """Sum of an integer column so far, after every row; a null adds nothing, and before the
    first value the sum is null, as in a batch."""
    number = F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint"))
    marked = df.withColumns({"__number": number, "__known": F.col(value).isNotNull()})

    def step(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
        sums = state[0] + rows["__number"].to_numpy(dtype=np.int64).cumsum()
        seen = state[1] | np.logical_or.accumulate(rows["__known"].to_numpy(dtype=bool))
        rows[name] = pd.Series(sums, dtype="Int64").mask(~seen)
        return rows, (int(sums[-1]), bool(seen[-1]))

    output = _schema(df, f"{name} bigint")
    return keyed(marked, keys, order, step, (0, False), "total bigint, seen boolean", output)


def count_map(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], category: str, name: str = "counts"
) -> DataFrame:
    """Counts per category so far, as a map, after every row. Null is no category and has no entry."""

    def step(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
        known = dict(zip(state[0], state[1]))
        codes, found = pd.factorize(rows[category], use_na_sentinel=True)
        labels = sorted({*known, *found})
        place = np.array([labels.index(v) for v in found], dtype=np.int64)
        # One column per category, running down the rows.
        counts = np.zeros((len(rows), len(labels)), dtype=np.int64)
        hit = np.flatnonzero(codes >= 0)
        counts[hit, place[codes[hit]]] = 1
        counts = counts.cumsum(axis=0) + np.array([known.get(v, 0) for v in labels], dtype=np.int64)
        names = np.array(labels, dtype=object)
        shown = counts > 0
        rows["labels"] = [names[s].tolist() for s in shown]
        rows["numbers"] = [c[s] for c, s in zip(counts, shown)]
        return rows, (labels, counts[-1].tolist())

    raw = keyed(
        df.withColumn(category, F.col(category).cast("string")),
        keys,
        order,
        step,
        ([], []),
        "labels array<string>, numbers array<bigint>",
        _schema(df.withColumn(category, F.col(category).cast("string")), "labels array<string>, numbers array<bigint>"),
    )
    return raw.select(*df.columns, F.map_from_arrays("labels", "numbers").alias(name))


def _texts(df: DataFrame, value: str) -> DataFrame:
    """The values as text, made by Spark: a null among integers does not turn them into floats."""
    return df.withColumn("__item", F.col(value).cast("string"))


def history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    chunk: int | None = None,
    name: str = "history",
) -> DataFrame:
    """Values of the key so far as text, null for null; with ``chunk`` the list is cleared at that length.

    Without ``chunk`` the state grows with the key, so bound it where keys live long.
    """

    def step(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
        items = [*state[0], *[None if pd.isna(v) else v for v in rows["__item"]]]
        held = len(state[0])
        ends = np.arange(held + 1, len(items) + 1)
        starts = (ends - 1) // chunk * chunk if chunk else np.zeros(len(ends), dtype=np.int64)
        rows[name] = [items[a:b] for a, b in zip(starts, ends)]
        keep = len(items) // chunk * chunk if chunk else 0
        return rows, (items[keep:],)

    output = _schema(df, f"{name} array<string>")
    return keyed(_texts(df, value), keys, order, step, ([],), "items array<string>", output)


def recent_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    ttl: str,
    name: str = "history",
    evict: bool = False,
) -> DataFrame:
    """Values of the key no older than the time to live, null for null; older ones leave the state.

    With ``evict`` (on a watermarked stream) a key that stays silent for that
    long is forgotten altogether.
    """
    ts, ttl_micros = order[0], interval_micros(df, ttl)

    def step(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
        now = rows[ts].astype("datetime64[us]").astype("int64").to_numpy()
        times = np.concatenate([np.array(state[0], dtype=np.int64), now])
        items = [*state[1], *[None if pd.isna(v) else v for v in rows["__item"]]]
        ends = np.arange(len(items) - len(rows) + 1, len(items) + 1)
        # A value that has expired once does not come back, also if a later file is out of order.
        alive = np.maximum.accumulate(now) - ttl_micros
        starts = np.minimum(np.searchsorted(times, alive, side="left"), ends - 1)
        rows[name] = [items[a:b] for a, b in zip(starts, ends)]
        return rows, (times[starts[-1] :].tolist(), items[starts[-1] :])

    return keyed(
        _texts(df, value),
        keys,
        order,
        step,
        ([], []),
        "times array<bigint>, items array<string>",
        _schema(df, f"{name} array<string>"),
        F.col(ts) + interval(ttl) if evict else None,
    )


def count_trigger(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    every: int,
    purge: bool = False,
    window_end: str | None = None,
) -> DataFrame:
    """Fire on every ``every``-th row of a key.

    A window is a key too: name its end, on a watermarked stream, to drop the
    state of closed windows.
    """
    keys = list(keys)

    def step(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
        seen = state[0] + np.arange(1, len(rows) + 1)
        fired = rows[keys].assign(firing=seen // every, n=every if purge else seen)
        return fired[seen % every == 0], (state[0] + len(rows),)

    output = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL("firing bigint, n bigint").fields])
    expires = F.col(window_end) if window_end else None
    return keyed(df, keys, order, step, (0,), "seen bigint", output, expires)
