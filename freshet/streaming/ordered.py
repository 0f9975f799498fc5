"""Per-key state on streams in event-time order, whatever the order rows arrive in.

Rows of a key wait in a reorder buffer in its state until the watermark has passed them. No
row can come before them any more, so they are then put in order and handed to a *program*, which keeps typed
state of its own: single values, lists that are only appended to, maps of which only touched
entries are read and written. A result equals the batch operator's over the rows the watermark has passed,
however files and rows are shuffled within the delay; rows behind it are late and dropped by the engine.

The buffer of a key holds the rows of one delay. An event-time timer releases the oldest of them and lets
the program forget what has expired, also when the key stays silent. State is kept in RocksDB: start such
queries inside ``rocksdb(spark)``, as ``drained_in_order`` does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from copy import copy

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from freshet.functions.times import interval_micros, micros
from freshet.streaming.run import drained_table

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Plain names: the engine hands rows over as named tuples, which know no leading underscore.
_KEY, _EVENT_TIME, _TIME, _ROW = "key", "event_time", "time", "row"
_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

#: New rows that a task holds before it writes them, and rows handed to a program at once, where rows wait by slices.
HELD_ROWS, MADE_ROWS = 50_000, 5_000

#: Stands for a null in order columns, which come first.
_FIRST = -(1 << 63)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's setting is put back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def drained_in_order(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Drain a stream of this module into the shared folder and read the result back."""
    with rocksdb(spark):
        return drained_table(spark, df, label)


class Program:
    """What is done with the rows of a key, in order; ``inputs`` are the columns it reads.

    ``outputs`` (name -> type) are added to every row. ``process`` gets the inputs as lists and the times
    in microseconds; it gives one list per output, in which ``SKIP`` in the first drops the row.
    """

    inputs: Mapping[str, Column] = {}
    outputs: Mapping[str, str] = {}

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def start_from(self, row: Row) -> None:
        """Take over the state of a key from a row of a batch."""
        raise NotImplementedError

    def process(self, times: list[int], rows: dict[str, list]) -> list[list]:
        raise NotImplementedError

    def expire(self, watermark: int) -> None:
        """Forget what is not needed once the watermark (microseconds) is reached."""

    def expires_at(self) -> int | None:
        """Microseconds at which ``expire`` should be called next."""
        return None


SKIP = object()


class _Once:
    """A value state that is fetched once a call, and written only when it changes."""

    def __init__(self, state):
        self.state = state
        self.forget()

    def forget(self) -> None:
        self.known, self.value = False, None

    def get(self):
        if not self.known:
            self.known, self.value = True, self.state.get()
        return self.value

    def exists(self) -> bool:
        return self.get() is not None

    def update(self, value: tuple) -> None:
        if self.get() != value:
            self.state.update(value)
            self.value = value

    def clear(self) -> None:
        if self.exists():
            self.state.clear()
            self.value = None


class _Handle:
    """The engine's handle, whose value states are asked once a call: every question goes to another process."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle, self.values = handle, []

    def __getattr__(self, name):
        return getattr(self.handle, name)

    def getValueState(self, *args) -> _Once:  # noqa: N802
        self.values.append(_Once(self.handle.getValueState(*args)))
        return self.values[-1]

    def forget(self) -> None:
        for value in self.values:
            value.forget()


class _Ordered(StatefulProcessor):
    """What both forms of the reorder buffer share."""

    def __init__(self, program: Program, names: list[str], ties: int, results: list[str]):
        self.program, self.names, self.ties, self.results = program, names, ties, results

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = _Handle(handle)
        self.program.open(self.handle)
        # Keys seen in this task and micro-batch: their timers have nothing left to do.
        self.seen: set = set()

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.handle.forget()
        self.program.start_from(initialState)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802
        if tuple(key) in self.seen:
            return
        yield from self.handleInputRows(key, (), timerValues)

    def close(self) -> None:
        pass

    def _begin(self, key, timers) -> int:
        """The watermark in microseconds."""
        self.seen.add(tuple(key))
        self.handle.forget()
        return timers.getCurrentWatermarkInMs() * 1000

    def _made(self, ready: list[tuple]) -> dict[str, list]:
        """The columns that the program gives for rows whose time has come."""
        ready.sort(key=lambda r: r[: self.ties + 1])
        columns = list(zip(*ready))
        inputs = {n: list(c) for n, c in zip(self.names[self.ties + 1 : -1], columns[self.ties + 1 : -1])}
        made = self.program.process(list(columns[0]), inputs)
        frame = {_ROW: list(columns[-1])}
        frame.update(zip(self.results, made))
        if made and any(v is SKIP for v in made[0]):
            wanted = [v is not SKIP for v in made[0]]
            frame = {n: [v for v, w in zip(c, wanted) if w] for n, c in frame.items()}
        return frame

    def _wake(self, watermark: int, waiting: list[int]) -> None:
        """Forget what has expired, and call again when the next row or entry is due."""
        self.program.expire(watermark)
        soon = self.program.expires_at()
        at = min([*waiting, *([] if soon is None else [soon])], default=None)
        if at is not None:
            self.handle.registerTimer(-(-at // 1000))


class _InOrder(_Ordered):
    """Many keys of few rows: the rows of a key and micro-batch wait as one entry of a list."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "oldest bigint, packed binary")
        self.row = Row(_ROW, *self.results)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        watermark = self._begin(key, timerValues)
        new = [tuple(r[n] for n in self.names) for r in rows]
        ready = [r for r in new if r[0] <= watermark]
        kept = [r for r in new if r[0] > watermark]
        held = [tuple(e) for e in self.waiting.get()]
        closed = [e for e in held if e[0] > watermark]
        for oldest, packed in held:
            if oldest <= watermark:
                for r in pickle.loads(packed):
                    (ready if r[0] <= watermark else kept).append(r)
        entry = [(min(r[0] for r in kept), pickle.dumps(kept, 5))] if kept else []
        if len(closed) == len(held):
            # Nothing leaves: the rows of this batch alone are written.
            if entry:
                self.waiting.appendList(entry)
        elif closed or entry:
            self.waiting.put(closed + entry)
        else:
            self.waiting.clear()
        if ready:
            yield from map(self.row, *map(_plain_maps, self._made(ready).values()))
        self._wake(watermark, [e[0] for e in closed + entry])


class _InSlices(_Ordered):
    """Few keys of many rows: they wait by slices of time, of which one at a time is read.

    A task holds the rows of a slice and ``HELD_ROWS`` new ones, however many wait.
    """

    def __init__(self, program: Program, names: list[str], ties: int, results: list[str], width: int):
        super().__init__(program, names, ties, results)
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "slice bigint, part bigint", "packed binary")
        self.parts = self.handle.getValueState("parts", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        watermark = self._begin(key, timerValues)
        new: dict[int, list[tuple]] = {}
        count = 0
        for batch in rows:
            for r in zip(*(batch[c].tolist() for c in self.names)):
                new.setdefault(r[0] // self.width, []).append(r)
            count += len(batch)
            if count >= HELD_ROWS:
                self._put(new)
                new, count = {}, 0
        held: dict[int, list[int]] = {}
        for at, part in [tuple(k) for k in self.waiting.keys()]:
            held.setdefault(at, []).append(part)
        last = watermark // self.width
        ready: list[tuple] = []
        wakes = [at * self.width for at in {*held, *new} if at > last]
        for at in sorted(at for at in {*held, *new} if at <= last):
            every = new.pop(at, [])
            for part in held.get(at, []):
                every += pickle.loads(self.waiting.getValue((at, part))[0])
                self.waiting.removeKey((at, part))
            ready += [r for r in every if r[0] <= watermark]
            kept = [r for r in every if r[0] > watermark]
            if kept:
                new[at] = kept
                wakes.append(min(r[0] for r in kept))
            if len(ready) >= MADE_ROWS:
                yield from self._frames(ready)
                ready = []
        if ready:
            yield from self._frames(ready)
        if new:
            self._put(new)
        self._wake(watermark, wakes)

    def _put(self, new: dict[int, list[tuple]]) -> None:
        part = self.parts.get()[0] if self.parts.exists() else 0
        for at, rows in new.items():
            self.waiting.updateValue((at, part), (pickle.dumps(rows, 5),))
        self.parts.update((part + 1,))

    def _frames(self, ready: list[tuple]) -> Iterator[pd.DataFrame]:
        frame = self._made(ready)
        if frame[_ROW]:
            yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in frame.items()})


def _plain_maps(column: list) -> list:
    """Maps as lists of pairs, which is how Arrow takes them from rows."""
    return [list(v.items()) if isinstance(v, dict) else v for v in column]


def _sortable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(micros(df, name), F.lit(_FIRST))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(_FIRST))
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    program: Program,
    initial: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Run ``program`` over the rows of each key, in the order of ``order``, adding its outputs.

    The first order column is the event time and carries the watermark. Rows without a time come
    first in their micro-batch. ``initial`` (keys and what ``program.start_from`` reads, one row
    a key) is the state to begin with. With ``slices``, microseconds, rows wait by slices of that length and a
    task reads one at a time: for few keys of many rows.
    """
    ties = [f"tie_{i}" for i in range(len(order) - 1)]
    inputs = dict(zip([f"in_{i}" for i in range(len(program.inputs))], program.inputs.values()))
    packed = df.select(
        _key(keys),
        F.col(order[0]).alias(_EVENT_TIME),
        _sortable(df, order[0]).alias(_TIME),
        *[_sortable(df, c).alias(t) for c, t in zip(order[1:], ties)],
        *[c.alias(n) for n, c in inputs.items()],
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", **_FORMATS}).alias(_ROW),
    )
    names = [_TIME, *ties, *inputs, _ROW]
    plain = _Renamed(program, dict(zip(inputs, program.inputs)))
    results = [f"out_{i}" for i in range(len(program.outputs))]
    output = T.StructType([T.StructField(_ROW, T.StringType())])
    for name, kind in zip(results, program.outputs.values()):
        output.add(name, T.StructType.fromDDL(f"c {kind}")[0].dataType)
    known = None
    if initial is not None:
        known = initial.select(_key(keys), *[c for c in initial.columns if c not in keys]).groupBy(_KEY)
    if slices:
        sliced = _InSlices(plain, names, len(ties), results, slices)
        made = packed.groupBy(_KEY).transformWithStateInPandas(sliced, output, "append", "eventTime", known)
    else:
        processor = _InOrder(plain, names, len(ties), results)
        made = packed.groupBy(_KEY).transformWithState(processor, output, "append", "eventTime", known)
    back = F.from_json(_ROW, _plain(df.schema), _FORMATS).alias(_ROW)
    shown = [F.col(r).alias(n) for r, n in zip(results, program.outputs)]
    return made.select(back, *results).select(f"{_ROW}.*", *shown)


def _key(keys: Sequence[str]) -> Column:
    """The key columns as one text, also where some are null."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false", **_FORMATS}).alias(_KEY)


def _plain(schema: T.StructType) -> T.StructType:
    """Without the mark of the event-time column."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


class _Renamed(Program):
    """A program whose inputs came under other names."""

    def __init__(self, program: Program, names: dict[str, str]):
        self.program, self.names = copy(program), names
        # Columns live on the driver only.
        self.program.inputs = {}
        program = self.program
        self.open, self.start_from = program.open, program.start_from
        self.expire, self.expires_at = program.expire, program.expires_at

    def process(self, times, rows):
        return self.program.process(times, {self.names[n]: c for n, c in rows.items()})


class CountSoFar(Program):
    """``n``: rows of the key so far."""

    def __init__(self, name: str = "n"):
        self.outputs = {name: "bigint"}

    def open(self, handle):
        self.n = handle.getValueState("n", "n bigint")

    def start_from(self, row):
        self.n.update((int(row["n"]),))

    def process(self, times, rows):
        before = self.n.get()[0] if self.n.exists() else 0
        self.n.update((before + len(times),))
        return [list(range(before + 1, before + len(times) + 1))]


class CountPerPeriod(Program):
    """``n``: rows of the key since its count was last cleared, which happens at every multiple of ``period``.

    A period's first row, or the watermark passing its end, clears the count of the one before.
    """

    def __init__(self, df: DataFrame, period: str, name: str = "n"):
        self.outputs = {name: "bigint"}
        self.period = interval_micros(df, period)

    def open(self, handle):
        self.held = handle.getValueState("period_count", "period bigint, n bigint")

    def process(self, times, rows):
        period, n = self.held.get() if self.held.exists() else (None, 0)
        counts = []
        for at in times:
            of = at // self.period
            period, n = of, n + 1 if of == period else 1
            counts.append(n)
        self.held.update((period, n))
        return [counts]

    def _end(self):
        return (self.held.get()[0] + 1) * self.period if self.held.exists() else None

    def expire(self, watermark):
        end = self._end()
        # A row at the end itself belongs to the next period.
        if end is not None and end - 1 <= watermark:
            self.held.clear()

    def expires_at(self):
        return self._end()


class SumSoFar(Program):
    """``total``: sum of an integer column so far; null before its first value, as in a batch."""

    def __init__(self, value: str, name: str = "total"):
        self.inputs = {"number": F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint")), "known": F.col(value).isNotNull()}
        self.outputs = {name: "bigint"}

    def open(self, handle):
        self.held = handle.getValueState("total", "total bigint, known boolean")

    def process(self, times, rows):
        total, seen = self.held.get() if self.held.exists() else (0, False)
        totals = []
        for number, known in zip(rows["number"], rows["known"]):
            total, seen = total + number, seen or known
            totals.append(total if seen else None)
        self.held.update((total, bool(seen)))
        return [totals]


class History(Program):
    """``history``: all values of the key so far as text; with ``chunk`` the list is cleared at that length.

    Values are appended: a micro-batch writes its own items, however long the list is.
    """

    def __init__(self, value: str, chunk: int | None = None, name: str = "history"):
        self.inputs = {"item": F.col(value).cast("string")}
        self.outputs = {name: "array<string>"}
        self.chunk = chunk

    def open(self, handle):
        self.items = handle.getListState("items", "item string")

    def process(self, times, rows):
        held = [r[0] for r in self.items.get()]
        items = held + rows["item"]
        ends = range(len(held) + 1, len(items) + 1)
        if not self.chunk:
            self.items.appendList([(i,) for i in rows["item"]])
            return [[items[:end] for end in ends]]
        cleared = len(items) // self.chunk * self.chunk
        if cleared:
            self.items.clear()
            if cleared < len(items):
                self.items.put([(i,) for i in items[cleared:]])
        else:
            self.items.appendList([(i,) for i in rows["item"]])
        return [[items[(end - 1) // self.chunk * self.chunk : end] for end in ends]]


class RecentHistory(Program):
    """``history``: the values of the key no older than the time to live, the row's own included.

    Every value is an entry of its own that leaves the state when the watermark is a time to live
    past it, also if the key never speaks again.
    """

    def __init__(self, df: DataFrame, value: str, ttl: str, name: str = "history"):
        self.inputs = {"item": F.col(value).cast("string")}
        self.outputs = {name: "array<string>"}
        self.ttl = interval_micros(df, ttl)

    def open(self, handle):
        self.entries = handle.getMapState("entries", "time bigint, nth bigint", "item string")
        # The time of the oldest entry and the number of the next one.
        self.edge = handle.getValueState("edge", "oldest bigint, next bigint")

    def process(self, times, rows):
        held = sorted((*k, v[0]) for k, v in self.entries.iterator()) if self.edge.exists() else []
        nth = self.edge.get()[1] if self.edge.exists() else 0
        all_times = [t for t, _, _ in held] + times
        items = [i for _, _, i in held] + rows["item"]
        lists, first = [], 0
        for at, time in enumerate(times, len(held)):
            while all_times[first] < time - self.ttl:
                first += 1
            lists.append(items[first : at + 1])
        for time, number, _ in held[:first]:
            self.entries.removeKey((time, number))
        for at in range(max(first, len(held)), len(items)):
            self.entries.updateValue((all_times[at], nth + at - len(held)), (items[at],))
        self.edge.update((all_times[first], nth + len(times)))
        return [lists]

    def expire(self, watermark):
        if not self.edge.exists() or self.edge.get()[0] + self.ttl > watermark:
            return
        # A row still to come is later than the watermark, so entries older by the time to live are done.
        left = None
        for time, number in sorted(tuple(k) for k in self.entries.keys()):
            if time + self.ttl <= watermark:
                self.entries.removeKey((time, number))
            else:
                left = time
                break
        if left is None:
            self.entries.clear()
            self.edge.clear()
        else:
            self.edge.update((left, self.edge.get()[1]))

    def expires_at(self):
        return self.edge.get()[0] + self.ttl if self.edge.exists() else None


class CategoryCount(Program):
    """``n``: rows of the key so far with the row's own category; null for a null category.

    Each category is an entry of its own: only those of the rows at hand are read and written.
    """

    def __init__(self, category: str, name: str = "n"):
        self.inputs = {"category": F.col(category).cast("string")}
        self.outputs = {name: "bigint"}

    def open(self, handle):
        self.counts = handle.getMapState("counts", "category string", "n bigint")

    def process(self, times, rows):
        known: dict = {}
        shown = []
        for category in rows["category"]:
            if category is None:
                shown.append(None)
                continue
            if category not in known:
                key = (category,)
                known[category] = (self.counts.getValue(key) or (0,))[0]
            known[category] += 1
            shown.append(known[category])
        for category, n in known.items():
            self.counts.updateValue((category,), (n,))
        return [shown]


class CountMap(CategoryCount):
    """``counts``: the counts of all categories so far, as a map; null is no category.

    Reads the whole map, since every row shows it; writes the entries that change.
    """

    def __init__(self, category: str, name: str = "counts"):
        super().__init__(category)
        self.outputs = {name: "map<string,bigint>"}

    def process(self, times, rows):
        known = {k[0]: v[0] for k, v in self.counts.iterator()}
        touched, shown = set(), []
        for category in rows["category"]:
            if category is not None:
                known[category] = known.get(category, 0) + 1
                touched.add(category)
            shown.append(dict(known))
        for category in touched:
            self.counts.updateValue((category,), (known[category],))
        return [shown]


class Threshold(Program):
    """Rows whose value exceeds the control value in force; control rows change it and are not shown."""

    def __init__(self, value: str, control: str, is_control: str, default: int = 0, name: str = "threshold"):
        self.inputs = {
            "value": F.coalesce(F.col(value).cast("double"), F.lit(float("-inf"))),
            "is_control": F.col(is_control),
            "change": F.coalesce(F.col(control).cast("bigint"), F.lit(0).cast("bigint")),
        }
        self.outputs = {name: "bigint"}
        self.default = default

    def open(self, handle):
        self.now = handle.getValueState("now", "threshold bigint")

    def process(self, times, rows):
        now = before = self.now.get()[0] if self.now.exists() else self.default
        shown = []
        for value, control, change in zip(rows["value"], rows["is_control"], rows["change"]):
            if control:
                now = change
            shown.append(now if not control and value > now else SKIP)
        if now != before:
            self.now.update((now,))
        return [shown]


CONTROL_COPIES = 64
"""Groups that a stream compared with a control stream is dealt into; each holds the control value once."""


def controlled(
    df: DataFrame,
    control: DataFrame,
    ts: str,
    row_id: str,
    value: str,
    setting: str,
    control_id: str,
    delay: str,
    copies: int = CONTROL_COPIES,
) -> DataFrame:
    """Rows of a stream whose ``value`` exceeds the control value in force at their time (0 before the first).

    Control rows (``ts``, ``control_id``, ``setting``) come on a stream too. Each goes to all of a fixed number of
    groups, a data row to one, so neither stream is read again and no task holds the other's history.
    A change at a row's own time comes before it; of several at one time the last by id counts; a
    null setting changes nothing. Returns the rows in their own columns with the value in force.
    """
    group = F.pmod(F.xxhash64(row_id), F.lit(copies)).cast("int")
    rows = df.select(
        F.col(ts).alias("__ts"), group.alias("__group"), F.lit(1).alias("__rank"), F.col(row_id).cast("bigint").alias("__id"),
        F.lit(False).alias("__control"), F.col(value).cast("double").alias("__value"), F.lit(None).cast("bigint").alias("__setting"),
        F.struct(*df.columns).alias("__data"),
    )
    kind = rows.schema["__data"].dataType
    changes = control.where(F.col(setting).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(ts).alias("__ts"), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__group"), F.lit(0).alias("__rank"),
        F.col(control_id).cast("bigint").alias("__id"), F.lit(True).alias("__control"), F.lit(None).cast("double").alias("__value"),
        F.col(setting).cast("bigint").alias("__setting"), F.lit(None).cast(_plain(kind)).alias("__data"),
    )
    both = rows.unionByName(changes).withWatermark("__ts", delay)
    program = Threshold("__value", "__setting", "__control")
    # A group has every control row, so it is read in slices.
    slices = max(1, interval_micros(df, delay) // 8)
    found = in_order(both, ["__group"], ["__ts", "__rank", "__id"], program, slices=slices)
    return found.select("__data.*", F.col("threshold"))


def state_rows(spark: SparkSession, checkpoint: str, variable: str, keys: str) -> DataFrame:
    """What a query's checkpoint holds in one state variable: the key columns, then those of the variable.

    ``keys`` is the DDL of the key columns. Lists and maps give a row an entry. The query must not be running.
    """
    read = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    found = F.from_json("key.key", keys, _FORMATS).alias("__keys")
    parts = [c for c in ("user_map_key", "value", "list_element", "user_map_value") if c in read.columns]
    return read.select(found, *parts).select("__keys.*", *[f"{c}.*" for c in parts])


def state_variables(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operators of a checkpoint: id, name, partitions, first and last batch and their state variables."""
    return spark.read.format("state-metadata").load(checkpoint)
