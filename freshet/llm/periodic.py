"""Periodic runs: stretches of a text that repeat a block of words at least twice.

Online dyadic square catching. Words are appended in portions. For every band of periods
``[b, 2b)`` the text is cut into aligned blocks of a power of two of words; each completed block
is a *catcher* that watches the words that arrive ``b`` to ``2b - 1`` places after it for itself.
A stretch that repeats with such a period holds a whole aligned block together with its repeat, so
no square escapes. What a catcher reports is compared word by word to both sides, as far as the
words agree; a stretch that still agrees at the end of the text stays open, and each appended
portion takes its comparison on. Squares of one period that touch are one run.

Hashes of blocks only point at places: words are compared themselves. All bands together cost
n log n comparisons, made by numpy.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words a run has at least.
LEAST = 12

#: Words that are appended at once.
PORTION = 1 << 16

#: Words of texts that are searched together.
TOGETHER = 1 << 15

RUN = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


_NONE = np.zeros(0, dtype=np.uint64)


def _block(low: int, least: int) -> int:
    """The largest power of two that fits, aligned, into every stretch to be found in the band of ``low``."""
    shortest = min(max(least - p, p) for p in range(low, 2 * low)) if low < least else low
    size = 1
    while 4 * size - 1 <= shortest:
        size *= 2
    return size


class SquareCatcher:
    """The runs of a growing sequence of word numbers; none is longer than ``longest``, if that is known."""

    def __init__(self, least: int = LEAST, longest: int | None = None):
        self.least = max(2, least)
        self.longest = longest
        self.n = 0
        self.words = np.zeros(0, dtype=np.int64)
        self.hashes: dict[int, np.ndarray] = {}
        # Per band, the places that its catchers have watched.
        self.watched: dict[int, int] = {}
        # Per period the starts of runs, and (period, start) -> end; stretches that reach the end of the text.
        self.starts: dict[int, list[int]] = {}
        self.ends: dict[tuple[int, int], int] = {}
        self.open: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray) -> None:
        """Add words; everything the text so far can show is found afterwards."""
        before, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            grown = np.zeros(max(self.n, 2 * len(self.words) if before else 0), dtype=np.int64)
            grown[:before] = self.words[:before]
            self.words = grown
        self.words[before : self.n] = words
        self._go_on()
        low = 1
        while 2 * low <= (self.n if self.longest is None else min(self.n, self.longest)):
            size = _block(low, self.least)
            hashes = self._hash(size)
            for place, period in self._caught(hashes, low, size, self.watched.get(low, 0)):
                self._compare(place, period, size)
            self.watched[low] = len(hashes)
            low *= 2

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period.

        A stretch that was still too short to be a run when its catcher spoke may have grown inside
        a run of a smaller period: multiples of that are left out.
        """
        return sorted((s, e - s, p) for (p, s), e in self.ends.items() if not self._multiple(p, s, e))

    def _multiple(self, period: int, start: int, end: int) -> bool:
        for q, starts in self.starts.items():
            if q < period and period % q == 0:
                at = bisect_right(starts, start) - 1
                if at >= 0 and self.ends[q, starts[at]] >= end:
                    return True
        return False

    def _hash(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size`` words; those from earlier portions are kept."""
        kept = self.hashes.get(size, _NONE)
        at, until = len(kept), self.n - size + 1
        if at < until:
            with np.errstate(over="ignore"):
                if size == 1:
                    new = self.words[at:until].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                else:
                    half = self._hash(size // 2)
                    new = half[at:until] * np.uint64(0xD6E8FEB86659FD93 + 2 * size) + half[at + size // 2 : until + size // 2]
                    new ^= new >> np.uint64(29)
            self.hashes[size] = kept = np.concatenate([kept, new])
        return kept

    def _caught(self, hashes: np.ndarray, low: int, size: int, first: int) -> Iterator[tuple[int, int]]:
        """Pairs (place of a block, period) whose repeat begins at ``first`` or later, those inside known runs left out."""
        last = len(hashes)
        begin = max(0, first - 2 * low + 1)
        places = np.arange(-(-begin // size) * size, last - low, size)
        if not len(places):
            return
        found, periods = [], []
        whole = int(np.searchsorted(places, last - 2 * low, side="right"))
        if whole and low < 4 * (last - first):
            views = np.lib.stride_tricks.as_strided(
                hashes[places[0] + low :], (whole, low), (size * 8, 8), writeable=False
            )
            row, column = np.nonzero(views == hashes[places[:whole], None])
            found.append(places[row])
            periods.append(column + low)
        else:
            whole = 0
        for place in places[whole:].tolist():
            at = max(place + low, first)
            hit = np.flatnonzero(hashes[at : min(place + 2 * low, last)] == hashes[place])
            if len(hit):
                found.append(np.full(len(hit), place))
                periods.append(hit + (at - place))
        if not found:
            return
        place, period = np.concatenate(found), np.concatenate(periods)
        new = place + period >= first
        place, period = place[new], period[new]
        # Inside a run, a multiple of its period says nothing new.
        for q, starts in self.starts.items():
            if not len(place):
                return
            of_run = np.searchsorted(starts, place, side="right") - 1
            end = np.array([self.ends[q, s] for s in starts])[np.maximum(of_run, 0)]
            fresh = (of_run < 0) | (end < place + period + size) | (period % q != 0)
            place, period = place[fresh], period[fresh]
        order = np.lexsort((place, period))
        yield from zip(place[order].tolist(), period[order].tolist())

    def _compare(self, place: int, period: int, size: int) -> None:
        starts = self.starts.get(period)
        if starts:
            at = bisect_right(starts, place) - 1
            if at >= 0 and self.ends[period, starts[at]] >= place + period + size:
                return
        words = self.words
        if not np.array_equal(words[place : place + size], words[place + period : place + period + size]):
            return
        start = self._back(place, period)
        if (period, start) not in self.open:
            self._note(period, start, self._ahead(place + size, period))

    def _back(self, at: int, period: int) -> int:
        step = 32
        while at > 0:
            low = max(0, at - step)
            differ = np.flatnonzero(self.words[low:at] != self.words[low + period : at + period])
            if len(differ):
                return low + int(differ[-1]) + 1
            at, step = low, 4 * step
        return 0

    def _ahead(self, at: int, period: int) -> int:
        step, until = 32, self.n - period
        while at < until:
            high = min(until, at + step)
            differ = np.flatnonzero(self.words[at:high] != self.words[at + period : high + period])
            if len(differ):
                return at + int(differ[0])
            at, step = high, 4 * step
        return at

    def _note(self, period: int, start: int, agrees: int) -> None:
        """Words from ``start`` to ``agrees`` are equal to those a period later."""
        end = agrees + period
        if end == self.n:
            self.open[period, start] = agrees
        else:
            self.open.pop((period, start), None)
        if agrees - start >= period and end - start >= self.least:
            if (period, start) not in self.ends:
                insort(self.starts.setdefault(period, []), start)
            self.ends[period, start] = end

    def _go_on(self) -> None:
        for (period, start), agrees in list(self.open.items()):
            self._note(period, start, self._ahead(agrees, period))


def runs_of(texts: list[list], least: int = LEAST, portion: int = PORTION) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each list of words.

    Texts follow each other in one sequence, whose word numbers differ from text to text, so that
    no run leaves its text.
    """
    known, count = [], 0
    for words in texts:
        numbers: dict = {}
        known.append(
            np.fromiter((numbers.setdefault(w, count + len(numbers)) for w in words), dtype=np.int64, count=len(words))
        )
        count += len(numbers)
    sequence = np.concatenate([_NONE.astype(np.int64), *known])
    catcher = SquareCatcher(least, max(map(len, texts), default=0))
    for at in range(0, len(sequence), portion):
        catcher.append(sequence[at : at + portion])
    bounds = np.cumsum([0, *map(len, texts)]).tolist()
    found: list[list] = [[] for _ in texts]
    for start, length, period in catcher.runs():
        text = bisect_right(bounds, start) - 1
        found[text].append((start - bounds[text], length, period))
    return found


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    covered = np.cumsum(edges)[:-1]
    return [w for w, c in zip(words, covered.tolist()) if not c]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(key, n_words, runs, collapsed) of every document.

    ``runs`` has (start, length, period) by start, then period, in words ``[^\\x20\\x09-\\x0D]+``
    numbered from 0; a run has at least ``least`` words and two periods, and neither neighbour
    continues it. ``collapsed`` is the text, one space between words, without the words that a run
    holds after its first period. A null text has no words, empty runs and an empty text. Rows are
    independent: repeated rows and keys, also null ones, come out as often as they go in, and other
    columns of ``docs`` are not looked at. A task holds one batch of rows and the numbers of one text.
    """
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", RUN),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at = 0
            while at < len(texts):
                # Texts are searched together up to a number of words; a longer one is searched alone.
                first, held, split = at, 0, []
                while at < len(texts) and held < TOGETHER:
                    # bytes.split() cuts at just the blank and the controls 9 to 13.
                    words = (texts[at].as_py() or "").encode().split()
                    if split and len(words) >= TOGETHER // 4:
                        break
                    split.append(words)
                    held += len(words) * (4 if len(words) >= TOGETHER // 4 else 1) + 1
                    at += 1
                runs = runs_of(split, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(first, at - first),
                        pa.array([len(words) for words in split], pa.int64()),
                        pa.array([[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs], run_type),
                        pa.array([b" ".join(collapsed(*one)) for one in zip(split, runs)], pa.binary()).cast(pa.string()),
                    ],
                    ["key", "n_words", "runs", "collapsed"],
                )

    found = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(find, schema)
    return found.withColumnRenamed("key", key)


def longest_run(runs: str = "runs"):
    """The longest run (ties: smallest start, then period) as a struct; null if there is none."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(ranked)
    return F.when(F.size(runs) > 0, F.struct(best["start"].alias("start"), (-best["l"]).alias("length"), best["period"].alias("period")))


def runs_text(runs: str = "runs"):
    """Every run as ``start,length,period`` and a line feed."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(line, "")
