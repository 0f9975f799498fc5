"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-case words and their first 4, 5 and 6 letters, hashed to
2^20 places; the letters let a word count that was never seen, if it begins like one
that was. The machine scores

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

over the terms present, so that pairs (an insult with the mention of a group) weigh what
their words alone do not. It is fitted on a bounded sample of labelled rows, over the
terms that the sample shows to go with either label; every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from freshet.llm.base import saved

PLACES = 1 << 20
PREFIXES = (4, 5, 6)
#: Bounds of the training sample: rows labelled 1 and rows labelled 0.
POSITIVE, NEGATIVE = 5_000, 10_000
#: Terms the machine knows, the fewest sample rows a term occurs in, and factors per term.
TERMS, FEWEST, FACTORS = 4_096, 4, 8
#: Log-likelihood a term's split over the labels must gain; below it most gains are chance.
GAIN = 6.0
EPOCHS, BATCH, RATE, DECAY = 30, 512, 0.02, 2e-4
SEED = 5
#: Distinct words a task remembers.
REMEMBERED = 500_000
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels must not be learnt from; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def terms_of(word: str) -> list[int]:
    """The places of one lower-case word."""
    whole = [xxhash.xxh32_intdigest(word) % PLACES]
    return whole + [xxhash.xxh32_intdigest(f"{word[:n]}*") % PLACES for n in PREFIXES if len(word) >= n]


def text_terms(text: str | None) -> list[int]:
    places: set[int] = set()
    for word in set(WORD.findall((text or "").lower())):
        places.update(terms_of(word))
    return sorted(places)


@F.pandas_udf(ArrayType(IntegerType()))
def _terms(texts: pd.Series) -> pd.Series:
    return texts.map(text_terms)


@dataclass
class Machine:
    """A fitted machine: ``place`` (sorted) are the hashed terms of ``weight`` and ``factor``."""

    place: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of rows of term numbers laid end to end; ``starts`` has one more entry than rows."""
        linear = _row_sums(self.weight[flat], starts)
        v = self.factor[flat]
        pairs = _row_sums(v, starts) ** 2 - _row_sums(v * v, starts)
        return self.bias + linear + 0.5 * pairs.sum(axis=1)


def _row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[np.ndarray], labels: np.ndarray, place: np.ndarray) -> Machine:
    """Adam over mini-batches of rows of term numbers."""
    rng = np.random.default_rng(SEED)
    machine = Machine(place, 0.0, np.zeros(len(place)), rng.normal(0, 0.03, (len(place), FACTORS)))
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    machine.bias = float(np.log(share / (1 - share)))
    if not len(labels) or not len(place):
        return machine
    table = np.concatenate([machine.weight[:, None], machine.factor], axis=1)
    first, second, turn = np.zeros_like(table), np.zeros_like(table), 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            flat = np.concatenate([rows[i] for i in chosen])
            sizes = np.array([len(rows[i]) for i in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)])
            machine.weight, machine.factor = table[:, 0], table[:, 1:]
            error = (_sigmoid(machine.logits(flat, starts)) - labels[chosen]) / len(chosen)
            each = np.repeat(error, sizes)
            v = table[flat, 1:]
            sums = np.repeat(_row_sums(v, starts), sizes, axis=0)
            gradient = np.empty_like(table)
            gradient[:, 0] = np.bincount(flat, each, len(place))
            for k in range(FACTORS):
                gradient[:, k + 1] = np.bincount(flat, each * (sums[:, k] - v[:, k]), len(place))
            gradient += DECAY * table / max(1, len(rows) // BATCH)
            turn += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
            table -= RATE * (1 - epoch / EPOCHS) * step
            machine.bias -= RATE * float(error.sum())
    machine.weight, machine.factor = table[:, 0].copy(), table[:, 1:].copy()
    return machine


def sample(docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, negative: int = NEGATIVE) -> DataFrame:
    """(toxic, terms) of a bounded sample of labelled rows, those with the smallest hashes of doc_id.

    Rows held out, and rows without label or doc_id, are never in it. A doc_id with both labels counts as toxic.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    ones = known.where("__toxic = 1").orderBy(*by_hash).limit(positive)
    zeros = known.where("__toxic = 0").orderBy(*by_hash).limit(negative)
    # At most positive + negative rows of 12 bytes: small enough to send to all.
    chosen = F.broadcast(ones.unionByName(zeros).withColumnRenamed("doc_id", "__id"))
    return docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__id")).select(
        "doc_id", F.col("__toxic").alias("toxic"), _terms("text").alias("terms")
    )


def learn(docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, negative: int = NEGATIVE) -> Machine:
    """Fit a machine; terms are chosen by the likelihood ratio of their split over the labels."""
    rows = saved(sample(docs, labels, positive, negative), "toxicity-sample")
    ones, every = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    split = rows.select(F.explode("terms").alias("place"), "toxic")
    split = split.groupBy("place").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).where(F.col("n") >= FEWEST)
    share = F.lit(max(ones, 0.5) / max(every, 1))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    gain = part(F.col("a"), F.col("n") * share) + part(F.col("n") - F.col("a"), F.col("n") * (1 - share))
    best = split.where(gain >= GAIN).orderBy(gain.desc(), "place").limit(TERMS)
    place = np.array(sorted(r.place for r in best.select("place").collect()), dtype=np.int64)
    kept = rows.select("doc_id", "toxic", F.array_intersect("terms", F.array(*map(F.lit, place.tolist())).cast("array<int>")).alias("t"))
    found = kept.orderBy("doc_id", "toxic").collect() if len(place) else []
    numbers = [np.searchsorted(place, np.array(sorted(r.t), dtype=np.int64)) for r in found]
    return fit(numbers, np.array([r.toxic for r in found], dtype=float), place)


class Scorer:
    """Scores texts; remembers which terms of the machine a word has."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.number = {int(p): i for i, p in enumerate(machine.place)}
        self.seen: dict[str, tuple[int, ...]] = {}

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows = []
        for text in texts:
            found: set[int] = set()
            for word in set(WORD.findall((text or "").lower())):
                numbers = self.seen.get(word)
                if numbers is None:
                    if len(self.seen) >= REMEMBERED:
                        self.seen.clear()
                    numbers = self.seen[word] = tuple(self.number[t] for t in terms_of(word) if t in self.number)
                if numbers:
                    found.update(numbers)
            rows.append(sorted(found))
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        flat = np.array([i for r in rows for i in r], dtype=np.int64)
        return _sigmoid(self.machine.logits(flat, starts))


def scores(text: Column, machine: Machine) -> Column:
    """The score of a text column, 0 to 1; null counts as empty and gets the score of the bias."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for batch in batches:
            yield pd.Series(scorer.score(batch.tolist()), dtype="float64")

    return F.pandas_udf(run, DoubleType())(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``score`` and ``predicted`` in place of any of that name.

    Every row is returned, repeated ones too. Without labelled rows all scores are alike.
    """
    machine = learn(docs, labels)
    new = {"held_out": held_out(F.col("doc_id")), "score": scores(F.col("text"), machine)}
    scored = docs.withColumns(new)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
