"""Mixing sources to target weights by balanced (cube) sampling.

Every source gets a target, a number of words. A document of the source is taken
``target / source size`` times: its whole part for certain, its fraction as an inclusion
probability. Which documents are rounded up is settled by the cube method. The flight
moves three open probabilities at a time along the null space of the two constraints
(words, documents), so that both totals stay as they are, until one of the three is 0 or 1.

Documents fly in chunks drawn by the hash of their doc_id, so that a source of any
size is spread over many tasks; each chunk leaves two open ones. What is left flies
again, in fewer chunks, until a source has one chunk. There the flight stops early
and the last open documents, of spread sizes, are settled together: of
all ways to round them the one is taken that comes nearest to the words still due, then to
the documents still due.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.base import saved, words

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all words, and the largest target of a source.
SHARE, MOST = 1.5, 2.0
#: Documents per chunk of a flight, and open documents left to the landing.
CHUNK, LANDING = 4096, 14
SEED = 20
ROW = "doc_id long, size long, source string, source_size long, target double, sure long, p double, open long, chunks long"
#: Probabilities this near to 0 or 1 are settled.
NEAR = 1e-9


def numbered_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, documents, weight). Sources are ranked range by range, no task sorts them all."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    ranged = totals.repartitionByRange(F.col("source").isNull(), "source")
    ranged = saved(ranged.withColumn("part", F.spark_partition_id()), "source-ranges")
    # One row per partition: few enough for one task.
    up_to = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n"))
    offsets = offsets.select("part", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    ranked = ranged.join(offsets, "part").withColumn("rank", F.col("offset") + F.row_number().over(within) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    return ranked.select("source", "source_size", "documents", weight.cast("double").alias("weight"))


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target``: shares by weight, none above ``most`` times the source's size.

    The level (words per weight) rises until no further source is full. Only sums
    over the sources come to the driver.
    """
    full = F.col("source_size") * most
    whole = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        over = F.col("weight") * level > full
        filled, open_weight = sources.agg(F.sum(F.when(over, full)), F.sum(F.when(~over, F.col("weight")))).first()
        risen = (whole - (filled or 0)) / open_weight if open_weight else level
        if risen <= level * (1 + 1e-12):
            break
        level = risen
    return sources.withColumn("target", F.least(full.cast("double"), F.col("weight") * level))


def fly(size: np.ndarray, p: np.ndarray, stop: int) -> np.ndarray:
    """Flight: inclusion probabilities after moving until ``stop`` (two or more) are open."""
    p = [float(x) for x in p]
    size = [float(x) for x in size]
    rng = np.random.default_rng([SEED, len(p)]).random(len(p) + 1).tolist()
    waiting = [i for i in range(len(p)) if NEAR < p[i] < 1 - NEAR]
    waiting.reverse()
    left, hand, turn = len(waiting), [], 0
    while left > max(stop, 2):
        while len(hand) < 3:
            hand.append(waiting.pop())
        a, b, c = hand
        move = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(move):
            move = (1.0, -1.0, 0.0)
        scale = max(abs(x) for x in move)
        move = [x / scale for x in move]
        up = min((1 - p[i]) / m if m > 0 else p[i] / -m for i, m in zip(hand, move) if m)
        down = min(p[i] / m if m > 0 else (1 - p[i]) / -m for i, m in zip(hand, move) if m)
        # Up with a chance that keeps every expectation as it is.
        step = up if rng[turn] * (up + down) < down else -down
        turn = (turn + 1) % len(rng)
        for i, m in zip(hand, move):
            p[i] += step * m
            if p[i] <= NEAR or p[i] >= 1 - NEAR:
                p[i] = float(round(p[i]))
        still = [i for i in hand if 0.0 < p[i] < 1.0]
        left -= len(hand) - len(still)
        hand = still
    return np.array(p)


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Settle the last open documents: nearest in words, then in documents."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_):
        choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        words_off = np.abs(choices @ size[open_] - (size[open_] * p[open_]).sum())
        rows_off = np.abs(choices.sum(axis=1) - p[open_].sum())
        p = p.copy()
        p[open_] = choices[np.lexsort((rows_off, np.round(words_off, 6)))[0]]
    return p


def _spread_order(size: np.ndarray) -> np.ndarray:
    """Largest first, but for ``LANDING`` documents of evenly spread rank, which come last."""
    order = np.argsort(-size, kind="stable")
    last = np.zeros(len(size), dtype=bool)
    last[np.unique(np.linspace(0, len(size) - 1, LANDING).astype(int))] = True
    return np.concatenate([order[~last], order[last]])


def _settle(rows: pd.DataFrame) -> pd.DataFrame:
    """The flight of one chunk, and its landing if it is the source's only one."""
    rows = rows.sort_values(["doc_id", "size"], kind="stable", ignore_index=True)
    rows = rows.iloc[_spread_order(rows["size"].to_numpy())]
    size, p = rows["size"].to_numpy(dtype=float), rows["p"].to_numpy()
    only = rows["chunks"].iloc[0] == 1
    p = fly(size, p, LANDING if only else 2)
    return rows.assign(p=land(size, p) if only else p).drop(columns="chunk")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source; other columns are ignored): doc_id, size, source,
    source_size, target, copies (0, 1 or 2 under the standard limits) and taken = copies * size.

    A null text has size 0, a null source is a source of its own and the last one.
    Sources without a word get target 0 and no document. Rows without a doc_id, and repeated rows,
    are documents like any other. Reruns over the same rows agree.
    """
    rows = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("size"), "source")
    rows = saved(rows, "mix-sizes")
    goal = targets(saved(numbered_sources(rows, weights), "mix-sources"), share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("ratio", F.round(ratio, 12)).withColumn("sure", F.floor("ratio").cast("long"))
    goal = goal.withColumn("p", F.col("ratio") - F.col("sure"))
    kept = F.struct("source_size", "target", "sure").alias("goal")
    goal = goal.select(F.col("source").alias("__source"), kept, "p", F.col("documents").alias("open"))
    state = rows.join(goal, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    state = state.select("doc_id", "size", "source", "goal.*", "p", "open")
    done, salt = [], 0
    while True:
        chunks = F.greatest(F.lit(1), F.ceil(F.col("open") / CHUNK)).cast("long")
        place = F.pmod(F.xxhash64("doc_id", "size", F.lit(salt)), F.col("chunks"))
        dealt = state.withColumn("chunks", chunks).withColumn("chunk", place)
        flown = saved(dealt.groupBy("source", "chunk").applyInPandas(_settle, ROW), f"mix-flight-{salt}")
        done.append(flown.where("p <= 0 or p >= 1"))
        left = flown.where("p > 0 and p < 1")
        counts = saved(left.groupBy("source").agg(F.count("*").alias("open")), f"mix-open-{salt}")
        if counts.isEmpty():
            break
        salt += 1
        left = left.drop("open", "chunks")
        state = left.join(
            counts.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))
        ).drop("__source")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    copies = F.col("sure") + F.round("p").cast("long")
    whole = whole.withColumn("copies", copies)
    return whole.select(
        "doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Rows that agree in doc_id, source and size share their copies evenly, the first by text first.
    """
    key = ["doc_id", "source", "size"]
    found = mix(docs).groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    found = found.where("copies > 0").select(F.struct(*key, "copies", "n").alias("mix"))
    size = F.size(words(F.col("text"))).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("row"), size.alias("size"))
    same = F.col("row.doc_id").eqNullSafe(F.col("mix.doc_id")) & F.col("row.source").eqNullSafe(F.col("mix.source"))
    rows = rows.join(found, same & (F.col("size") == F.col("mix.size")))
    nth = F.row_number().over(Window.partitionBy("mix.doc_id", "mix.source", "mix.size").orderBy(F.xxhash64("row.text")))
    share_of = F.floor(F.col("mix.copies") / F.col("mix.n")) + (nth <= F.col("mix.copies") % F.col("mix.n")).cast("long")
    rows = rows.withColumn("take", share_of.cast("int")).where("take > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("take")))).select("row.*")
