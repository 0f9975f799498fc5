"""Language-model scores by masked pseudo-likelihood.

A small network sees two words on either side of a place and predicts the word in it. A
document's score is the sum over all its places of the log-probability of the word there,
given its neighbours. Unlike a left-to-right model, each word is judged from both sides.

The words of the whole corpus are counted in Spark; the most frequent ones are symbols of their
own, all others share symbols by the hash of their last three bytes. The network predicts symbols; a shared one
times the word's part in it, from the counts, is the probability of the word. The output is two-level: first one of 32
classes, then one of its 32 members, so that 64 numbers are computed per place, not 1,024.

Training masks every place of all documents in just one of the rounds, which a hash deals it to. Documents are
dealt into shards by a hash of id and content, as many as the corpus has places for, and stand in the order of
the hash in them. Each shard trains a replica from the weights of the round before; the replicas are averaged
with the number of their places as weights. Sums are kept in whole numbers. So neither the files and partitions of
the table nor the number of cores have a part in the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.base import saved

#: Symbols: CLASSES * MEMBERS; the last ``SHARED`` are shared by rare words. Symbol 0 is the edge.
CLASSES, MEMBERS, SHARED = 32, 32, 256
SYMBOLS = CLASSES * MEMBERS
#: Neighbours on each side, numbers per symbol and hidden numbers.
SIDE, WIDTH, HIDDEN = 2, 16, 32
#: Rounds of averaging, which share all places between them, places per step, step size.
ROUNDS, STEP, RATE = 2, 1024, 0.05
#: Places one replica is trained on, in all rounds.
SHARD_PLACES = 1 << 22
#: Words whose counts every task is given, the most frequent ones; occurrences added to each word's count.
KNOWN, ADDED = 1 << 17, 0.5
#: Whole-number scale of averaged weights, and weights per averaged block.
SCALE, SLAB = 1 << 30, 1024
#: Bytes of texts whose words are looked up at once.
CHUNK = 1 << 23
#: Places handled at once, and steps whose orders are found at once.
PLACES, AHEAD = 1 << 16, 16
SEED = 9

SHAPES = {
    "embed": (SYMBOLS, WIDTH),
    "hidden": (2 * SIDE * WIDTH, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "classes": (CLASSES, HIDDEN),
    "class_bias": (CLASSES,),
    "members": (CLASSES, MEMBERS, HIDDEN),
    "member_bias": (CLASSES, MEMBERS),
}


def _bucket(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word[-3:], 42) % SHARED


def _chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of things that stand side by side, up to a size together; a larger one is alone."""
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > most:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts in UTF-8, which are in lower case and not null, in one row, and the number of words of each."""
    split = pc.ascii_split_whitespace(texts)
    found, ends = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    # Blanks at an end of a text leave an empty word there.
    some = pc.not_equal(found, "")
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return found.filter(some), np.diff(before[ends - ends[0]])


@dataclass
class Vocabulary:
    """What is known of words: up to ``KNOWN`` frequent ones have a place, the others share one by bucket, after these."""

    known: pa.Array
    #: Symbol, and logarithm of the word's part in it, by place.
    symbols: np.ndarray
    parts: np.ndarray
    #: Occurrences of each symbol in the corpus.
    counts: np.ndarray

    def _places(self, found: pa.Array) -> np.ndarray:
        known = pc.index_in(found, value_set=self.known)
        places = known.fill_null(-1).to_numpy().astype(np.int32)
        ends = pc.binary_slice(found.filter(known.is_null()).view(pa.binary()), -3).dictionary_encode()
        buckets = np.array([_bucket(end) for end in ends.dictionary.to_pylist()], dtype=np.int32)
        places[places < 0] = len(self.known) + buckets[ends.indices.to_numpy()]
        return places

    def spell(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The places of the words of some texts in one row, and the number of words of each text."""
        low = [(text or "").lower().encode("utf-8", "surrogatepass") for text in texts]
        found, lengths = _split(pa.array(low, pa.binary()).view(pa.string()))
        return self._places(found), lengths

    def places(self, text: str | None) -> np.ndarray:
        return self.spell([text])[0]

    def symbol(self, word: bytes) -> int:
        return int(self.symbols[self._places(pa.array([word], pa.binary()).view(pa.string()))[0]])


def _frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words that occur more often than some number, the smallest that no more than ``most`` exceed, in
    order; but at least those that are symbols of their own. Few numbers occur, so that they are found by a small table."""
    kinds = counts.groupBy("n").agg(F.count("*").alias("kinds"))
    upto = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    least = kinds.withColumn("all", F.sum("kinds").over(upto)).where(F.col("all") <= most).agg(F.min("n")).first()[0]
    first = counts.orderBy(F.col("n").desc(), "word").limit(SYMBOLS - SHARED - 1).collect()
    rows = {row.word.encode(): row.n for row in first}
    if least is not None:
        rows |= {row.word.encode(): row.n for row in counts.where(F.col("n") >= least).collect()}
    return sorted(rows.items(), key=lambda row: (-row[1], row[0]))


def spelled(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(shard, mark, doc_id, symbols, parts): the texts as symbols, which all later passes read in place of the text, and
    the sum of the logarithms of their words' parts in shared symbols. Rows are in their shards, in order."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Sizes in bytes; the words of a chunk are looked up at once.
            sizes = pc.binary_length(batch["text"]).fill_null(0).to_numpy()
            for start, end in _chunks(sizes, CHUNK):
                part = batch.slice(start, end - start)
                places, lengths = vocabulary.spell(part["text"].to_pylist())
                ends = np.concatenate([[0], np.cumsum(lengths)])
                parts = vocabulary.parts.take(places)
                sums = [parts[a:b].sum() for a, b in zip(ends.tolist(), ends[1:].tolist())]
                rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(vocabulary.symbols.take(places)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], rows, pa.array(sums, pa.float64())], ["doc_id", "symbols", "parts"])

    found = docs.select("doc_id", "text").mapInArrow(spell, "doc_id long, symbols array<short>, parts double")
    shards = max(1, -(-int(vocabulary.counts.sum()) // SHARD_PLACES))
    mark = F.xxhash64("doc_id", "symbols")
    dealt = found.select(F.pmod(mark, F.lit(shards)).cast("int").alias("shard"), mark.alias("mark"), "doc_id", "symbols", "parts")
    return dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "mark", "doc_id", "symbols")


def learn_vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts the words of all documents; ties are settled by the word.

    A word's part in its symbol is (n + a) / (N + a (D + 1)) of n occurrences of N of the symbol's D words. Beyond
    the known words n is the mean of the bucket's others, of which an unseen word is one more.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in _chunks(pc.binary_length(batch["text"]).to_numpy(), CHUNK):
                found = pc.value_counts(_split(batch["text"].slice(start, end - start))[0])
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

    each = docs.select(F.lower(F.coalesce("text", F.lit(""))).alias("text")).mapInArrow(count, "word string, n long")
    counts = saved(each.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    known = _frequent(counts, KNOWN)
    own = SYMBOLS - SHARED - 1
    # The same hash as _bucket, over all words; those with symbols of their own, and known ones, are taken off again.
    shared = F.pmod(F.xxhash64(F.substring(F.col("word").cast("binary"), -3, 3)), F.lit(SHARED))
    times, kinds = np.zeros(SHARED), np.zeros(SHARED)
    for row in counts.groupBy(shared.alias("place")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        times[row.place], kinds[row.place] = row.n, row.kinds
    for word, n in known[:own]:
        times[_bucket(word)] -= n
        kinds[_bucket(word)] -= 1
    seen = np.zeros(SYMBOLS)
    seen[1 : len(known[:own]) + 1] = [n for _, n in known[:own]]
    seen[SYMBOLS - SHARED :] = times
    symbols = np.zeros(len(known) + SHARED, dtype=np.int16)
    parts = np.zeros(len(known) + SHARED)
    symbols[: len(known[:own])] = np.arange(1, len(known[:own]) + 1)
    symbols[len(known) :] = np.arange(SYMBOLS - SHARED, SYMBOLS)
    whole = times + ADDED * (kinds + 1)
    rest_times, rest_kinds = times.copy(), kinds.copy()
    for at, (word, n) in enumerate(known[own:], own):
        bucket = _bucket(word)
        symbols[at] = SYMBOLS - SHARED + bucket
        parts[at] = np.log((n + ADDED) / whole[bucket])
        rest_times[bucket] -= n
        rest_kinds[bucket] -= 1
    parts[len(known) :] = np.log((rest_times / (rest_kinds + 1) + ADDED) / whole)
    return Vocabulary(pa.array([word for word, _ in known], pa.binary()).view(pa.string()), symbols, parts, seen)


def first_weights(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Small random numbers; the biases are the words' frequencies."""
    rng = np.random.default_rng(SEED)
    w = {name: rng.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()}
    often = (vocabulary.counts + 1.0).reshape(MEMBERS, CLASSES).T
    w["hidden_bias"][:] = 0
    w["class_bias"] = np.log(often.sum(axis=1) / often.sum()).astype(np.float32)
    w["member_bias"] = np.log(often / often.sum(axis=1, keepdims=True)).astype(np.float32)
    return w


#: Logits below this can be raised to powers as they are.
SAFE = 60.0
_ONES = np.ones(max(CLASSES, MEMBERS), dtype=np.float32)


def _largest(weights: np.ndarray, bias: np.ndarray) -> float:
    """What no logit of hidden numbers between -1 and 1 exceeds."""
    return float((np.abs(weights).sum(axis=-1) + np.abs(bias)).max())


def _powers(logits: np.ndarray, largest: float, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Takes exp of the logits in their place, shifted where they could overflow: the sums of each row, and the logits
    at the chosen places of all rows."""
    if largest > SAFE:
        logits -= logits.max(axis=1, keepdims=True)
    picked = None if chosen is None else logits.ravel().take(chosen)
    np.exp(logits, out=logits)
    return logits @ _ONES[: logits.shape[1]], picked


def _spans(sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, start, end) of each class that occurs, in places in the order of classes."""
    ends = np.cumsum(sizes).tolist()
    return [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _outer(w: dict[str, np.ndarray], hidden: np.ndarray) -> np.ndarray:
    """Logits of the classes."""
    out = hidden @ w["classes"].T
    out += w["class_bias"]
    return out


def _inner(w: dict[str, np.ndarray], hidden: np.ndarray, sizes: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits of the members of each place's class, places in the order of classes."""
    out, members, dot = np.empty((len(hidden), MEMBERS), dtype=np.float32), list(w["members"].transpose(0, 2, 1)), np.dot
    for c, a, b in spans:
        dot(hidden[a:b], members[c], out[a:b])
    out += np.repeat(w["member_bias"], sizes, axis=0)
    return out


def _seen(w: dict[str, np.ndarray], near: np.ndarray) -> np.ndarray:
    """The numbers of the neighbours of each place, side by side."""
    return w["embed"].take(near.ravel(), axis=0).reshape(len(near), -1)


def _hidden(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    out = x @ w["hidden"]
    out += w["hidden_bias"]
    return np.tanh(out, out=out)


def log_probabilities(w: dict[str, np.ndarray], near: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each target symbol given its neighbours."""
    klass = target % CLASSES
    order, sizes = np.argsort(klass, kind="stable"), np.bincount(klass, minlength=CLASSES)
    klass, member, every = klass[order], target[order] // CLASSES, np.arange(len(target))
    hidden = _hidden(w, _seen(w, near.take(order, axis=0)))
    outer, own = _powers(_outer(w, hidden), _largest(w["classes"], w["class_bias"]), every * CLASSES + klass)
    inner, one = _powers(_inner(w, hidden, sizes, _spans(sizes)), _largest(w["members"], w["member_bias"]), every * MEMBERS + member)
    out = np.empty(len(target))
    out[order] = own.astype(np.float64) - np.log(outer.astype(np.float64)) + one - np.log(inner.astype(np.float64))
    return out


class Replica:
    """Weights under training; every weight has its own step size, which shrinks as it moves (Adagrad)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.flat = np.concatenate([weights[name].ravel() for name in SHAPES])
        self.moved, self.change, self.root = np.full_like(self.flat, 1e-4), np.empty_like(self.flat), np.empty_like(self.flat)
        # Views of all weights and of the gradients of all.
        self.w, self.gradient = _views(self.flat), _views(self.change)
        self.most = {"classes": np.inf, "members": np.inf}

    def _move(self) -> None:
        np.square(self.change, out=self.root)
        self.moved += self.root
        np.sqrt(self.moved, out=self.root)
        self.change *= RATE
        self.change /= self.root
        self.flat -= self.change

    def _most(self, name: str, bias: str) -> float:
        """What no logit exceeds. A step moves no weight by more than ``RATE``, so that it need not be taken anew before
        that many steps could have brought it to ``SAFE``."""
        self.most[name] += 1.01 * RATE * (HIDDEN + 1)
        if self.most[name] > SAFE:
            self.most[name] = _largest(self.w[name], self.w[bias])
        return self.most[name]

    def descend(self, near: np.ndarray, target: np.ndarray) -> None:
        """Steps of ``STEP`` places, the last one of what is left, down the mean negative log-probability of each."""
        for at in range(0, len(target), AHEAD * STEP):
            self._steps(near[at : at + AHEAD * STEP], target[at : at + AHEAD * STEP])

    def _steps(self, near: np.ndarray, target: np.ndarray) -> None:
        """The orders that some steps need are found for all of them at once."""
        step = np.arange(len(target)) // STEP
        steps = int(step[-1]) + 1
        # Places in the order of their classes, so that only the products are taken class by class.
        key = step * CLASSES + target % CLASSES
        order = np.argsort(key.astype(np.uint16), kind="stable")
        sizes = np.bincount(key, minlength=steps * CLASSES).reshape(steps, CLASSES)
        near, target = near.take(order, axis=0).astype(np.intp), target[order].astype(np.intp)
        every = np.arange(len(target)) % STEP
        klass, member = every * CLASSES + target % CLASSES, every * MEMBERS + target // CLASSES
        # The gradients of one symbol stand together and are summed as a segment.
        key = (near + (step * SYMBOLS)[:, None]).ravel()
        beside = np.argsort(key.astype(np.uint16), kind="stable") % (STEP * 2 * SIDE)
        times = np.bincount(key, minlength=steps * SYMBOLS).reshape(steps, SYMBOLS)
        for k in range(steps):
            part = slice(k * STEP, (k + 1) * STEP)
            whole = slice(k * STEP * 2 * SIDE, (k + 1) * STEP * 2 * SIDE)
            self._step(near[part], klass[part], member[part], sizes[k], beside[whole], times[k])

    def _step(self, near: np.ndarray, klass: np.ndarray, member: np.ndarray, sizes: np.ndarray, beside: np.ndarray, times: np.ndarray) -> None:
        w, g, n, spans = self.w, self.gradient, np.float32(len(near)), _spans(sizes)
        x = _seen(w, near)
        hidden = _hidden(w, x)
        outer = _outer(w, hidden)
        sums, _ = _powers(outer, self._most("classes", "class_bias"))
        outer *= (1 / (sums * n))[:, None]
        outer.ravel()[klass] -= 1 / n
        inner = _inner(w, hidden, sizes, spans)
        sums, _ = _powers(inner, self._most("members", "member_bias"))
        inner *= (1 / (sums * n))[:, None]
        inner.ravel()[member] -= 1 / n
        lifted, members, change, dot = np.empty_like(hidden), list(w["members"]), list(g["members"]), np.dot
        if len(spans) < CLASSES:
            g["members"][:], g["member_bias"][:] = 0, 0
        for c, a, b in spans:
            own = inner[a:b]
            dot(own, members[c], lifted[a:b])
            dot(own.T, hidden[a:b], change[c])
        g["member_bias"][[c for c, _, _ in spans]] = np.add.reduceat(inner, [a for _, a, _ in spans])
        back = outer @ w["classes"]
        back += lifted
        np.dot(outer.T, hidden, out=g["classes"])
        outer.sum(axis=0, out=g["class_bias"])
        hidden *= hidden
        back *= np.subtract(1, hidden, out=hidden)
        lower = (back @ w["hidden"].T).reshape(-1, WIDTH)
        np.dot(x.T, back, out=g["hidden"])
        back.sum(axis=0, out=g["hidden_bias"])
        shown = np.flatnonzero(times)
        ends = np.cumsum(times[shown])
        g["embed"][:] = 0
        g["embed"][shown] = np.add.reduceat(lower.take(beside, axis=0), ends - times[shown])
        self._move()


def _mixed(symbols: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(symbols.tobytes(), SEED)


def _turns(lengths: np.ndarray, keys: np.ndarray, rounds: int) -> np.ndarray:
    """The round in which each place of some texts is masked, by a hash of the text and the place."""
    places = np.arange(lengths.sum(), dtype=np.uint64) - np.repeat(np.cumsum(lengths) - lengths, lengths).astype(np.uint64)
    mixed = (places + np.repeat(keys, lengths)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)) % np.uint64(rounds)


def _masked(symbols: np.ndarray, key: int, turn: int, rounds: int) -> np.ndarray:
    """The places masked in a round; those of all rounds are disjoint and together all places."""
    return np.flatnonzero(_turns(np.array([len(symbols)]), np.array([key], dtype=np.uint64), rounds) == turn)


def _windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Some texts in one row with edges between them: the row, the places of all their symbols, their lengths."""
    edge = np.zeros(SIDE, dtype=np.int16)
    row = np.concatenate([edge, *(part for text in texts for part in (text, edge))])
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    return row, np.arange(lengths.sum()) + SIDE * (1 + np.repeat(np.arange(len(texts)), lengths)), lengths


#: Where the neighbours of a place stand.
OFFSETS = np.concatenate([np.arange(-SIDE, 0), np.arange(1, SIDE + 1)])


def _groups(texts: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Texts up to a number of places; a longer one is alone."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > PLACES:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[name].ravel() for name in SHAPES]).astype(np.float64)


def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The weights in a row of all."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    return _views(flat.astype(np.float32))


def _train_round(texts: DataFrame, weights: dict[str, np.ndarray], turn: int, rounds: int) -> dict[str, np.ndarray]:
    def replica(texts: list[np.ndarray], own: Replica, left: list[np.ndarray]) -> int:
        """Train on the masked places of some texts in whole steps; what is left waits for the next ones."""
        trained = 0
        for group in _groups(texts):
            row, places, lengths = _windows(group)
            keys = np.array([_mixed(text) for text in group], dtype=np.uint64)
            places = places[_turns(lengths, keys, rounds) == turn]
            trained += len(places)
            for at in range(0, len(places), PLACES):
                part = places[at : at + PLACES]
                near = np.concatenate([left[0], row[part[:, None] + OFFSETS]])
                target = np.concatenate([left[1], row[part]])
                whole = len(target) // STEP * STEP
                own.descend(near[:whole], target[:whole])
                left[:] = near[whole:], target[whole:]
        return trained

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, own, left, trained = None, None, None, 0
        for batch in batches:
            for name, rows in batch.groupby("shard", sort=False):
                if name != shard:
                    if trained:
                        yield finished(own, left, trained)
                    shard, own, trained = name, Replica(weights), 0
                    left = [np.empty((0, 2 * SIDE), np.int16), np.empty(0, np.int16)]
                trained += replica(rows["symbols"], own, left)
        if trained:
            yield finished(own, left, trained)

    def finished(own: Replica, left: list[np.ndarray], trained: int) -> pd.DataFrame:
        if len(left[1]):
            own.descend(*left)
        # A replica counts by the places it was trained on.
        whole = np.rint((_flat(own.w) - _flat(weights)) * SCALE).astype(np.int64)
        slabs = [whole[i : i + SLAB] for i in range(0, len(whole), SLAB)]
        return pd.DataFrame({"slab": range(len(slabs)), "places": trained, "change": [s.tolist() for s in slabs]})

    replicas = texts.select("shard", "symbols").mapInPandas(train, "slab int, places long, change array<long>")
    each = replicas.select("slab", "places", F.posexplode("change").alias("at", "change"))
    weighted = F.sum(F.col("change").cast("decimal(38,0)") * F.col("places"))
    mean = each.groupBy("slab", "at").agg((weighted / F.sum("places")).cast("double").alias("change"))
    slabs = mean.groupBy("slab").agg(F.array_sort(F.collect_list(F.struct("at", "change"))).alias("changes")).orderBy("slab")
    rows = slabs.select("changes.change").collect()
    if not rows:
        return weights
    return _shaped(_flat(weights) + np.concatenate([np.array(r.change) for r in rows]) / SCALE)


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights from the spelled texts of the whole corpus."""
    weights = first_weights(vocabulary)
    for turn in range(rounds):
        weights = _train_round(texts, weights, turn, rounds)
    return weights


def pseudo_likelihood(texts: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """Per row of spelled texts: doc_id, n_words, log_prob (the sum over all words, natural
    logarithm) and per_word (its mean; null for a text without words)."""

    def sums(group: list[np.ndarray]) -> np.ndarray:
        row, places, lengths = _windows(group)
        parts = [places[at : at + PLACES] for at in range(0, len(places), PLACES)]
        found = [log_probabilities(weights, row[part[:, None] + OFFSETS], row[part]) for part in parts]
        total = np.zeros(len(group))
        some = lengths > 0
        if some.any():
            total[some] = np.add.reduceat(np.concatenate(found), (np.cumsum(lengths) - lengths)[some])
        return total

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch["symbols"]
            found = [sums(group) for group in _groups(rows)]
            lengths = [len(r) for r in rows]
            log_prob = np.concatenate([np.empty(0), *found]) + batch["parts"].to_numpy(dtype=float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": lengths, "log_prob": log_prob})

    found = texts.mapInPandas(score, "doc_id long, n_words long, log_prob double")
    return found.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn the vocabulary and the network from all documents (doc_id, text; other columns are ignored), then
    score them all. A null text counts as empty; repeated rows are kept, each with its score."""
    vocabulary = learn_vocabulary(docs)
    texts = saved(spelled(docs, vocabulary), "symbols")
    return pseudo_likelihood(texts, train(texts, vocabulary))
