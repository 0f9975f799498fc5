"""Near duplicates by SimHash, searched with a covering code of anchor points.

The fingerprint's bits 0-22, 23-45 and 46-60 are three blocks. Each block is
covered by a perfect code: twice the binary Golay code (covering radius 3), once
the Hamming code of length 15 (covering radius 1). An anchor is a codeword of each.

Any two fingerprints at distance 2 or less have a midpoint at distance 1 or less
from both. The anchor nearest to the midpoint lies within the covering radius of
it in every block. So both fingerprints lie within the covering radius of that
anchor in every block, but for one block at most, where they may be one bit
beyond: the radius plus half the threshold, which is all that "radius plus threshold"
needs when both sides are replicated. A fingerprint has 1 to 18 such anchors.
Bits 61-63 are left out of the anchors; that only brings fingerprints closer.

Equal fingerprints are merged first. Under an anchor only a spanning set of the
links found is emitted. Should an anchor gather too many distinct fingerprints to
compare them all, these are dealt out again under the finest code, in which every point
is an anchor (covering radius 0) and nothing is left to compare: two fingerprints
that share a point at distance 1 or less from both are links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from freshet.llm.base import row_marks, saved
from freshet.llm.components import components

#: Words per shingle and the largest number of differing bits of a link.
SHINGLE, DISTANCE = 3, 2
SEED = 42
#: Distinct fingerprints under one anchor up to which all are compared with all.
CROWD = 512
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16

# Generator polynomials of the two codes, lowest power in bit 0.
GOLAY_POLYNOMIAL = 0b110001110101
HAMMING_POLYNOMIAL = 0b10011


def fingerprint_of(data: bytes | None) -> int:
    """The 64-bit SimHash of a text in UTF-8, as a signed integer."""
    found = (data or b"").lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) < SHINGLE:
        hashes = [digest(b" ".join(found), SEED)]
    else:
        hashes = [digest(b" ".join(t), SEED) for t in zip(*(found[i:] for i in range(SHINGLE)))]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), CHUNK):
        part = values[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprint(data: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(x) for x in data], dtype="int64")


def fingerprints(text: Column) -> Column:
    """SimHash of a text column as a long; null counts as empty."""
    return _fingerprint(F.coalesce(text, F.lit("")).cast("binary"))


def _remainder(value: int, polynomial: int) -> int:
    while value.bit_length() >= polynomial.bit_length():
        value ^= polynomial << (value.bit_length() - polynomial.bit_length())
    return value


class Block:
    """Some bits of the fingerprint and the perfect cyclic code that covers them."""

    def __init__(self, shift: int, length: int, polynomial: int, radius: int):
        self.shift, self.length, self.radius = shift, length, radius
        degree = polynomial.bit_length() - 1
        self.single = [_remainder(1 << bit, polynomial) for bit in range(length)]
        # Error patterns by remainder: the one within the radius, and those one bit beyond it.
        self.leader = np.zeros(1 << degree, dtype=np.int64)
        for weight in range(1, radius + 1):
            pattern, rest = self._patterns(weight)
            self.leader[rest] = pattern
        pattern, rest = self._patterns(radius + 1)
        order = np.argsort(rest, kind="stable")
        self.patterns = pattern[order]
        self.starts = np.searchsorted(rest[order], np.arange((1 << degree) + 1))

    def _patterns(self, weight: int) -> tuple[np.ndarray, np.ndarray]:
        bits = np.array(list(combinations(range(self.length), weight)))
        single = np.array(self.single)
        return np.bitwise_or.reduce(1 << bits, axis=1), np.bitwise_xor.reduce(single[bits], axis=1)

    def value(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> np.uint64(self.shift)).astype(np.int64) & ((1 << self.length) - 1)

    def nearest(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = self.value(fps)
        rest = np.zeros(len(fps), dtype=np.int64)
        for bit, single in enumerate(self.single):
            rest ^= (value >> bit & 1) * single
        return (value ^ self.leader[rest]) << self.shift, rest

    def one_beyond(self, fps: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, codeword) for the codewords one bit beyond the covering radius."""
        count = self.starts[rest + 1] - self.starts[rest]
        row = np.repeat(np.arange(len(fps)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        return row, (self.value(fps)[row] ^ self.patterns[self.starts[rest][row] + nth]) << self.shift


def code_blocks() -> list[Block]:
    return [Block(0, 23, GOLAY_POLYNOMIAL, 3), Block(23, 23, GOLAY_POLYNOMIAL, 3), Block(46, 15, HAMMING_POLYNOMIAL, 1)]


def anchors_of(fps: np.ndarray, blocks: list[Block] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) pairs for an array of unsigned fingerprints."""
    blocks = blocks or code_blocks()
    near = [block.nearest(fps) for block in blocks]
    whole = near[0][0] | near[1][0] | near[2][0]
    rows, anchors = [np.arange(len(fps))], [whole]
    for block, (codeword, rest) in zip(blocks, near):
        row, other = block.one_beyond(fps, rest)
        rows.append(row)
        anchors.append((whole ^ codeword)[row] | other)
    return np.concatenate(rows), np.concatenate(anchors)


def points_of(fps: np.ndarray, blocks: list[Block] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, point) for every point at distance 1 or less."""
    flips = np.concatenate([[0], 1 << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    return np.repeat(np.arange(len(fps)), 65), (fps[:, None] ^ flips).ravel().view(np.int64)


def _replicate(deal):
    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = code_blocks()
        for batch in batches:
            fps = batch["fp"].to_numpy(dtype=np.int64)
            row, anchor = deal(fps.view(np.uint64), blocks)
            yield pd.DataFrame({"anchor": anchor, "fp": fps[row]})

    return replicate


def spanning_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(fp, smallest fp of its part) for distinct fingerprints compared all with all."""
    label = np.arange(len(fps))
    close = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)) <= distance
    while True:
        lower = np.where(close, label, len(fps)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return [(int(fps[i]), int(fps[k])) for i, k in enumerate(label) if i != k]


def _compare(distance: int, crowd: int):
    """Over rows sorted by anchor: links as (fp, other, False); the members of a crowded
    anchor as (fp, fp, True). Holds one anchor's rows, ``crowd`` at most."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.empty(0, dtype=np.int64)
        anchor, over = None, False
        for batch in batches:
            if batch.empty:
                continue
            keys, fps = batch["anchor"].to_numpy(dtype=np.int64), batch["fp"].to_numpy(dtype=np.int64)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            links: list[tuple[int, int]] = []
            crowded: list[np.ndarray] = []
            # Groups of one row inside a batch have nothing to compare.
            worth = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
            for start, end in zip(starts[worth], ends[worth]):
                if keys[start] != anchor:
                    if len(held) > 1:
                        links += spanning_links(held, distance)
                    held, anchor, over = held[:0], keys[start], False
                if not over and len(held) + end - start > crowd:
                    crowded.append(held)
                    held, over = held[:0], True
                if over:
                    crowded.append(fps[start:end])
                else:
                    held = np.concatenate([held, fps[start:end]])
            yield _found(links, crowded)
        if len(held) > 1:
            yield _found(spanning_links(held, distance), [])

    return compare


def _found(links: list[tuple[int, int]], crowded: list[np.ndarray]) -> pd.DataFrame:
    many = np.concatenate(crowded) if crowded else np.empty(0, dtype=np.int64)
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame(
        {
            "a": np.concatenate([pairs[:, 0], many]),
            "b": np.concatenate([pairs[:, 1], many]),
            "crowded": np.arange(len(pairs) + len(many)) >= len(pairs),
        }
    )


FOUND = "a long, b long, crowded boolean"


def _links_under(fps: DataFrame, deal, distance: int, crowd: int) -> DataFrame:
    dealt = fps.mapInPandas(_replicate(deal), "anchor long, fp long")
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor", "fp")
    return dealt.mapInPandas(_compare(distance, crowd), FOUND).distinct()


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): a spanning set of the links between distinct fingerprints (column fp)."""
    found = saved(_links_under(fps, anchors_of, DISTANCE, crowd), "anchor-links")
    again = found.where("crowded").select(F.col("a").alias("fp")).distinct()
    # Two fingerprints under one point are links already: any distance will do.
    finest = _links_under(again, points_of, 64, 65)
    return found.where("not crowded").select("a", "b").unionByName(finest.select("a", "b"))


def _rooted(fps: DataFrame, crowd: int) -> DataFrame:
    """Distinct fingerprints (column fp and others) with the root of their component, a fingerprint."""
    roots = components(links(fps.select("fp"), crowd))
    joined = fps.join(roots, fps["fp"] == roots["node"], "left")
    return saved(joined.select(*fps.columns, F.coalesce("root", "fp").alias("root")), "fingerprint-roots")


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, fingerprint
    (16 hex digits) and component_id, the smallest doc_id that can be reached over links.

    Null and word-free texts have fingerprint 0 and are linked like any other. Rows
    without doc_id get a component as well, and a null component_id only where no row of it
    has a doc_id. Repeated rows are kept, each with the same values.
    """
    rows = saved(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "fingerprints")
    rooted = _rooted(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), crowd)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component of linked fingerprints.

    It is the row with the smallest doc_id; rows without one come last, and of several rows with that
    doc_id a hash of their columns decides. Ids do not link: rows without doc_id, or that share one, go only
    where their fingerprints are linked. Components and choices are made on hashes; texts are joined to them once.
    """
    first, second = row_marks(docs)
    found = docs.select("doc_id", fingerprints(F.col("text")).alias("fp"), first.alias("m0"), second.alias("m1"))
    choice = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "m0", "m1"))
    # Fingerprints are asked for by the links and by the choice: they are made once.
    rooted = _rooted(saved(found.groupBy("fp").agg(choice.alias("choice")), "fingerprints"), crowd)
    kept = rooted.groupBy("root").agg(F.min("choice").alias("choice")).select("choice.m0", "choice.m1")
    rows = docs.select(F.struct(*docs.columns).alias("row"), first.alias("m0"), second.alias("m1")).join(kept, ["m0", "m1"])
    # Only rows equal in all columns have the same marks: one of them stays.
    return rows.groupBy("m0", "m1").agg(F.first("row").alias("row")).select("row.*")
