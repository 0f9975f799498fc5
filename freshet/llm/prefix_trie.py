"""The trie of conversation prefixes: one row per distinct sequence of first turns.

Splitter-skeleton. Conversations become sorted paths, one fixed-width digest a turn, so that all
that share a prefix lie side by side. A bounded set of *splitters*, drawn from the paths, cuts the
order into shards; a cut may fall between copies of one conversation, so that a large group of
them is shared out too. Prefixes of splitters are the only nodes that can lie in several shards:
their trie, the *skeleton*, is sent to every task. A shard sorted on its own gives all other nodes
whole, in one pass with one open node per depth, and for skeleton nodes partial sums; these are
reduced, and summed over subtrees by prefix sums along the skeleton's preorder.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.base import saved
from freshet.plans.ordering import slot_count

#: Bytes of a turn's digest; paths compare turn by turn because all are as long.
WIDTH = 16

#: Conversations a shard should hold on large tables.
SHARD_ROWS = 200_000

#: Sampled paths per splitter.
OVERSAMPLING = 32

#: Turns of a splitter. One that is longer is cut there and then never splits a group of copies.
SPLITTER_TURNS = 256

#: Ids of ending conversations that one row of a skeleton node's list holds.
PIECE = 4096

#: Rows in one batch of results.
BATCH = 4096

_NO_ID = -(1 << 63)


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as array<struct<digest, chars>>.

    ``turn`` gives the order, null first; rows of one turn stand in the order of their digests, and
    repeated rows are turns of their own. Null roles and texts are empty. Rows without a conv_id
    belong to no conversation. A conversation is one row of some 30 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(content, 256)), 1, WIDTH).alias("digest"),
        F.char_length(text).alias("chars"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))))


def with_shared_heads(sequences: DataFrame, heads: Column, group: int = 100, most: int = 5) -> DataFrame:
    """Every conversation c with the first ``heads`` turns of conversation c - c % group before its own after those.

    ``heads`` is an expression of conv_id, at most ``most``. All turns there are if the first has fewer, none
    if it does not exist; a conversation may end up without turns.
    """
    own = sequences.withColumn("__head", heads).withColumn("__first", F.col("conv_id") - F.col("conv_id") % group)
    firsts = sequences.where(F.col("conv_id") % group == 0)
    firsts = firsts.select(F.col("conv_id").alias("__first"), F.slice("turns", 1, most).alias("__shared"))
    both = own.join(firsts, "__first", "left")
    shared = F.slice(F.coalesce("__shared", F.slice("turns", 1, 0)), F.lit(1), F.col("__head"))
    rest = F.slice("turns", F.col("__head") + 1, F.greatest(F.size("turns") - F.col("__head"), F.lit(0)))
    return both.select("conv_id", F.concat(shared, rest).alias("turns"))


class Skeleton:
    """The trie of the splitters' paths, numbered in preorder; the root is 0."""

    def __init__(self, paths: list[bytes]):
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.last = [-1], [0], [0]
        trail, before = [0], b""
        for path in paths:
            same = _shared_turns(before, path)
            del trail[same + 1 :]
            for at in range(same * WIDTH, len(path), WIDTH):
                node = len(self.parent)
                self.children[trail[-1], path[at : at + WIDTH]] = node
                self.parent.append(trail[-1])
                self.depth.append(len(trail))
                self.last.append(node)
                trail.append(node)
            for node in trail:
                self.last[node] = len(self.parent) - 1
            before = path


def _shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths begin with in common."""
    if b.startswith(a):
        return len(a) // WIDTH
    at = 0
    while a[at : at + WIDTH] == b[at : at + WIDTH]:
        at += WIDTH
    return at // WIDTH


_ROW = (
    "kind int, conv_id bigint, depth int, parent_conv_id bigint, skeleton int, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends string"
)
_NODE, _PART, _ENDS = 0, 1, 2


class _Open:
    """A node whose members are still coming in."""

    __slots__ = ("skeleton", "chars", "n", "least", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, skeleton: int | None, chars: int):
        self.skeleton, self.chars = skeleton, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.least = None
        self.ends = None
        self.waiting: list[tuple] = []


class _Shard:
    """One pass over the sorted paths of a shard."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.out: list[tuple] = []
        self.stack = [_Open(0, 0)]
        self.path = b""

    def add(self, path: bytes, conv_id: int, chars: list[int]) -> None:
        same = _shared_turns(self.path, path)
        while len(self.stack) > same + 1:
            self._close()
        for depth in range(same, len(path) // WIDTH):
            above = self.stack[-1].skeleton
            node = None
            if above is not None:
                node = self.skeleton.children.get((above, path[depth * WIDTH : (depth + 1) * WIDTH]))
            self.stack.append(_Open(node, chars[depth]))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if node.skeleton is None:
            node.ends = node.ends or hashlib.sha256()
            node.ends.update(str(conv_id).encode() if node.n == 1 else b",%d" % conv_id)
        else:
            node.ends = node.ends or []
            node.ends.append(conv_id)
            if len(node.ends) == PIECE:
                self._piece(node)

    def finish(self) -> None:
        while self.stack:
            self._close()

    def _piece(self, node: _Open) -> None:
        self.out.append((_ENDS, node.ends[0], None, None, node.skeleton, None, None, None, None, ",".join(map(str, node.ends))))
        node.ends = None

    def _close(self) -> None:
        node = self.stack.pop()
        if not node.n:
            return
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton is not None:
            if node.ends:
                self._piece(node)
            self.out.append((_PART, node.least, node.chars, None, node.skeleton, node.n, node.children, node.leaves, node.saved, None))
            return
        leaves = node.leaves if node.children else 1
        savings = node.saved + (node.n - 1) * node.chars
        depth = len(self.stack)
        for row in node.waiting:
            self.out.append((*row[:3], node.least, *row[4:]))
        ends = (node.ends or hashlib.sha256()).hexdigest()
        row = (_NODE, node.least, depth, None, above.skeleton, node.n, node.children, leaves, savings, ends)
        above.children += 1
        above.leaves += leaves
        above.saved += savings
        # A parent knows its smallest member when it closes; a skeleton node's is joined later.
        (self.out if above.skeleton is not None else above.waiting).append(row)


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), BATCH):
        columns = zip(*rows[at : at + BATCH])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("conv_id", pa.int64()),
        ("depth", pa.int32()),
        ("parent_conv_id", pa.int64()),
        ("skeleton", pa.int32()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends", pa.string()),
    ]
)


def _splitters(paths: DataFrame, shards: int, rows: int) -> list[tuple[bytes, int]]:
    """Up to about one splitter a shard, evenly along a sample's order, which follows the ids alone."""
    if shards < 2:
        return []
    every = max(1, rows // (OVERSAMPLING * shards))
    whole = F.octet_length("path") <= SPLITTER_TURNS * WIDTH
    sample = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select(
        F.substring("path", 1, SPLITTER_TURNS * WIDTH).alias("path"),
        F.when(whole, F.col("conv_id")).otherwise(_NO_ID).alias("conv_id"),
    )
    ranked = sample.withColumn("at", F.row_number().over(Window.orderBy("path", "conv_id")))
    step = max(1, min(OVERSAMPLING, rows // shards))
    found = ranked.where(F.col("at") % step == 0).select("path", "conv_id").collect()
    return sorted({(bytes(row["path"]), row["conv_id"]) for row in found})


def prefix_trie(sequences: DataFrame, shard_rows: int = SHARD_ROWS, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of (conv_id, turns array<struct<digest binary(16), chars int>>).

    A node is a distinct sequence of first turns, from the empty one (the root) on; its members are the
    conversations that begin with it. conv_id: smallest member; depth; parent_conv_id: that of the parent, null
    at the root; n_convs: members; n_children; n_leaves: childless nodes of its subtree, itself included;
    saved_tokens: summed over its subtree, (members - 1) times the characters of the node's last turn;
    ends_sha256: of the members without further turns, their ids in order, comma-joined. No
    conversations, no rows. conv_id must be unique and not null. A shard holds in memory one path and
    the finished children of its open nodes; what goes to the driver is one path a shard, of
    256 turns at most.
    """
    spark = sequences.sparkSession
    joined = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    paths = saved(sequences.select("conv_id", F.unhex(joined).alias("path"), F.col("turns.chars").alias("chars")), "paths")
    rows = paths.count()
    shards = shards or slot_count(paths, rows, shard_rows)
    splitters = _splitters(paths, shards, rows)
    skeleton = Skeleton([path for path, _ in splitters])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], ["conv_id", "path", "chars", "shard"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            for conv_id, path, chars, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    if state:
                        state.finish()
                        yield from _batches(state.out, _ARROW)
                    current, state = shard, _Shard(skeleton)
                state.add(path, conv_id, chars)
                if len(state.out) >= BATCH:
                    yield from _batches(state.out, _ARROW)
                    state.out.clear()
        if state:
            state.finish()
            yield from _batches(state.out, _ARROW)

    placed = paths.mapInArrow(place, "conv_id bigint, path binary, chars array<int>, shard int")
    shared = placed.repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    built = saved(shared.mapInArrow(build, _ROW), "trie")

    top = _skeleton_nodes(spark, built, skeleton)
    parents = top.select(F.col("skeleton").alias("__above"), F.col("conv_id").alias("__conv"))
    whole = built.where(f"kind = {_NODE}").join(parents, F.col("skeleton") == F.col("__above"), "left")
    return whole.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.coalesce("parent_conv_id", "__conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    ).unionByName(top.drop("skeleton"))


def _skeleton_nodes(spark, built: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The rows of skeleton nodes from the partial sums of all shards; as many as the splitters have prefixes."""
    below = [0] * len(skeleton.parent)
    for above in skeleton.parent[1:]:
        below[above] += 1
    fixed = spark.createDataFrame(
        list(zip(range(len(below)), skeleton.parent, skeleton.depth, skeleton.last, below)),
        "skeleton int, above int, depth long, last int, below long",
    )
    reduced = built.where(f"kind = {_PART}").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    nodes = fixed.join(reduced, "skeleton").withColumns(
        {
            "n_children": F.col("n_children") + F.col("below"),
            "own_saved": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"),
            "own_leaves": F.col("n_leaves") + F.when(F.col("n_children") + F.col("below") == 0, 1).otherwise(0),
        }
    )
    # A subtree is a stretch of the preorder: its sum is the difference of two prefix sums.
    upto = Window.orderBy("skeleton").rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.withColumns({"sum_saved": F.sum("own_saved").over(upto), "sum_leaves": F.sum("own_leaves").over(upto)})
    nodes = saved(nodes, "skeleton")
    ends = nodes.select(F.col("skeleton").alias("last"), F.col("sum_saved").alias("to_saved"), F.col("sum_leaves").alias("to_leaves"))
    above = nodes.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    pieces = built.where(f"kind = {_ENDS}").select("skeleton", "conv_id", "ends")
    hashed = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "conv_id").mapInArrow(
        _hash_ends, "skeleton int, ends_sha256 string"
    )
    empty = hashlib.sha256().hexdigest()
    return (
        nodes.join(ends, "last")
        .join(above, "above", "left")
        .join(hashed, "skeleton", "left")
        .select(
            "skeleton",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("to_leaves") - F.col("sum_leaves") + F.col("own_leaves")).alias("n_leaves"),
            (F.col("to_saved") - F.col("sum_saved") + F.col("own_saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash over the pieces of each skeleton node, as they come in order."""
    names = ["skeleton", "ends_sha256"]
    current, hashed = None, None
    for batch in batches:
        for node, _, text in zip(*(c.to_pylist() for c in batch.columns)):
            if node != current:
                if hashed:
                    yield pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([hashed.hexdigest()])], names)
                current, hashed = node, hashlib.sha256(text.encode())
            else:
                hashed.update(b"," + text.encode())
    if hashed:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([hashed.hexdigest()])], names)
