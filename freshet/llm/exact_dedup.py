"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. The distinct blocks
are sorted and numbered; from then on a text is a short sequence of integers.
Adjacent pairs of integers are numbered in the same way, again and again, until
one integer is left for each text. Two texts have the same number of rounds and
the same last integer exactly if they are equal: no step relies on a hash being
free of collisions.

Numbers depend on the set of blocks alone, not on partitions or on timing, so a
task that is run again after an executor is lost yields the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.base import packed, saved

#: Bytes per block.
BLOCK = 4096
#: Numbers are given bucket by bucket; a bucket is sorted by one task.
BUCKETS = 1 << 20

KEY = ["doc_id", "sha"]


def _block_hash(block: Column, bits: int) -> Column:
    whole = F.xxhash64(block)
    return whole if bits == 64 else F.shiftrightunsigned(whole, 64 - bits)


def _cut(docs: DataFrame, block: int, bits: int) -> DataFrame:
    """A row per block: doc_id, sha, blocks, pos, block, h."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.unhex(F.sha2(data, 256)).alias("sha"), data.alias("data"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("data") / block)).cast("int")
    rows = rows.withColumn("blocks", count)
    rows = rows.select(*KEY, "blocks", "data", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("pos"))
    piece = F.substring("data", F.col("pos") * block + 1, F.lit(block))
    return rows.select(*KEY, "blocks", "pos", piece.alias("block")).withColumn("h", _block_hash(F.col("block"), bits))


def _block_names(blocks: DataFrame) -> DataFrame:
    """(h, first, same): blocks with hash h have the numbers first, first + 1, ... in the
    order of ``same``, which is kept only where several distinct blocks share h."""
    distinct = blocks.groupBy("h").agg(F.array_sort(F.collect_set("block")).alias("same"))
    distinct = distinct.select("h", F.size("same").alias("n"), F.when(F.size("same") > 1, F.col("same")).alias("same"))
    distinct = distinct.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(BUCKETS)))
    before = Window.partitionBy("bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    first = packed(F.col("bucket"), F.coalesce(F.sum("n").over(before), F.lit(0)))
    return distinct.select("h", first.alias("first"), "same")


def _name_blocks(docs: DataFrame, block: int, bits: int) -> DataFrame:
    """(doc_id, sha, rows, blocks, pos, name)."""
    blocks = _cut(docs, block, bits)
    names = saved(_block_names(blocks.select("h", "block")), "block-names")
    places = blocks.groupBy(*KEY, "blocks", "pos", "h").agg(F.count("*").alias("rows"))
    shared = names.where(F.col("same").isNotNull())
    named = places.join(names.where(F.col("same").isNull()).select("h", "first"), "h")
    named = named.select(*KEY, "rows", "blocks", "pos", F.col("first").alias("name"))
    if shared.isEmpty():
        return named
    # Distinct blocks with one hash: told apart by their bytes.
    each = shared.select("h", "first", F.posexplode("same").alias("nth", "block"))
    each = each.select("h", "block", (F.col("first") + F.col("nth")).alias("name"))
    split = blocks.join(each, ["h", "block"]).groupBy(*KEY, "blocks", "pos", "name").agg(F.count("*").alias("rows"))
    return named.unionByName(split)


def _pair_up(sequences: DataFrame) -> DataFrame:
    """Adjacent names side by side: (doc_id, sha, rows, blocks, pos, a, b)."""
    even = F.col("pos") % 2 == 0
    half = F.ceil(F.col("blocks") / 2).cast("int")
    return sequences.groupBy(
        *KEY, "rows", half.alias("blocks"), F.floor(F.col("pos") / 2).cast("int").alias("pos")
    ).agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))


def _name_pairs(pairs: DataFrame) -> DataFrame:
    distinct = pairs.select("a", "b").distinct()
    distinct = distinct.withColumn("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(BUCKETS)))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("a", "b"))
    names = distinct.select("a", "b", packed(F.col("bucket"), rank).alias("name"))
    return pairs.join(names, ["a", "b"]).select(*KEY, "rows", "blocks", "pos", "name")


def identities(docs: DataFrame, block: int = BLOCK, bits: int = 64) -> DataFrame:
    """(doc_id, sha, rows, round, name): (round, name) is the identity of the text.

    One row per distinct (doc_id, text); ``rows`` counts its repetitions. Null texts
    count as empty; null doc_ids are a value like any other.
    """
    state = saved(_name_blocks(docs, block, bits), "names-0")
    done, turn = [], 0
    while True:
        done.append(state.where("blocks = 1").select(*KEY, "rows", F.lit(turn).alias("round"), "name"))
        left = state.where("blocks > 1")
        if left.isEmpty():
            break
        turn += 1
        state = saved(_name_pairs(saved(_pair_up(left), f"pairs-{turn}")), f"names-{turn}")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def exact_duplicates(docs: DataFrame, block: int = BLOCK, bits: int = 64) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, keep_id,
    group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; a row without doc_id stays
    only if no row of its group has one. Of rows equal in doc_id and text one stays.
    ``bits`` shortens the block hash, for tests of the collision path only.
    """
    found = identities(docs, block, bits)
    identity = ["round", "name"]
    groups = found.groupBy(*identity).agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    each = found.join(groups, identity).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows equal in doc_id and
    text the one whose other columns sort first stays."""
    kept = exact_duplicates(docs, block).where("kept").select("doc_id", F.unhex("text_sha256").alias("sha"))
    kept = kept.select(F.struct("doc_id", "sha").alias("kept"))
    sha = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), sha.alias("sha"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept.doc_id")) & (F.col("sha") == F.col("kept.sha")))
    # Rows equal in doc_id and text meet map-side: one of them is left of each task.
    others = [F.col("row")[name].cast("string") for name in docs.columns if name not in ("doc_id", "text")]
    first = F.min_by("row", F.struct(F.lit(0).alias("c"), *[o.alias(f"c{i}") for i, o in enumerate(others)]))
    return rows.groupBy("id", "sha").agg(first.alias("row")).select("row.*")
