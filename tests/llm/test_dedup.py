"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from check import compare
from freshet.llm import exact_dedup, simhash
from freshet.llm.components import components
from freshet.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, kept string, rows int"


def docs_of(spark, rows):
    """Documents with two columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA)


AWKWARD = [
    (1, "a" * 9000), (2, "a" * 9000), (3, "a" * 8999 + "b"), (4, ""), (5, None), (None, "a" * 9000), (7, "é" * 5000),
    (8, "é" * 5000), (9, "one"), (9, "one"), (9, "two"), (None, None), (11, "x" * 4096), (12, "x" * 4096 + "y"),
    (13, "ab" * 50000), (14, "ab" * 50000), (15, "ab" * 49999 + "ac"), (None, "lonely"), (None, "lonely"),
]


def expected_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = set()
        for i in ids:
            kept = i == keep and i not in seen
            seen.add(i)
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "bits"), [(4096, 64), (64, 64), (4096, 3), (1000, 5)])
def test_exact_duplicates(spark, block, bits):
    """Also with hashes so short that distinct blocks share them."""
    found = exact_dedup.exact_duplicates(docs_of(spark, AWKWARD), block, bits)
    assert sorted(map(tuple, found.collect()), key=repr) == expected_groups(AWKWARD)


def test_exact_stage_keeps_columns_and_one_row_each(spark):
    kept = exact_dedup.drop_exact_duplicates(docs_of(spark, AWKWARD))
    assert kept.columns == ["doc_id", "text", "kept", "rows"]
    texts = [row.text or "" for row in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in AWKWARD})


def test_exact_empty(spark):
    assert exact_dedup.exact_duplicates(docs_of(spark, [])).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for k in range(i):
            if (prints[i] ^ prints[k]).bit_count() <= 2:
                root[max(find(i), find(k))] = min(find(i), find(k))
    return [find(i) for i in range(len(prints))]


def test_fingerprint_is_the_contracts():
    for text in ["", None, "One", "one TWO", "É A b c d", "a b c\ta b\nc  d", "x " * 70000, "İ K a b"]:
        assert simhash.fingerprint_of(None if text is None else text.encode()) & (2**64 - 1) == plain_fingerprint(text)


@pytest.mark.parametrize("crowd", [512, 2])
def test_near_duplicates_against_all_pairs(spark, data, crowd):
    """Whole small table; a crowd of 2 sends nearly everything through the finest code."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, None), (1001, ""), (1002, rows[0][1])]
    rows.sort()
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    want = sorted((i, f"{p:016x}", rows[r][0]) for (i, _), p, r in zip(rows, prints, roots))
    found = simhash.near_duplicates(docs_of(spark, rows), crowd)
    assert sorted(map(tuple, found.collect())) == want


def test_every_link_shares_an_anchor():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = a.copy()
    for _ in range(simhash.DISTANCE):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a), dtype=np.uint64)
    pairs = [set(zip(*(x.tolist() for x in simhash.anchors_of(fps)))) for fps in (a, b)]
    assert {row for row, _ in pairs[0] & pairs[1]} == set(range(len(a)))


def test_near_stage_keeps_one_of_each(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "quite another text here"), (None, "z z z q")]
    kept = simhash.drop_near_duplicates(docs_of(spark, rows))
    assert kept.columns == ["doc_id", "text", "kept", "rows"]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "z z z q"), (3, "a b c d"), (9, "quite another text here")]


def test_near_empty(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    random.seed(2)
    chain = [(i, i + 1) for i in range(60)]
    hub = [(200, i) for i in range(201, 260)]
    edges = [(a, b) if random.random() < 0.5 else (b, a) for a, b in chain + hub + hub[:5]]
    found = components(spark.createDataFrame(edges + [(7, 7)], "a long, b long"))
    want = {i: 0 for i in range(1, 61)} | {i: 200 for i in range(201, 260)}
    assert {r.node: r.root for r in found.collect()} == want


def test_exact_query_has_no_python(spark, data):
    plan = QUERIES["op3_exact_dedup"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_fingerprint_column(spark):
    found = spark.createDataFrame([("a b c",), (None,)], "text string").select(simhash.fingerprints(F.col("text")))
    assert [r[0] & (2**64 - 1) for r in found.collect()] == [plain_fingerprint("a b c"), 0]


def test_exact_query_equals_its_sql(spark, con, data):
    good, text = compare(spark, con, "op3_exact_dedup", data)
    assert good, text


def test_near_stage_loses_no_other_text(spark):
    """Rows without an id, and different texts of one id, go only where they are linked."""
    words = "one two three four five six seven eight nine ten".split()
    texts = [" ".join(random.Random(i).choices(words, k=40)) for i in range(7)]
    rows = [(None, t) for t in texts[:5]] + [(8, texts[5]), (8, texts[6]), (8, texts[6])]
    df = spark.createDataFrame([(i, t, "x", 1, {"k": i}) for i, t in rows], "doc_id long, text string, __id string, row int, m0 map<string,long>")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.text for r in kept.collect()) == sorted(texts)
    linked = df.unionByName(df.limit(0)).unionByName(df.where("text is not null").withColumn("doc_id", F.lit(3).cast("long")).limit(1))
    assert simhash.drop_near_duplicates(linked).count() == len(texts)


def test_near_stage_against_a_plain_version(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    want = sorted(rows[i][0] for i in set(roots))
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect()) == want


def test_stages_keep_columns_of_any_name(spark):
    from freshet.llm.mixing import mixed
    from freshet.llm.quality import statistics

    rows = [(1, "a b c", "s", 9, 9, 9, 9), (1, "a b c", "s", 9, 9, 9, 9), (2, "d e f", "s", 9, 9, 9, 9), (None, None, None, 9, 9, 9, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __first int, __take int, __w int, mix int")
    assert exact_dedup.drop_exact_duplicates(df).count() == 3
    for found in (exact_dedup.drop_exact_duplicates(df), simhash.drop_near_duplicates(df), mixed(df), statistics(df)):
        assert found.columns[: len(df.columns)] == df.columns
        assert {tuple(r[3:7]) for r in found.collect()} <= {(9, 9, 9, 9)}


def test_stages_with_empty_tables(spark):
    from freshet.llm.mixing import mixed

    empty = docs_of(spark, []).withColumn("source", F.lit("s"))
    for stage in (exact_dedup.drop_exact_duplicates, simhash.drop_near_duplicates, mixed):
        assert stage(empty).collect() == []
