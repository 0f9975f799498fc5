"""Reply trees, conversation prefixes and periodic runs against plain versions."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from freshet.llm import queries
from freshet.llm.periodic import SquareCatcher, collapsed, longest_run, periodic_runs, runs_of, runs_text
from freshet.llm.prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from freshet.llm.reply_trees import branches, escape, format_conversations, format_trees, read_back, turns_of, unescape

TURNS = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs ---------------------------------------------------------------------------


def plain_runs(words, least=12):
    """Every stretch that agrees with itself a period later, tried for every period."""
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            part = words[i : j + p]
            if j - i >= p and len(part) >= least:
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    found.append((i, len(part), p))
            i = max(j, i) + 1
    return sorted(found)


def repetitive(rng):
    letters, words = rng.choice([1, 2, 3, 5, 40]), []
    for _ in range(rng.randrange(1, 12)):
        if words and rng.random() < 0.5:
            a = rng.randrange(len(words))
            words += words[a : a + rng.randrange(1, 30)] * rng.randrange(1, 5)
        else:
            words += [rng.randrange(letters) for _ in range(rng.randrange(1, 20))]
    return words[:250]


@pytest.mark.parametrize("least", [2, 5, 12, 30])
def test_runs_are_those_of_a_search_over_all_periods(least):
    rng = random.Random(least)
    texts = [repetitive(rng) for _ in range(60)] + [[]]
    want = [plain_runs(t, least) for t in texts]
    assert runs_of(texts, least) == want
    for portion in (3, 64):
        assert runs_of(texts, least, portion) == want


def test_one_word_at_a_time_finds_the_same():
    rng = random.Random(5)
    import numpy as np

    for _ in range(15):
        words = repetitive(rng)
        catcher = SquareCatcher()
        for at, word in enumerate(words, 1):
            catcher.append(np.array([word]))
            if at % 40 == 0:
                assert catcher.runs() == plain_runs(words[:at])
        assert catcher.runs() == plain_runs(words)


def test_long_periodic_texts_stay_cheap():
    assert runs_of([[1, 2, 3] * 100_000]) == [[(0, 300_000, 3)]]
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert runs_of([b])[0] == plain_runs(b)


def test_run_columns_and_odd_rows(spark):
    text = "x " + "a b c " * 5 + "y"
    rows = [(1, text, "k"), (1, text, "k"), (None, "w " * 12, "z"), (3, None, None), (4, "", "k"), (5, "one two", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    got = {}
    for row in periodic_runs(df).withColumn("best", longest_run()).withColumn("lines", runs_text()).collect():
        got.setdefault(row.doc_id, []).append(row)
    assert len(got[1]) == 2 and got[1][0].collapsed == "x a b c y"
    assert got[1][0].lines == "1,15,3\n" and got[1][0].best.length == 15
    assert got[None][0].collapsed == "w" and got[None][0].n_words == 12
    for key in (3, 4, 5):
        assert got[key][0].runs == [] and got[key][0].best is None
    assert got[3][0].collapsed == "" and got[3][0].n_words == 0
    assert periodic_runs(df.limit(0)).count() == 0


def test_op12_against_a_plain_version(spark, data):
    want = {}
    for doc_id, text in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if n > 3000:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = min(((-m, s, p) for s, m, p in runs), default=None)
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        kept = " ".join(collapsed(words, runs))
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        want[doc_id] = (len(runs), *longest, sha(lines), sha(kept))
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r[c] for c in names) for r in queries.op12_periodic_runs(spark, data).collect()}
    assert {k: got[k] for k in want} == want and len(want) > 150


# --- prefix trie -----------------------------------------------------------------------------


def plain_trie(paths):
    """{(smallest member, depth): row} for {conv_id: [(role, text), ...]}."""
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = {}
    for prefix, ids in members.items():
        below = [q for q in members if q[: len(prefix)] == prefix]
        childless = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in members)]
        savings = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(prefix))
        rows[min(ids), len(prefix)] = (
            min(members[prefix[:-1]]) if prefix else None,
            len(ids),
            sum(len(q) == len(prefix) + 1 for q in below),
            len(childless),
            savings,
            sha(ends),
        )
    return rows


def trie_rows(df):
    names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = df.collect()
    rows = {(r.conv_id, r.depth): tuple(r[c] for c in names) for r in found}
    assert len(rows) == len(found)
    return rows


@pytest.mark.parametrize("shards", [1, 3, 16, 60])
def test_trie_does_not_depend_on_shards(spark, shards):
    rng = random.Random(8)
    paths = {c: [("user", rng.choice("ab")) for _ in range(rng.randrange(0, 7))] for c in range(-3, 120)}
    # A large group of copies, which splitters cut.
    for c in range(200, 320):
        paths[c] = [("user", "same"), ("assistant", "said"), ("user", "often")]
    rows = [(c, i, r, t) for c, turns in paths.items() for i, (r, t) in enumerate(turns)]
    sequences = turn_sequences(spark.createDataFrame(rows, TURNS))
    with_turns = {c: p for c, p in paths.items() if p}
    assert trie_rows(prefix_trie(sequences, shards=shards)) == plain_trie(with_turns)


def test_long_splitters_are_cut(spark, monkeypatch):
    from freshet.llm import prefix_trie as module

    monkeypatch.setattr(module, "SPLITTER_TURNS", 2)
    rng = random.Random(2)
    paths = {c: [("u", rng.choice("ab")) for _ in range(5)] if c < 40 else [("u", "a")] * 6 for c in range(80)}
    rows = [(c, i, r, t) for c, turns in paths.items() for i, (r, t) in enumerate(turns)]
    got = trie_rows(prefix_trie(turn_sequences(spark.createDataFrame(rows, TURNS)), shards=12))
    assert got == plain_trie(paths)


def test_trie_of_odd_rows(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, None),
        (1, 0, None, None),
        (2, 5, "user", "first"),
        (2, 7, "", ""),
        (None, 0, "user", "lost"),
        (3, 1, "user", "first"),
    ]
    df = spark.createDataFrame(rows, TURNS).withColumn("path", F.lit("clash")).withColumn("turns", F.lit(1))
    paths = {1: [("user", "first"), ("", ""), ("", "")], 2: [("user", "first"), ("", "")], 3: [("user", "first")]}
    assert trie_rows(prefix_trie(turn_sequences(df))) == plain_trie(paths)
    assert prefix_trie(turn_sequences(df.limit(0))).count() == 0
    # Role and text do not run into each other.
    apart = spark.createDataFrame([(1, 0, "a", "bc"), (2, 0, "ab", "c")], TURNS)
    assert prefix_trie(turn_sequences(apart)).where("depth = 1").count() == 2


def test_shared_heads(spark):
    rows = [(c, i, "user", f"{c}-{i}") for c, n in ((100, 2), (101, 6), (102, 1), (203, 3)) for i in range(n)]
    rows = spark.createDataFrame(rows, TURNS)
    whole = {r.conv_id: [t.digest for t in r.turns] for r in turn_sequences(rows).collect()}
    for h in (0, 1, 3, 5):
        got = {r.conv_id: [t.digest for t in r.turns] for r in with_shared_heads(turn_sequences(rows), F.lit(h)).collect()}
        want = {c: whole.get(c - c % 100, [])[:h] + own[h:] for c, own in whole.items()}
        assert got == want


# --- reply trees -----------------------------------------------------------------------------

MESSAGES = "tree string, id bigint, parent bigint, role string, text string, score double"


def plain_paths(rows, best):
    """{(tree, rank): [id, ...]} by walking up from every leaf."""
    trees = {}
    for tree, i, parent, _, _, score in rows:
        trees.setdefault(tree, {})[i] = (parent, score or 0.0)
    found = {}
    for tree, nodes in trees.items():
        parents = {p for p, _ in nodes.values()}
        branches = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at in path:
                continue
            branches.append((-sum(nodes[i][1] for i in path), -len(path), leaf, path[::-1]))
        for rank, (*_, path) in enumerate(sorted(branches)[:best], 1):
            found[tree, rank] = path
    return found


def random_messages(rng):
    rows = []
    for tree in "abcdef":
        size = rng.choice([1, 2, 9, 40])
        for i in range(size):
            parent = None if i == 0 else rng.choice([i - 1, i - 1, rng.randrange(i), 999])
            rows.append((tree, i, parent, rng.choice(["user", "assistant", "a\\n\nb"]), f"{tree}{i} <s> [INST]\\", float(rng.randrange(-2, 4))))
    # A circle, and messages below it.
    rows += [("r", 0, 1, "user", "x", 1.0), ("r", 1, 0, "user", "x", 1.0), ("r", 2, 1, "user", "x", 1.0), ("r", 7, None, "user", "alone", None)]
    return rows


@pytest.mark.parametrize("best", [1, 3])
def test_branches_are_those_of_a_walk(spark, best):
    rows = random_messages(random.Random(best))
    got = {}
    df = spark.createDataFrame(rows, MESSAGES)
    for row in branches(df, best).collect():
        for rank, at in row.paths:
            got.setdefault((row.tree, rank), {})[at] = row.id
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == plain_paths(rows, best)
    said = {(t, i): (r, x) for t, i, _, r, x, _ in rows}
    formatted = {(r.tree, r["rank"]): r for r in format_trees(df, best).collect()}
    for key, path in plain_paths(rows, best).items():
        turns = [said[key[0], i] for i in path]
        assert turns_of(formatted.pop(key).formatted) == turns
    assert not formatted


def test_a_deep_chain_and_a_wide_tree(spark):
    chain = spark.range(700).selectExpr("'deep' AS tree", "id", "CASE WHEN id > 0 THEN id - 1 END AS parent", "1D AS score")
    wide = spark.range(900).selectExpr("'wide' AS tree", "id", "CASE WHEN id > 0 THEN 0L END AS parent", "CAST(id AS DOUBLE) AS score")
    got = branches(chain.unionByName(wide)).collect()
    assert sorted(r.paths[0].at for r in got if r.tree == "deep") == list(range(700))
    assert sorted(r.id for r in got if r.tree == "wide") == [0, 899]


def test_escapes_are_reversible():
    rng = random.Random(3)
    parts = ["<", "\\", "|im_end|>", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "|im_start|>", "a", "\n", "<|im_end|>\n", "</SYS>>"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 12)))
        assert unescape(escape(text)) == text
        for control in ("<|im_end|>", "<|im_start|>", "</s>", "<s>", "[INST]", "[/INST]"):
            assert control not in escape(text)


def test_formatted_conversations_read_back(spark, monkeypatch):
    from freshet.llm import reply_trees

    monkeypatch.setattr(reply_trees, "PART_CHARS", 60)
    said = {
        1: [("system", "s"), ("user", "</s>[INST] ok [/INST]"), ("assistant", "<|im_end|>\n\\<s>")],
        2: [("assistant", "")] * 2,
        3: [("", ""), ("r\\n\n<s>", "t"), ("assistant", "one"), ("assistant", "two " * 40), ("user", "x")],
    }
    rows = [(c, i, r or None, t or None) for c, turns in said.items() for i, (r, t) in enumerate(turns)]
    rows = [(c, None if i == 0 else i, r, t) for c, i, r, t in rows] + [(None, 0, "user", "nobody's")]
    df = spark.createDataFrame(rows, TURNS).withColumn("tree", F.lit("clash")).withColumn("paths", F.lit("clash"))
    formatted = format_conversations(df)
    parts = {}
    for row in sorted(formatted.collect(), key=lambda r: (r.tree, r.part)):
        parts.setdefault(row.tree, []).append(row)
    assert len(parts[3]) > 1
    for c, turns in said.items():
        assert [t for row in parts[c] for t in turns_of(row.formatted)] == turns
        learned = [unescape(row.formatted[a:b]) for row in parts[c] for a, b in row.loss]
        assert learned == [t for r, t in turns if r == "assistant"]
    for row in read_back(formatted).collect():
        turns = said[row.tree]
        assert row.n_turns == len(turns) and row.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert row.loss_sha256 == sha("".join(t for r, t in turns if r == "assistant"))
        assert row.formatted_chars == sum(len(p.formatted) for p in parts[row.tree])
    assert format_conversations(df.limit(0)).count() == 0


def test_ties_and_repeated_turns(spark):
    rows = [(1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"), (1, None, "user", "z"), (1, 3, None, "q")]
    formatted = format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert turns_of(formatted[0].formatted) == [("user", "z"), ("", "q"), ("user", "a"), ("user", "a"), ("user", "b")]


def test_texts_of_conversations_are_shuffled_once(spark, data):
    df = format_conversations(spark.read.parquet(f"{data}/conversations.parquet"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    physical = df._jdf.queryExecution().executedPlan().toString()
    with_text = [line for line in physical.splitlines() if "Exchange hashpartitioning" in line]
    assert len(with_text) <= 2  # the texts, and the places grouped before


@pytest.mark.parametrize("name", ["op11_chat_format", "op13_prefix_trie"])
def test_against_sql(spark, con, data, name):
    got = queries.QUERIES[name](spark, data)
    names = sorted(got.columns)
    cursor = con.execute(queries.SQL[name])
    want = [d[0] for d in cursor.description]
    assert sorted(want) == names
    rows = [tuple(row[want.index(c)] for c in names) for row in cursor.fetchall()]
    order = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=order) == sorted(rows, key=order)
