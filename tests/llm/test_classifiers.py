"""Toxicity, quality rules and personal data: exact parts against brute force, learned parts held out."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F

from freshet.llm import boosting, pii, quality, toxicity
from freshet.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def planted(n=900):
    """Toxic texts mention a group together with an insult; either alone is clean."""
    random.seed(6)
    filler = ["w" + "".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = random.sample(filler, 40)
        insult, group = random.random() < 0.5, random.random() < 0.5
        words += ["zork"] * insult + ["martians"] * group
        random.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(insult and group)))
    return rows, labels


def test_pairs_of_terms_are_learnt(spark):
    rows, labels = planted()
    docs = spark.createDataFrame([(*r, 0.1, "p") for r in rows], "doc_id long, text string, score double, predicted string")
    found = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS))
    truth = {i: t for i, _, t in labels}
    held = [r for r in found.collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held) and len(held) > 200
    right = sum(int(r.predicted == truth[r.doc_id]) for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in held)


def test_toxicity_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a"), (1, None), (1, None), (2, ""), (3, "x " * 60000)], "doc_id long, text string"
    )
    for labels in ([], [(1, 1, None), (None, 1, 1)], [(2, 1, 1), (2, 1, 0), (3, 0, 0)]):
        found = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
        assert not next(r for r in found if r.doc_id is None).held_out
    assert toxicity.toxicity(docs.where("false"), spark.createDataFrame([], LABELS)).count() == 0


def test_toxicity_never_learns_held_out_labels(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, x).select("doc_id", "score").collect())) for x in (labels, turned))
    assert a == b


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    odd = ["", None, "a", "a b", "a a a a", "a b c a b c", "x\n x\nx\n\n \nx", "é|é b c", "a b c d " * 20000, "𝒳𝒳 a\x0bb\x1cc"]
    rows = docs.unionByName(spark.createDataFrame([(-i, t) for i, t in enumerate(odd, 1)], docs.schema))
    for row in quality.statistics(rows).collect():
        assert tuple(row[name] for name in quality.BASE) == plain_statistics(row.text), row.doc_id


def test_quality_rules_on_held_out_rows(spark, data):
    """Rules learnt from even rows keep the good and drop the bad of the odd ones."""
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = [r for r in found.collect() if not r.base_failed]
    right = sum(int(r.kept == bool(r.quality)) for r in rows)
    assert rows and right / len(rows) > 0.9
    assert all(not r.kept for r in found.collect() if r.base_failed)


def test_rules_cover_planted_junk():
    random.seed(3)
    names = list(quality.STATISTICS)
    rows = []
    for _ in range(900):
        row = {n: random.random() for n in names}
        row["bad"] = int(row["symbol_share"] > 0.8 or (row["repeat_share"] > 0.7 and row["n_words"] < 0.5))
        rows.append(row)
    rules = quality.learn_rules(rows)
    wrong = sum(any(all(c.holds(r) for c in rule) for rule in rules) != bool(r["bad"]) for r in rows)
    assert wrong / len(rows) < 0.05
    assert quality.learn_rules([]) == []


def test_quality_without_labels_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "k", 1.5), (None, None, "k", 2.5)], "doc_id long, text string, kept string, n_words double")
    found = quality.quality(docs, spark.createDataFrame([], LABELS))
    assert [(r.n_words, r.base_failed, r.kept) for r in found.orderBy("n_words").collect()] == [(0, True, False), (2, True, False)]
    assert found.where("kept").count() == 0


def test_quality_query_has_no_python(spark, data):
    plan = QUERIES["op2_quality_rules"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_pii(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(start, pii.KINDS[k], end) for start, k, end in sorted(found)]


def test_base_patterns_against_plain_expressions():
    random.seed(2)
    pool = ["a@b.c", "@", ".", "1", "22", "255", "256", "007", "+", "-", " ", "(", ")", "x", "_", "4111 1111 1111 1111", "@b.c-d.e", "é", "+1 (017) 555-7713"]
    for _ in range(6000):
        text = "".join(random.choice(pool) for _ in range(random.randint(0, 14)))
        assert pii.base_spans(text) == plain_pii(text), text


def test_long_runs_are_quick():
    for text in ["a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 150_000]:
        pii.base_spans(text)
        pii.candidates(text)


def test_pii_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "ann@x.org " * 3000), (None, "b@c.de")], docs.schema))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = pii.pii_digest(pii.personal_data(docs)).collect()
    assert len(found) == len(texts)
    for row in found:
        base = plain_pii(texts[row.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for a, k, b in base)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(s[1] == k for s in base) for k in pii.KINDS)
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))


def test_trees_find_what_is_written_alike(spark):
    """Phone numbers without a plus sign, in the company of phone numbers; codes elsewhere stay."""
    random.seed(9)

    def digits(n):
        return "".join(random.choice("0123456789") for _ in range(n))

    rows = []
    for i in range(1500):
        kind = i % 3
        if kind == 0:
            rows.append((i, f"please call me at phone +1 555 {digits(3)} {digits(4)} today"))
        elif kind == 1:
            rows.append((i, f"the order code was {digits(3)} {digits(3)} {digits(4)} in total"))
        else:
            rows.append((i, f"write to user{digits(3)}@mail.example.com soon"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.personal_data(docs).collect()
    assert all("phone" not in r.spans for r in found if r.doc_id % 3 == 1)
    assert all(r.spans.startswith(("phone", "email")) for r in found if r.doc_id % 3 != 1)


def test_pii_learns_from_every_document(spark, monkeypatch):
    """Company seen in no small part of the table counts, and both ways of growing give the same trees."""
    plain = spark.range(30_000).selectExpr("id AS doc_id", "'nothing to see, code 123 456 7890 here' AS text")
    rare = spark.range(30_000, 30_400).selectExpr("id AS doc_id", "concat('ring at home +1 555 222 ', 1000 + id % 9000, ' tonight') AS text")
    docs = plain.unionByName(rare)
    judge = pii.learn(docs)
    proposed = pii._proposed(docs)
    # Each number is proposed as a card and as a phone.
    assert proposed.agg(F.sum("n")).first()[0] == 60_800
    assert proposed.where("label = 1").agg(F.sum("n")).first()[0] == 400
    text = "ring at home 001 555 222 1234 tonight"
    assert [s[1] for s in judge.added(text, [])] == ["phone"]
    assert judge.added("nothing to see, code 123 456 7890 here", []) == []
    monkeypatch.setattr(boosting, "ROUNDS", 4)
    few = rare.unionByName(plain.where("doc_id < 500"))
    here, there = pii.learn(few), pii.learn(few, at_driver=0)
    assert here.threshold == there.threshold and here.trees.bias == there.trees.bias
    for a, b in zip(here.trees.value + here.trees.limit, there.trees.value + there.trees.limit):
        assert np.array_equal(a, b)


def test_redaction():
    assert pii.redacted("mail a@b.cd now", "email:5:11") == "mail [email] now"
    assert pii.redacted("abcdef", "ip:1:4,card:2:5") == "a[ip]f"
    assert pii.redacted(None, "") is None


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(x[:1500], y[:1500])
    assert ((trees.margins(x[1500:]) > 0) == y[1500:]).mean() > 0.95
    assert boosting.fit(x[:0], y[:0]).margins(x[:3]).shape == (3,)


def test_pii_empty(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name", ["op5_toxicity", "op7_pii"])
def test_reruns_agree(spark, data, name):
    a, b = (sorted(map(tuple, QUERIES[name](spark, data).collect())) for _ in range(2))
    assert a == b
