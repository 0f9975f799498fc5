"""Balanced sampling: targets against plain water filling, totals against targets."""

import numpy as np
import pytest

from freshet.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, p double"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "own", 0.5) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights):
    """Share out by weight; full sources leave, the rest is shared again."""
    target, open_ = {}, set(sizes)
    rest = 1.5 * sum(sizes.values())
    while True:
        level = rest / sum(weights[s] for s in open_) if open_ else 0
        full = {s for s in open_ if weights[s] * level > 2 * sizes[s]}
        if not full:
            return target | {s: weights[s] * level for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
            open_.remove(s)


def corpus(n=3000):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        source = [None, "é", "b", "a", "Z", ""][int(rng.integers(0, 6)) if rng.random() < 0.5 else 3]
        rows.append((i, " ".join(["w"] * int(rng.lognormal(3, 1.2))), source))
    return rows + [(n, None, "a"), (n + 1, "", None), (n + 2, "w " * 4000, "b"), (5, "w w", "a"), (None, "w w w", "b")]


def test_targets_and_totals(spark):
    rows = corpus()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = plain_targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)})
    found = mixing.mix(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for source, target in want.items():
        assert taken[source] == pytest.approx(target, rel=0.01, abs=5)


def test_small_chunks_balance_as_well_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    docs = docs_of(spark, corpus())
    first, second = [sorted(map(tuple, mixing.mix(d).collect()), key=repr) for d in (docs, docs.repartition(7))]
    assert first == second
    totals = {}
    for _, _, source, _, target, _, taken in first:
        totals.setdefault(source, [target, 0])[1] += taken
    for target, got in totals.values():
        assert got == pytest.approx(target, rel=0.01, abs=5)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 500, 400).astype(float), rng.random(400)
    flown = mixing.fly(size, p, 2)
    assert ((flown > 0) & (flown < 1)).sum() <= 2
    assert flown.sum() == pytest.approx(p.sum(), abs=1e-6)
    assert (flown * size).sum() == pytest.approx((p * size).sum(), abs=1e-3)


def test_inclusion_follows_the_probabilities(monkeypatch):
    """Over many seeds every document is taken about as often as its probability says."""
    size, p = np.arange(1.0, 13.0), np.full(12, 0.3)
    total = np.zeros(12)
    for seed in range(600):
        monkeypatch.setattr(mixing, "SEED", seed)
        total += mixing.fly(size, p, 2)
    assert np.abs(total / 600 - 0.3).max() < 0.09


def test_mixed_rows(spark):
    docs = docs_of(spark, corpus(300))
    want = {}
    for r in mixing.mix(docs).collect():
        key = (r.doc_id, r.source, r.size)
        want[key] = want.get(key, 0) + r.copies
    found = mixing.mixed(docs)
    assert found.columns == docs.columns
    got = {}
    for r in found.collect():
        key = (r.doc_id, r.source, len((r.text or "").split()))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_empty_and_wordless(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    found = mixing.mix(docs_of(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r.target, r.taken) for r in found] == [(0.0, 0), (0.0, 0)]
