"""Encoding against the public library, and both kinds of model against plain search."""

import os
import random

import numpy as np
import pytest

from freshet.llm import pieces as P
from freshet.llm.queries import PIECES

needs_model = pytest.mark.skipif(not os.path.exists(PIECES), reason="no model file")


@pytest.fixture(scope="module")
def model():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def tables():
    return P.load_pieces(PIECES)


def awkward(model):
    random.seed(4)
    chars = "abcdeéßñ \n0123.,-_()<>#aeinrst▁"
    texts = ["", " ", "a  b", " a", "a ", "\n", "x\ty\n\nz", "   ", "日本𠀀", "\x00q", "\n \n", "ﬁ½", "<s> </s> <0x41>"]
    texts += ["".join(random.choice(chars) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    some = [model.id_to_piece(i) for i in range(259, model.get_piece_size())]
    texts += ["".join(random.choice(some) for _ in range(8)) for _ in range(3000)]
    texts += [random.choice(["a", "=", "-", " ", "the", "aa"]) * random.randint(1, 70) for _ in range(300)]
    return texts


@needs_model
def test_same_ids_as_the_library(model, tables):
    texts = awkward(model)
    ids, offsets = P.Encoder(tables).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == model.encode(texts)
    assert tables.decode(ids.astype(np.int64), offsets) == [t.replace(P.MARK, " ") for t in texts]


@needs_model
def test_whole_table(spark, data, model, tables):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "long " * 60000)], docs.schema))
    found = P.decode(P.encode(docs, tables), tables).collect()
    assert len(found) == docs.count()
    for row in found:
        assert list(row.ids) == model.encode(row.text or "")
        assert row.decoded == (row.text or "")


@needs_model
def test_forgetting_words_changes_nothing(model, tables, monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 5)
    encoder = P.Encoder(tables)
    for text in ["one two three four five six", "seven one two eight"]:
        assert encoder.encode([text])[0].tolist() == model.encode(text)


@needs_model
def test_clashing_and_extra_columns(spark, tables):
    df = spark.createDataFrame([("x", 5, "a b")], "ids string, decoded int, text string")
    found = P.decode(P.encode(df, tables), tables)
    assert found.columns == ["text", "ids", "decoded"] and found.first().decoded == "a b"
    assert P.encode(df.where("false"), tables).count() == 0


def test_unigram_finds_the_best_path():
    """A made-up unigram vocabulary against trying all segmentations."""
    random.seed(1)
    vocabulary = ["<unk>", "▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "▁▁"]
    scores = [0.0] + [random.uniform(-6, -1) for _ in vocabulary[1:]]
    tables = P.Pieces(vocabulary, scores, {}, 0, False, list(range(1, len(vocabulary))))
    known = {v: s for v, s in zip(vocabulary[1:], scores[1:])}

    def best(word):
        paths = [(0.0, ())] + [None] * len(word)
        for end in range(1, len(word) + 1):
            options = [
                (paths[start][0] + known[word[start:end]], (*paths[start][1], vocabulary.index(word[start:end])))
                for start in range(end)
                if word[start:end] in known and paths[start]
            ]
            paths[end] = max(options) if options else None
        return list(paths[-1][1])

    words = [P.MARK + "".join(random.choice("abc") for _ in range(random.randint(0, 12))) for _ in range(300)]
    flat, sizes = tables.encode_words(words)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [best(w) for w in words]


def test_merging_by_rank_against_plain_merging():
    """A made-up BPE vocabulary: the pieces are the merges of random pairs."""
    random.seed(8)
    pieces = ["<unk>", "a", "b", "c", "▁"]
    while len(pieces) < 60:
        joined = random.choice(pieces[1:4] + pieces[5:]) + random.choice(pieces[1:4] + pieces[5:])
        if joined not in pieces and len(joined) < 9:
            pieces.append(joined)
    scores = [0.0] + [-1e9] * 4 + [-float(i) for i in range(len(pieces) - 5)]
    usable = list(range(1, len(pieces)))
    tables = P.Pieces(pieces, scores, {}, 0, True, usable)
    known = {pieces[i]: i for i in usable}
    words = ["".join(random.choice("abc") for _ in range(random.randint(1, 25))) for _ in range(2000)]
    flat, sizes = tables.encode_words(words)
    got = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == [[known[s] for s in P.merged(list(w), known, tables.scores)[0]] for w in words]


def test_unspaced_text_is_cut_between_pieces():
    import time

    import sentencepiece

    pieces, model = P.load_pieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(9)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(20_000))
    few = "".join(rng.choice("的一是不了人我在有他这中大来上国") for _ in range(2_000))
    latin = "".join(rng.choice("abcdefghij") for _ in range(300))
    emoji = "".join(chr(rng.randrange(0x1F600, 0x1F640)) for _ in range(200))
    texts = [han, few, f"x {few} y\n{latin}", latin * 2, emoji + few, few + latin + emoji, f"  {han[:99]}  ", "▁" * 90 + few]
    P.Encoder(pieces).encode(["warm up " + few])
    for text in texts:
        ids, _ = P.Encoder(pieces).encode([text])
        assert ids.tolist() == model.encode(text.replace("▁", " "))
    encoder, started = P.Encoder(pieces), time.process_time()
    encoder.encode([han])
    assert time.process_time() - started < 0.3


def _message(*fields):
    """A protocol buffer message of small numbers and short byte strings."""
    return b"".join(
        bytes([number << 3, value]) if isinstance(value, int) else bytes([number << 3 | 2, len(value)]) + value for number, value in fields
    )


def test_the_model_type_is_read_from_the_file():
    plain = (4, 0)
    assert P.read_kind(_message((2, _message((3, 2))), (3, _message(plain)))) == (True, True)
    assert P.read_kind(_message((2, _message((3, 1))), (3, _message(plain, (3, 0))))) == (False, False)
    assert P.read_kind(_message((3, _message(plain)))) == (False, True)
    for broken in ([(2, _message((3, 4))), (3, _message(plain))], [(3, _message(plain, (2, b"map")))], [(3, _message())]):
        with pytest.raises(ValueError):
            P.read_kind(_message(*broken))
    assert P.load_pieces(PIECES).bpe
