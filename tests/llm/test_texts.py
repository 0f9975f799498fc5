"""Secrets, pages, language-model scores and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from freshet.llm import html_text, lm, secret_scan
from freshet.llm.pieces import load_pieces
from freshet.llm.queries import PIECES, QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_base_secrets_against_plain_expressions(spark, data):
    random.seed(5)
    pool = ["token", "SECRET", "api_key", "apikey", "paſſwd", "PassWord", '"', "'", " ", ":", "=", "abc", "a" * 24, "AKIA", "Z9" * 9, "é𝒳", "\n", "=short", "0f" * 13]
    texts = ["".join(random.choice(pool) for _ in range(random.randint(0, 12))) for _ in range(1500)]
    texts += [None, "", "token = abcdef " * 2000] + [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "b", 1) for i, t in enumerate(texts)] + [(None, "token=abcdef", "b", 1)], "doc_id long, text string, base string, spans int")
    found = secret_scan.secret_digest(secret_scan.secrets(docs)).collect()
    assert len(found) == len(texts) + 1
    for row in found:
        base = plain_secrets(texts[row.doc_id] or "" if row.doc_id is not None else "token=abcdef")
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), row.doc_id
        assert set(base) <= set(row.spans.split(",")) | ({""} if not base else set())


def test_battery_tells_keys_from_words(spark):
    """Random keys long enough for the tests to tell are found, identifiers and paths of words are not."""
    random.seed(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["user", "Name", "value2", "Count", "request", "Handler", "index1", "Total", "service", "Error"]
    rows, keys = [], set()
    for i in range(400):
        if i % 2:
            rows.append((i, "the " + "".join(random.choice(letters) for _ in range(random.randint(34, 48))) + " end"))
            keys.add(i)
        else:
            rows.append((i, "the " + "".join(random.choice(words) for _ in range(9)) + " end"))
    found = secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = {r.doc_id for r in found if r.spans}
    assert len(hit & keys) / len(keys) > 0.9
    assert len(hit - keys) / 200 < 0.1


def test_keys_after_equals_signs_and_slashes_are_found(spark):
    random.seed(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    frames = ["aws_access_value={}", "https://x.example/get?sig={}", "/some-path/of_files/{}", "SIG={}=", "/a-b/k={}"]
    rows, spans = [], {}
    for i in range(100):
        frame, key = frames[i % len(frames)], "".join(random.choice(letters) for _ in range(44))
        at = frame.index("{")
        rows.append((i, "see " + frame.format(key) + " end"))
        spans[i] = f"random:{4 + at}:{4 + at + 44 + (frame[-1] == '=')}"
    found = {r.doc_id: r.spans for r in secret_scan.secret_digest(secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for k in range(len(frames)):
        assert sum(found[i] == spans[i] for i in range(k, 100, len(frames))) >= 16, frames[k]


def test_secrets_empty_and_native(spark, data):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secret_scan.secrets(empty).count() == 0
    plan = QUERIES["op6_secrets"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>"
    "<nav><ul><li>Home<li>News</ul></nav><div class='cookie-notice'>We use</div><main><article><h1>A &amp; B</h1>"
    "<p>One  <b>two</b><br>three<p>Four<ul><li>x<li>y</ul><div id=comments><p>I agree</div>"
    "<form>Sign<input></form></article></main><aside>More</aside><footer>&copy;</footer><script>if(a<b){'</p>'}</script></body></html>"
)


def test_article_of_a_page():
    assert html_text.main_text(PAGE) == "A & B\n\nOne two three\n\nFour\n\nx\n\ny"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain <", "plain <"), ("<p>a<p>b", "a\n\nb"), ("<article>cut off <b", "cut off"),
        ("<script>var a='<p>x</p>'", ""), ("<div>a&nbsp;&#233;&lt;</div>", "a é<"), ("<!-- <p>no</p> --><p>yes", "yes"),
        ("<p>a</div></span>b</p>", "ab"), ("<article><p>in</p></article><p>out</p>", "in"), ("<P>Up</P><BR/>per", "Up\n\nper"),
    ],
)
def test_broken_pages(page, text):
    assert html_text.main_text(page) == text


def test_deep_pages_end():
    assert html_text.main_text("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"


def test_templates_are_cut_per_host_and_articles_are_not(spark):
    page = "<body><div><p>Welcome to the site</p></div><div><p>Story number {0}</p></div></body>"
    shared = "<body><article><p>Same sentence</p><p>Own {0}</p></article></body>"
    rows = [(i, f"http://A.example:80/{i}", page.format(i), "t") for i in range(8)]
    rows += [(100 + i, f"https://b.example/{i}", shared.format(i), "t") for i in range(8)]
    rows += [(200, "http://c.example/", page.format(0), "t"), (None, None, None, "t"), (3, "http://A.example:80/3", page.format(3), "t")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(found) == len(rows)
    text = {(r.page_id, r.url): (r.text, r.n_chars) for r in found}
    assert text[3, "http://A.example:80/3"] == ("Story number 3", 14)
    assert text[101, "https://b.example/1"][0] == "Same sentence\n\nOwn 1"
    assert text[200, "http://c.example/"][0] == "Welcome to the site\n\nStory number 0"
    assert text[None, None] == ("", 0)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("copies", [3, 60])
def test_copies_of_a_page_make_no_template(spark, copies):
    page = "<body><div><p>A story</p><p>told {0}</p></div></body>"
    rows = [(i, "http://a.example/", page.format("often")) for i in range(copies)] + [(0, "http://b.example/", page.format("again"))] * copies
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 2 * copies
    assert {(r.url, r.text) for r in found} == {("http://a.example/", "A story\n\ntold often"), ("http://b.example/", "A story\n\ntold again")}


def test_only_blocks_on_a_share_of_the_host_are_templates(spark):
    page = "<body><div><p>Welcome</p></div>{1}<div>Do <em>not</em> go, {0}<table><tr><td>0</td><td>{0}</td></tr></table></div></body>"
    rows = [(i, "http://a.example/", page.format(i, "<p>Thanks.</p>" if i < 60 else "")) for i in range(400)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    text = {r.page_id: r.text for r in found.collect()}
    assert text[7] == "Thanks.\n\nDo not go, 7\n\n0\n\n7"
    assert text[99] == "Do not go, 99\n\n0\n\n99"


def test_containers_that_articles_share_are_cut(spark):
    page = "<body><article><h1>Title {0}</h1><p>Same sentence</p><p>Own {0}</p><div class=bar7><a>Pass it on</a></div><div>{1}</div></article></body>"
    rows = [(i, "http://a.example/", page.format(i, "Seen twice" if i < 4 else i)) for i in range(9)]
    rows += [(i, "http://b.example/", f"<body><p>{i}</p><article><div>The story</div></article></body>") for i in range(9)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    text = {(r.page_id, r.url): r.text for r in found.collect()}
    assert text[2, "http://a.example/"] == "Title 2\n\nSame sentence\n\nOwn 2\n\nSeen twice"
    assert text[8, "http://a.example/"] == "Title 8\n\nSame sentence\n\nOwn 8\n\n8"
    assert text[5, "http://b.example/"] == "The story"


def test_pages_table(spark, data):
    """The table's articles, read with a plain expression."""
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for row in QUERIES["op8_html"](spark, data).collect():
        article = re.search("<article>(.*?)</article>", pages[row.page_id], re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?p>|</?h1>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b)


def test_pseudo_likelihood_adds_up(spark):
    """Against the definition, place by place, with the full table of probabilities."""
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, ""), (3, None), (None, "cat"), (1, "the cat sat on the mat")], "doc_id long, text string")
    vocabulary = lm.learn_vocabulary(docs)
    texts = lm.spelled(docs, vocabulary)
    weights = lm.train(texts, vocabulary, 1)
    found = {r.doc_id: r for r in lm.pseudo_likelihood(texts, weights).collect()}
    symbols = [0, 0] + [vocabulary.symbol(w) for w in b"the cat sat on the mat".split()] + [0, 0]
    total = 0.0
    for at in range(2, len(symbols) - 2):
        near = np.array([[symbols[at - 2], symbols[at - 1], symbols[at + 1], symbols[at + 2]]] * lm.SYMBOLS)
        table = lm.log_probabilities(weights, near, np.arange(lm.SYMBOLS))
        assert np.exp(table).sum() == pytest.approx(1.0, abs=1e-4)
        total += table[symbols[at]]
    assert found[1].log_prob == pytest.approx(total, abs=1e-4)
    assert (found[2].log_prob, found[2].per_word, found[3].n_words) == (0.0, None, 0)
    assert lm.score_documents(docs.where("false")).count() == 0


def test_every_place_is_trained_on_once():
    symbols = np.arange(1000, dtype=np.int16)
    rounds = [lm._masked(symbols, 77, turn, lm.ROUNDS) for turn in range(lm.ROUNDS)]
    assert sorted(np.concatenate(rounds).tolist()) == list(range(1000))


def test_both_sides_are_learnt(spark):
    """After training, real sentences score better than the same words shuffled."""
    random.seed(3)
    sentence = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for i in range(600):
        start = random.randint(0, 9)
        rows.append((i, " ".join((sentence * 30)[start : start + 200])))
    shuffled = [(1000 + i, " ".join(random.sample(text.split(), 200))) for i, text in rows[:50]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = lm.learn_vocabulary(docs)
    weights = lm.train(lm.spelled(docs, vocabulary), vocabulary, 2)
    both = spark.createDataFrame(rows[:50] + shuffled, "doc_id long, text string")
    found = lm.pseudo_likelihood(lm.spelled(both, vocabulary), weights).collect()
    real, mixed = (np.mean([r.per_word for r in found if (r.doc_id >= 1000) == late]) for late in (False, True))
    assert real > mixed + 0.5


def test_pipeline_stages(spark, data):
    """Each stage on its own input: columns, what goes and what stays."""
    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 120")
    shapes = []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.saved(stage(spark, docs, data), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
            assert after.select("doc_id").exceptAll(docs.select("doc_id")).where("false").count() == 0
        if name == "exact_dedup":
            assert after.count() == docs.select("text").distinct().count() == after.select("text").distinct().count()
        if name == "simhash_near_dedup":
            assert after.count() <= docs.count() and after.join(docs, "doc_id", "left_anti").count() == 0
        shapes.append(after.count())
        docs = after
    tokens = load_pieces(PIECES)
    assert docs.columns == ["doc_id", "source", "ids"] and shapes[-1] == shapes[-2] and tokens.size == 32000


def test_pipeline_on_an_empty_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
    assert docs.count() == 0


def corpus_rows(seed=5, n=300):
    random.seed(seed)
    stems = ["".join(random.choice("bcdfghklmnprst") + random.choice("aeiou") for _ in range(3)) for _ in range(1800)]
    weights = [1 / (i + 3) for i in range(len(stems))]
    return [(i, " ".join(random.choices(stems, weights, k=random.randint(30, 90)))) for i in range(n)], stems


def test_scores_do_not_follow_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_PLACES", 4000)
    rows, _ = corpus_rows()
    docs = spark.createDataFrame([*rows, rows[0], (None, None)], "doc_id long, text string")
    scores = [
        sorted((r.doc_id or -1, r.log_prob) for r in lm.score_documents(docs.repartition(n)).collect()) for n in (1, 7)
    ]
    assert [a for a, _ in scores[0]] == [a for a, _ in scores[1]] and len(scores[0]) == len(rows) + 2
    assert np.allclose([b for _, b in scores[0]], [b for _, b in scores[1]], atol=1e-3)


def test_made_up_words_score_worse_than_rare_ones(spark):
    rows, stems = corpus_rows()
    rare = set(stems[900:])
    shown, spoilt = [], []
    for i, text in rows[:60]:
        garbled = ["".join(random.choice("qxzwvj") for _ in w[:-3]) + w[-3:] if w in rare else w for w in text.split()]
        shown.append((1000 + i, text))
        spoilt.append((2000 + i, " ".join(garbled)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = lm.learn_vocabulary(docs)
    weights = lm.train(lm.spelled(docs, vocabulary), vocabulary)
    found = lm.pseudo_likelihood(lm.spelled(spark.createDataFrame(shown + spoilt, "doc_id long, text string"), vocabulary), weights)
    score = {r.doc_id: r.log_prob for r in found.collect()}
    changed = sum(a != b for (_, x), (_, y) in zip(shown, spoilt) for a, b in zip(x.split(), y.split()))
    lost = sum(score[1000 + i] - score[2000 + i] for i, _ in rows[:60])
    assert changed > 100 and lost / changed > 1


def test_parts_of_a_symbol_add_up(spark, monkeypatch):
    """The known words of a bucket, its others and one unseen word share its symbol."""
    rows, _ = corpus_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for known in (1 << 17, 1000):
        monkeypatch.setattr(lm, "KNOWN", known)
        found = lm.learn_vocabulary(docs)
        seen = {w.encode() for _, t in rows for w in t.split()}
        total = np.zeros(lm.SYMBOLS)
        for word in seen:
            places = found.places(word.decode())
            total[found.symbols[places[0]]] += np.exp(found.parts[places[0]])
        for bucket in range(lm.SYMBOLS - lm.SHARED, lm.SYMBOLS):
            total[bucket] += np.exp(found.parts[len(found.symbols) - lm.SYMBOLS + bucket])
        assert np.allclose(total[lm.SYMBOLS - lm.SHARED :], 1)
        own = [found.symbol(w) for w in seen if found.symbol(w) < lm.SYMBOLS - lm.SHARED]
        assert len(own) == len(set(own)) == 767


def test_words_are_looked_up_together(spark, monkeypatch):
    """All words of a text in one look-up, as split by the definition; an ending is hashed once, not once a word."""
    vocabulary = lm.learn_vocabulary(spark.createDataFrame([(1, "the cat sat on the mat")], "doc_id long, text string"))
    known = vocabulary.known.to_pylist()
    asked, bucket = [], lm._bucket
    monkeypatch.setattr(lm, "_bucket", lambda word: asked.append(word) or bucket(word))
    texts = ["  The\tcat\x0b\x0csat ", None, "", " \r\n", "the\u00a0cat a\x1cb \u00c9T\u00c9 x", " ".join(f"{i}ing" for i in range(500))]
    places, lengths = vocabulary.spell(texts)
    words = [text.lower().encode().split() if text else [] for text in texts]
    assert lengths.tolist() == [len(w) for w in words]
    plain = [known.index(w.decode()) if w.decode() in known else len(known) + bucket(w) for text in words for w in text]
    assert places.tolist() == plain
    assert len(asked) <= 6


def test_counts_are_those_of_all_words(spark, monkeypatch):
    """Whatever the chunks, and with rows that are empty or longer than a chunk."""
    monkeypatch.setattr(lm, "CHUNK", 40)
    rows, _ = corpus_rows(n=60)
    docs = spark.createDataFrame([*rows, rows[0], (None, None), (7, " \n")], "doc_id long, text string").repartition(3)
    vocabulary = lm.learn_vocabulary(docs)
    seen = Counter(w for _, text in [*rows, rows[0]] for w in text.split())
    assert vocabulary.counts.sum() == sum(seen.values())
    assert all(vocabulary.counts[vocabulary.symbol(w.encode())] == n for w, n in seen.most_common(50))
    spelt = {r.doc_id: r.symbols for r in lm.spelled(docs, vocabulary).collect()}
    assert all(spelt[i] == [vocabulary.symbol(w.encode()) for w in text.split()] for i, text in rows if i != 7) and spelt[None] == []


def test_steps_follow_the_definition(monkeypatch):
    """Steps with some classes absent against gradients of the plain formula; the largest logit is not taken in every step."""
    rng = np.random.default_rng(1)
    vocabulary = lm.Vocabulary(None, None, None, rng.integers(0, 50, lm.SYMBOLS).astype(float))
    n = 2 * lm.STEP + 70
    near, target = (rng.integers(0, lm.SYMBOLS // 3, shape).astype(np.int16) for shape in ((n, 2 * lm.SIDE), n))
    target[lm.STEP :] = target[lm.STEP :] // lm.CLASSES * lm.CLASSES + target[lm.STEP :] % 5
    start = lm.first_weights(vocabulary)
    asked, largest = [], lm._largest
    monkeypatch.setattr(lm, "_largest", lambda *a: asked.append(1) or largest(*a))
    own = lm.Replica(start)
    own.descend(near, target)
    assert len(asked) == 2
    w = {name: x.astype(float) for name, x in start.items()}
    moved = {name: np.full_like(x, 1e-4) for name, x in w.items()}
    for at in range(0, n, lm.STEP):
        a, t = near[at : at + lm.STEP], target[at : at + lm.STEP]
        klass, member, every = t % lm.CLASSES, t // lm.CLASSES, np.arange(len(t))
        x = w["embed"][a].reshape(len(t), -1)
        hidden = np.tanh(x @ w["hidden"] + w["hidden_bias"])
        outer = np.exp(hidden @ w["classes"].T + w["class_bias"])
        inner = np.exp(np.einsum("nh,nmh->nm", hidden, w["members"][klass]) + w["member_bias"][klass])
        outer, inner = (p / p.sum(axis=1, keepdims=True) / len(t) for p in (outer, inner))
        outer[every, klass] -= 1 / len(t)
        inner[every, member] -= 1 / len(t)
        back = (outer @ w["classes"] + np.einsum("nm,nmh->nh", inner, w["members"][klass])) * (1 - hidden**2)
        g = {name: np.zeros_like(x) for name, x in w.items()}
        np.add.at(g["members"], klass, inner[:, :, None] * hidden[:, None, :])
        np.add.at(g["member_bias"], klass, inner)
        np.add.at(g["embed"], a.ravel(), (back @ w["hidden"].T).reshape(-1, lm.WIDTH))
        g |= {"classes": outer.T @ hidden, "class_bias": outer.sum(axis=0), "hidden": x.T @ back, "hidden_bias": back.sum(axis=0)}
        for name in w:
            moved[name] += g[name] ** 2
            w[name] -= lm.RATE * g[name] / np.sqrt(moved[name])
    assert all(np.allclose(own.w[name], w[name], atol=2e-5) for name in w)
    assert all(np.array_equal(start[name], x) for name, x in lm.first_weights(vocabulary).items())
