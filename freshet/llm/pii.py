"""Personal data: fixed patterns, and boosted trees over the candidates of loose generators.

The fixed patterns always hold. Beside them, generators of high recall propose
overlapping candidates: anything around an at sign, long groups of digits, dotted
numbers, account-like codes. Trees judge each by its format and by the words around it. They are
trained on the candidates of all documents, with the fixed patterns as labels: a
candidate is positive if it covers a match of its kind. So they learn in what company personal data
stands, and find what is written like it but not by the pattern. Scores are calibrated on
candidates that the trees were not trained on: the threshold of each kind is the lowest at which
its calibrated precision holds; a kind that never gets there adds nothing.

Of overlapping candidates the one with the best score is taken.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.boosting import BINS, Trees, binned, cut_points, grow, histogram, of_bins
from freshet.plans.scratch import materialize

KINDS = ["email", "ip", "card", "phone"]

# The patterns of the contract, written so that no text is scanned twice.
# A mail address is looked for from its at sign; digit runs are entered at their start only.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]+")

#: Generators by the kind they add to.
LOOSE = {
    "email": re.compile(r"[\w.%+-]{1,64}(?:@|\x20?[(\[]at[)\]]\x20?)[\w-]{1,64}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[\w-]{1,64}){1,4}"),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?:[.,-][0-9]{1,3}){3}(?![\w.])"),
    "card": re.compile(r"(?<![\w+])[0-9]{3,6}(?:[\x20./-]?[0-9]{3,6}){2,5}(?!\w)"),
    "phone": re.compile(r"(?<![\w.])(?:\+|00|\()?[0-9]{1,4}\)?(?:[\x20./-]?\(?[0-9]{2,4}\)?){2,5}(?!\w)"),
}
#: Different candidates (in bins, with their numbers) that are learned from at the driver; more stay in Spark, with the same trees.
CELLS = 100_000
#: Share of documents for calibration, precision the calibrated threshold must show, fewest candidates for it.
CALIBRATION, PRECISION, SEEN = 4, 0.98, 20
#: Steps of log odds and of margins.
ODDS_STEP, MARGIN_STEP = 1 / 64, 1 / 1024
#: Places that context words are hashed to, words looked at and the characters they are looked for in.
CONTEXT, NEAR, REACH = 512, 3, 60

Span = tuple[int, str, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            after = match.end()
            found.append((start, "email", after))
        at = text.find("@", max(at + 1, after))
    return found


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns, by start, then kind."""
    found = _emails(text)
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append((m.start(), "ip", m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0]) if len(m[0]) <= 37 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def candidates(text: str) -> list[Span]:
    found = []
    for kind, pattern in LOOSE.items():
        if kind == "email" and not ("@" in text or "(at" in text or "[at" in text):
            continue
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(found)


WORD = re.compile(r"[^\W\d_]+")


def features(text: str, span: Span) -> tuple[list[float], list[int]]:
    """Format numbers, and the places of the words around."""
    start, kind, end = span
    value = text[start:end]
    digits = _digits(value)
    groups = [len(g) for g in DIGIT.findall(value)]
    before, after = text[max(0, start - REACH) : start], text[end : end + REACH]
    left = [w.lower() for w in WORD.findall(before)][-NEAR:]
    right = [w.lower() for w in WORD.findall(after)][:1]
    places = [xxhash.xxh32_intdigest(w) % CONTEXT for w in left] + [xxhash.xxh32_intdigest("+" + w) % CONTEXT for w in right]
    last = before[-1:] or " "
    numbers = [
        float(KINDS.index(kind)), float(end - start), float(len(digits)), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)), float(value[:1] == "+"), float("(" in value),
        float(value.count(" ")), float(value.count("-")), float(value.count(".")), float("@" in value),
        float(luhn(digits) if 8 <= len(digits) <= 24 else 0), float(value[:1] == "0"), float(last.isspace()),
        float(last in ":=\"'(<"), float((after[:1] or " ").isspace()), float(":" in before[-8:]),
    ]
    return numbers, places


@dataclass
class Judge:
    """Trees, the context's log odds by place, and the margin a candidate of each kind must reach."""

    trees: Trees
    odds: np.ndarray
    threshold: dict[str, float]

    def rows(self, found: list[tuple[list[float], list[int]]]) -> np.ndarray:
        context = np.array([[self.odds[p].max(initial=0.0), self.odds[p].sum()] for _, p in found])
        return np.hstack([np.array([n for n, _ in found]), np.round(context / ODDS_STEP) * ODDS_STEP])

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans beyond the base ones, none overlapping another."""
        if not any(np.isfinite(t) for t in self.threshold.values()):
            return []
        open_ = [s for s in candidates(text) if np.isfinite(self.threshold[s[1]]) and not _touches(s, base)]
        if not open_:
            return []
        margins = self.trees.margins(self.rows([features(text, s) for s in open_]))
        taken: list[Span] = []
        for margin, span in sorted(zip(margins, open_), key=lambda x: (-x[0], x[1])):
            if margin >= self.threshold[span[1]] and not _touches(span, taken):
                bisect.insort(taken, span)
        return taken


def _touches(span: Span, sorted_spans: list[Span]) -> bool:
    """Whether a span overlaps one of a list sorted by start; spans of one kind do not overlap each other."""
    at = bisect.bisect_left(sorted_spans, (span[2], "", 0))
    return any(s[2] > span[0] for s in sorted_spans[max(0, at - 2 * len(KINDS)) : at])


CELL = "kind int, fitted boolean, label int, bins binary, n long"


def _proposed(docs: DataFrame) -> DataFrame:
    """The candidates of all documents as the trees see them, like ones together: fitted (false: for
    calibration), numbers, places, label, n."""
    fitted = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) != 0, F.lit(True))

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for used, text in zip(batch["fitted"], batch["text"]):
                text = text or ""
                found = candidates(text)
                base = base_spans(text) if found else []
                by_kind = {kind: [s for s in base if s[1] == kind] for kind in KINDS}
                for span in found:
                    numbers, places = features(text, span)
                    seen[bool(used), tuple(numbers), tuple(sorted(places)), int(_touches(span, by_kind[span[1]]))] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["fitted", "numbers", "places", "label", "n"])

    output = "fitted boolean, numbers array<double>, places array<int>, label int, n long"
    return (
        docs.select(fitted.alias("fitted"), "text").mapInPandas(propose, output)
        .groupBy("fitted", "numbers", "places", "label").agg(F.sum("n").alias("n"))
    )


def _odds(found: DataFrame) -> np.ndarray:
    """Log odds of a candidate with a word at each place."""
    total = found.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good")).first()
    seen, good = np.ones(CONTEXT), np.full(CONTEXT, total.good / total.n if total.n else 0.5)
    by_place = found.select(F.explode(F.array_distinct("places")).alias("place"), "n", "label").groupBy("place")
    for r in by_place.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good")).collect():
        seen[r.place] += r.n
        good[r.place] += r.good
    share = good / seen
    return np.log(np.maximum(share, 1e-3) / np.maximum(1 - share, 1e-3))


def _arrays(cells: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(map(bytes, cells["bins"])), dtype=np.uint8).reshape(-1, width)
    return bins, cells["label"].to_numpy(dtype=float), cells["n"].to_numpy(dtype=np.int64)


def _local_sums(cells: pd.DataFrame, cuts: list[np.ndarray]):
    bins, label, count = _arrays(cells, len(cuts))
    x, known = of_bins(bins, cuts), {}

    def sums(trees: Trees, path: list) -> np.ndarray:
        grown = len(trees.feature)
        if grown not in known:
            if grown:
                newest = Trees(0.0, trees.feature[-1:], trees.limit[-1:], trees.value[-1:])
                margin = known.pop(grown - 1) + newest.margins(x)
            else:
                margin = trees.margins(x)
            known[grown] = margin
        return histogram(x, bins, label, count, known[grown], path)

    return sums


def _spark_sums(cells: DataFrame, cuts: list[np.ndarray]):
    def sums(trees: Trees, path: list) -> np.ndarray:
        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = 0
            for batch in batches:
                bins, label, count = _arrays(batch, len(cuts))
                x = of_bins(bins, cuts)
                total = total + histogram(x, bins, label, count, trees.margins(x), path)
            if np.ndim(total):
                g, h, n = total.reshape(3, -1)
                yield pd.DataFrame({"at": np.arange(len(g)), "g": g, "h": h, "n": n})

        made = cells.mapInPandas(part, "at int, g long, h long, n long").groupBy("at").agg(F.sum("g"), F.sum("h"), F.sum("n"))
        out = np.zeros((3, 2 ** len(path) * len(cuts) * BINS), dtype=np.int64)
        for at, *values in made.collect():
            out[:, at] = values
        return out.reshape(3, -1, len(cuts), BINS)

    return sums


def _thresholds(cells: DataFrame, trees: Trees, cuts: list[np.ndarray]) -> dict[str, float]:
    """Per kind the lowest margin at which the calibration candidates show the precision."""

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins, label, count = _arrays(batch, len(cuts))
            step = np.floor(trees.margins(of_bins(bins, cuts)) / MARGIN_STEP).astype(np.int64)
            yield pd.DataFrame({"kind": batch["kind"], "step": step, "n": count, "good": (count * label).astype(np.int64)})

    steps = cells.where("NOT fitted").mapInPandas(judged, "kind int, step long, n long, good long")
    steps = steps.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
    found = dict.fromkeys(KINDS, float("inf"))
    for i, kind in enumerate(KINDS):
        n = good = 0
        for r in sorted((r for r in steps if r.kind == i), key=lambda r: -r.step):
            n, good = n + r.n, good + r.good
            if good >= SEEN and good >= PRECISION * n:
                found[kind] = max(0.0, r.step * MARGIN_STEP)
    return found


def learn(docs: DataFrame, at_driver: int = CELLS) -> Judge:
    """Train on the candidates of all documents.

    They are put in bins and counted; the trees grow on the counts, which are read at the driver if there
    are at most ``at_driver``, else added up in Spark for each level of each tree. Sums are of whole numbers, so both give the same.
    """
    found = materialize(_proposed(docs), "pii-candidates")
    fitted = found.where("fitted")
    judge = Judge(Trees(), _odds(fitted), dict.fromkeys(KINDS, float("inf")))

    def rows(batch: pd.DataFrame) -> np.ndarray:
        return judge.rows([(list(n), list(p)) for n, p in zip(batch["numbers"], batch["places"])])

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"x": list(rows(batch)), "n": batch["n"].to_numpy()})

    exploded = fitted.mapInPandas(values, "x array<double>, n long").select(F.posexplode("x").alias("feature", "value"), "n")
    # A few hundred lengths, counts and steps of log odds a feature, however many documents.
    occur = exploded.groupBy("feature", "value").agg(F.sum("n").alias("n")).toPandas()
    if not len(occur):
        return judge
    cuts = [cut_points(of["value"].to_numpy(), of["n"].to_numpy()) for _, of in occur.groupby("feature")]

    def in_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = rows(batch)
                made = batch[["fitted", "label", "n"]].assign(kind=x[:, 0].astype(int), bins=[b.tobytes() for b in binned(x, cuts)])
                yield made[["kind", "fitted", "label", "bins", "n"]]

    cells = found.mapInPandas(in_cells, CELL).groupBy("kind", "fitted", "label", "bins").agg(F.sum("n").alias("n"))
    cells = materialize(cells, "pii-cells")
    learned = cells.where("fitted")
    few = learned.count() <= at_driver
    sums = _local_sums(learned.toPandas(), cuts) if few else _spark_sums(learned, cuts)
    total = learned.agg(F.sum("n"), F.sum(F.col("n") * F.col("label"))).first()
    judge.trees = grow(cuts, total[0], total[1], sums)
    judge.threshold = _thresholds(cells, judge.trees, cuts)
    return judge


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, the counts of the base spans,
    and base and spans as ``kind:start:end`` joined by commas, in code points, end exclusive. ``spans``
    has the base ones and those that the trees add. Null counts as empty. Repeated rows are kept."""
    judge = learn(docs)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                text = text or ""
                base = base_spans(text)
                every = sorted(base + judge.added(text, base), key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
                kinds = [s[1] for s in base]
                out.append((*(kinds.count(k) for k in KINDS), _written(base), _written(every)))
            frame = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])
            frame = frame.astype({"base": object, "spans": object})
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return docs.select("doc_id", "text").mapInPandas(find, FOUND)


def redacted(text: str | None, spans: str) -> str | None:
    """A text with each span replaced by its kind in brackets; overlapping spans become one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for item in spans.split(","):
        kind, start, end = item.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]


def pii_digest(found: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    digest = F.sha2(F.col("base").cast("binary"), 256)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest.alias("base_sha256"), "spans")
