"""Quality rules: learned decision lists over the statistics of a text.

Sequential covering: a rule is a conjunction of thresholds that holds for texts of low
quality. It is grown condition by condition on two thirds of the labelled rows by the
information gained, pruned on the other third, and accepted if it is right there; the
rows that it covers leave, and the next rule is grown. The list is emitted as one
ordered conditional expression, so that scoring is a projection. All
statistics are column expressions as well.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.base import free_names, words

#: Bound of the training sample: labelled rows, those with the smallest hashes of doc_id.
SAMPLE = 12_000
#: Thresholds tried per statistic, conditions per rule, rules, precision a rule must show when pruned.
CUTS, CONDITIONS, RULES, PRECISION = 32, 4, 12, 0.85
#: Fewest low-quality rows a rule must cover when grown.
COVERED = 5

#: Limits of the fixed base rule.
FEWEST_WORDS, REPEATED_PERCENT = 50, 50

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the learned rules look at.
STATISTICS = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)),
    "symbol_share": lambda: F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
    "symbols_per_word": lambda: F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
    "dup_line_share": lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
    "distinct_share": lambda: F.col("n_distinct") / F.greatest("n_words", F.lit(1)),
    "stop_share": lambda: F.col("n_sentence_ends") / F.greatest("n_words", F.lit(1)),
}


def _repeat_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more; ``w`` must be a plain column."""
    n = F.size(w)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>"))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the statistics of each whole text; null counts as empty.

    Windows are told apart by 64-bit hashes. No text is exploded or shuffled: arrays are sorted
    inside the row, so a text of n words costs n log n.
    """
    w, lines_of, h, ordered, at_of = free_names(docs, "__w", "__lines", "__h", "__sorted", "__at")
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    rows = docs.withColumns({w: words(F.col(text)), lines_of: lines})
    rows = rows.withColumn(h, _repeat_words(F.col(w)))
    # Only texts with an equal pair of windows need their places.
    repeats = F.size(h) > F.size(F.array_distinct(h))
    placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    rows = rows.withColumn(ordered, F.when(repeats, F.sort_array(placed)))
    s = F.col(ordered)
    twice = F.filter(s, lambda x, i: (x.h == F.get(s, i - 1).h) | (x.h == F.get(s, i + 1).h))
    # Generated, not projected: a filter on the result must not be pushed into the lambda below.
    rows = rows.withColumn(at_of, F.explode(F.array(F.sort_array(F.transform(twice, lambda x: x.i)))))
    at = F.col(at_of)
    # A place adds up to three words, fewer where the next place comes sooner.
    added = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    new = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size(lines_of) - F.size(F.array_distinct(lines_of))).cast("long"),
        "n_repeat_words": F.coalesce(F.aggregate(added, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
        "n_lines": F.size(lines_of).cast("long"),
        "n_distinct": F.size(F.array_distinct(w)).cast("long"),
        "n_sentence_ends": F.length(F.regexp_replace(whole, r"[^.!?]+", "")).cast("long"),
    }
    return rows.withColumns(new).drop(w, lines_of, h, ordered, at_of)


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    limit: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.statistic] > self.limit if self.above else row[self.statistic] <= self.limit

    def column(self) -> Column:
        value = F.col(f"__{self.statistic}")
        return value > self.limit if self.above else value <= self.limit


Rule = list[Condition]


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [row for row in rows if all(c.holds(row) for c in rule)]


def _bad(rows: list[dict]) -> int:
    return sum(row["bad"] for row in rows)


def _cuts(rows: list[dict], name: str) -> list[float]:
    values = sorted({row[name] for row in rows})
    step = max(1, len(values) // CUTS)
    return [(a + b) / 2 for a, b in list(zip(values, values[1:]))[::step]]


def _best_condition(rows: list[dict]) -> Condition | None:
    """The condition with the largest gain in information about low quality."""
    bad, every, best = _bad(rows), len(rows), (1e-9, None)
    if bad in (0, every):
        return None
    prior = math.log(bad / every)
    for name in STATISTICS:
        ordered = sorted((row[name], row["bad"]) for row in rows)
        cuts, at, below_bad = _cuts(rows, name), 0, 0
        for cut in cuts:
            while at < every and ordered[at][0] <= cut:
                below_bad += ordered[at][1]
                at += 1
            for above, p, n in ((False, below_bad, at), (True, bad - below_bad, every - at)):
                if p >= COVERED:
                    gain = p * (math.log(p / n) - prior)
                    if gain > best[0]:
                        best = (gain, Condition(name, above, cut))
    return best[1]


def _grow(rows: list[dict]) -> Rule:
    rule: Rule = []
    while len(rule) < CONDITIONS and (condition := _best_condition(rows)):
        rule.append(condition)
        rows = _covered([condition], rows)
    return rule


def _worth(rule: Rule, rows: list[dict]) -> float:
    covered = _covered(rule, rows)
    p, n = _bad(covered), len(covered)
    return (2 * p - n) / n if n else -1.0


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """Drop last conditions while that makes the rule no worse on rows it was not grown on."""
    while len(rule) > 1 and _worth(rule[:-1], rows) >= _worth(rule, rows):
        rule = rule[:-1]
    return rule


def learn_rules(rows: list[dict]) -> list[Rule]:
    """Sequential covering over rows of statistics with ``bad`` (1: low quality)."""
    grow = [row for i, row in enumerate(rows) if i % 3 != 2]
    test = [row for i, row in enumerate(rows) if i % 3 == 2]
    rules: list[Rule] = []
    while len(rules) < RULES:
        rule = _grow(grow)
        if not rule:
            break
        rule = _prune(rule, test)
        seen = _covered(rule, test) or _covered(rule, grow)
        if _bad(seen) < PRECISION * len(seen):
            break
        rules.append(rule)
        grow = [row for row in grow if not all(c.holds(row) for c in rule)]
        test = [row for row in test if not all(c.holds(row) for c in rule)]
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> list[dict]:
    """At most ``bound`` rows of numbers. Rows that fail the base rule are left out: it has decided them."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    # Bounded, 12 bytes a row: small enough to send to all.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).withColumnRenamed("doc_id", "__id"))
    rows = statistics(docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__id")))
    rows = rows.where(~base_failed())
    numbers = {name: make() for name, make in STATISTICS.items()}
    rows = rows.select("doc_id", (1 - F.col("__quality")).cast("int").alias("bad"), *(v.alias(k) for k, v in numbers.items()))
    # An id may stand on many rows: what is collected is bounded by rows.
    return [row.asDict() for row in rows.orderBy(F.xxhash64("doc_id", F.lit(7)), *numbers).limit(bound).collect()]


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """(kept, rule): the first rule that holds drops a text; rule is its number, 0 if none holds."""
    number = F.lit(0)
    for i in range(len(rules), 0, -1):
        holds = F.lit(True)
        for condition in rules[i - 1]:
            holds = holds & condition.column()
        number = F.when(holds, F.lit(i)).otherwise(number)
    return number == 0, number


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the statistics, base_failed, rule and kept in place of any of that name.

    Without labels of both kinds no rule is learned and only the base rule drops texts.
    Rows are never merged: repeated ones get the same values.
    """
    rules = learn_rules(labelled_statistics(docs, labels))
    rows = statistics(docs)
    rows = rows.withColumns({f"__{name}": make() for name, make in STATISTICS.items()})
    kept, number = verdict(rules)
    rows = rows.withColumns({"base_failed": base_failed(), "rule": number})
    rows = rows.withColumn("kept", ~F.col("base_failed") & kept)
    return rows.drop(*(f"__{name}" for name in STATISTICS))
