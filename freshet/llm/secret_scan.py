"""Secret scans: fixed patterns, and a battery of randomness tests for other strings.

A candidate is a run of 20 or more characters that keys are written in, or what lies between
its equals signs and slashes. Its encoding is
inferred from the characters it uses. Three tests ask whether it could be a random string of
that encoding: chi-squared uniformity over the alphabet, the number of runs above and
below the alphabet's middle, and the correlation of neighbours. Their smallest p-value, times
three, is the candidate's p-value.

Ordinary strings fail the tests, random ones do not. Which p-values count as failures is settled
per encoding and class of length by the Benjamini-Hochberg rule, so that among the
strings dismissed as ordinary at most a share ``FALSE`` is expected to be random. Short
strings give the tests little power; they are reported only where even a string using half
of the alphabet evenly would have been dismissed.

All expressions are built-in ones. p-values are counted in bins, so that no class of strings is
ever sorted in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.base import saved
from freshet.llm.spans import as_spans, digest, in_order, joined, matches

# The patterns of the contract. Group 2 of ``assign`` is the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that fails from its first AKIA is shorter still from a later one
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so the bound may stand in the pattern
ASSIGN_LEAST = 6

KINDS = ["assign", "access", "hex", "random"]

#: What a candidate looks like, and its alphabets by name.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: What a candidate run is cut into, and a piece at its slashes.
PIECE, SEGMENT = r"[^=]+=*", r"[^/]+"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
#: Rate of false discoveries, bins of -log10 p and bins per unit, z below which power is too low.
FALSE, BINS, PER_UNIT, POWER = 0.05, 64, 4, 3.0


def _tail(z: Column) -> Column:
    """P(N > z) of the standard normal, by a fixed rational approximation (error below 1e-7 of 1)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _encoding(body: Column) -> Column:
    """The encoding of a string by the characters it uses; null if it is none."""
    has = {name: body.rlike(p) for name, p in {"d": "[0-9]", "u": "[A-Z]", "l": "[a-z]", "s": "[+/]", "m": "[-_]", "e": "="}.items()}
    return (
        F.when(has["e"] | (has["s"] & has["m"]), None)
        .when(body.rlike("^[0-9a-f]+$") & has["d"] & has["l"], "hex")
        .when(body.rlike("^[0-9A-F]+$") & has["d"] & has["u"], "HEX")
        .when(body.rlike("^[A-Z2-7]+$") & has["d"] & has["u"], "base32")
        .when(body.rlike("^[0-9a-z]+$") & has["d"] & has["l"], "base36")
        .when(body.rlike("^[0-9A-Z]+$") & has["d"] & has["u"], "BASE36")
        .when(~(has["d"] & has["u"] & has["l"]), None)
        .when(has["s"], "base64")
        .when(has["m"], "base64url")
        .otherwise("base62")
    )


def candidates(rows: DataFrame) -> DataFrame:
    """One row per candidate of rows (id, text): id, start, end, body (without padding), encoding, n, k, and
    ``piece`` (where the part between equals signs starts) with ``whole``.

    A run is cut at equals signs that are not padding at its end. Such a piece is a candidate, and
    so is what lies between its slashes: a path before a key must not hide it.
    """
    found = F.explode(matches(F.col("text"), CANDIDATE)).alias("m")
    runs = rows.select("id", found).select("id", F.col("m.start").alias("run"), F.col("m.end").alias("run_end"), F.col("m.value").alias("value"))
    pieces = runs.select("id", "run", "run_end", F.explode(matches(F.col("value"), PIECE)).alias("m"))
    piece = (F.col("run") + F.col("m.start")).alias("piece")
    end = F.when(F.col("run") + F.col("m.end") == F.col("run_end"), F.col("run_end"))
    pieces = pieces.select("id", piece, end.alias("padded_end"), F.regexp_replace("m.value", "=+$", "").alias("string"))
    string = F.col("string")
    whole = F.struct(F.lit(0).alias("start"), F.length(string).alias("end"), string.alias("value"), string.alias("part"))
    between = F.when(F.contains(string, F.lit("/")), matches(string, SEGMENT)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string,part:string>>"))
    parts = pieces.select("id", "piece", "padded_end", string, F.explode(F.concat(F.array(whole), between)).alias("m"))
    last = F.col("m.end") == F.length(string)
    each = parts.select(
        "id",
        "piece",
        (F.col("m.end") - F.col("m.start") == F.length(string)).alias("whole"),
        (F.col("piece") + F.col("m.start")).alias("start"),
        F.coalesce(F.when(last, F.col("padded_end")), F.col("piece") + F.col("m.end")).alias("end"),
        F.col("m.value").alias("body"),
    )
    each = each.withColumn("encoding", _encoding(F.col("body"))).where(F.col("encoding").isNotNull() & (F.length("body") >= 16))
    alphabet = F.create_map(*(F.lit(x) for pair in ALPHABETS.items() for x in pair))[F.col("encoding")]
    return each.withColumns({"alphabet": alphabet, "n": F.length("body").cast("double"), "k": F.length(alphabet).cast("double")})


def tested(found: DataFrame) -> DataFrame:
    """Adds p (the battery's p-value that the string is random), its bin, the class of length, and power."""
    n, k = F.col("n"), F.col("k")
    symbols = F.split("alphabet", "")
    counts = F.transform(symbols, lambda c: (n - F.length(F.replace(F.col("body"), c, F.lit("")))))
    found = found.withColumn("counts", F.explode(F.array(counts)))
    chi = F.aggregate("counts", F.lit(0.0), lambda a, c: a + (c - n / k) * (c - n / k)) * k / n
    # The statistic's exact mean and variance under uniformity; it is compared on both sides.
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    middle = (k / 2).cast("int")
    place = F.expr("transform(split(body, ''), c -> cast(locate(c, alphabet) - 1 as double))")
    # Generated, so that no later step pulls the arrays into its lambdas.
    found = found.withColumn("z_chi", z_chi).withColumn("values", F.explode(F.array(place)))
    centre = (k - 1) / 2
    next_value = lambda i: F.get(F.col("values"), i + 1)
    runs = F.aggregate(
        F.transform("values", lambda v, i: F.when(next_value(i).isNull(), 0.0).otherwise(((v >= middle) != (next_value(i) >= middle)).cast("double"))),
        F.lit(1.0),
        lambda a, x: a + x,
    )
    share = 2 * (middle / k) * (1 - middle / k)
    z_runs = (runs - 1 - (n - 1) * share) / F.sqrt((n - 1) * share * (1 - share))
    products = F.transform("values", lambda v, i: (v - centre) * (F.coalesce(next_value(i), centre) - centre))
    variance = (k * k - 1) / 12
    z_serial = F.aggregate(products, F.lit(0.0), lambda a, x: a + x) / (variance * F.sqrt(n - 1))
    both = lambda z: 2 * _tail(F.abs(z))
    found = found.withColumns({"p_chi": both(F.col("z_chi")), "p_runs": both(z_runs), "p_serial": both(z_serial)})
    p = F.least(F.lit(1.0), 3 * F.least("p_chi", "p_runs", "p_serial"))
    # Half of the alphabet, used evenly, has the chi-squared statistic n + k - 1 on average.
    power = n / F.sqrt(2 * (k - 1) * (n - 1) / n)
    bin_ = F.least(F.lit(BINS - 1), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * PER_UNIT)).cast("int")
    return found.withColumns({"p": p, "bin": bin_, "length_class": F.floor(F.log2("n")).cast("int"), "power": power})


def dismissed_bins(found: DataFrame) -> DataFrame:
    """(encoding, length_class, from_bin): p-values in this bin and beyond are failures.

    Benjamini-Hochberg over binned p-values: the largest threshold t with t * all <= FALSE * (p-values up to t).
    """
    binned = found.groupBy("encoding", "length_class", "bin").agg(F.count("*").alias("c"))
    # At most BINS rows per class.
    group = Window.partitionBy("encoding", "length_class")
    upward = group.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    binned = binned.withColumns({"up_to": F.sum("c").over(upward), "every": F.sum("c").over(group)})
    limit = F.pow(F.lit(10.0), -F.col("bin") / PER_UNIT)
    passing = binned.where(limit * F.col("every") <= FALSE * F.col("up_to"))
    return passing.groupBy("encoding", "length_class").agg(F.min("bin").alias("from_bin"))


def random_strings(rows: DataFrame) -> DataFrame:
    """(id, start, end, p) of the candidates that the battery does not dismiss; of a piece found whole, no parts."""
    found = tested(candidates(rows)).select("id", "piece", "whole", "start", "end", "encoding", "length_class", "p", "bin", "power")
    found = saved(found, "secret-candidates")
    limits = dismissed_bins(found)
    judged = found.join(limits, ["encoding", "length_class"], "left")
    keep = (F.col("power") >= POWER) & (F.col("from_bin").isNull() | (F.col("bin") < F.col("from_bin")))
    # Bounded by what one piece holds.
    spans = F.collect_set(F.struct("whole", "start", "end", "p")).alias("spans")
    kept = judged.where(keep).groupBy("id", "piece").agg(spans, F.max("whole").alias("any"))
    best = kept.select("id", F.explode(F.filter("spans", lambda s: s.whole == F.col("any"))).alias("s"))
    return best.select("id", "s.start", "s.end", "s.p")


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m.part) >= ASSIGN_LEAST)
    kinds = [as_spans(assign, "assign"), as_spans(matches(text, ACCESS), "access"), as_spans(matches(text, HEX), "hex")]
    return in_order(F.concat(*kinds), KINDS)


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, base and spans, arrays of
    struct(start, k, end, kind) in code points, end exclusive. Null counts as empty.

    Spans of the battery (kind ``random``) that touch a base span are left out: it has them.
    Rows are told apart by doc_id and text; of repeated rows each gets its spans.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.xxhash64("doc_id", "text"))
    extra = random_strings(rows.select("id", "text").where(F.col("text").rlike(CANDIDATE))).distinct()
    # Bounded by what one text holds.
    extra = extra.groupBy("id").agg(F.collect_list(F.struct("start", "end", F.lit("random").alias("kind"))).alias("more"))
    based = rows.select("doc_id", "id", F.explode(F.array(base_spans(F.col("text")))).alias("base"))
    both = based.join(extra, "id", "left")
    free = F.filter(F.col("more"), lambda m: ~F.exists(F.col("base"), lambda b: (b.start < m["end"]) & (m.start < b.end)))
    plain = F.transform("base", lambda b: F.struct(b.start.alias("start"), b.end.alias("end"), b.kind.alias("kind")))
    every = F.concat(plain, F.coalesce(free, F.array().cast("array<struct<start:int,end:int,kind:string>>")))
    return both.select("doc_id", "base", in_order(every, KINDS).alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    count = lambda kind: F.size(F.filter("base", lambda b: b.kind == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        digest(F.col("base")).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
