"""Places of pattern matches as column expressions, and span lists as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,kind:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """array<struct(start, end, value, part)> of leftmost non-overlapping matches, in code points.

    The gaps that splitting leaves and the matches alternate, which gives the places.
    Everything is evaluated only for texts that hold a match. ``part`` is the group's text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pieces = F.arrays_zip(gaps.alias("gap"), found.alias("value"), part.alias("part"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string,part:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(state: Column, piece: Column) -> Column:
        begin = state.at + piece["gap"]
        end = begin + F.coalesce(F.length(piece["value"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), piece["value"].alias("value"), piece["part"].alias("part"))
        return F.struct(end.alias("at"), F.when(piece["value"].isNull(), state.out).otherwise(F.concat(state.out, F.array(span))).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(pieces, start, step, lambda s: s.out)).otherwise(empty)


def as_spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m.start.alias("start"), m.end.alias("end"), F.lit(kind).alias("kind")))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """By start, then by the kind's place in the list, then by end."""
    keyed = F.transform(
        spans, lambda s: F.struct(s.start.alias("start"), F.array_position(F.array(*map(F.lit, kinds)), s.kind).alias("k"), s.end.alias("end"), s.kind.alias("kind"))
    )
    return F.sort_array(keyed)


def joined(ordered: Column) -> Column:
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def digest(ordered: Column) -> Column:
    return F.sha2(joined(ordered).cast("binary"), 256)
