"""Matches with their places, in DataFrame expressions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,match:string>"


def none_of(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def matches(text: Column, pattern: str, worth: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, match), in code points, end exclusive.

    The lengths of the pieces between matches and of the matches add up to the places. ``worth`` is a cheap
    condition without which there is no match. The pattern must not match the empty string.
    """

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["before"])
        end = start + F.coalesce(F.length(piece["match"]), F.lit(0))
        here = F.array(F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match")))
        return F.struct(end.alias("at"), F.when(piece["match"].isNull(), done["found"])
                        .otherwise(F.concat(done["found"], here)).alias("found"))

    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                        lambda b, m: F.struct(b.alias("before"), m.alias("match")))
    start = F.struct(F.lit(0).alias("at"), none_of(SPAN).alias("found"))
    found = F.aggregate(pieces, start, step, lambda done: done["found"])
    condition = text.rlike(pattern) if worth is None else worth & text.rlike(pattern)
    return F.when(condition, found).otherwise(none_of(SPAN))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def overlapping(spans: Column, one: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < one["end"]) & (one["start"] < s["end"]))
