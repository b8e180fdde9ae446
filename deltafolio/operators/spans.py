"""Spans of a printed line: array<struct<text, size, flags, x0, y0, x1, y1>> in order; column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bold bit of a span's flags, and the sizes and forms of footnote markers.
BOLD = 16
MARKER_SIZE = 8.0
MARKER = r"^[0-9]+(,[0-9]+)*$"
DOT_LEADER = r"(\. ){4,}"


def _blank(s: Column) -> Column:
    return F.trim(s["text"]) == ""


def _marker(s: Column) -> Column:
    return (s["size"] < MARKER_SIZE) & F.trim(s["text"]).rlike(MARKER)


def segments(spans: Column) -> Column:
    """Arrays of spans between spans of blanks only (two columns that share a line); empty ones are left out."""
    start = F.array(F.array().cast("array<struct<text:string,size:double,flags:int,x0:double,y0:double,x1:double,y1:double>>"))

    def step(acc: Column, s: Column) -> Column:
        last = F.size(acc) - 1
        grown = F.transform(acc, lambda part, k: F.when(k == last, F.concat(part, F.array(s))).otherwise(part))
        return F.when(_blank(s), F.concat(acc, start)).otherwise(grown)

    return F.filter(F.aggregate(spans, start, step), lambda part: F.size(part) > 0)


def text_of(spans: Column) -> Column:
    """The joined text without footnote markers."""
    return F.trim(F.array_join(F.transform(F.filter(spans, lambda s: ~_marker(s)), lambda s: s["text"]), ""))


def starts_with_marker(spans: Column, least: int = 15) -> Column:
    """Whether the first span that is not blank is a footnote marker with at least ``least`` characters after it."""
    solid = F.filter(spans, lambda s: ~_blank(s))
    rest = F.trim(F.array_join(F.transform(F.slice(solid, 2, F.greatest(F.size(solid) - 1, F.lit(0))), lambda s: s["text"]), ""))
    return F.coalesce(_marker(F.get(solid, F.lit(0))) & (F.length(rest) >= least), F.lit(False))


def is_bold(spans: Column) -> Column:
    """The bold bit of the first span that is not blank."""
    return F.coalesce(F.get(F.filter(spans, lambda s: ~_blank(s)), F.lit(0))["flags"].bitwiseAND(BOLD) != 0, F.lit(False))


def largest_size(spans: Column) -> Column:
    return F.array_max(F.transform(spans, lambda s: s["size"]))


def bbox(spans: Column) -> Column:
    """The union of the spans' boxes."""
    least, most = (lambda c: F.array_min(F.transform(spans, lambda s: s[c]))), (lambda c: F.array_max(F.transform(spans, lambda s: s[c])))
    return F.struct(least("x0").alias("x0"), least("y0").alias("y0"), most("x1").alias("x1"), most("y1").alias("y1"))


def line_id(page: Column, block: Column, line: Column, segment: Column | None = None) -> Column:
    """p{page}_b{block}_l{line} and, for a segment of a line, _s{segment}."""
    head = F.concat(F.lit("p"), page.cast("string"), F.lit("_b"), block.cast("string"), F.lit("_l"), line.cast("string"))
    return head if segment is None else F.concat(head, F.coalesce(F.concat(F.lit("_s"), segment.cast("string")), F.lit("")))
