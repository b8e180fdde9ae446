"""Column functions on text keys. The queries use ASCII white space; ``unicode_key`` is for manuals with other blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks, dashes, bullets and marks that keys are made without.
BLANKS = "[ \\t\\n\\r]+"
DASHES = "[‐-―-]"
NOTE = r"(?i)^\s*note:\s*"
BULLET = r"(?<!\S)[l●](?!\S)"


def clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def key(c: Column) -> Column:
    return F.lower(clean(c))


def unicode_key(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " ")))


def code(c: Column) -> Column:
    """A code as a key: trimmed, upper case."""
    return F.upper(F.trim(c))


def card_name(c: Column) -> Column:
    """A card's name as a key: dashes of all kinds between words are blanks."""
    return key(F.regexp_replace(c, DASHES, " "))


def without_note(c: Column) -> Column:
    """A title as a key without its "Note:"."""
    return key(F.regexp_replace(c, NOTE, ""))


def position(c: Column) -> Column:
    """Dashes of all kinds become hyphens."""
    return F.regexp_replace(clean(c), "[‐-―]", "-")


def position_rank(c: Column) -> Column:
    """The leading number of a position, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(c, "^[0-9]+", 0), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def range_of(c: Column) -> Column:
    """'12-14' or '12' as struct(start, end)."""
    start = F.nullif(F.regexp_extract(c, "^([0-9]+)", 1), F.lit("")).try_cast("int")
    end = F.nullif(F.regexp_extract(c, "^[0-9]+-([0-9]+)$", 1), F.lit("")).try_cast("int")
    return F.struct(start.alias("start"), F.coalesce(end, start).alias("end"))


def repair(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, " ", " "), r"\bTC R\b", "TCR")


def without_bullets(c: Column) -> Column:
    return clean(F.regexp_replace(c, BULLET, ""))


def shown_date(c: Column) -> Column:
    return F.concat(F.substring(c, 7, 2), F.lit("/"), F.substring(c, 5, 2), F.lit("/"), F.substring(c, 1, 4))


def short(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.substring(c, 1, n)), F.lit("…"))).otherwise(c)
