"""Lines that are no content: page furniture, running headers, leaders, and boilerplate of guides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean
from .spans import DOT_LEADER

# Forms of lines that are no content.
PAGE_NUMBER = r"^[0-9]{1,4}$"
ROMAN = r"(?i)^[ivxlcdm]+$"
MONTH_YEAR = r"(?i)^(january|february|march|april|may|june|july|august|september|october|november|december) [0-9]{4}$"
DAY_DATE = r"(?i)^[0-9]{1,2} (january|february|march|april|may|june|july|august|september|october|november|december) [0-9]{4}$"


def dot_leader(text: Column) -> Column:
    """A line of a table of contents."""
    return text.rlike(DOT_LEADER)


def page_number(text: Column) -> Column:
    return F.trim(text).rlike(PAGE_NUMBER)


def outside(y0: Column, y1: Column, header: float, footer: float) -> Column:
    """Wholly in the band of the running header or footer."""
    return (y1 <= header) | (y0 >= footer)


def furniture(y0: Column, y1: Column, text: Column, header: float, footer: float) -> Column:
    return outside(y0, y1, header, footer) | dot_leader(text)


def without_running_headers(lines: DataFrame, page: list[str], order: list[str], is_header: Column, follows: Column, is_noise: Column) -> DataFrame:
    """Lines but headers, the line after a header if ``follows`` holds for it, and noise. page: the keys of one page."""
    after = F.lag(is_header).over(Window.partitionBy(*page).orderBy(*order))
    gone = F.coalesce(is_header, F.lit(False)) | (F.coalesce(after, F.lit(False)) & F.coalesce(follows, F.lit(False))) | F.coalesce(is_noise, F.lit(False))
    return lines.withColumn("_gone", gone).where("not _gone").drop("_gone")


def guide_noise(text: Column, boilerplate: list[str] = (), notice: str = "proprietary") -> Column:
    """Empty lines, exact boilerplate, digits or roman numerals alone, month and year, notices that hold ``notice``."""
    c = F.lower(clean(F.coalesce(text, F.lit(""))))
    exact = c.isin(*[b.lower() for b in boilerplate]) if boilerplate else F.lit(False)
    return (c == "") | exact | c.rlike(r"^[0-9]+$") | c.rlike(ROMAN) | c.rlike(MONTH_YEAR) | F.contains(c, F.lit(notice.lower()))


def routed(lines: DataFrame, rotated: Column) -> tuple[DataFrame, DataFrame]:
    """(upright, rotated) lines, for parsers of their own."""
    turned = F.coalesce(rotated, F.lit(False))
    return lines.where(~turned), lines.where(turned)
