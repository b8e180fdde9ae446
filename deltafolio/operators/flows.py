"""Headings, rows and paragraphs of running pages, as relations: stretches by the line before, blocks inside a stretch by its lines.

Lines and results are as in ``cards``. A stretch is a run of lines of one kind on one page, without a gap; only its lines are ever
collected, so an edition of any length is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, reads
from . import bands, scan
from .cards import _flag, _lines

# Heading sizes of the narrative manuals and their levels.
HEADING_LEVELS = {26.0: 1, 20.0: 2, 14.0: 3}


def _parts(lines: Column, joins) -> Column:
    """The number (1, 2, …) of each line's block: ``joins`` tells from the open block's left edge, top and bottom whether a line goes on with it."""
    start = F.struct(F.array().cast("array<int>").alias("parts"), F.lit(0).alias("n"), *(F.lit(0.0).alias(c) for c in ("left", "top", "bottom")))

    def step(acc: Column, x: Column) -> Column:
        on = (acc["n"] > 0) & joins(acc, x)
        n = F.when(on, acc["n"]).otherwise(acc["n"] + 1)
        return F.struct(
            F.concat(acc["parts"], F.array(n)).alias("parts"), n.alias("n"), F.when(on, acc["left"]).otherwise(x["x0"]).alias("left"),
            F.when(on, F.least(acc["top"], x["y0"])).otherwise(x["y0"]).alias("top"), F.when(on, F.greatest(acc["bottom"], x["y1"])).otherwise(x["y1"]).alias("bottom"),
        )

    return F.aggregate(lines, start, step)["parts"]


def _blocks(lines: DataFrame, scope: list[str], kind: Column, goes_on: Column, joins) -> DataFrame:
    """scope, block, kind, lines (in order): ``goes_on`` compares a line with ``was``, the one before of its kind and page."""
    was = F.col("was")
    same = (was["kind"] == F.col("kind")) & (was["page"] == F.col("page")) & goes_on
    marked = _lines(lines, scope).withColumn("kind", kind)
    steps = {"was": scan.before(F.struct("kind", "page", "size", "y1"))}, {"stretch": scan.total(_flag(~F.coalesce(same, F.lit(False))))}
    found = scan.scanned(marked, scope, ["page", "ord"], *steps)
    line = F.struct("page", "ord", "x0", "y0", "x1", "y1", "text", "size")
    held = found.groupBy(*scope, "stretch", "kind").agg(F.array_sort(F.collect_list(line)).alias("all"))
    cut = held.withColumn("part", F.when(F.size("all") == 1, F.array(F.lit(1))).otherwise(_parts(F.col("all"), joins)))
    numbers = F.sequence(F.lit(1), F.array_max("part"))
    of = lambda n: F.transform(F.filter(F.arrays_zip("all", "part"), lambda z: z["part"] == n), lambda z: z["all"])
    pieces = F.when(F.array_max("part") == 1, F.array("all")).otherwise(F.transform(numbers, of))
    # Stored, as numbering reads them twice.
    stored = materialize(cut.select(*scope, "stretch", "kind", F.posexplode(pieces).alias("piece", "lines")), "blocks")
    numbered = scan.scanned(stored, scope, ["stretch", "piece"], {"block": scan.total(F.lit(1))})
    return reads(numbered.withColumn("block", (F.col("block") - 1).cast("bigint")), stored, found, numbered)


def _near(shift: float):
    return lambda block, x: F.abs(x["x0"] - block["left"]) <= shift


def _said(lines: str = "lines") -> Column:
    return F.trim(F.array_join(F.transform(lines, lambda x: x["text"]), " "))


def narrative(lines: DataFrame, scope: list[str], levels: dict[float, int] | None = None, shift: float = 20.0, gap: float = 10.0) -> DataFrame:
    """section_heading (level, text): neighbouring lines of one heading size on a page; paragraph (text): lines near its first one's left
    edge, up to ``gap`` below the line before."""
    levels = levels or HEADING_LEVELS
    kind = F.when(F.col("size").isin(*levels), "section_heading").otherwise("paragraph")
    head = F.col("kind") == "section_heading"
    goes_on = F.when(head, F.col("size") == F.col("was")["size"]).otherwise(F.col("y0") - F.col("was")["y1"] <= gap)
    heading = lambda x: x["size"].isin(*levels)
    found = _blocks(lines, scope, kind, goes_on, lambda block, x: heading(x) | _near(shift)(block, x))
    level, first = F.create_map(*(F.lit(x) for pair in levels.items() for x in pair)), F.col("lines")[0]
    return reads(found.select(*scope, "block", first["page"].alias("page"), F.col("kind").alias("type"), F.when(head, F.try_element_at(level, first["size"])).alias("level"), _said().alias("text")), found)


def index_blocks(
    lines: DataFrame, scope: list[str], heading_size: float = 12.0, heading: str = r"^\d{2}\s", row_size: float = 10.5, row_gap: float = 4.0, shift: float = 20.0, gap: float = 10.0,
) -> DataFrame:
    """section_heading (text): a line each; table_row (cells): lines that overlap the row by over half of the smaller height or begin up to
    ``row_gap`` below it, never across pages; paragraph (text), as in ``narrative``."""
    is_row = lambda x: x["size"] == row_size
    kind = F.when((F.col("size") == heading_size) & F.col("text").rlike(heading), "section_heading").when(F.col("size") == row_size, "table_row").otherwise("paragraph")
    goes_on = F.when(F.col("kind") == "section_heading", False).when(F.col("kind") == "paragraph", F.col("y0") - F.col("was")["y1"] <= gap).otherwise(True)

    def joins(block: Column, x: Column) -> Column:
        shared = F.least(block["bottom"], x["y1"]) - F.greatest(block["top"], x["y0"])
        wraps = (shared > 0.5 * F.least(block["bottom"] - block["top"], x["y1"] - x["y0"])) | (x["y0"] - block["bottom"] <= row_gap)
        return F.when(is_row(x), wraps).otherwise(_near(shift)(block, x))

    found = _blocks(lines, scope, kind, goes_on, joins)
    across = F.array_sort(F.transform("lines", lambda x, k: F.struct(x["x0"].alias("x0"), k.alias("k"), x["text"].alias("text"))))
    row = F.col("kind") == "table_row"
    return reads(found.select(*scope, "block", F.col("lines")[0]["page"].alias("page"), F.col("kind").alias("type"), F.when(~row, _said()).alias("text"), F.when(row, bands.merged_cells(across)).alias("cells")), found)
