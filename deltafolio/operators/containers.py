"""Containers of blocks: sections, heading paths, merged tables, duplicates, signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan
from .bands import asof


def section_ord(df: DataFrame, scope: list[str], is_heading: Column, order: str = "ord") -> DataFrame:
    found = scan.scanned(df, scope, [order], {"section": scan.total(F.when(is_heading, 1).otherwise(0))})
    return found.withColumn("section", F.col("section").cast("long"))


def heading_path(df: DataFrame, scope: list[str], level: str, text: str, depth: int = 3, order: str = "ord") -> DataFrame:
    """path: the open headings of levels 1..depth; a heading closes those below its level, missing levels are left out.

    A heading is open if it comes after the last one of a lower level: two running values for each level, one window for all.
    """
    own, cut = ([f"{name}{k}" for k in range(1, depth + 1)] for name in ("own", "cut"))
    own, cut = scan.fresh(df.columns, *own), scan.fresh(df.columns, *cut)
    columns = {}
    for k in range(1, depth + 1):
        columns[own[k - 1]] = scan.latest(F.when((F.col(level) == k) & F.col(text).isNotNull(), F.struct(F.col(order).alias("at"), F.col(text).alias("text"))))
        columns[cut[k - 1]] = scan.latest(F.when(F.col(level) < k, F.col(order)))
    found = scan.scanned(df, scope, [order], columns)
    opened = [F.when(F.col(c).isNull() | (F.col(o)["at"] > F.col(c)), F.col(o)["text"]) for o, c in zip(own, cut)]
    return found.withColumn("path", F.concat_ws(" > ", *opened)).drop(*columns)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def coalesced(df: DataFrame, keys: list[str], value: str, order: str, clean: Column) -> DataFrame:
    """Parts of one title in order; the displayed one is the first clean one, else the first."""
    return df.groupBy(*keys).agg(
        F.min_by(value, F.struct((~clean).cast("int"), F.col(order))).alias("title"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), " / ").alias("parts"),
        F.count("*").alias("n"),
    )


def signature(df: DataFrame, scope: list[str], name: str, rank: str, boring: list[str]) -> DataFrame:
    """The first name, by rank, that is not boilerplate."""
    return df.groupBy(*scope).agg(F.min_by(F.when(~F.col(name).isin(*boring), F.col(name)), F.when(~F.col(name).isin(*boring), F.col(rank))).alias("signature"))


def carried(df: DataFrame, scope: list[str], value: Column, name: str, order: str = "ord") -> DataFrame:
    """The last value seen so far, as for captions and titles."""
    return scan.scanned(df, scope, [order], {name: scan.latest(value)})


# Names of what no range of the contents covers.
FRONT_MATTER, UNASSIGNED = "front_matter", "unassigned"
APPENDIX = r"^Appendix ([A-E]):"


def toc_ranges(toc: DataFrame, scope: list[str], last_page: str, level: int = 2, pattern: str = APPENDIX) -> DataFrame:
    """scope, name, start, end (pages) from a table of contents (scope, level, title, page, and the last page of the scope).

    Ranges begin at the titles that match and end before the next one; pages before the first are front matter.
    """
    starts = toc.where((F.col("level") == level) & F.col("title").rlike(pattern)).select(*scope, F.lower(F.regexp_extract("title", pattern, 1)).alias("name"), F.col("page").alias("start"), F.col(last_page).alias("_last"))
    front = starts.groupBy(*scope).agg(F.min("start").alias("_first"), F.max("_last").alias("_last")).where("_first > 1").select(*scope, F.lit(FRONT_MATTER).alias("name"), F.lit(1).cast(starts.schema["start"].dataType).alias("start"), "_last")
    both = starts.unionByName(front)
    after = F.lead("start").over(Window.partitionBy(*scope).orderBy("start", "name"))
    return both.withColumn("end", F.coalesce(after - 1, "_last")).drop("_last")


def in_ranges(rows: DataFrame, ranges: DataFrame, scope: list[str], at: str, name: str = "name") -> DataFrame:
    """rows with the name of the range (scope, name, start, end) that holds them, else "unassigned"; one sorted sweep, no range join.

    Ranges of a scope do not overlap.
    """
    marks = ranges.select(*scope, "start", F.struct(F.col(name).alias("n"), F.col("end").alias("e")).alias("_range"))
    found = asof(rows, marks, scope, at, "start", "_range")
    return found.withColumn(name, F.when(F.col("_range")["e"].isNull() | (F.col(at) <= F.col("_range")["e"]), F.col("_range")["n"])).withColumn(name, F.coalesce(name, F.lit(UNASSIGNED))).drop("_range")


def sections(blocks: DataFrame, scope: list[str], is_heading: Column, title: str = "text", order: str = "ord") -> DataFrame:
    """Blocks that stand under a heading, with section (1, 2, …) and its title; what comes before the first heading is dropped."""
    numbered = section_ord(blocks, scope, is_heading, order).where("section > 0")
    names = numbered.where(is_heading).groupBy(*scope, "section").agg(F.min_by(title, order).alias("section_title"))
    return numbered.where(~is_heading).join(names, [*scope, "section"])


def tables_of(blocks: DataFrame, scope: list[str], order: str = "ord") -> DataFrame:
    """Rows (type table_row, cells) with the title of their table: the paragraph right before its header, else the header's cells.

    Equal titles in a row are one table; tables without rows go.
    """
    was, = scan.fresh(blocks.columns, "was")
    caption = F.when(F.col(was)["type"] == "paragraph", F.col(was)["text"])
    title = F.when(F.col("type") == "table_header", F.coalesce(caption, F.array_join("cells", " ")))
    rows = scan.scanned(blocks, scope, [order], {was: scan.before(F.struct("type", "text"))}, {"title": scan.latest(title)})
    return rows.where("type = 'table_row' and title is not null").drop(was)


def paired_signatures(sections_a: DataFrame, sections_b: DataFrame, scope: list[str], title: str = "title", signature: str = "signature", order: str = "ord") -> DataFrame:
    """Sections of equal titles, the k-th with the k-th: groups of one title are put in order of their signatures first."""

    def side(df: DataFrame, name: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*scope, title).orderBy(signature, order))
        return df.withColumn("nth", nth).select(*scope, title, "nth", F.struct(signature, order).alias(name))

    return side(sections_a, "a").join(side(sections_b, "b"), [*scope, title, "nth"], "full_outer")


def continued_rows(blocks: DataFrame, scope: list[str], code: str, text: str, back: int = 50) -> DataFrame:
    """'CODE (continued)' rows join the latest row of that code among the ``back`` blocks before; others stay."""
    base = F.regexp_replace(code, r" \(continued\)$", "")
    w = Window.partitionBy(*scope, "_base").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks.withColumns({"_base": base, "_cont": F.col(code).endswith(" (continued)")}).withColumn("_prev", F.lag("ord").over(Window.partitionBy(*scope, "_base").orderBy("ord")))
    rows = rows.withColumn("_open", (~F.col("_cont") | F.col("_prev").isNull() | (F.col("ord") - F.col("_prev") > back)).cast("int")).withColumn("_group", F.sum("_open").over(w))
    return rows.groupBy(*scope, "_base", "_group").agg(F.min("ord").alias("ord"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", text))), lambda x: x[text]), "\n").alias(text), F.count("*").alias("n")).withColumnRenamed("_base", code).drop("_group")


def continued_cells(blocks: DataFrame, scope: list[str], cells: str = "cells", back: int = 50) -> DataFrame:
    """Rows of cells, of which the first is a code: 'CODE (continued)' rows join the latest row of that code among the ``back`` blocks
    before, cell by cell, if they have as many cells; others stay. Result: scope, ord (of the first), code, cells, n."""
    code = F.element_at(cells, 1)
    rows = blocks.withColumns({"code": F.regexp_replace(code, r"\s*\(continued\)$", ""), "_cont": code.rlike(r"\(continued\)$"), "_size": F.size(cells)})
    w = Window.partitionBy(*scope, "code").orderBy("ord")
    near = (F.col("ord") - F.lag("ord").over(w) <= back) & (F.col("_size") == F.lag("_size").over(w))
    rows = rows.withColumn("_open", (~F.coalesce(F.col("_cont") & near, F.lit(False))).cast("int")).withColumn("_group", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = rows.groupBy(*scope, "code", "_group").agg(F.array_sort(F.collect_list(F.struct("ord", cells))).alias("_rows"), F.count("*").alias("n"))
    first = F.col("_rows")[0][cells]
    joined = F.transform(first, lambda c, k: F.when(k == 0, c).otherwise(F.array_join(F.filter(F.transform("_rows", lambda r: F.get(r[cells], k)), lambda t: t != ""), "\n")))
    return merged.select(*scope, F.col("_rows")[0]["ord"].alias("ord"), "code", joined.alias(cells), "n")
