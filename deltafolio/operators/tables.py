"""Tables of printed pages, as relations: header tiers, zones, columns, and rows opened by anchors.

Lines have scope, page, ord, x0, y0, x1, y1, text, size, bold, fonts, and may have ``segments``, their parts between wide blanks, as
array<struct<x0, y0, x1, y1, text>>. Reading axes: rows run down the page and columns to the
right, or, on rotated pages, rows run to the right and columns from the bottom edge up. ``along`` and ``end`` are a line's
extent in the direction of rows, ``across`` its place among the columns and ``rank`` the order of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import flagged_of, materialize, reads, release, rows_of
from . import assembly, bands, scan
from .assembly import PREFIX

# Distances in points.
TIER, COLUMN, GROUP = 15.0, 20.0, 65.0
ROW_GAP, ROTATED_GAP, BULLET = 3.0, 6.8, 10.0


def oriented(lines: DataFrame, rotated: bool) -> DataFrame:
    along, end, across = ("x0", "x1", "y1") if rotated else ("y0", "y1", "x0")
    axes = lambda of: {"along": of(along), "end": of(end), "across": of(across), "rank": -of(across) if rotated else of(across)}
    out = lines.withColumns(axes(F.col))
    if "segments" not in lines.columns:
        return out
    return out.withColumn("segments", F.transform("segments", lambda s: F.struct(*(v.alias(n) for n, v in axes(lambda c: s[c]).items()), F.coalesce(s["text"], F.lit("")).alias("text"))))


def _joined(rows: Column, *order: str) -> Column:
    """Texts of the collected rows in the order of the struct's leading fields."""
    return F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.trim("text").alias("text")))), lambda x: x["text"]), " "))


def header_cells(headers: DataFrame, scope: list[str], tier: float = TIER, column: float = COLUMN, **limit) -> DataFrame:
    """scope, at (the tier's first line), name, across, rank, blank (whether the name begins with a blank).

    A line within ``tier`` of its tier's first line belongs to it; inside a tier, gaps over ``column`` part the cells. limit, here and below:
    split, as ``scan.scanned`` has it.
    """
    one = F.struct("along", "across", "ord", "rank", "text")
    page = headers.groupBy(*scope).agg(F.array_sort(F.collect_list(one)).alias("h"))
    tiers = page.withColumn("at", bands.leaders(F.transform("h", lambda x: x["along"]), tier)).select(*scope, F.explode(F.arrays_zip("h", "at")).alias("z")).select(*scope, "z.at", "z.h.*")
    clustered = bands.gap_cluster(tiers, [*scope, "at"], "across", column, ["along", "ord"], **limit)
    first = lambda c: F.min_by(c, F.struct("along", "ord"))
    return clustered.groupBy(*scope, "at", "cluster").agg(
        _joined(F.col("text"), "along", "ord").alias("name"), first("across").alias("across"), first("rank").alias("rank"), first(F.col("text").startswith(" ")).alias("blank")
    ).drop("cluster")


def zones(cells: DataFrame, scope: list[str], group: float = GROUP) -> DataFrame:
    """scope, zone (1, 2, …), start, columns: array<struct<name, across, rank, blank>>.

    A tier that repeats a name of its zone opens the next zone. A zone's columns are the headers below its first tier, and those of
    the first that none of them is within ``group`` of: the others name groups. Of equal names, the first stands.
    """
    tiers = cells.groupBy(*scope, "at").agg(F.array_sort(F.collect_list(F.struct("across", "name", "rank", "blank"))).alias("cells"))
    page = tiers.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("at", "cells"))).alias("tiers"))
    names = lambda t: F.transform(t["cells"], lambda c: c["name"])
    begin = F.struct(F.lit(0).alias("zone"), F.array().cast("array<string>").alias("names"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        opens = (acc["zone"] == 0) | F.arrays_overlap(acc["names"], names(t))
        zone = acc["zone"] + F.when(opens, 1).otherwise(0)
        return F.struct(zone.alias("zone"), F.when(opens, names(t)).otherwise(F.concat(acc["names"], names(t))).alias("names"), F.concat(acc["out"], F.array(zone)).alias("out"))

    numbered = page.withColumn("zone", F.aggregate("tiers", begin, step)["out"]).select(*scope, F.explode(F.arrays_zip("tiers", "zone")).alias("z")).select(*scope, "z.zone", "z.tiers.at", "z.tiers.cells")
    parts = numbered.groupBy(*scope, "zone").agg(F.min("at").alias("start"), F.array_sort(F.collect_list(F.struct("at", "cells"))).alias("t"))
    leaves = F.flatten(F.transform(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))), lambda x: x["cells"]))
    columns = parts.withColumn("leaves", leaves).withColumn("own", F.concat("leaves", F.filter(F.col("t")[0]["cells"], lambda h: F.forall("leaves", lambda x: F.abs(h["across"] - x["across"]) > group))))
    first = F.filter("own", lambda c, k: F.array_position(F.transform("own", lambda x: x["name"]), c["name"]) == k + 1)
    return columns.select(*scope, "zone", "start", first.alias("columns"))


def in_zones(rows: DataFrame, found: DataFrame, scope: list[str], forward: bool = False, **limit) -> DataFrame:
    """Rows of pages with zones, with their zone and found's other columns: the last that starts at or before them, else the first;
    forward (titles) the first that starts at or after them, else the last."""
    mark, = scan.fresh([*rows.columns, *found.columns], "mark")
    edge = (F.max if forward else F.min)("zone").over(Window.partitionBy(*scope))
    # The first zone starts before all places (nulls sort first), the last, forward, behind them (NaN sorts last).
    start = F.when(F.col("zone") == edge, F.lit(float("nan") if forward else None).cast("double")).otherwise(F.col("start"))
    marks = found.select(*scope, start.alias("start"), F.struct(*(c for c in found.columns if c not in (*scope, "start"))).alias(mark))
    near = bands.asof(rows, marks, scope, "along", "start", mark, forward, **limit)
    return near.where(F.col(mark).isNotNull()).select(*(c for c in near.columns if c != mark), f"{mark}.*")


def anchored_rows(data: DataFrame, found: DataFrame, bullets: DataFrame | None, scope: list[str], gap: float = ROW_GAP, bullet: float = BULLET, **limit) -> DataFrame:
    """scope, zone, row (0: text before any anchor), ord, columns (a map), anchor_column, names, blanks.

    Each line goes to the nearest column. A line of the first column opens a row if it is the first one or over ``gap`` behind the
    end of the last one, unless a bullet up to ``bullet`` further on marks it as wrapped; the other lines go with the open row.
    Lines whose segments are nearest to different columns are a line for each segment. bullets None: there are none.
    """
    lines = in_zones(data, found.select(*scope, "start", "zone", F.col("columns").alias("own")), scope, **limit)
    if bullets is None:
        lines = lines.withColumn("marks", F.lit(None).cast("array<double>"))
    else:
        marks = bullets.groupBy(*scope).agg(F.collect_list("along").alias("marks"))
        lines = scan.merged(lines, marks, scope)
    if "segments" in data.columns:
        part = ["along", "end", "across", "rank", "text"]
        parts = F.when(assembly.fused("segments", "own", "across"), F.col("segments")).otherwise(F.array(F.struct(*part)))
        lines = lines.select("*", F.posexplode(parts).alias("piece", "part")).withColumns({c: F.col("part")[c] for c in part})
    else:
        lines = lines.withColumn("piece", F.lit(0))
    nearest = assembly.nearest_name(F.col("across"), "own", "across")
    anchor = F.array_min(F.transform("own", lambda c, k: F.struct(c["rank"].alias("r"), k.alias("k"), c["name"].alias("name"))))["name"]
    placed = lines.withColumns({"column": nearest, "anchor_column": anchor})
    is_anchor = F.col("column") == F.col("anchor_column")
    order = Window.partitionBy(*scope, "zone").orderBy("along", "rank", "ord", "piece")
    far = F.col("along") - F.last(F.when(is_anchor, F.col("end")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    wrapped = F.coalesce((F.col("far") <= bullet) & F.exists("marks", lambda b: (b > F.col("along")) & (b - F.col("along") < bullet)), F.lit(False))
    opens = is_anchor & (F.col("far").isNull() | ((F.col("far") > gap) & ~wrapped))
    numbered = placed.withColumn("far", far).withColumn("opens", opens.cast("int")).withColumn("row", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    texts = numbered.withColumn("column", F.when(F.col("row") == 0, PREFIX).otherwise(F.col("column"))).groupBy(*scope, "zone", "row", "column").agg(_joined(F.col("text"), "along", "rank", "ord", "piece").alias("text"), F.min("ord").alias("ord"))
    rows = texts.groupBy(*scope, "zone", "row").agg(F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("cells"), F.min("ord").alias("ord"))
    rows = scan.merged(rows, found.select(*scope, "zone", "columns"), [*scope, "zone"], "inner")
    ordered = F.array_sort(F.transform("columns", lambda c, k: F.struct(c["rank"].alias("r"), k.alias("k"), c["name"].alias("name"), c["blank"].alias("blank"))))
    rows = rows.withColumn("sorted", ordered)
    names = F.transform("sorted", lambda c: c["name"])
    filled = F.map_from_arrays(names, F.transform(names, lambda n: F.coalesce(F.try_element_at("cells", n), F.lit(""))))
    return rows.select(
        *scope, "zone", "row", "ord", F.when(F.col("row") == 0, F.col("cells")).otherwise(filled).alias("columns"), F.col("sorted")[0]["name"].alias("anchor_column"), names.alias("names"),
        F.transform(F.filter("sorted", lambda c: c["blank"]), lambda c: c["name"]).alias("blanks"),
    )


def page_tables(
    lines: DataFrame, scope: list[str], rotated: bool = False, header_size: float = 9.5, data_size: float = 9.0, title_size: float = 10.5, bullet_font: str = "Wingdings",
    headings: tuple[tuple[float, int], ...] | None = None, most: int = scan.SPLIT,
) -> DataFrame:
    """Blocks of pages: scope, page, ord, type, level, row, title, text, anchor_column, columns, items, cells.

    Headings; grid rows by zone of their page (level: the zone, row: the row in it, items: its columns in order, cells: those whose
    name begins with a blank); the rest as paragraphs, one a page, or one a line on rotated pages. Headers and titles are bold.
    Rows are as the lines give them; ``final_tables`` mends them. Null texts are empty. Lines are stored once, with their roles, and pages
    are counted: only where some have over ``most`` lines are scans cut into ranges.
    """
    levels = dict(headings or (((14.0, 1), (12.0, 2)) if rotated else ((26.0, 1), (20.0, 2))))
    size, bold, key = F.col("size"), F.coalesce("bold", F.lit(False)), [*scope, "page"]
    role = F.when(F.exists(F.coalesce("fonts", F.array().cast("array<string>")), lambda f: f.startswith(bullet_font)), "bullet").when(size.isin(*levels), "heading")
    role = role.when(bold & (size == header_size), "header").when(bold & (size == title_size), "title").when(~bold & (size == data_size), "data").otherwise("rest")
    placed = oriented(lines.withColumn("text", F.coalesce("text", F.lit(""))), rotated).withColumn("role", role).withColumn("bullet", F.col("role") == "bullet")
    every = materialize(placed.select(*key, "ord", "along", "end", "across", "rank", "text", "size", "role", "bullet", *(c for c in lines.columns if c == "segments")), "lines", "bullet")
    counts = every.groupBy(*key).agg(F.bool_or(F.col("role") == "header").alias("headed"), (F.count(F.lit(1)) > most).alias("large"))
    odd = materialize(counts.where("large or not headed"), "odd-pages", "large")
    limit = {"split": most if flagged_of(odd) else None}
    of = lambda r: every.where(F.col("role") == r).drop("role", "bullet")
    # Stored: two sweeps and a join read the zones, and headers are few.
    found = materialize(zones(header_cells(of("header"), key, **limit), key), "zones")
    rows = anchored_rows(of("data"), found, of("bullet") if flagged_of(every) else None, key, ROTATED_GAP if rotated else ROW_GAP, **limit)
    titles = in_zones(of("title"), found.select(*key, "start", "zone"), key, forward=True, **limit).groupBy(*key, "zone").agg(_joined(F.col("text"), "along", "ord").alias("title"))
    none = lambda kind: F.lit(None).cast(kind)
    names = ["type", "level", "row", "title", "text", "anchor_column", "columns", "items", "cells"]

    def block(df: DataFrame, **own: Column) -> DataFrame:
        kinds = {"level": "int", "row": "long", "columns": "map<string,string>", "items": "array<string>", "cells": "array<string>"}
        return df.select(*key, "ord", *(own.get(n, none(kinds.get(n, "string"))).alias(n) for n in names))

    level = F.create_map(*(F.lit(x) for pair in levels.items() for x in pair))
    heads = block(of("heading"), type=F.lit("section_heading"), level=F.element_at(level, F.col("size")), text=F.trim("text"))
    grid = block(scan.merged(rows, titles, [*key, "zone"]), type=F.lit("grid_row"), level=F.col("zone"), row=F.col("row").cast("long"), title=F.coalesce("title", F.lit("")), anchor_column=F.col("anchor_column"), columns=F.col("columns"), items=F.col("names"), cells=F.col("blanks"))
    rest = of("rest")
    if rows_of(odd):
        loose, bare = of("data").unionByName(of("title")), odd.where("not headed").select(*key)
        rest = rest.unionByName(scan.merged(loose, bare, key, "left_semi"))
    if rotated:
        plain = block(rest, type=F.lit("paragraph"), text=F.trim("text"))
    else:
        plain = block(rest.groupBy(*key).agg(_joined(F.col("text"), "along", "rank", "ord").alias("body"), F.min("ord").alias("ord")), type=F.lit("paragraph"), text=F.col("body"))
    return reads(heads.unionByName(grid).unionByName(plain), every, odd, found)


def final_tables(lines: DataFrame, scope: list[str], rotated: bool = False, **sizes) -> DataFrame:
    """``page_tables`` with its grid rows put together: phantom columns join the header before them, dash orphans the row before them.

    sizes: further parameters of ``page_tables``. items are the row's columns in order; anchor_column keeps the header's own name, also
    where it took a phantom column in: such tables have no orphans. The parsed blocks are stored once, for the passes over them, and
    the rows of a table are counted there.
    """
    parsed = page_tables(lines, scope, rotated, **sizes)
    blocks = materialize(parsed, "page-tables")
    release(parsed)
    table = [*scope, "page", "level"]
    grid, most = blocks.where("type = 'grid_row'"), sizes.get("most", scan.SPLIT)
    large = scan.large_scopes(grid, table, most)
    limit = {"split": most if rows_of(large) else None}
    release(large)
    rows = assembly.joined_orphans(assembly.phantom_columns(grid, table, order="items", spaced="cells"), table, **limit)
    return reads(blocks.where("type <> 'grid_row'").unionByName(rows.withColumn("items", F.map_keys("columns"))), blocks, rows)
