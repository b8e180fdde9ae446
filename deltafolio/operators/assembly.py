"""Rows and tables put together after parsing, as column expressions: re-segmenting, phantom columns, orphans, continued tables, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import with_ratio
from ..functions.text import clean
from ..storage import reads
from . import scan

#: Fixed value: the column of text that no row claims.
PREFIX = "__unassigned_prefix__"
#: Fixed value: how the text of a row begins that belongs to the row before.
DASH = r"^[–‒-]\s"
#: How a text refers to a table, and notices that criteria are compared without.
TABLE_REFERENCE = r"(?i)Table\s+[0-9]+[-–][0-9]+"
NOTICES = (r"(?i)all rights reserved", r"(?i)interchange processing", r"©\s*[0-9]{4}\s*\w+")


def block_role(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The role of the first rule that holds."""
    out = F.lit(otherwise)
    for role, condition in reversed(rules):
        out = F.when(condition, role).otherwise(out)
    return out


def included(role: Column, left_out: tuple[str, ...]) -> Column:
    """Whether blocks of a role take part in matching."""
    return ~role.isin(*left_out)


def nearest_name(at: Column, columns: str, x: str = "x") -> Column:
    """The name of the column (array<struct<name, …>>) whose ``x`` is nearest to a place; of equally far ones the first."""
    return F.array_min(F.transform(columns, lambda c, k: F.struct(F.abs(c[x] - at).alias("d"), k.alias("k"), c["name"].alias("name"))))["name"]


def fused(segments: str, columns: str, x: str = "x") -> Column:
    """Whether a line's segments are nearest to different columns: it is several cells, not one with wide blanks."""
    return F.coalesce(F.size(F.array_distinct(F.transform(segments, lambda s: nearest_name(s[x], columns, x)))) > 1, F.lit(False))


def resegment(lines: DataFrame, keys: list[str], segments: str = "segments", columns: str = "columns") -> DataFrame:
    """keys, segment, column, text. segments: array<struct<x, text>>, columns: array<struct<name, x>>.

    A line is split at its segments only if they are nearest to different columns (ties: the first); else it is one segment at
    its first one's column. Lines without segments or columns have no rows.
    """

    column_of = lambda s: F.struct(nearest_name(s["x"], columns).alias("column"), s["text"].alias("text"))
    placed = lines.where((F.size(segments) > 0) & (F.size(columns) > 0)).select(*keys, F.transform(segments, column_of).alias("s"), fused(segments, columns).alias("split"))
    whole = F.array(F.struct(F.col("s")[0]["column"].alias("column"), F.array_join(F.transform("s", lambda x: x["text"]), " ").alias("text")))
    return placed.select(*keys, F.posexplode(F.when(F.col("split"), F.col("s")).otherwise(whole)).alias("segment", "x")).select(*keys, "segment", "x.column", "x.text")


def phantom_columns(rows: DataFrame, scope: list[str], columns: str = "columns", order: str = "names", spaced: str = "spaced") -> DataFrame:
    """Header fragments that never hold a value join the column before them, with a blank where the fragment began with one.

    columns: map, order: names from the first column on, spaced: those that began with a blank. Only tables of two rows or more;
    prefix rows count for nothing and stay. Where a joined name is a column already, the last that is joined to it stands. One
    aggregate of the names that are ever filled, joined back to the rows.
    """
    plain = ~F.map_contains_key(columns, PREFIX)
    value = lambda c: F.coalesce(F.try_element_at(columns, c), F.lit(""))
    none = F.array().cast("array<string>")
    # Names are few: they are collected, the rows of a hot table are only counted.
    cells = rows.where(plain).select(*scope, F.posexplode_outer(F.filter(order, lambda c: F.trim(value(c)) != "")).alias("_k", "_name"))
    seen = cells.groupBy(*scope).agg(F.collect_set("_name").alias("_filled"), F.count_if(F.coalesce("_k", F.lit(0)) == 0).alias("_rows"))
    known = scan.merged(rows, seen, scope).withColumn("_filled", F.coalesce("_filled", none))
    ever = lambda c: F.array_contains("_filled", c)
    fragment = lambda c, k: (k > 0) & ~ever(c) & ever(F.get(F.col(order), k - 1))
    applies = plain & (F.col("_rows") > 1) & (F.size("_filled") > 0) & (F.size("_filled") < F.size(order))

    def merged(c, k):
        after = F.get(F.col(order), k + 1)
        takes = F.coalesce(~ever(after) & ever(c), F.lit(False))
        gap = F.when(F.array_contains(spaced, after), " ").otherwise("")
        name = F.when(takes, F.trim(F.concat(c, gap, after))).otherwise(c)
        return F.struct(F.when(~fragment(c, k), name).alias("key"), value(c).alias("value"), F.struct(takes.alias("takes"), k.alias("k")).alias("rank"))

    found = known.withColumn("_entries", F.when(applies, F.filter(F.transform(order, merged), lambda e: e["key"].isNotNull())))
    stands = F.filter("_entries", lambda e: ~F.exists("_entries", lambda x: (x["key"] == e["key"]) & (x["rank"] > e["rank"])))
    whole = F.map_from_entries(F.transform(stands, lambda e: F.struct(e["key"], e["value"])))
    return found.withColumn(columns, F.when(applies, whole).otherwise(F.col(columns))).drop("_rows", "_filled", "_entries")


def dash_orphans(rows: DataFrame, scope: list[str], anchor: str, others: list[str], order: str = "ord") -> DataFrame:
    """Rows with nothing but an anchor text that starts with a dash join the row before; the scope's first row never does."""
    w = Window.partitionBy(*scope).orderBy(order)
    empty = F.lit(True)
    for c in others:
        empty = empty & (F.trim(F.coalesce(c, F.lit(""))) == "")
    orphan = F.coalesce(empty & F.trim(anchor).rlike(DASH) & (F.row_number().over(w) > 1), F.lit(False))
    groups = rows.withColumn("_orphan", orphan).withColumn("_group", F.sum((~F.col("_orphan")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order, F.trim(F.coalesce(anchor, F.lit(""))).alias("t")))), lambda x: x["t"])
    whole = groups.groupBy(*scope, "_group").agg(F.min(order).alias(order), F.trim(F.array_join(texts, " ")).alias(anchor), *(F.min_by(c, order).alias(c) for c in others), F.count("*").alias("n"))
    return whole.drop("_group")


def joined_orphans(rows: DataFrame, scope: list[str], columns: str = "columns", anchor: str = "anchor_column", order: str = "row", **limit) -> DataFrame:
    """``dash_orphans`` of rows whose cells are a map: the rows without the orphans, whose texts end the anchor cell before them.

    anchor: the column with the name of the row's anchor cell. The scope's first row is never an orphan; prefix rows and rows without
    a map stay and count for nothing. Islands by a running count, so that a scope of any size is many tasks; limit: split, as ``scan.scanned``
    has it.
    """
    island, head, texts = scan.fresh(rows.columns, "island", "head", "texts")
    held = F.coalesce(F.map_contains_key(columns, PREFIX), F.lit(True))
    text = F.trim(F.coalesce(F.try_element_at(columns, F.col(anchor)), F.lit("")))
    alone = ~F.exists(F.map_entries(columns), lambda e: (e["key"] != F.col(anchor)) & (F.trim(F.coalesce(e["value"], F.lit(""))) != ""))
    orphan = F.coalesce(alone & text.rlike(DASH), F.lit(False))
    numbered = scan.scanned(rows.where(~held), scope, [order], {island: scan.total(F.when(orphan, 0).otherwise(1))}, **limit)
    own = F.struct(*(F.col(c) for c in rows.columns))
    # An island's first row is its head: before the first row that is no orphan, the scope's first.
    islands = numbered.groupBy(*scope, island).agg(F.min_by(own, order).alias(head), F.array_sort(F.collect_list(F.struct(F.col(order), text.alias("t")))).alias(texts))
    joined = F.trim(F.array_join(F.transform(texts, lambda x: x["t"]), " "))
    name, cells = F.coalesce(F.col(head)[anchor], F.lit("")), F.col(head)[columns]
    ended = F.map_concat(F.map_filter(cells, lambda k, v: k != name), F.create_map(name, joined))
    grown = F.when(F.size(texts) == 1, cells).when(F.map_contains_key(cells, name), F.transform_values(cells, lambda k, v: F.when(k == name, joined).otherwise(v))).otherwise(ended)
    found = islands.select(*((grown if c == columns else F.col(head)[c]).alias(c) for c in rows.columns))
    return reads(found.unionByName(rows.where(held)), numbered)


def table_schema(markdown: Column) -> Column:
    """The header's column names, cleaned, without empty ones; null where there is none."""
    lines = F.filter(F.split(markdown, "\n"), lambda x: F.trim(x) != "")
    names = F.filter(F.transform(F.split(F.get(lines, F.lit(0)), r"\|"), lambda x: F.lower(clean(x))), lambda x: x != "")
    return F.when(F.size(names) > 0, F.array_join(names, "|"))


def continued_tables(tables: DataFrame, scope: list[str], order: str = "ord") -> DataFrame:
    """Tables go on with the one before if they start on the page after it, without caption, in its section, with its header.

    tables: scope, ord, page, table_id, section, text (Markdown) -> scope, ord, page, page_end, table_id, section, text, parts.
    A continuation leaves out its first two lines. Gaps and islands: one window, one aggregate.
    """
    w = Window.partitionBy(*scope).orderBy(order)
    before = lambda c: F.lag(c).over(w)
    rows = tables.withColumn("_schema", table_schema(F.col("text")))
    goes_on = (F.col("page") == before("page") + 1) & F.col("table_id").isNull() & F.col("section").eqNullSafe(before("section")) & (F.col("_schema") == before("_schema"))
    rows = rows.withColumn("_on", F.coalesce(goes_on, F.lit(False))).withColumn("_group", F.sum((~F.col("_on")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    kept = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    body = F.when(F.col("_on") & (F.size(kept) >= 2), F.slice(kept, 3, F.greatest(F.size(kept) - 2, F.lit(1)))).otherwise(kept)
    parts = rows.withColumn("_body", F.array_join(body, "\n"))
    text = F.transform(F.array_sort(F.collect_list(F.struct(order, "_body"))), lambda x: x["_body"])
    return parts.groupBy(*scope, "_group").agg(
        F.min(order).alias(order), F.min("page").alias("page"), F.max("page").alias("page_end"), F.min_by("table_id", order).alias("table_id"), F.min_by("section", order).alias("section"),
        F.array_join(F.filter(text, lambda x: x != ""), "\n").alias("text"), F.count("*").alias("parts"),
    ).drop("_group")


def table_index(tables: DataFrame, scope: list[str], order: str = "ord") -> DataFrame:
    """scope, table_id, content ('id: title' and the text); the last table of an id wins; tables without id or text have none."""
    content = F.when(F.coalesce("title", F.lit("")) != "", F.concat("table_id", F.lit(": "), "title", F.lit("\n"), "text")).otherwise(F.col("text"))
    return tables.where((F.coalesce("table_id", F.lit("")) != "") & (F.coalesce("text", F.lit("")) != "")).groupBy(*scope, "table_id").agg(F.max_by(content, order).alias("content"))


def references(text: Column) -> Column:
    """Sorted distinct references to tables, with plain hyphens."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TABLE_REFERENCE), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.replace(x, F.lit("–"), F.lit("-")))))


def with_references(changes: DataFrame, keys: list[str], old_index: DataFrame, new_index: DataFrame) -> DataFrame:
    """keys, ref, old, new, unchanged: a row for each table that a change's texts refer to, looked up in both editions."""
    refs = changes.select(*keys, F.explode(F.array_distinct(F.concat(references(F.col("old")), references(F.col("new"))))).alias("ref"))
    missing = F.concat(F.lit("[Table "), "ref", F.lit(" not found in extracted guide]"))
    found = refs.join(old_index.select(F.col("table_id").alias("ref"), F.col("content").alias("_old")), "ref", "left").join(new_index.select(F.col("table_id").alias("ref"), F.col("content").alias("_new")), "ref", "left")
    return found.select(*keys, "ref", F.coalesce("_old", missing).alias("old"), F.coalesce("_new", missing).alias("new")).withColumn("unchanged", F.col("old") == F.col("new"))


def rate_changes(matched: DataFrame, keys: list[str], old: str = "old_rate", new: str = "new_rate") -> DataFrame:
    plain = lambda c: F.lower(clean(F.coalesce(c, F.lit(""))))
    return matched.select(*keys, plain(old).alias("old"), plain(new).alias("new")).where("old <> new")


def criteria_text(text: Column) -> Column:
    for notice in NOTICES:
        text = F.regexp_replace(text, notice, "")
    return clean(text)


def criteria_changes(old: DataFrame, new: DataFrame, keys: list[str], threshold: float = 0.98) -> DataFrame:
    """keys, change_type, old, new, ratio of criteria tables by title; a full outer join, the ratio only of unequal pairs."""
    both = old.select(*keys, F.col("text").alias("_a")).join(new.select(*keys, F.col("text").alias("_b")), keys, "full_outer")
    one = both.where(F.col("_a").isNull() | F.col("_b").isNull())
    lone = one.select(*keys, F.when(F.col("_a").isNull(), "criteria_table_added").otherwise("criteria_table_removed").alias("change_type"), F.coalesce("_a", F.lit("")).alias("old"), F.coalesce("_b", F.lit("")).alias("new"), F.lit(0.0).alias("ratio"))
    pairs = both.where(F.col("_a").isNotNull() & F.col("_b").isNotNull()).select(*keys, F.lit("criteria_changed").alias("change_type"), criteria_text(F.col("_a")).alias("old"), criteria_text(F.col("_b")).alias("new")).where("old <> new")
    return lone.unionByName(with_ratio(pairs, F.lower("old"), F.lower("new"), "ratio").where(F.col("ratio") < threshold))
