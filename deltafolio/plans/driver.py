"""From blocks of all editions to changes of all consecutive pairs, in one plan: match, detect, judge, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import with_ratio
from ..operators import classify, containers, diffing, landing, matching, reporting
from ..storage import materialize, reads

PAIR = ["manual", "pair"]
CONTENT = "row_content_changed"


def sides(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks (manual, edition, …) as the older and the newer side of each pair of consecutive editions."""
    pairs = landing.edition_pairs(blocks)
    side = lambda c: blocks.join(pairs.select("manual", F.col(c).alias("edition"), "pair"), ["manual", "edition"]).drop("edition")
    return side("edition_a"), side("edition_b")


def matched_sections(a: DataFrame, b: DataFrame, threshold: float = 0.85) -> DataFrame:
    """manual, pair, a_section, b_section, a_title, b_title, title, status, match_type: sections by equal titles in their order, then by similar ones."""
    names = lambda df: df.groupBy(*PAIR, F.col("section").alias("ord")).agg(F.min("section_title").alias("title")).withColumn("text", T.unicode_key(F.col("title")))
    old, new = names(a), names(b)
    hits = matching.fuzzy_match(old, new, PAIR, threshold)
    left = old.select(*PAIR, F.col("ord").alias("a_ord"), F.col("title").alias("a_title"))
    right = new.select(*PAIR, F.col("ord").alias("b_ord"), F.col("title").alias("b_title"))
    both = left.join(hits.select(*PAIR, "a_ord", "b_ord", "match_type"), [*PAIR, "a_ord"], "left").join(right, [*PAIR, "b_ord"], "full_outer")
    return both.select(*PAIR, F.col("a_ord").alias("a_section"), F.col("b_ord").alias("b_section"), "a_title", "b_title", F.coalesce("b_title", "a_title").alias("title"), matching.status(F.col("a_ord"), F.col("b_ord")).alias("status"), "match_type")


EVENT = ["change_type", "title", "key", "column_index", "old", "new"]


def _event(kind, title="title", key=None, at=None, old=None, new=None) -> Column:
    """One event as a struct; what is None is null."""
    text = lambda c: (F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c).cast("string")
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("change_type"), F.col(title).alias("title"), text(key).alias("key"), (F.lit(None) if at is None else at).cast("int").alias("column_index"), text(old).alias("old"), text(new).alias("new"))


def _events(rows: DataFrame, events: Column) -> DataFrame:
    """All events of a row from one scan."""
    return rows.select(*PAIR, F.explode(F.array_compact(events)).alias("e")).select(*PAIR, "e.*")


def _section_events(both: DataFrame) -> DataFrame:
    renamed = F.when((F.col("status") == "matched") & (F.col("match_type") == "fuzzy"), _event("section_renamed", old="a_title", new="b_title"))
    return _events(both, F.array(F.when(F.col("status") != "matched", _event(F.concat(F.lit("section_"), "status"))), renamed))


def _row_events(matched: DataFrame, name_index: int | None, same: float) -> DataFrame:
    """Rows that came and went, names that became reserved or defined in place (the field's only event then), and differing cells."""
    line = lambda c: F.array_join(c, " | ")
    both, old, new = F.col("status") == "matched", F.col("a.cells"), F.col("b.cells")
    turned = F.lit(None).cast("string") if name_index is None else F.when(both, diffing.reserved_transition(F.coalesce(F.get(old, F.lit(name_index)), F.lit("")), F.coalesce(F.get(new, F.lit(name_index)), F.lit(""))))
    whole = F.when(~both, _event(F.concat(F.lit("row_"), "status"), key="key", old=line(old), new=line(new))).when(turned.isNotNull(), _event(turned, key="key", old=line(old), new=line(new)))
    n = F.least(F.size(old), F.size(new))
    cells = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.when(diffing.changed(F.get(old, k), F.get(new, k)), _event(CONTENT, key="key", at=k, old=F.get(old, k), new=F.get(new, k))))
    found = _events(matched, F.concat(F.array(whole), F.when(both & turned.isNull() & (n > 1), cells).otherwise(F.array().cast(cells_type(matched)))))
    # Only contents are compared: other events have nothing to compare and stay.
    content = F.col("change_type") == CONTENT
    text = lambda c: F.when(content, T.clean(F.coalesce(F.col(c), F.lit(""))))
    return with_ratio(found, text("old"), text("new"), "_ratio").where(~content | (F.col("_ratio") < same)).drop("_ratio")


def cells_type(matched: DataFrame) -> str:
    return f"array<struct<change_type:string,title:{matched.schema['title'].dataType.simpleString()},key:string,column_index:int,old:string,new:string>>"


def _duplicate_events(counted: DataFrame, kind: str) -> DataFrame:
    """counted: manual, pair, title, key, a_times, b_times -> a warning for each section with keys that are there more than once."""
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(F.col(c) > 1, F.col("key")))), ",")
    twice = counted.where("a_times > 1 or b_times > 1").groupBy(*PAIR, "title").agg(listed("a_times").alias("old"), listed("b_times").alias("new"))
    return twice.select(*PAIR, _event(kind, old="old", new="new").alias("e")).select(*PAIR, "e.*")


def _move_events(both: DataFrame, a: DataFrame, b: DataFrame, text: Column) -> DataFrame:
    """possible_section_move for removed and added sections that hold the same."""

    def side(blocks: DataFrame, own: str, status: str) -> DataFrame:
        mine = both.where(F.col("status") == status).select(*PAIR, F.col(f"{own}_section").alias("section"))
        return blocks.join(mine, [*PAIR, "section"]).select(*PAIR, "section", "ord", T.unicode_key(text).alias("text"))

    found = matching.section_moves(side(a, "a", "removed"), side(b, "b", "added"), PAIR)
    names = lambda own: both.select(*PAIR, F.col(f"{own}_section").alias(own), F.col(f"{own}_title")).where(F.col(own).isNotNull())
    named = found.join(names("a"), [*PAIR, "a"]).join(names("b"), [*PAIR, "b"])
    return named.select(*PAIR, _event("possible_section_move", title="b_title", old="a_title", new="b_title").alias("e")).select(*PAIR, "e.*")


def _paragraph_events(both: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Paragraphs of matched sections: added, removed, reflowed, changed, and those that are there twice."""
    pairs = both.where("status = 'matched'").select(*PAIR, "title", "a_section", "b_section")

    def side(blocks: DataFrame, own: str) -> DataFrame:
        named = blocks.where("type = 'paragraph'").join(pairs.select(*PAIR, F.col(f"{own}_section").alias("section"), "title", "a_section"), [*PAIR, "section"])
        return named.select(*PAIR, "title", "a_section", "ord", "text", T.unicode_key(F.col("text")).alias("key"))

    # A section's own number tells sections of one title apart.
    scope = [*PAIR, "title", "a_section"]
    x, y = (materialize(side(s, own), "paragraphs") for s, own in ((a, "a"), (b, "b")))
    packed = lambda df, name: df.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("ord", "key", "text"))).alias(name))
    texts = materialize(packed(x, "a").join(packed(y, "b"), scope, "full_outer"), "paragraphs-of-sections")
    found = matching.align_and_pool(texts.select(*scope, F.transform("a", lambda p: p["key"]).alias("old"), F.transform("b", lambda p: p["key"]).alias("new")), scope)
    # What came or went is an event of its own for each paragraph; a reflow or a rewording is one for its stretch.
    come, gone = F.col("status") == "added", F.col("status") == "removed"
    lone = F.when(gone, F.sequence("a_from", F.col("a_to") - 1)).when(come, F.sequence("b_from", F.col("b_to") - 1))
    found = found.where("status <> 'exact'").withColumn("at", F.explode_outer(lone))
    # A row for each paragraph of an event, which finds its own text by its place: no row holds a section's paragraphs.
    places = lambda own, i, j: F.transform(F.when(F.col("at").isNull(), F.sequence(i, F.col(j) - 1)).otherwise(F.array("at")), lambda k: F.struct(F.lit(own).alias("side"), k.alias("place")))
    wanted = F.when(gone, places("a", "a_from", "a_to")).when(come, places("b", "b_from", "b_to")).otherwise(F.concat(places("a", "a_from", "a_to"), places("b", "b_from", "b_to")))
    event = [*scope, "status", F.coalesce("at", "a_from").alias("event")]
    wanted = found.select(*event, F.explode(wanted).alias("x")).select(*scope, "status", "event", "x.*")
    held = lambda own: texts.select(*scope, F.lit(own).alias("side"), F.posexplode(own).alias("place", "p")).select(*scope, "side", "place", "p.text")
    placed = wanted.join(held("a").unionByName(held("b")).hint("merge"), [*scope, "side", "place"])
    stretch = lambda own: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == own, F.struct("place", "text")))), lambda p: p["text"]), " ")
    own = placed.groupBy(*scope, "status", "event").agg(stretch("a").alias("old"), stretch("b").alias("new"))
    named = {"fuzzy": "content_changed", "reflowed": "reflowed", "removed": "removed", "added": "added"}
    kind = F.concat(F.lit("paragraph_"), F.coalesce(*(F.when(F.col("status") == k, F.lit(v)) for k, v in named.items())))
    events = own.select(*PAIR, _event(kind, old=F.when(F.col("status") != "added", F.col("old")), new=F.when(F.col("status") != "removed", F.col("new"))).alias("e")).select(*PAIR, "e.*")
    times = lambda df, name: df.groupBy(*PAIR, "title", "key").agg(F.count(F.lit(1)).alias(name))
    twice = _duplicate_events(times(x, "a_times").join(times(y, "b_times"), [*PAIR, "title", "key"], "full_outer"), "duplicate_paragraph_warning")
    return reads(events.unionByName(twice), x, y, texts)


def changes(blocks: DataFrame, threshold: float = 0.85, same: float = diffing.SAME, name_index: int | None = None) -> DataFrame:
    """manual, pair, change_type, title, key, column_index, old, new.

    blocks: manual, edition, ord, type ("section_heading", "table_row" or "paragraph"), text (of headings and paragraphs), cells (of
    rows, the first is the key; ``name_index``: the place of a field's name among them, which may be "Reserved"). Sections are added,
    removed, renamed, matched, or moved with what they hold; rows of matched sections are matched by key, the last of equal keys
    counts and the others are warned of; paragraphs are aligned. The matches of sections and of rows are made once and stored.
    """
    a, b = (materialize(containers.sections(s, PAIR, F.col("type") == "section_heading"), "blocks") for s in sides(blocks))
    both = materialize(matched_sections(a, b, threshold), "sections")
    scope = [*PAIR, "title", "key"]

    def rows(side: DataFrame, section: str) -> DataFrame:
        named = side.where("type = 'table_row'").join(both.where("status = 'matched'").select(*PAIR, F.col(section).alias("section"), "title"), [*PAIR, "section"])
        keyed = named.select(*PAIR, "title", T.code(F.element_at("cells", 1)).alias("key"), "ord", "cells")
        return keyed.groupBy(*scope).agg(F.max_by("cells", "ord").alias("cells"), F.count(F.lit(1)).alias("times"))

    matched = materialize(matching.match_unique(rows(a, "a_section"), rows(b, "b_section"), scope), "rows")
    twice = _duplicate_events(matched.select(*scope, F.col("a.times").alias("a_times"), F.col("b.times").alias("b_times")), "duplicate_key_warning")
    held = F.when(F.col("type") == "table_row", F.array_join("cells", " | ")).otherwise(F.col("text"))
    parts = [_section_events(both), _row_events(matched, name_index, same), twice, _move_events(both, a, b, held), _paragraph_events(both, a, b)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return reads(out, a, b, both, matched)


def judged_changes(blocks: DataFrame, call: Callable[[str, str], tuple[str, str]] = classify.rule_classifier, **options) -> DataFrame:
    return classify.judged(changes(blocks, **options), [CONTENT], call)


def reports(judged: DataFrame) -> DataFrame:
    """manual, pair, body: business rules first, then structure, then the rest, each with its lines in order."""
    business = F.col("ai_category") == "business_rule_change"
    part = F.when(business, 1).when(F.col("change_type") != CONTENT, 2).otherwise(3)
    what = F.concat_ws(" ", F.lit("-"), "change_type", "title", "key", F.col("column_index").cast("string"))
    line = F.when(F.col("change_type") == CONTENT, F.concat(what, F.lit(": "), F.coalesce("old", F.lit("")), F.lit(" -> "), F.coalesce("new", F.lit("")))).otherwise(what)
    rows = judged.select(*PAIR, F.struct(part.alias("part"), "title", "key", "change_type", "column_index").alias("at"), line.alias("line"))
    return reporting.bodies(rows, PAIR, "at", "line")
