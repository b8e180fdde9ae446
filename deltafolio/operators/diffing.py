"""Differences of matched entities: cells, fields, maps, composites, and reserved ranges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import with_ratio
from ..functions.text import clean


# Fixed value: texts this alike are not reported as changed.
SAME = 0.98


def changed(old: Column, new: Column) -> Column:
    return clean(F.coalesce(old, F.lit(""))) != clean(F.coalesce(new, F.lit("")))


def unlike(rows: DataFrame, same: float | None = SAME, similar: Callable[[Column], Column] = clean) -> DataFrame:
    """Rows whose old and new differ, with similarity_ratio; those of at least ``same`` go (None: all stay, without a ratio).

    ``similar``: what the ratio compares, say texts without bullet marks (text.without_bullets). Only differing texts are compared.
    """
    different = rows.where(changed(F.col("old"), F.col("new")))
    if same is None:
        return different
    text = lambda c: similar(F.coalesce(F.col(c), F.lit("")))
    return with_ratio(different, text("old"), text("new"), "similarity_ratio").where(F.col("similarity_ratio") < same)


def cells_diff(matched: DataFrame, keys: list[str], a: str = "a_cells", b: str = "b_cells", skip: int = 1, same: float | None = SAME, header: str | None = None) -> DataFrame:
    """A row for each differing cell; the first (key) cells are skipped, and the longer row's rest. header: names of the columns."""
    n = F.least(F.size(a), F.size(b))
    both = F.arrays_zip(F.slice(F.col(a), 1, n).alias("old"), F.slice(F.col(b), 1, n).alias("new"))
    names = [F.col(header).alias("_header")] if header else []
    rows = matched.select(*keys, *names, F.posexplode(F.transform(both, lambda x: F.struct(x["old"], x["new"]))).alias("column_index", "cell")).where(F.col("column_index") >= skip)
    label = [F.coalesce(F.get("_header", F.col("column_index")), F.concat(F.lit("column "), F.col("column_index").cast("string"))).alias("column")] if header else []
    return unlike(rows.select(*keys, "column_index", *label, "cell.old", "cell.new"), same)


def field_diff(matched: DataFrame, keys: list[str], fields: list[str], same: float | None = SAME) -> DataFrame:
    """matched: keys, structs a and b -> a row for each differing field."""
    items = F.array(*(F.struct(F.lit(f).alias("field"), F.col("a")[f].cast("string").alias("old"), F.col("b")[f].cast("string").alias("new")) for f in fields))
    return unlike(matched.select(*keys, F.explode(items).alias("x")).select(*keys, "x.*"), same)


def map_diff(matched: DataFrame, keys: list[str], skip: tuple[str, ...] = (), same: float | None = SAME) -> DataFrame:
    """matched: keys, maps a and b -> a row for each differing name of either."""
    names = F.array_sort(F.array_union(F.coalesce(F.map_keys("a"), F.array().cast("array<string>")), F.coalesce(F.map_keys("b"), F.array().cast("array<string>"))))
    rows = matched.select(*keys, "a", "b", F.explode(names).alias("name")).where(~F.col("name").isin(*skip) if skip else F.lit(True))
    return unlike(rows.select(*keys, "name", F.coalesce(F.try_element_at("a", "name"), F.lit("")).alias("old"), F.coalesce(F.try_element_at("b", "name"), F.lit("")).alias("new")), same)


def flattened(value: Column, nested: bool = False) -> Column:
    """A list as one text: items joined by blanks, or, of lists of lists, by " | "; null is empty."""
    return F.coalesce(F.array_join(F.flatten(value), " | ") if nested else F.array_join(value, " "), F.lit(""))


def unconsumed(events: DataFrame, consumed: DataFrame, keys: list[str]) -> DataFrame:
    """Added and removed items that no split or merge explains already; null keys are compared like values."""
    gone = consumed.select(*(F.col(k).alias("_" + k) for k in keys)).distinct()
    return events.join(gone, [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys], "left_anti")


def with_context(events: DataFrame, paragraphs: DataFrame, scope: list[str], text: str = "text", order: str = "ord") -> DataFrame:
    """events with ``context``: all new paragraphs of their section, in order; none is an empty array."""
    wanted = paragraphs.join(events.select(*scope).distinct(), scope, "left_semi")
    own = wanted.groupBy(*scope).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]).alias("context"))
    return events.join(own, scope, "left").withColumn("context", F.coalesce("context", F.array().cast("array<string>")))


def backfilled(events: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """events whose null attributes are filled from the facts of their key (one row a key); further facts become columns."""
    own = [c for c in facts.columns if c not in keys]
    both = events.join(facts.select(*keys, *(F.col(c).alias("_" + c) for c in own)), keys, "left")
    return both.withColumns({c: F.coalesce(*([c] if c in events.columns else []), "_" + c) for c in own}).drop(*("_" + c for c in own))


def composite(struct: str, fields: list[str]) -> Column:
    return clean(F.concat_ws(" ", *(F.col(struct)[f].cast("string") for f in fields)))


def is_reserved(c: Column) -> Column:
    return F.lower(F.trim(c)) == "reserved"


def reserved_transition(old: Column, new: Column) -> Column:
    return F.when(is_reserved(old) & ~is_reserved(new), "field_became_defined").when(~is_reserved(old) & is_reserved(new), "field_became_reserved")


#: Widths of the bins in which ranges meet, each ``_WIDER`` times the one before.
_LEVELS, _WIDER = 12, 8


def _level(start: str, end: str) -> Column:
    """The narrowest level whose bins are as wide as the range."""
    width = (F.col(end) - F.col(start) + 1).cast("double")
    return F.least(F.greatest(F.ceil(F.log(width) / F.log(F.lit(float(_WIDER))) - 1e-9), F.lit(0)), F.lit(_LEVELS)).cast("int")


def _with_bins(ranges: DataFrame, start: str, end: str) -> DataFrame:
    size = F.pow(F.lit(float(_WIDER)), F.col("_level")).cast("bigint")
    return ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / size).cast("bigint"), F.floor(F.col(end) / size).cast("bigint"))))


def _binned(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each of the one or two bins, of a width of the range's own size, that a range touches; a range of any width has no more.

    Ranges without a start or an end meet nothing.
    """
    return _with_bins(ranges.where(f"{start} <= {end}").withColumn("_level", _level(start, end)), start, end)


def _probes(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each bin of the range's own level and of all wider ones that it touches, one or two a level: there it looks for wider ranges."""
    return _with_bins(ranges.where(f"{start} <= {end}").withColumn("_level", F.explode(F.sequence(_level(start, end), F.lit(_LEVELS)))), start, end)


def _meeting(a: DataFrame, b: DataFrame, scope: list[str], ends_a: tuple[str, str], ends_b: tuple[str, str]) -> DataFrame:
    """All pairs of ranges of a scope that meet, each once, by bins: the narrower one (a, of equal ones) looks in its bins of the wider one's level."""
    (s, e), (t, f) = ends_a, ends_b
    on = [*scope, "_level", "_bin"]
    wide_b = _probes(a, s, e).join(_binned(b, t, f), on)
    wide_a = _binned(a, s, e).join(_probes(b, t, f), on).where(_level(s, e) > _level(t, f))
    both = wide_b.unionByName(wide_a.select(*wide_b.columns))
    size = F.pow(F.lit(float(_WIDER)), F.col("_level")).cast("bigint")
    first = F.floor(F.greatest(s, t) / size)
    return both.where((F.col(s) <= F.col(f)) & (F.col(t) <= F.col(e)) & (F.col("_bin") == first)).drop("_level", "_bin")


def reserved_splits(removed: DataFrame, added: DataFrame, scope: list[str], only_start: bool = False) -> DataFrame:
    """Removed reserved ranges that contain added ones, of which a defined one starts where the range does. Frames: scope, s, e, name.

    Ranges meet in bins, so a large scope is no product of its ranges.
    """
    r = removed.where(is_reserved(F.col("name"))).select(*scope, F.col("s").alias("rs"), F.col("e").alias("re"))
    inside = _meeting(r, added.select(*scope, "s", "e", "name"), scope, ("rs", "re"), ("s", "e")).where("s >= rs and e <= re")
    new = ~is_reserved(F.col("name")) & ((F.col("s") == F.col("rs")) if only_start else F.lit(True))
    label = F.struct("s", F.concat(F.col("s").cast("string"), F.lit("-"), F.col("e").cast("string"), F.lit(" "), F.col("name")).alias("t"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, label))), lambda x: x["t"]), ",")
    out = inside.groupBy(*scope, "rs", "re").agg(F.max(~is_reserved(F.col("name")) & (F.col("s") == F.col("rs"))).alias("ok"), joined(new).alias("new_fields"), joined(~new).alias("remaining_reserved"))
    return out.where("ok").drop("ok")


def reserved_merges(removed: DataFrame, added: DataFrame, scope: list[str]) -> DataFrame:
    """Removed defined ranges that overlap added reserved ones, each pair once."""
    a = removed.where(~is_reserved(F.col("name"))).select(*scope, F.col("s").alias("a_s"), F.col("e").alias("a_e"), F.col("name").alias("a_name"))
    b = added.where(is_reserved(F.col("name"))).select(*scope, "s", "e")
    return _meeting(a, b, scope, ("a_s", "a_e"), ("s", "e"))
