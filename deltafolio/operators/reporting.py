"""Reports as relations: bodies of lines, summaries, top items, hints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import short
from ..storage import materialize


def dedupe_transitions(events: DataFrame, keys: list[str]) -> DataFrame:
    """One event for each key, from a row rather than a card."""
    return events.groupBy(*keys).agg(F.max("kind").alias("kind"), F.bool_or(F.col("kind") == "row").alias("confirmed_in_row"), F.bool_or(F.col("kind") == "card").alias("confirmed_in_card"))


def rename_hints(added: DataFrame, removed: DataFrame, label: str, name: str) -> DataFrame:
    """Labels with exactly one addition and one removal."""
    one = lambda df, c: df.groupBy(label).agg(F.count("*").alias("n"), F.min(name).alias(c)).where("n = 1").drop("n")
    return one(removed, "old").join(one(added, "new"), label)


def before_after(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    count = lambda df, c: df.groupBy(key).agg(F.count("*").alias(c))
    zero = F.lit(0).cast("bigint")
    both = count(a, "before").join(count(b, "after"), key, "full_outer").select(key, F.coalesce("before", zero).alias("before"), F.coalesce("after", zero).alias("after"))
    return both.withColumn("delta", F.col("after") - F.col("before"))


def top(items: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    return items.withColumn("n", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("n") <= n)


def headings(df: DataFrame, title: str, signature: str) -> DataFrame:
    """title, signature, heading: titles with several signatures show them. Titles are counted by partial sums and joined back."""
    many = df.groupBy(title).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col(title).alias("_title"), F.lit(True).alias("_many"))
    both = df.join(many, F.col(title).eqNullSafe(F.col("_title")), "left")
    shown = F.when(F.col("_many"), F.concat(F.col(title).cast("string"), F.lit(" ("), F.col(signature), F.lit(")"))).otherwise(F.col(title).cast("string"))
    return both.select(title, signature, shown.alias("heading"))


def without_moved(events: DataFrame, moved: DataFrame, keys: list[str]) -> DataFrame:
    """Added and removed sections but those that only moved."""
    return events.where(F.col("change_type").isin("added", "removed")).join(moved.select(*keys).distinct(), keys, "left_anti")


def row_summary(columns: Column, anchor: str, n: int = 80) -> Column:
    """'k: v; …' of a row's filled columns but the anchor, in the order of their names, cut to n characters."""
    entries = F.filter(F.array_sort(F.map_entries(columns)), lambda e: (e["key"] != anchor) & (F.coalesce(e["value"], F.lit("")) != ""))
    return short(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; "), n)


def index_lines(log: DataFrame, pair: str, business: Column | None = None) -> DataFrame:
    """pair, line: a list entry for each pair's report with its counts."""
    own = F.count_if(business) if business is not None else F.lit(0).cast("bigint")
    counts = log.groupBy(pair).agg(F.count("*").alias("n"), own.alias("b"))
    name = F.col(pair).cast("string")
    return counts.select(pair, F.concat(F.lit("- ["), name, F.lit("]("), name, F.lit(".md): "), F.col("n").cast("string"), F.lit(" changes, "), F.col("b").cast("string"), F.lit(" of business rules")).alias("line"))


def latest(reports: DataFrame, manual: str, pair: str) -> DataFrame:
    """The rows of each manual's last pair."""
    last = reports.groupBy(manual).agg(F.max(pair).alias(pair))
    return reports.join(last, [manual, pair], "left_semi")


def pills(log: DataFrame, manual: str, item: Column, n: int = 3, order: str = "ord") -> DataFrame:
    """manual, headline (all changes), groups: array<struct<change_type, count, items>>, most frequent first, n items each."""
    rows = log.withColumns({"_item": item, "_n": F.row_number().over(Window.partitionBy(manual, "change_type").orderBy(order))})
    groups = rows.groupBy(manual, "change_type").agg(F.count("*").alias("count"), F.transform(F.array_sort(F.collect_list(F.when(F.col("_n") <= n, F.struct("_n", "_item")))), lambda x: x["_item"]).alias("items"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("minus"), "change_type", "count", "items")))
    return groups.groupBy(manual).agg(F.sum("count").alias("headline"), F.transform(ordered, lambda g: F.struct(g["change_type"].alias("change_type"), g["count"].alias("count"), g["items"].alias("items"))).alias("groups"))


def summary(log: DataFrame, manual: str) -> DataFrame:
    kind = lambda t: F.count_if(F.col("change_type") == t)
    return log.groupBy(manual).agg(F.count("*").alias("headline"), kind("added").alias("added"), kind("removed").alias("removed"), kind("content_changed").alias("changed"))


def bodies(lines: DataFrame, groups: list[str], order: str, line: str) -> DataFrame:
    return lines.groupBy(*groups).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), "\n").alias("body"))


def report(sections: list[tuple[str, DataFrame]], order: str) -> DataFrame:
    """part (1, 2, …), body: each section's heading with its count, then its lines in order; empty sections are left out.

    Sections: (title, frame of the order column and ``line``).
    """
    out = None
    for part, (title, lines) in enumerate(sections, 1):
        own = lines.select(F.lit(part).alias("part"), F.lit(title).alias("_title"), F.col(order).alias("_ord"), "line")
        out = own if out is None else out.unionByName(own)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_ord", "line"))), lambda x: x["line"]), "\n")
    return out.groupBy("part").agg(F.first("_title").alias("_title"), F.count("*").alias("_n"), body.alias("_body")).select("part", F.concat(F.lit("## "), "_title", F.lit(" ("), F.col("_n").cast("string"), F.lit(")\n"), "_body").alias("body"))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Global places without a single-task window: range-partitioned, counted by partition, then numbered inside each.

    Range bounds are sampled anew whenever a plan runs, so the partitioned rows are written once to the shared folder, and both
    the counts and the result read them there. Equal keys are in one partition: their order among each other is arbitrary.
    """
    spark = df.sparkSession
    names = [f"_k{i}" for i in range(len(order))]
    rows = df.select("*", *(c.alias(k) for c, k in zip(order, names)))
    parts = materialize(rows.repartitionByRange(*names).withColumn("_p", F.spark_partition_id()), "ranked")
    total, starts = 0, []
    for r in sorted(parts.groupBy("_p").agg(F.count("*").alias("n")).collect()):  # one number a partition
        starts.append((r["_p"], total))
        total += r["n"]
    offsets = spark.createDataFrame(starts, "_p int, _start bigint")
    place = F.row_number().over(Window.partitionBy("_p").orderBy(*names))
    return parts.withColumn("_n", place).join(F.broadcast(offsets), "_p").withColumn(name, F.col("_start") + F.col("_n")).drop("_p", "_n", "_start", *names)
