"""Landing of new editions: type detection, all-or-nothing batches, conflicts, pairs and chains, publication state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import broadcast_if_fits, fits, materialize, reads


def edition_pairs(editions: DataFrame) -> DataFrame:
    """(manual, edition) -> consecutive pairs of distinct editions."""
    w = Window.partitionBy("manual").orderBy("edition")
    rows = editions.select("manual", "edition").distinct().withColumn("edition_b", F.lead("edition").over(w)).where("edition_b is not null")
    return rows.select("manual", F.col("edition").alias("edition_a"), "edition_b", F.concat("edition", F.lit("_to_"), "edition_b").alias("pair"))


#: Documents that are looked at to tell rare title words from common ones: one in so many, by a hash of their ids. Any choice is lossless.
LOOKED_AT = 16


def detect_titles(docs: DataFrame, titles: DataFrame) -> DataFrame:
    """(doc_id, slug) where exactly one title's tokens are all in the document. Titles: slug, tokens (distinct); titles without
    tokens are in no document.

    Each title waits at its rarest word only: a document meets the titles whose rarest word it has, and the whole title is verified
    there. Words that many titles or documents share lead to no rows. The titles are broadcast if they fit.
    """
    words = materialize(titles.select("slug", F.explode("tokens").alias("word")), "title-words")
    few = words.select("word").distinct()
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(LOOKED_AT)) == 0).select(F.explode("tokens").alias("word")).join(broadcast_if_fits(few, words), "word", "left_semi")
    seen = some.groupBy("word").agg(F.count(F.lit(1)).alias("docs")).join(words.groupBy("word").agg(F.count(F.lit(1)).alias("titles")), "word", "right")
    rank = F.struct(F.coalesce("docs", F.lit(0)).alias("d"), "titles", "word")
    rarest = words.join(seen, "word").groupBy("slug").agg(F.min(rank)["word"].alias("word"))
    # The title travels as one text, so that its size is known.
    mark = "\x00"
    need = materialize(rarest.join(titles.select("slug", F.array_join("tokens", mark).alias("title")), "slug"), "titles")
    held = lambda tokens: F.size(F.array_except(F.split("title", mark), tokens)) == 0
    if fits(need):
        hits = docs.select("doc_id", "tokens", F.explode("tokens").alias("word")).join(F.broadcast(need), "word").where(held(F.col("tokens"))).select("doc_id", "slug")
    else:
        pairs = docs.select("doc_id", F.explode("tokens").alias("word")).join(need.select("word", "slug"), "word").select("doc_id", "slug")
        hits = pairs.join(need.select("slug", "title"), "slug").join(docs.select("doc_id", "tokens"), "doc_id").where(held(F.col("tokens"))).select("doc_id", "slug")
    return reads(hits.groupBy("doc_id").agg(F.min("slug").alias("slug"), F.count("*").alias("c")).where("c = 1").drop("c"), words, need)


def validate_batch(inbox: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """A verdict for each manual, and whether all are fine: one or two files, two of different dates; a single one needs an older
    edition in the corpus (manual, edition), if a corpus is given."""
    groups = inbox.groupBy("manual").agg(F.count("*").alias("n"), F.count_distinct("edition").alias("dates"), F.min("edition").alias("_first"))
    alone = F.lit(False)
    if corpus is not None:
        oldest = corpus.groupBy("manual").agg(F.min("edition").alias("_oldest"))
        groups = groups.join(oldest, "manual", "left")
        alone = (F.col("n") == 1) & ~F.coalesce(F.col("_oldest") < F.col("_first"), F.lit(False))
    verdict = F.when(~F.col("n").isin(1, 2), "size").when((F.col("n") == 2) & (F.col("dates") < 2), "dates").when(alone, "no older edition").otherwise("ok")
    rows = groups.withColumn("verdict", verdict).select("manual", "n", "dates", "verdict")
    gate = rows.agg(F.bool_and(F.col("verdict") == "ok").alias("batch_ok"))  # one row
    return rows.join(F.broadcast(gate))


def latest_editions(corpus: DataFrame) -> DataFrame:
    """manual, latest, editions (how many different ones)."""
    return corpus.groupBy("manual").agg(F.max("edition").alias("latest"), F.count_distinct("edition").alias("editions"))


def chain(pairs: DataFrame, old: str, new: str) -> DataFrame:
    """The consecutive pairs that lead from one edition to a later one."""
    return pairs.where((F.col("edition_a") >= old) & (F.col("edition_b") <= new))


def edition_counts(lines: DataFrame, keys: list[str], kept: Column) -> DataFrame:
    """keys, num_lines_in, num_lines_kept."""
    return lines.groupBy(*keys).agg(F.count("*").alias("num_lines_in"), F.count_if(kept).alias("num_lines_kept"))


def with_copies(files: DataFrame, content: str = "text") -> DataFrame:
    """files without their content, with its digest and how many files have it; digests are counted by partial sums."""
    rows = files.withColumn("digest", F.sha2(content, 256)).drop(content)
    many = rows.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1 and digest is not null")
    return rows.join(many, "digest", "left").withColumn("copies", F.when(F.col("digest").isNotNull(), F.coalesce("copies", F.lit(1).cast("bigint"))))


def conflicts(new: DataFrame, corpus: DataFrame) -> DataFrame:
    """Targets that exist with other content. Frames: target, digest."""
    return new.join(corpus.withColumnRenamed("digest", "corpus_digest"), "target").where("digest <> corpus_digest")


def is_new(latest: DataFrame, state: DataFrame, columns: list[str]) -> DataFrame:
    """State missing, or of another edition."""
    old = state.select("slug", *(F.col(c).alias("_" + c) for c in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col("_" + c))
    return latest.join(old, "slug", "left").withColumn("is_new", ~same).drop(*("_" + c for c in columns))
