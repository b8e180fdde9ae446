"""Classification of content changes: a pluggable classifier with retries, validation and the deterministic safety net."""

from __future__ import annotations

import json
import re
import time
import urllib.request
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.similarity import disappeared
from ..functions.text import unicode_key
from ..storage import materialize, reads, release, rows_of
from .scan import fresh

# Categories of a change.
CATEGORIES = ("business_rule_change", "editorial_change", "extraction_noise")
SOFT = ("editorial_change", "extraction_noise")


def rule_classifier(old: str, new: str) -> tuple[str, str]:
    """Stands in for a language model: no network."""
    if "".join(old.split()).lower() == "".join(new.split()).lower():
        return "extraction_noise", "only blanks or case differ"
    if sorted(old.lower().split()) == sorted(new.lower().split()):
        return "editorial_change", "the same words in another order"
    return "business_rule_change", "words differ"


def with_retries(call: Callable[[str, str], tuple[str, str]], attempts: int = 3, pause: float = 1.0) -> Callable[[str, str], tuple[str, str]]:
    def run(old: str, new: str) -> tuple[str, str]:
        for k in range(attempts):
            try:
                return call(old, new)
            except OSError:
                if k == attempts - 1:
                    raise
                time.sleep(pause * 2**k)
        raise AssertionError

    return run


def classify(changes: DataFrame, call: Callable[[str, str], tuple[str, str]] = rule_classifier) -> DataFrame:
    """Adds ai_category and ai_reason to rows with old and new; one classifier for each partition, cache the result by writing it."""
    schema = StructType([*changes.schema.fields, StructField("ai_category", StringType()), StructField("ai_reason", StringType())])

    def run(batches):
        ask = with_retries(call)
        for pdf in batches:
            got = [ask(o or "", n or "") for o, n in zip(pdf["old"], pdf["new"])]
            yield pdf.assign(ai_category=pd.Series([g[0] for g in got], index=pdf.index, dtype=object), ai_reason=pd.Series([g[1] for g in got], index=pdf.index, dtype=object))

    return changes.mapInPandas(run, schema)


def remembered(changes: DataFrame, store: str, call: Callable[[str, str], tuple[str, str]] = rule_classifier, said: Column | None = None) -> DataFrame:
    """classify, with every answer kept under a digest of what was asked: a text that was judged before, in this run or another, is not asked again.

    ``said``: the whole prompt, where it holds more than old and new. ``store``: a folder for answers only; each run adds a table of its
    own there, so a run that fails adds nothing, and of two answers to one prompt the smaller is taken by all. Null texts are empty.
    """
    spark, digest = changes.sparkSession, fresh(changes.columns, "digest")[0]
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    asked = said if said is not None else F.concat(F.length(empty("old")).cast("string"), F.lit(":"), empty("old"), empty("new"))
    rows = changes.withColumn(digest, F.sha2(F.coalesce(asked, F.lit("")), 256))
    schema = "digest string, ai_category string, ai_reason string"
    where = spark._jvm.org.apache.hadoop.fs.Path(store)
    known = lambda: spark.read.schema(schema).parquet(f"{store}/answers-*") if where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{store}/answers-*/_SUCCESS")) else spark.createDataFrame([], schema)
    once = rows.groupBy(F.col(digest).alias("digest")).agg(F.min(F.struct(empty("old").alias("old"), empty("new").alias("new"))).alias("q")).select("digest", "q.old", "q.new")
    new = materialize(once.join(known().select("digest"), "digest", "left_anti"), "questions")
    if rows_of(new):
        classify(new, call).select("digest", "ai_category", "ai_reason").write.parquet(f"{store}/answers-{uuid.uuid4().hex}")
    release(new)
    answers = known().groupBy(F.col("digest").alias(digest)).agg(F.min(F.struct("ai_category", "ai_reason")).alias("a")).select(digest, "a.ai_category", "a.ai_reason")
    return rows.join(answers, digest, "left").drop(digest)


def prompt(template: str, **columns: Column) -> Column:
    """The template with each {name} replaced by that column; nulls are empty."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(F.coalesce(columns[x].cast("string"), F.lit("")) if k % 2 else F.lit(x) for k, x in enumerate(parts)))


def http_classifier(url: str, body: Callable[[str, str], dict], answer: Callable[[dict], tuple[str, str]], timeout: float = 120.0) -> Callable[[str, str], tuple[str, str]]:
    """A classifier that posts JSON to a model service; what goes wrong on the way is an OSError, which with_retries tries again."""

    def call(old: str, new: str) -> tuple[str, str]:
        request = urllib.request.Request(url, json.dumps(body(old, new)).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return answer(json.load(reply))

    return call


def check_service(url: str, timeout: float = 5.0) -> None:
    """Raises before anything is planned if the model service does not answer."""
    try:
        with urllib.request.urlopen(url, timeout=timeout):
            return
    except OSError as e:
        raise RuntimeError(f"no answer from the model service at {url}: {e}") from e


def classify_only(changes: DataFrame, kinds: list[str], call: Callable[[str, str], tuple[str, str]] = rule_classifier) -> DataFrame:
    """classify for the change types in ``kinds``; other events pass through without a category."""
    mine = F.col("change_type").isin(*kinds)
    rest = changes.where(~F.coalesce(mine, F.lit(False))).withColumns({"ai_category": F.lit(None).cast("string"), "ai_reason": F.lit(None).cast("string")})
    return validated(classify(changes.where(mine), call)).unionByName(rest)


def validated(df: DataFrame) -> DataFrame:
    """Unknown categories become noise, and the reason says what they were."""
    known = F.col("ai_category").isin(*CATEGORIES)
    note = F.concat(F.lit("unknown category "), F.coalesce("ai_category", F.lit("none")), F.lit(": "), F.coalesce("ai_reason", F.lit("")))
    return df.withColumns({"ai_reason": F.when(known, F.col("ai_reason")).otherwise(note), "ai_category": valid_category(F.col("ai_category"))})


def judged(changes: DataFrame, kinds: list[str], call: Callable[[str, str], tuple[str, str]] = rule_classifier, context: str | None = None, bullets: frozenset[str] = frozenset()) -> DataFrame:
    """The whole judgement of a pair's changes: classes, disappeared content (without what the context's paragraphs hold), safety net."""
    rows = classify_only(changes, kinds, call).withColumn("disappeared_content", disappeared(F.col("old"), F.col("new"), bullets=bullets))
    if context:
        gone, moved = F.col("disappeared_content"), relocated(F.col("disappeared_content"), F.col(context))
        rows = rows.withColumns({"relocated_content": moved, "disappeared_content": F.array_except(gone, moved)}).drop(context)
    return safety_net(rows, F.size("disappeared_content") > 0)


def category_summary(df: DataFrame, pair: list[str]) -> DataFrame:
    """pair, ai_category, n of the classified changes."""
    return df.where("ai_category is not null").groupBy(*pair, "ai_category").agg(F.count("*").alias("n"))


def enriched(changes: DataFrame, lookups: list[DataFrame], keys: list[str], name: str) -> DataFrame:
    """changes with the name from the first lookup (keys, name; one row a key) that has it, else empty."""
    out = changes
    for k, own in enumerate(lookups):
        out = out.join(own.select(*keys, F.col(name).alias(f"_name{k}")), keys, "left")
    return out.withColumn(name, F.coalesce(*(f"_name{k}" for k in range(len(lookups))), F.lit(""))).drop(*(f"_name{k}" for k in range(len(lookups))))


def valid_category(c: Column) -> Column:
    return F.when(c.isin(*CATEGORIES), c).otherwise("extraction_noise")


def safety_net(df: DataFrame, disappeared: Column) -> DataFrame:
    """A soft category with content that disappeared becomes a business rule change; the original is kept."""
    override = F.col("ai_category").isin(*SOFT) & disappeared
    return df.withColumns({"ai_original_category": F.when(override, F.col("ai_category")), "safety_net_override": override, "ai_category": F.when(override, F.lit("business_rule_change")).otherwise(F.col("ai_category"))})


def relocated(chunks: Column, paragraphs: Column) -> Column:
    """Disappeared chunks that are found in some new paragraph, whatever the blanks and the case of either."""
    return F.filter(chunks, lambda c: F.exists(paragraphs, lambda p: F.contains(unicode_key(p), unicode_key(c))))


def relocations(events: DataFrame, paragraphs: DataFrame, scope: list[str], chunks: str = "disappeared_content", text: str = "text") -> DataFrame:
    """events with relocated_content: the chunks (an array of texts) that stand in a paragraph (scope, text) of their scope, in order; the others stay.

    A containment join on normalised texts. A chunk's words between its first and its last one are words of any paragraph that holds it, so
    it waits at the one that fewest paragraphs of the scope have, and only those are searched; chunks without such a word, of one
    or two words, are searched for in all. No event carries a paragraph. Null scopes hold nothing; null or empty chunks are dropped.
    """
    at, = fresh(events.columns, "event_no")
    rows = materialize(events.withColumn(at, F.monotonically_increasing_id()), "events")
    said = rows.select(*scope, at, F.posexplode(chunks).alias("place", "chunk")).withColumn("said", unicode_key(F.col("chunk"))).where("said <> ''")
    inner = F.array_distinct(F.slice(F.split("said", " "), 2, F.greatest(F.size(F.split("said", " ")) - 2, F.lit(0))))
    said = materialize(said.withColumn("inner", inner), "chunks")
    wanted = said.select(*scope).distinct()
    held = paragraphs.select(*scope, unicode_key(F.col(text)).alias("held")).join(wanted, scope, "left_semi").where("held <> ''").distinct()
    held = materialize(held.withColumn("paragraph", F.monotonically_increasing_id()), "paragraphs")
    sought = said.select(*scope, F.explode("inner").alias("word")).distinct()
    words = materialize(held.select(*scope, "paragraph", F.explode(F.array_distinct(F.split("held", " "))).alias("word")).join(sought, [*scope, "word"], "left_semi"), "paragraph-words")
    often = words.groupBy(*scope, "word").agg(F.count(F.lit(1)).alias("times"))
    # A word that no paragraph has is missing here: its chunk stands nowhere.
    own = said.select(*scope, at, "place", "said", F.size("inner").alias("n"), F.explode("inner").alias("word")).join(often, [*scope, "word"])
    anchor = own.groupBy(*scope, at, "place", "said", "n").agg(F.min(F.struct("times", "word"))["word"].alias("word"), F.count(F.lit(1)).alias("found")).where("found = n")
    near = anchor.join(words, [*scope, "word"]).select(at, "place", "said", "paragraph")
    long = near.join(held.select("paragraph", "held"), "paragraph").where(F.contains("held", F.col("said"))).select(at, "place")
    short = said.where(F.size("inner") == 0).select(*scope, at, "place", "said").join(held, scope).where(F.contains("held", F.col("said"))).select(at, "place")
    hits = long.unionByName(short).distinct().groupBy(at).agg(F.collect_set("place").alias("_places"))
    out = rows.join(hits, at, "left")
    is_in = lambda k: F.coalesce(F.array_contains("_places", k), F.lit(False))
    kept = lambda moved: F.filter(F.transform(chunks, lambda c, k: F.when(is_in(k) if moved else ~is_in(k), c)), lambda c: c.isNotNull() & (unicode_key(c) != ""))
    none = F.array().cast("array<string>")
    moved, left = F.coalesce(kept(True), none), F.coalesce(kept(False), none)
    return reads(out.withColumns({"relocated_content": moved, chunks: left}).drop(at, "_places"), rows, said, held, words)


def keyword_overlap(line: Column, other: Column) -> Column:
    """Share of a line's distinct words of four letters or more that the other line holds."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) >= 4))
    return F.size(F.array_intersect(words(line), words(other))) / F.greatest(F.size(words(line)), F.lit(1))


def uncovered_lines(text: Column, other: Column, share: float = 0.6, least: int = 25) -> Column:
    """Lines of at least ``least`` characters of which no such line of the other text holds the share of the words."""
    lines = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), F.trim), lambda x: F.length(x) >= least)
    return F.filter(lines(text), lambda x: ~F.exists(lines(other), lambda o: keyword_overlap(x, o) >= share))


def downgraded(confidence: Column, old: Column, new: Column) -> Column:
    """"low" where either text has uncovered lines; no category changes."""
    gone = (F.size(uncovered_lines(old, new)) > 0) | (F.size(uncovered_lines(new, old)) > 0)
    return F.when(gone, "low").otherwise(confidence)


def limited(df: DataFrame, pair: str, order: str, n: int, only: list[str] | None = None) -> DataFrame:
    """The first n changes of each pair (the feature itself is a limit), of the pairs in ``only`` if it is given."""
    df = df if only is None else df.where(F.col(pair).isin(*only))
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(pair).orderBy(order))).where(F.col("_n") <= n).drop("_n")
