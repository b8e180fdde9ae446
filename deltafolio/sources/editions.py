"""Sources and sinks of editions: text and HTML lines, binary files, JSON documents, Markdown and HTML reports, state."""

from __future__ import annotations

import os
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS = r"(?s)<(h1|h2|h3|p|li|title)[^>]*>([^<]*)<"


def lines_from_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("ord", "line")).withColumn("ord", F.col("ord").cast("long"))


def blocks_from_html(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(TAGS), F.lit(1)).alias("tag"), F.regexp_extract_all(html, F.lit(TAGS), F.lit(2)).alias("text"))
    rows = pages.select(key, F.posexplode(both).alias("ord", "x"))
    return rows.select(key, F.col("ord").cast("long").alias("ord"), "x.tag", "x.text")


def editions_from_files(spark: SparkSession, path: str) -> DataFrame:
    """'YYYYMMDD - Title.ext' files: edition, title, digest and content."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    name = F.replace(name, F.lit("%20"), F.lit(" "))
    return files.select("path", F.regexp_extract(name, r"^(\d{8}) - ", 1).alias("edition"), F.regexp_extract(name, r"^\d{8} - (.*)\.[^.]*$", 1).alias("title"), F.sha2("content", 256).alias("digest"), "content")


def lines_from_files(editions: DataFrame, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """One file to many lines, by any extractor (a PDF library, say)."""

    def run(batches):
        for pdf in batches:
            rows = [(p, e, k, t) for p, e, c in zip(pdf["path"], pdf["edition"], pdf["content"]) for k, t in enumerate(extract(c))]
            yield pd.DataFrame(rows, columns=["path", "edition", "ord", "line"])

    return editions.select("path", "edition", "content").mapInPandas(run, "path string, edition string, ord bigint, line string")


def write_documents(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).json(path)


def read_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON documents of a known schema; a folder without files raises, so that a wrong path is not an empty result."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path).select("path")
    if not files.limit(1).count():
        raise FileNotFoundError(f"no JSON documents in {path}")
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def write_report(bodies: DataFrame, path: str) -> None:
    """A text file for each pair: column body."""
    bodies.select("pair", F.col("body").alias("value")).write.mode("overwrite").partitionBy("pair").text(path)


def write_index(lines: DataFrame, path: str, title: str = "Index") -> None:
    """One file: a title and the entries (pair, line), the newest pair first. There is an entry for each pair only."""
    head = lines.sparkSession.createDataFrame([("~", f"# {title}")], "pair string, line string")
    rows = head.unionByName(lines.select(F.col("pair").cast("string").alias("pair"), "line")).coalesce(1).sortWithinPartitions(F.desc("pair"))
    rows.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def html_report(payload: DataFrame, template: str | None = None) -> DataFrame:
    """The template (by default the one beside this module) with the base64 of the JSON of each row in place of its mark."""
    if template is None:
        with open(os.path.join(os.path.dirname(__file__), "report.html"), encoding="utf-8") as f:
            template = f.read()
    data = F.base64(F.encode(F.to_json(F.struct("*")), "UTF-8"))
    return payload.select(F.replace(F.lit(template), F.lit("__DATA_B64__"), F.regexp_replace(data, r"\s", "")).alias("html"))


_STATE = "slug string, edition_a string, edition_b string"
_POINTER = "CURRENT"


def save_state(state: DataFrame, path: str, legacy: str | None = None) -> None:
    """Publish the state of the slugs at hand; other slugs keep theirs. Call it once the report stands.

    A whole new snapshot is written beside the old ones, then one rename of a pointer makes it the current one: a run that fails before leaves
    the old state whole, one that fails after it leaves the new one. What is older than the snapshot before goes, and so does the legacy file,
    which load_state reads only where there is no pointer.
    """
    spark = state.sparkSession
    new = state.select("slug", "edition_a", "edition_b")
    kept = load_state(spark, path, legacy).join(new.select("slug"), "slug", "left_anti")
    now = _current(spark, path)
    name = f"v{int(now[1:]) + 1 if now else 1:09d}"
    fs, place = _file(spark, f"{path}/{name}")
    fs.delete(place, True)  # of a run that failed
    new.unionByName(kept).write.parquet(f"{path}/{name}")
    _point(spark, path, name)
    for status in fs.listStatus(_file(spark, path)[1]):
        old = status.getPath().getName()
        if old.startswith("v") and old < (now or name):
            fs.delete(status.getPath(), True)
    if legacy:
        own, p = _file(spark, legacy)
        own.delete(p, False)


def _current(spark: SparkSession, path: str) -> str | None:
    fs, p = _file(spark, f"{path}/{_POINTER}")
    return spark.read.text(f"{path}/{_POINTER}").first()[0] if fs.exists(p) else None


def _point(spark: SparkSession, path: str, name: str) -> None:
    """One atomic rename."""
    jvm = spark._jvm
    fs, p = _file(spark, f"{path}/_{_POINTER}.{name}")
    out = fs.create(p, True)
    out.write(bytearray(name.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(p, _file(spark, f"{path}/{_POINTER}")[1], how)


def load_state(spark: SparkSession, path: str, legacy: str | None = None) -> DataFrame:
    """slug, edition_a, edition_b: the current snapshot; where there is none, one JSON object of slugs from before; else empty."""
    now = _current(spark, path)
    if now:
        return spark.read.schema(_STATE).parquet(f"{path}/{now}")
    if legacy and _file(spark, legacy)[0].exists(_file(spark, legacy)[1]):
        whole = spark.read.text(legacy, wholetext=True).select(F.from_json("value", "map<string,struct<edition_a:string,edition_b:string>>").alias("m"))
        return whole.select(F.explode("m").alias("slug", "s")).select("slug", "s.edition_a", "s.edition_b")
    return spark.createDataFrame([], _STATE)


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """(from, to) of the files of an accepted batch; a target that exists raises before anything is moved."""
    places = [(_file(spark, a), _file(spark, b)[1]) for a, b in moves]
    for (fs, _), to in places:
        if fs.exists(to):
            raise FileExistsError(to.toString())
    for (fs, source), to in places:
        fs.mkdirs(to.getParent())
        if not fs.rename(source, to):
            raise OSError(f"could not move {source.toString()}")


def write_alert(verdicts: DataFrame, path: str) -> None:
    """The rejected manuals of a batch and why, with the time, as text."""
    line = F.concat(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"), F.lit(" "), F.col("manual").cast("string"), F.lit(": "), F.col("verdict"))
    verdicts.where("verdict <> 'ok'").select(line.alias("value")).coalesce(1).write.mode("append").text(path)
