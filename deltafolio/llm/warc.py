"""Content-addressed web archive.

An archive is two tables: ``payloads`` keeps every payload once under its SHA-256, and ``headers`` keeps each record's
exact header bytes with the digest of its payload. Of records with equal payloads of at least ``min_revisit`` bytes, the
one with the smallest page_id is the response and the others revisit it; smaller payloads always make responses. Reading
verifies each payload against its digest once and joins the headers to it.

Both tables are Parquet in the shared folder, so lost executors lose nothing. Pages are read and digested twice, payload bytes
are shuffled once (to keep one row for each digest); all other shuffles move headers or digests. The smallest page_id of a
digest is broadcast where it fits; else joins on a digest that a third of the rows share are sort-merge joins, which adaptive
execution splits.

Defined results: null html is an empty payload (a response); rows with equal page_id and payload are one record each, but
only one of them (any, they are equal) is stored as payload; rows with equal page_id and different payloads are records of
their own, each with its payload's response; rows without a page_id are never the first of equal payloads, and where all rows of a
payload are so, all are responses and one of them holds it; page ids of any type and text come back as text (``%``, ``>`` and line ends are percent-encoded in the header); an
empty table gives an empty archive; null urls become an empty WARC-Target-URI, line ends in urls are percent-encoded; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_fits, col, materialize, reads, release

#: Records carry this date: the pages have none, and equal input must give equal archives.
DATE = "2024-01-01T00:00:00Z"


class Archive(NamedTuple):
    headers: DataFrame
    payloads: DataFrame


# What may not stand in a header value, and the escape sign itself, which comes first.
_ESCAPES = (("%", "%25"), (">", "%3E"), ("\r", "%0D"), ("\n", "%0A"))


def _escaped(value):
    """An id as header text: null is empty, an empty text is a lone escape sign."""
    out = value.cast("string")
    for plain, code in _ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return F.coalesce(F.when(out == "", "%").otherwise(out), F.lit(""))


def _unescaped(value):
    out = F.when(value == "%", "").when(value != "", value)
    for plain, code in reversed(_ESCAPES):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return out


def _header():
    """The exact header block of a record, as text."""
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _escaped(F.col("page_id")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.replace(F.replace(F.coalesce(F.col("url"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), _escaped(F.col("refers_to")), F.lit(">"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit("\r\n"),
    )


def write(pages: DataFrame, min_revisit: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    rows = pages.select(
        col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"), F.encode(F.coalesce(col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    facts = materialize(rows.select("page_id", "url", "digest", "payload_bytes"), "warc-facts")
    first = materialize(facts.groupBy("digest").agg(F.min("page_id").alias("first_id")), "warc-first")
    light = facts.join(broadcast_if_fits(first), "digest")
    # Rows with one and the same page_id and payload are all the response: a record does not revisit itself.
    is_revisit = (F.col("payload_bytes") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull()
    records = light.withColumns({"record_type": F.when(is_revisit, "revisit").otherwise("response"), "refers_to": F.when(is_revisit, F.col("first_id"))})
    headers = materialize(records.select(F.encode(_header(), "UTF-8").alias("header"), "digest"), "warc-headers")
    # One holder for each digest; the payload itself moves in this one shuffle only.
    holders = broadcast_if_fits(first.select("digest", F.col("first_id").alias("page_id")), first)
    held = rows.where("page_id is not null").join(holders, ["digest", "page_id"], "left_semi").dropDuplicates(["digest", "page_id"]).select("digest", "payload")
    # Payloads that only rows without an id have; usually there are no such rows, and nothing is moved.
    alone = broadcast_if_fits(first.where("first_id is null").select("digest"), first)
    stored = rows.where("page_id is null").select("digest", "payload").join(alone, "digest").dropDuplicates(["digest"])
    payloads = materialize(held.unionByName(stored), "warc-payloads")
    release(facts, first)
    return Archive(headers, payloads)


def parsed(headers: DataFrame) -> DataFrame:
    """The header bytes back as columns; the digest is what the header itself says."""
    text = F.decode("header", "UTF-8")
    field = lambda name, value: F.regexp_extract(text, r"\r\n" + name + ": " + value + r"\r\n", 1)
    return headers.select(
        "header",
        _unescaped(field("WARC-Record-ID", "<urn:page:([^>]*)>")).alias("page_id"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("digest"),
        _unescaped(field("WARC-Refers-To", "<urn:page:([^>]*)>")).alias("refers_to"),
        field("Content-Length", "([0-9]+)").cast("long").alias("content_length"),
    )


def verified(payloads: DataFrame) -> DataFrame:
    """(digest, payload, payload_bytes); a payload that does not have the digest it is stored under raises."""
    actual = F.sha2("payload", 256)
    return payloads.select(
        F.when(actual == F.col("digest"), actual).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes")
    )


def read(archive: Archive) -> DataFrame:
    """One row for each record: its parsed header with the size and digest of its verified payload."""
    facts = verified(archive.payloads).select(F.col("digest"), "payload_bytes")
    rows = parsed(archive.headers).join(facts, "digest").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return reads(rows, archive.headers, archive.payloads)


def reconstruct(archive: Archive) -> DataFrame:
    """Original records, byte for byte: header block, payload (none in a revisit) and the two line ends; and the full payload."""
    rows = parsed(archive.headers).join(verified(archive.payloads), "digest")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return rows.select("page_id", "record_type", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"), "payload")
