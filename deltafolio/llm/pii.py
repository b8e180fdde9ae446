"""Personal data: four fixed kinds, and identifiers discovered by bootstrapped contextual extraction.

The spans of the fixed kinds are seeds. Every mention (a seed, or an unknown run of words that each hold a digit or an at
sign, such as grouped numbers) has lexical patterns: the two words before it, and the word on either side. Patterns and
instances form a graph that Spark scores in rounds: a pattern's confidence in a kind is the share of its instances that belong
to it, if at least ``min_support`` distinct instances do; an instance belongs to a kind if 1 - prod(1 - confidence) over the
patterns that hold reaches ``min_confidence``. Instances that do stay accepted and join the next round's seeds, until a round
accepts none; their mentions become spans. Logarithms are summed as whole numbers, so no result depends on an order; of kinds
of equal confidence, the first listed wins.

Scale: texts are read twice in the pipeline and once in the query, and never shuffled for scoring; the graph holds mentions
only, pre-aggregated to (pattern, instance) before it is shuffled. A round costs a few aggregations of the graph; there are as
many as the longest chain of discoveries. Nothing reaches the driver but row counts. Tables are broadcast where they fit.

Defined results: a null text is an empty one; repeated rows give repeated rows, with the same spans; an empty table gives an
empty table; whole texts are read, and neither mentions nor patterns are cut: those of over ``LONG`` characters stand in the
graph as digests; spans are code points, end exclusive; other columns are kept by ``redact`` and ignored by ``scan``. A null
doc_id is an id like any other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Covered, broadcast_if_fits, by_size, col, id_type, keyed_text, materialize, reads, release, rows_of

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match can only begin where a run of digits does: any later start in the run sees the same rest.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_MARK = re.compile(r"[0-9@]")
#: Longer instances and patterns are digests in the graph.
LONG = 200
_STOP = frozenset(".,;:!?")
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&"


def emails(text: str) -> list[tuple[int, int]]:
    """Each at sign with the run of allowed characters before it, back to the last match, and a domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _marked_words(text: str) -> Iterator[tuple[int, int]]:
    """Words that hold a digit or an at sign, found from there outwards."""
    m = _MARK.search(text)
    while m:
        begin, end = m.start(), m.end()
        while begin and not text[begin - 1].isspace():
            begin -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        yield begin, end
        m = _MARK.search(text, end)


def _runs(text: str, taken: Covered) -> Iterator[tuple[int, int]]:
    """Marked words that no fixed span meets; neighbours on one line, with one blank and no stop between them, make one run."""
    open_at = close_at = -1
    for begin, end in _marked_words(text):
        if taken.meets(begin, end):
            begin = -1
        if open_at >= 0 and begin == close_at + 1 and text[close_at] in " \t\xa0" and text[close_at - 1] not in _STOP:
            close_at = end
            continue
        if open_at >= 0:
            yield open_at, close_at
        open_at, close_at = begin, end
    if open_at >= 0:
        yield open_at, close_at


def _stripped(text: str, begin: int, end: int) -> tuple[int, int]:
    """Without marks at the edges; a bracket that is closed within stays."""
    run = text[begin:end]
    lead, rear = len(run) - len(run.lstrip(_EDGE)), len(run) - len(run.rstrip(_EDGE))
    if lead and run[lead - 1] == "(" and ")" in run[lead : len(run) - rear]:
        lead -= 1
    return begin + lead, end - rear


def _word_before(text: str, at: int) -> tuple[int, str]:
    while at and text[at - 1].isspace():
        at -= 1
    end = at
    while at and not text[at - 1].isspace():
        at -= 1
    return at, text[at:end].lower().strip(_EDGE)


def _word_after(text: str, at: int) -> str:
    n = len(text)
    while at < n and text[at].isspace():
        at += 1
    begin = at
    while at < n and not text[at].isspace():
        at += 1
    return text[begin:at].lower().strip(_EDGE)


def _name(text: str) -> str:
    return text if len(text) <= LONG else "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, str, str]]:
    """(kind or -1, start, end, instance, pattern before, pattern around) of the seeds and of unknown runs."""
    found, taken = list(base), Covered((s, e) for _, s, e in base)
    for begin, end in _runs(text, taken):
        start, end = _stripped(text, begin, end)
        if start < end and _MARK.search(text, start, end):
            found.append((-1, start, end))
    out = []
    for kind, s, e in found:
        at, near = _word_before(text, s)
        _, far = _word_before(text, at)
        instance = _name(" ".join(text[s:e].lower().split()))
        out.append((kind, s, e, instance, _name(f"{far} {near} _".strip()), _name(f"{near} _ {_word_after(text, e)}")))
    return out


_MENTION = "array<struct<kind:int,s:int,e:int,instance:string,before:string,around:string>>"


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the text's hash, n_email, n_ip, n_card, n_phone, base_spans, found (mentions). No shuffle."""
    frame = keyed_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    names = ["doc_id", "text_hash", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "found"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        mention = pa.list_(pa.struct([("kind", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("instance", pa.string()), ("before", pa.string()), ("around", pa.string())]))
        keys = ("kind", "s", "e", "instance", "before", "around")
        for whole in batches:
            for batch, texts in by_size(whole, 2):
                counts, spans, found = [], [], []
                for text in texts:
                    base = base_spans(text) if text else []
                    counts.append([sum(k == kind for k, _, _ in base) for kind in range(4)])
                    spans.append(joined(base))
                    found.append([dict(zip(keys, m)) for m in mentions(text, base)] if text else [])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)), pa.array(spans, pa.string()), pa.array(found, mention)], names)

    return frame.mapInArrow(run, f"doc_id {id_type(frame, 'doc_id')}, text_hash bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, found {_MENTION}")


def discover(extracted: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(instance, kind) of unknown instances that the graph accepts, as a table."""
    m = extracted.select(F.explode("found").alias("m")).select("m.*")
    edges = materialize(
        m.select("instance", "kind", F.explode(F.array("before", "around")).alias("pattern")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges"
    )
    accepted = materialize(edges.select("instance", "kind").limit(0), "pii-accepted")
    while True:
        own = broadcast_if_fits(accepted.select("instance", F.col("kind").alias("found_kind")), accepted)
        known = edges.join(own, "instance", "left")
        kind = F.when(F.col("kind") >= 0, F.col("kind")).otherwise(F.coalesce("found_kind", F.lit(-1)))
        # A handful of rows for each pattern: one for each kind at most.
        patterns = (
            known.groupBy("pattern", kind.alias("kind")).agg(F.count("*").alias("n"))
            .groupBy("pattern")
            .agg(F.sum("n").alias("total"), F.max(F.when(F.col("kind") >= 0, F.struct("n", (-F.col("kind")).alias("minus")))).alias("best"))
            .where((F.col("best.n") >= min_support) & (F.col("best.n") >= min_confidence / 2 * F.col("total")))
            .select("pattern", (-F.col("best.minus")).alias("kind"), F.round(F.log1p(-F.col("best.n") / (F.col("total") + 1)) * -1e12).cast("bigint").alias("weight"))
        )
        patterns = materialize(patterns, "pii-patterns")
        scored = (
            known.where("kind = -1 and found_kind is null").select("pattern", "instance").join(broadcast_if_fits(patterns), "pattern")
            .groupBy("instance", "kind").agg(F.sum("weight").alias("weight"))
            .groupBy("instance").agg(F.max(F.struct("weight", (-F.col("kind")).alias("minus"))).alias("best"))
            .where((1 - F.exp(F.col("best.weight") / -1e12)) >= min_confidence)
            .select("instance", (-F.col("best.minus")).alias("kind"))
        )
        new = materialize(scored, "pii-new")
        release(patterns)
        if not rows_of(new):
            release(edges, new)
            return accepted
        both = materialize(accepted.unionByName(new), "pii-accepted")
        release(accepted, new)
        accepted = both


def discovered_spans(extracted: DataFrame, accepted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, s, e) of the mentions of accepted instances, each once, as a table."""
    unknown = extracted.select("doc_id", "text_hash", F.explode("found").alias("m")).where("m.kind = -1").select("doc_id", "text_hash", "m.s", "m.e", "m.instance")
    return materialize(unknown.join(broadcast_if_fits(accepted), "instance").select("doc_id", "text_hash", "kind", "s", "e").distinct(), "pii-spans")


def _by_text(spans: DataFrame) -> DataFrame:
    """_id, _hash, extra: a text's discovered spans, in order; broadcast if they fit."""
    grouped = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.array_sort(F.collect_list(F.struct("kind", "s", "e"))).alias("extra"))
    return broadcast_if_fits(grouped, spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans (all), n_discovered. One row for each input row."""
    found = materialize(extract(docs, id_col, text_col), "pii-found")
    accepted = discover(found, min_support, min_confidence)
    spans = discovered_spans(found, accepted)
    release(accepted)
    rows = found.drop("found").join(_by_text(spans), F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("text_hash").eqNullSafe(F.col("_hash")), "left")
    kinds = F.array(*(F.lit(k) for k in KINDS))
    one = F.transform(F.filter(F.split("base_spans", ","), lambda x: x != ""), lambda x: F.struct((F.array_position(kinds, F.split(x, ":")[0]) - 1).cast("int").alias("kind"), F.split(x, ":")[1].cast("int").alias("s"), F.split(x, ":")[2].cast("int").alias("e")))
    every = F.array_sort(F.concat(one, F.coalesce("extra", F.array().cast("array<struct<kind:int,s:int,e:int>>"))))
    text = F.array_join(F.transform(every, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    out = rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans", F.when(F.col("extra").isNull(), F.col("base_spans")).otherwise(text).alias("spans"), F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_discovered"))
    return reads(out, found, spans)


def _mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans become one placeholder, of the kind that starts first."""
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The same rows and columns with every span replaced by its kind in the text; length_col gets the new length."""
    found = materialize(extract(docs, id_col, text_col), "pii-found")
    accepted = discover(found)
    spans = discovered_spans(found, accepted)
    release(found, accepted)
    row = docs.select(F.struct(*(col(c) for c in docs.columns)).alias("_row"), col(id_col).alias("_doc"), col(text_col).cast("string").alias("_text"))
    both = row.join(_by_text(spans), F.col("_doc").eqNullSafe(F.col("_id")) & F.xxhash64("_text").eqNullSafe(F.col("_hash")), "left")
    both = both.select("_row", "_text", F.transform("extra", lambda x: F.array(x["kind"], x["s"], x["e"])).alias("_extra"))
    schema = both.select("_row").schema.add("_text", "string")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch, own in by_size(whole, 1):
                texts = []
                for text, more in zip(own, batch.column(2).to_pylist()):
                    texts.append(text if not text else _mask(text, base_spans(text) + [tuple(x) for x in more or ()]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_row", "_text"])

    new = {text_col: F.col("_text")}
    if length_col in docs.columns:
        new[length_col] = F.char_length("_text").cast(docs.schema[length_col].dataType)
    out = both.mapInArrow(run, schema).select(*((new[c] if c in new else F.col("_row")[c]).alias(c) for c in docs.columns))
    return reads(out, spans)
