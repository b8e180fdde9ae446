"""Best-fit packing of token sequences by minimum bin slack.

Documents become token ids and one end id; those longer than a sequence are cut into full pieces and one first piece that
holds the rest. Pieces of a length are alike, so a bin is a multiset of lengths: each bin starts from the longest piece left
and a bitset subset-sum over the lengths still available finds the fullest combination for the rest; it is removed as often
as the available pieces allow, which is what removing it once and searching again would do, since a fullest combination
stays a fullest one while it can be had. The search sees counts by length only: at most ``capacity`` numbers, however many
documents there are, and at most about two patterns for each length.

Scale: token ids are made in one pass over the texts and only (piece, length, checksum) rows go on. Places are dealt by the
rank of a piece among those of its length; ranks come from counts of (length, salt) groups, so a length that a third of all
pieces share is spread over ``SALTS`` groups. The plan is broadcast: at most a few rows for each (pattern, length).

Defined results: a null text is an empty one: just the end id, one piece of length 1; repeated rows are packed each on its
own; an empty table gives an empty table; whole texts are packed, of any length; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_size, id_type, keyed_text, materialize, reads, tokenizer_path

CAPACITY = 2048
SALTS = 1024
END = 0
#: Runs of white space from this length on are not given to the rank encoder, which fails at about a million.
LONG_RUN = 20_000

_ENCODERS: dict[str, object] = {}


def _bytes_of_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str):
    """Ids of the byte-level vocabulary in a tokenizers file. Its ids are its merge ranks, so the faster rank encoder gives
    the same ids as the tokenizers library does; where they are not, and for texts that hold one of the file's added tokens or
    a run of white space that the rank encoder's pattern cannot take (its matcher's stack is bounded), the library is used."""
    if path in _ENCODERS:
        return _ENCODERS[path]
    import regex
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, added = file["model"], [x["content"] for x in file.get("added_tokens") or ()]
    vocabulary, letters = model["vocab"], _bytes_of_letters()
    tool = Tokenizer.from_file(path)
    blank_run = regex.compile(r"\s{%d}" % LONG_RUN).search
    by_library = lambda text: tool.encode(text, add_special_tokens=False).ids
    merged = [("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    if [vocabulary[x] for x in merged] == list(range(256, 256 + len(merged))):
        ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items() if rank < 256 + len(merged)}
        by_rank = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        encode = lambda text: by_library(text) if any(x in text for x in added) or len(text) >= LONG_RUN and blank_run(text) else by_rank(text)
    else:
        encode = by_library
    _ENCODERS[path] = encode
    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, salt and, with keep_ids, ids: array<int>."""
    frame = keyed_text(docs, id_col, text_col)
    schema = f"doc_id {id_type(frame, 'doc_id')}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode = encoder(tokenizer_path(vocabulary))
        for whole in batches:
            for batch, texts in by_size(whole, 1):
                rows, source = [], []
                for k, text in enumerate(texts):
                    ids = np.array([*encode(text or ""), END], "<u4")
                    for n, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length]
                        rows.append((n, start, length, zlib.crc32(own.tobytes()), own.astype("i4") if keep_ids else None))
                        source.append(k)
                columns = [batch.column(0).take(pa.array(source, pa.int64())), *(pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int32(), pa.int64(), pa.int64(), pa.int64()]))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([r[4] for r in rows], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    # Spark's own row numbers would differ in a task that is run again; this salt does not, and equal rows are spread as well.
    return frame.mapInArrow(run, schema).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum within room: bitset subset-sum, long pieces first."""
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            new = (reach | reach << length) & mask
            if new == reach:
                break
            steps.append((length, reach))
            reach = new
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> at & 1:
            at -= length
            out[length] = out.get(length, 0) + 1
    return out


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths in each with how often), until no piece is left."""
    left, out = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        seed = max(left)
        left[seed] -= 1
        own = fullest(left, capacity - seed)
        left[seed] += 1
        own[seed] = own.get(seed, 0) + 1
        times = min(left[n] // m for n, m in own.items())
        for n, m in own.items():
            left[n] -= times * m
            if not left[n]:
                del left[n]
        out.append((times, own))
    return out


def plan_rows(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, pieces a bin, first bin, offset of the first such piece in a bin)."""
    used: dict[int, int] = {}
    rows, bin_ = [], 0
    for times, own in patterns:
        offset = 0
        for length in sorted(own, reverse=True):
            first = used.get(length, 0)
            used[length] = first + times * own[length]
            rows.append((length, first, used[length], own[length], bin_, offset))
            offset += length * own[length]
        bin_ += times
    return rows


def place(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to stored pieces."""
    spark = made.sparkSession
    groups = made.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan_rows(minimum_bin_slack(counts, capacity))
    plan = spark.createDataFrame(rows, "length bigint, lo bigint, hi bigint, each bigint, first_bin bigint, first_offset bigint")
    # Equal (doc_id, piece, checksum) rows are interchangeable, so the rank among them does not matter.
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = made.withColumn("_row", F.row_number().over(order)).join(before, ["length", "salt"]).withColumn("_rank", F.col("before") + F.col("_row") - 1)
    placed = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))).drop(plan["length"])
    k = F.col("_rank") - F.col("lo")
    return placed.withColumns({
        "sequence_id": F.col("first_bin") + F.floor(k / F.col("each")).cast("long"),
        "offset": (F.col("first_offset") + F.pmod(k, F.col("each")) * F.col("length")).cast("long"),
    }).drop("_row", "_rank", "before", "salt", "lo", "hi", "each", "first_bin", "first_offset")


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with keep_ids, ids. The result reads a stored table
    of pieces, which ``release`` deletes. Nulls, ties, repeated rows and empty tables: as above; a null doc_id is an id like any other."""
    made = materialize(pieces(docs, vocabulary, capacity, id_col, text_col, keep_ids), "pack-pieces")
    return reads(place(made, capacity), made)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves; at most ``capacity`` ids meet in a group. Needs keep_ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
