import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from deltafolio.llm import packing


def ids_by_library(texts):
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tool.encode_special_tokens = True
    return [x.ids + [0] for x in tool.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(docs, capacity=2048):
    source = docs.select("doc_id", "text").collect()
    ids = {r["doc_id"]: x for r, x in zip(source, ids_by_library([r["text"] for r in source]))}
    rows = packing.pack(docs, capacity=capacity).collect()
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] <= capacity and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        assert r["piece"] == 0 or r["length"] == capacity
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        parts[r["doc_id"]].append(r["length"])
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= capacity
    for r in source:
        assert sum(parts[r["doc_id"]]) == len(ids[r["doc_id"]]) * sum(x["doc_id"] == r["doc_id"] for x in source)
    total = sum(r["length"] for r in rows)
    assert not rows or len(bins) <= -(-total // capacity) * 1.01 + 1
    return rows


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs, capacity=16)
    assert check(no_docs) == []


def test_added_tokens_like_the_library_by_default():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tool, encode = Tokenizer.from_file(path), packing.encoder(path)
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", "a <|endoftext| > b", "plain words"):
        assert list(encode(text)) == tool.encode(text, add_special_tokens=False).ids, text
    assert list(encode("a <|endoftext|> b")) == [64, 220, 50256, 275]


def test_long_runs_like_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tool, encode = Tokenizer.from_file(path), packing.encoder(path)
    n = 2_000_000
    for text in (" " * n, "\n" * n, "\r\n" * (n // 2), "x" + " " * n + "y", "a" * n, "7" * n, "\u3000" * (n // 3), "=" * n, " " * (packing.LONG_RUN - 1) + "z"):
        assert list(encode(text)) == tool.encode(text, add_special_tokens=False).ids, text[:9]


def test_blank_runs_in_documents(spark):
    check(spark.createDataFrame([(1, " " * 1_500_000), (2, "a" + "\n" * 1_200_000 + "b"), (3, "word " * 9), (None, "x")], "doc_id bigint, text string"))


def test_sequences_hold_the_ids(documents):
    packed = packing.pack(documents, keep_ids=True)
    sizes = {r["sequence_id"]: len(r["ids"]) for r in packing.sequences(packed).collect()}
    assert sizes == {r["sequence_id"]: r["n"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}


def test_fullest_combination_like_trying_all():
    r = random.Random(2)
    for _ in range(300):
        items = [r.randint(1, 30) for _ in range(r.randint(0, 9))]
        room = r.randint(0, 60)
        best = max(sum(c) for n in range(len(items) + 1) for c in combinations(items, n) if sum(c) <= room)
        counts = {n: items.count(n) for n in set(items)}
        got = packing.fullest(counts, room)
        assert sum(n * m for n, m in got.items()) == best and all(m <= counts[n] for n, m in got.items())


def test_plan_uses_every_piece_once():
    r = random.Random(4)
    for _ in range(50):
        counts = {r.randint(1, 100): r.randint(1, 1000) for _ in range(r.randint(1, 40))}
        patterns = packing.minimum_bin_slack(counts, 100)
        used = defaultdict(int)
        for times, own in patterns:
            assert sum(n * m for n, m in own.items()) <= 100
            for n, m in own.items():
                used[n] += times * m
        assert dict(used) == counts and len(patterns) <= 2 * len(counts) + 40
