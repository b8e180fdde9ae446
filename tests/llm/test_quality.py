import math
import re
from collections import Counter

import pytest

from deltafolio.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_counts_like_brute_force(documents, odd_docs, no_docs, labels):
    for docs in (documents, odd_docs):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = quality.score(docs, labels).collect()
        assert len(rows) == docs.count()
        for r in rows:
            got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert got == plain(texts[r["doc_id"]]), r["doc_id"]
            assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0])
            assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality.THRESHOLD)
    assert quality.score(no_docs, labels).collect() == []


def test_ratio_is_the_difference_of_two_multinomials(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, "bad junk"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id bigint, quality int")
    ratios = quality.fit(docs, quality.trusted_ids(labels), buckets=1 << 12)
    assert len(ratios) == 1 << 12
    # 5 n-grams are trusted, 8 are in the corpus, one is added to every bucket.
    n, g = (1 << 12) + 8, (1 << 12) + 5
    expected = Counter({round(math.log(1 / g) - math.log(1 / n), 6): (1 << 12) - 8, round(math.log(2 / g) - math.log(2 / n), 6): 0})
    assert Counter(ratios)[max(expected, key=expected.get)] >= (1 << 12) - 8
    assert min(ratios) == round(math.log(1 / g) - math.log(2 / n), 6)


def test_without_labels_only_base_rules_decide(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert all(r["kept"] == (not r["base_failed"]) and r["llr"] == 0 for r in quality.score(documents, none).collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_held_out_good_documents_stay_at_every_size(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    rated = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
    out = "pmod(xxhash64(doc_id), 10) < 2 and quality = 1"
    rows = quality.score(docs, rated.where(f"not ({out})")).where("not base_failed").join(rated, "doc_id")
    held = [r["llr"] for r in rows.where(out).collect()]
    assert len(held) >= 5 and min(held) >= quality.THRESHOLD, min(held)
    bad = [r["kept"] for r in rows.where("quality = 0").collect()]
    assert sum(bad) < len(bad) / 2


def test_filter_keeps_columns(odd_docs, labels):
    kept = quality.filter_documents(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in quality.score(odd_docs, labels).where("kept").collect())
    assert sorted(r["doc_id"] for r in kept.collect()) == ids


def test_no_python_in_the_plan(documents, labels):
    plan = quality.score(documents, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def plain_llr(texts, good, buckets=quality.BUCKETS, prior=quality.PRIOR):
    """id -> mean shrunk log ratio, with another hash library and plain dictionaries. texts: (id, text)."""
    import struct

    import xxhash

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        out = [x if x < 1 << 63 else x - (1 << 64) for x in h]
        pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42)) for a, b in zip(h, h[1:])]
        return [x % buckets for x in out] + [(x if x < 1 << 63 else x - (1 << 64)) % buckets for x in pairs]

    every, trusted = Counter(), Counter()
    for k, text in texts:
        every.update(grams(text))
        if k in good:
            trusted.update(grams(text))
    if not trusted:
        return {k: 0.0 for k, _ in texts}
    share = sum(trusted.values()) / sum(every.values())

    def ratio(b):
        expected = share * every[b]
        return math.log((trusted[b] + prior) / (expected + prior)) + expected / (2 * (expected + prior) ** 2) + share / (expected + prior)

    return {k: sum(map(ratio, grams(text))) / max(len(grams(text)), 1) for k, text in texts}


def test_likelihood_ratio_and_verdict_like_brute_force(documents, odd_docs, labels):
    for docs in (documents, odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
        wanted = plain_llr(rows, good)
        for r in quality.score(docs, labels).collect():
            assert abs(r["llr"] - wanted[r["doc_id"]]) < 2e-4, r["doc_id"]
            if abs(wanted[r["doc_id"]] - quality.THRESHOLD) > 2e-4:
                assert r["kept"] == (not r["base_failed"] and wanted[r["doc_id"]] >= quality.THRESHOLD)
