import random
import zlib

import pytest

from deltafolio.llm import compression_classifier as cc
from deltafolio.llm import queries


@pytest.fixture(scope="module")
def prose():
    r = random.Random(11)
    words = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(400)]
    return lambda n, seed: " ".join(random.Random(seed).choices(words, k=n))


@pytest.fixture(scope="module")
def corpus(prose):
    """(doc_id, text, label): odd ids are bad (shouted, marked or repeated words)."""
    out = []
    for k in range(400):
        text = prose(20 + k % 200, k)
        if k % 4 == 1:
            text = (" ".join(w + "!!" for w in text.upper().split()), " ".join(w + "###" for w in text.split()), " ".join([text.split()[0]] * 150))[k % 3]
        out.append((k, text, int(k % 4 != 1)))
    return out


def frames(spark, corpus):
    docs = spark.createDataFrame([(k, t, 1.0, 5, "x") for k, t, _ in corpus], "doc_id bigint, text string, score double, quality int, source string")
    labels = spark.createDataFrame([(k, q, 0) for k, _, q in corpus], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(spark, corpus):
    got = cc.classify(*frames(spark, corpus)).collect()
    truth = {k: q for k, _, q in corpus}
    assert {r["doc_id"]: r["held_out"] for r in got} == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in truth}
    held = [r for r in got if r["held_out"]]
    assert len(held) > 60 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_held_out_labels_other_columns_and_order_change_nothing(spark, corpus):
    docs, labels = frames(spark, corpus)
    held = cc.held_out(labels["doc_id"])
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).orderBy(F.desc("doc_id"))
    want = sorted((r["doc_id"], r["score"]) for r in cc.classify(docs, labels).collect())
    assert sorted((r["doc_id"], r["score"]) for r in cc.classify(docs.drop("source", "score").repartition(7), other).collect()) == want


def test_scores_are_those_of_the_fitted_parts(spark, corpus):
    docs, labels = frames(spark, corpus)
    good, bad, model = cc.fit(docs.select("doc_id", "text"), labels)
    sizes = cc.Sizes(good, bad)
    want = {k: cc.chance(model, sizes(t)) for k, t, _ in corpus}
    assert {r["doc_id"]: r["score"] for r in cc.classify(docs, labels).collect()} == want


def test_the_curve_is_calibrated():
    r = random.Random(5)
    points, labels = [], []
    for _ in range(6000):
        x, y = r.gauss(0, 1), r.gauss(0, 2)
        points.append((x, y))
        labels.append(int(r.random() < 1 / (1 + 2.718281828 ** -(1.0 + 2.0 * x - 0.5 * y))))
    model = cc.curve(points, labels, [1.0] * len(points))
    assert abs(model[0] - 1) < 0.2 and abs(model[1] - 2) < 0.25 and abs(model[2] + 0.5) < 0.12
    scores = [cc.chance(model, p) for p in points]
    for low in (0.1, 0.3, 0.5, 0.7):
        own = [y for s, y in zip(scores, labels) if low <= s < low + 0.2]
        assert abs(sum(own) / len(own) - (low + 0.1)) < 0.06
    half = cc.curve(points, labels, [2.0 if y else 1.0 for y in labels])  # a label counted twice moves the constant by log 2
    assert abs(half[0] - model[0] - 0.693) < 0.15


def test_odd_rows(spark, odd_docs, no_docs, corpus):
    _, labels = frames(spark, corpus)
    got = cc.classify(odd_docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[0] == by[1]  # null and empty
    assert cc.classify(no_docs, labels).count() == 0
    nulls = spark.createDataFrame([(None, "some text"), (None, None)], "doc_id bigint, text string")
    assert [(r["doc_id"], r["held_out"]) for r in cc.classify(nulls, labels).collect()] == [(None, False)] * 2


def test_without_enough_labels_scores_are_the_share_of_good_ones(spark, corpus):
    docs, labels = frames(spark, corpus)
    for some, want in ((labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.limit(0), 0.5), (labels.selectExpr("doc_id", "cast(null as int) quality"), 0.5)):
        assert {r["score"] for r in cc.classify(docs, some).collect()} == {want}
    both = labels.selectExpr("doc_id", "0 quality").unionByName(labels.selectExpr("doc_id", "1 quality"))
    assert {r["score"] for r in cc.classify(docs, both).collect()} == {0.5}


def test_query_on_the_whole_table(spark, sf_dir):
    got = queries.op11_compression_classifier(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.8 * len(held)  # some sixty labels to learn from
