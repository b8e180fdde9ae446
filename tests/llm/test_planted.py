"""Planted strings in the texts of a table: what the methods add to the fixed kinds."""

import base64
import random

import pytest

from deltafolio.llm import pii, secret_scan

B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r["doc_id"], r["text"] or "") for r in rows]


def planted(texts, make, rng):
    """The texts with a string of ``make`` after some word, and doc_id -> its place."""
    out, where = [], {}
    for i, text in texts:
        words = text.split(" ")
        at = rng.randrange(len(words) + 1)
        before, new = "".join(w + " " for w in words[:at]), make()
        out.append((i, before + " ".join([new, *words[at:]])))
        where[i] = (len(before), len(before) + len(new))
    return out, where


def spans(row, column="spans"):
    return {tuple(map(int, x.split(":")[1:])) for x in row[column].split(",") if x}


def test_random_strings_are_found(spark, texts):
    rng = random.Random(3)
    kinds = [lambda: "".join(rng.choices(B62, k=24)), lambda: "".join(rng.choices(B62, k=40)), lambda: base64.b64encode(rng.randbytes(32)).decode()]
    rows, where = planted(texts, lambda: rng.choice(kinds)(), rng)
    found = 0
    for r in secret_scan.scan(spark.createDataFrame(rows, DOCS)).collect():
        begin, end = where[r["doc_id"]]
        found += sum(max(0, min(end, y) - max(begin, x)) for x, y in spans(r)) >= 0.8 * (end - begin)
    assert found >= 0.95 * len(rows)


def test_plain_documents_and_identifiers_add_nothing(spark, texts):
    rng = random.Random(4)
    names = ["get_the_next_page_of_results", "/usr/share/doc/packages/readme.txt", "https://www.example.com/news/today?id=12345", "123e4567-e89b-42d3-a456-426614174000"]
    rows, _ = planted(texts, lambda: rng.choice(names), rng)
    for table in (texts, rows):
        assert sum(r["n_random"] for r in secret_scan.scan(spark.createDataFrame(table, DOCS)).collect()) == 0


@pytest.mark.parametrize("share", [0.15, 0.6])
def test_unseen_addresses_in_known_contexts(spark, texts, share):
    """Found where most of a context's instances are seeds, never where they are the fewer part; nothing else is added."""
    rng, unseen, n = random.Random(5), {}, 0

    def make():
        nonlocal n
        new = rng.random() < share
        name = "".join(rng.choices("abcdefgh", k=8)) + str(n)
        n += 1
        unseen[n - 1] = new
        return f"please write to {name}@host{'' if new else '.com'} for details"

    rows, where = planted(texts, make, rng)
    wanted = {i: (b + len("please write to "), e - len(" for details")) for k, (i, (b, e)) in enumerate(where.items()) if unseen[k]}
    added = {r["doc_id"]: spans(r) - spans(r, "base_spans") for r in pii.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert wanted and {i: s for i, s in added.items() if s} == ({i: {s} for i, s in wanted.items()} if share < 0.5 else {})
