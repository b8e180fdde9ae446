import hashlib
import math
import random

import pytest

from deltafolio.llm import queries, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, entry int, code string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The contract, point by point. rows: (vec_id, vector, label) of the kept vectors."""
    vectors = [[math.floor(scale * x) for x in v] for _, v, _ in rows]
    width = -(-len(vectors[0]) // parts)
    cut = lambda v: [(v + [0] * (width * parts - len(v)))[p * width : (p + 1) * width] for p in range(parts)]
    first = {}
    for (i, v, _), x in zip(rows, vectors):
        if i is not None:
            first[i] = min(first.get(i, (v, x)), (v, x))
    starts = [cut(first[i][1]) for i in sorted(first)[:entries]] or [[[0] * width] * parts]
    books = [[s[p] for s in starts] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min(range(len(book)), key=lambda e: (far(part, book[e]), e))
    cuts = [cut(v) for v in vectors]
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cuts:
                groups.setdefault(nearest(c[p], books[p]), []).append(c[p])
            books[p] = [[sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])]
    codes = [[nearest(c[p], books[p]) for p in range(parts)] for c in cuts]
    errors = [sum(far(c[p], books[p][e]) for p, e in enumerate(code)) for c, code in zip(cuts, codes)]
    by = {}
    for (_, _, label), e in zip(rows, errors):
        by[label] = by.get(label, 0) + e
    long = lambda x: x if x is not None and x < 1 << 63 else None
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, bytes(code).hex(), long(e), long(by[label]), digest) for (i, _, label), code, e in zip(rows, codes, errors))


def found(frame):
    return sorted(tuple(r) for r in frame.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def f32(x):
    import numpy as np

    return float(np.float32(x))


def test_query_equals_brute_force_on_the_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(queries.op12_vector_codes(spark, sf_dir)) == plain(rows)


def test_odd_rows_ties_repeats_and_clashing_columns(spark):
    r = random.Random(3)
    good = [(k, [f32(r.choice([-1, -0.5, 0, 0.25, 1])) for _ in range(16)], r.choice([None, 1, 2])) for k in range(300)]
    good += good[:40] + [(1000 + k, good[5][1], 1) for k in range(200)]
    bad = [(7, None, 1), (8, [], 1), (9, [1.0] * 15 + [None], 1), (10, [float("nan")] * 16, 2), (11, [float("inf")] + [0.0] * 15, 2), (12, [1.0] * 8, None)]
    made = spark.createDataFrame([(*x, "clash", 1, "clash") for x in good + bad], SCHEMA).repartition(5)
    assert found(vector_codes.compress(made)) == plain(good)


def test_few_rows_odd_lengths_and_far_components(spark):
    rows = [(4, [1e30, 2.0, -3.0], None), (2, [f32(0.1), 0.0, 5.0], 1), (9, [-1e9, 1e9, 7.0], 1)]
    made = spark.createDataFrame([(*x, "", 0, "") for x in rows], "vec_id bigint, embedding array<double>, label int, v string, entry int, code string")
    for parts in (1, 2, 8):
        assert found(vector_codes.compress(made, parts=parts)) == plain(rows, parts=parts)


def test_null_ids_start_no_entry(spark):
    rows = [(None, [1.0, 2.0], 1)]
    got = vector_codes.compress(spark.createDataFrame([(*rows[0], "", 0, "")], SCHEMA), parts=2).collect()
    assert [(r["vec_id"], r["code"]) for r in got] == [(None, "0000")]
    rows = [(None, [1.0, 2.0], 1), (5, [3.0, 4.0], 1)]
    got = vector_codes.compress(spark.createDataFrame([(*x, "", 0, "") for x in rows], SCHEMA), parts=2).collect()
    assert {r["vec_id"]: r["code"] for r in got} == {None: "0000", 5: "0000"}


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1, "", 0, "")], [(1, [], 1, "", 0, "")]):
        assert vector_codes.compress(spark.createDataFrame(rows, SCHEMA)).count() == 0


@pytest.mark.parametrize("big", [False, True])
def test_tree_assigns_as_plain_search_does_and_compares_less(big):
    import numpy as np

    r = np.random.default_rng(5)
    centres = r.integers(-400, 400, (12, 3)) * 50
    points = (centres[r.integers(0, 12, 5000)] + r.integers(-30, 30, (5000, 3))).astype(float) * ((1 << 30) if big else 1)
    book = vector_codes.whole(np.vstack([points[:12], points[3:5]]))
    tree = vector_codes.KdTree(vector_codes.whole(points[vector_codes.tree_order(points)]))
    entry, counts, sums = tree.assigned(book)
    far = ((tree.points[:, None] - book) ** 2).sum(axis=2)
    assert (entry == far.argmin(axis=1)).all()
    assert counts.tolist() == np.bincount(entry, minlength=14).tolist()
    assert all((sums[e] == tree.points[entry == e].sum(axis=0)).all() for e in range(14) if counts[e])
    assert tree.compared < 2500  # most subtrees are assigned whole
    assert tree.boxes[0][2].tolist() == [tree.points.sum(axis=0).tolist()]
