import math
import random

import numpy as np
import pytest

from deltafolio.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n bigint, k string, w double"


def check(got, rows, components=8):
    """Rows of the result against exact sums and a numpy covariance of the centred vectors."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    exact = [[n * c - s for c, s in zip(v, sums)] for v in x]
    centred = np.array([[c / n for c in v] for v in exact])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    k = min(components, d)
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
        assert r["n"] == n
    dev = sorted(((i, sum(c * c for c in v)) for (i, _), v in zip(rows, exact)), key=str)
    white = centred @ vectors / np.sqrt(values)
    for c in range(1, k + 1):
        own = by[c]
        assert sorted(((r["vec_id"], r["deviation"]) for r in own), key=str) == dev
        assert all(abs(r["explained"] - values[c - 1] / np.trace(cov)) <= 1e-9 for r in own)
        gap = min(abs(values[c - 1] - v) for j, v in enumerate(np.linalg.eigvalsh(cov)[::-1]) if j != c - 1) / values[0] if d > 1 else 1
        if gap > 1e-6 and len({i for i, _ in rows}) == n:
            want, have = {i: w for (i, _), w in zip(rows, white[:, c - 1])}, {r["vec_id"]: r["whitened"] for r in own}
            sign = np.sign(sum(want[i] * have[i] for i in want))
            assert max(abs(want[i] - sign * have[i]) for i in want) < 1e-6
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-4


def test_query_equals_brute_force_on_the_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(queries.op13_whitening(spark, sf_dir).collect(), rows)


def test_odd_rows_repeats_and_clashing_columns(spark):
    r = random.Random(2)
    good = [(k, [float(np.float32(r.gauss(j, j + 1))) for j in range(12)]) for k in range(400)]
    good += [(None, good[0][1]), *good[:50]]
    bad = [(7, None), (8, []), (9, [1.0] * 11 + [None]), (10, [float("nan")] * 12), (11, [float("-inf")] * 12), (12, [1.0] * 3)]
    made = spark.createDataFrame([(i, v, 1, 5, "clash", 0.5) for i, v in good + bad], SCHEMA).repartition(4)
    check(whitening.whiten(made).collect(), good)


def test_whitened_rows_have_the_identity_as_covariance(spark, sf_dir):
    got = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=5).toPandas()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    cov = np.cov(wide.T, bias=True)
    assert np.abs(cov - np.eye(5)).max() < 1e-9
    assert got["identity_error"].iloc[0] < 1e-9


def test_fewer_dimensions_no_variance_and_entries_beyond_a_long(spark):
    got = whitening.whiten(spark.createDataFrame([(k, [float(k), 1.0], 1, 0, "", 0.0) for k in range(5)] + [(9, [1e30, 0.0], 1, 0, "", 0.0)], SCHEMA)).collect()
    assert {(r["component"], r["whitened"] is None, r["explained"]) for r in got} == {(1, False, 1.0), (2, True, 0.0)} and len(got) == 10
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1, 0, "", 0.0)] * 3, SCHEMA)).collect()
    assert len(got) == 6 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in got)


def test_deviations_beyond_a_long_are_null_and_exact_before(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 0.5]), (3, [0.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 0, "", 0.0) for i, v in rows], SCHEMA)).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for (i, _), v in zip(rows, x)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: w if w < 1 << 63 else None for i, w in want.items()}


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1, 0, "", 0.0)], [(1, [float("nan")], 1, 0, "", 0.0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


@pytest.mark.parametrize("most", [1, 1 << 20, 1 << 40, 1 << 60])
def test_deviations_are_exact_at_any_size(most):
    r = random.Random(most)
    x = [[r.randint(-most, most) for _ in range(3)] for _ in range(20)]
    sums, n = [sum(c) for c in zip(*x)], 1 << 33
    got = whitening.deviations(np.array(x, np.int64), n, sums)
    assert got.tolist() == [[n * c - s for c, s in zip(v, sums)] for v in x]
    assert (got * got).sum(axis=1).tolist() == [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
