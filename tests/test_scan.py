import random

import pytest
from pyspark.sql import functions as F

from deltafolio.operators import bands, containers, scan

SCHEMA = "s string, ord int, x int, range_of_scope string, first int"


def rows_like(n, seed=1):
    """One scope with most of the rows, a null one, and some small ones."""
    r = random.Random(seed)
    scopes = ["hot"] * 8 + [None, "a", "b"]
    return [(r.choice(scopes), k, r.choice([None, 1, 2, 3]), "clash", k) for k in r.sample(range(10 * n), n)]


def plain(rows):
    out = []
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s), key=lambda r: r[1])
        run, last, opened = None, None, 0
        for k, r in enumerate(own):
            run = run if r[2] is None else (run or 0) + r[2]
            last = last if r[2] is None else r[2]
            before = own[k - 1][2] if k else None
            opened += int(before == 3)
            coming = next((q[2] for q in own[k:] if q[2] is not None), None)
            out.append((s, r[1], r[2], r[3], r[4], run, last, coming, before, opened))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [1 << 20, 50, 1])
def test_all_scans_at_once_in_ranges_and_whole(spark, split):
    rows = rows_like(700)
    made = spark.createDataFrame(rows, SCHEMA).repartition(5)
    x = F.col("x")
    got = scan.scanned(made, ["s"], ["ord"], {"run": scan.total(x), "last": scan.latest(x), "coming": scan.coming(x), "before": scan.before(x)}, {"opened": scan.total(F.when(F.col("before") == 3, 1).otherwise(0))}, split=split)
    assert got.columns == [*made.columns, "run", "last", "coming", "before", "opened"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_a_large_scope_is_spread_over_many_tasks(spark):
    made = spark.range(20_000).select(F.lit("one").alias("s"), F.col("id").alias("ord"), F.lit(1).alias("x"))
    got = scan.scanned(made, ["s"], ["ord"], {"run": scan.total(F.col("x"))}, split=1000)
    assert got.where("run <> ord + 1").count() == 0
    ranges = spark.read.parquet(got._deltafolio_paths[1])
    sizes = [r["count"] for r in ranges.groupBy("range_of_scope").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 4000 and sum(sizes) == 20_000


def test_empty_and_null_values(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert scan.scanned(none, ["s"], ["ord"], {"run": scan.total(F.col("x"))}, split=0).count() == 0
    nulls = spark.createDataFrame([("a", 1, None, "", 0), ("a", None, None, "", 0)], SCHEMA)
    got = scan.scanned(nulls, ["s"], ["ord"], {"run": scan.total(F.col("x")), "last": scan.latest(F.col("x"))}, split=1).collect()
    assert [(r["run"], r["last"]) for r in got] == [(None, None)] * 2


@pytest.mark.parametrize("split", [1 << 20, 40])
def test_operators_give_the_same_in_ranges(spark, monkeypatch, split):
    """Paths, sections, captions, clusters and as-of marks of one large scope against plain loops."""
    r = random.Random(4)
    rows = [("hot" if k % 9 else None, k, r.choice([1, 2, 3, None, 5]), r.choice(["t", "u", None]), r.choice([0.0, 1.0, 2.5, 9.0, 30.0])) for k in range(600)]
    monkeypatch.setattr(scan.scanned, "__kwdefaults__", {"split": split})
    df = spark.createDataFrame(rows, "s string, ord int, level int, text string, v double").repartition(4)
    by = {s: sorted((x for x in rows if x[0] == s), key=lambda x: x[1]) for s in ("hot", None)}
    want_path, want_section, want_carried, want_cluster = {}, {}, {}, {}
    for own in by.values():
        open_, section, caption = {}, 0, None
        for _, k, level, text, _ in own:
            if level in (1, 2, 3):
                open_ = {j: t for j, t in open_.items() if j <= level}
                if text is not None:
                    open_[level] = text
            section += level == 1
            caption = text or caption
            want_path[k], want_section[k], want_carried[k] = " > ".join(open_[j] for j in sorted(open_)), section, caption
        cluster, last = 1, None
        for _, k, _, _, v in sorted(own, key=lambda x: (x[4], x[1])):
            cluster += last is not None and v - last > 2
            want_cluster[k], last = cluster, v
    got = lambda df, c: {x["ord"]: x[c] for x in df.collect()}
    assert got(containers.section_ord(df, ["s"], F.col("level") == 1), "section") == want_section
    assert got(containers.carried(df, ["s"], F.col("text"), "caption"), "caption") == want_carried
    assert got(bands.gap_cluster(df, ["s"], "v", 2, ["ord"]), "cluster") == want_cluster
    paths = got(containers.heading_path(df, ["s"], "level", "text"), "path")
    assert paths == want_path
    marks = [("hot" if k % 3 else None, k, f"m{k}") for k in range(5, 600, 7)]
    m = spark.createDataFrame(marks, "s string, at int, place string")
    for forward in (False, True):
        want = {}
        for s, own in by.items():
            for _, k, *_ in own:
                near = [(a, n) for q, a, n in marks if q == s and (a >= k if forward else a <= k)]
                want[k] = (min if forward else max)(near)[1] if near else None
        assert got(bands.asof(df, m, ["s"], "ord", "at", "place", forward), "place") == want
