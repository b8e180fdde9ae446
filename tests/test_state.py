"""What is kept between runs: answers, published editions, files that wait for each other; and ranges of any width."""

import json
import random

import pytest
from pyspark.sql import functions as F

from deltafolio.operators import classify, diffing
from deltafolio.sources import editions
from deltafolio.streaming import landing


def counting(folder):
    """A classifier that leaves a file for every call."""

    def call(old, new):
        import uuid

        (folder / uuid.uuid4().hex).write_text(f"{old}|{new}")
        return classify.rule_classifier(old, new)

    return call


def test_what_was_judged_is_not_asked_again(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    store, call = f"{tmp_path}/store", counting(calls)
    rows = [(k, *(("a b", "b a") if k % 3 else ("x", None)), "clash") for k in range(30)] + [(90, "ab", "c", ""), (91, "a", "bc", "")]
    made = spark.createDataFrame(rows, "k int, old string, new string, digest string").repartition(5)
    want = {k: classify.rule_classifier(o or "", n or "") for k, o, n, _ in rows}
    told = lambda df: {r["k"]: (r["ai_category"], r["ai_reason"]) for r in classify.remembered(df, store, call).collect()}
    assert told(made) == want and len(list(calls.iterdir())) == 4  # once for each distinct pair
    assert told(made) == want and len(list(calls.iterdir())) == 4
    more = made.unionByName(spark.createDataFrame([(99, "new", "pair", "")], made.schema))
    assert told(more) == want | {99: classify.rule_classifier("new", "pair")} and len(list(calls.iterdir())) == 5
    assert classify.remembered(made.limit(0), store, call).count() == 0 and len(list(calls.iterdir())) == 5
    # The whole prompt decides: another template asks anew.
    said = classify.prompt("Title {t}: {old} -> {new}", t=F.lit("T"), old=F.col("old"), new=F.col("new"))
    assert classify.remembered(made, store, call, said).count() == 32 and len(list(calls.iterdir())) == 9


def test_a_run_that_fails_adds_no_answers(spark, tmp_path):
    def broken(old, new):
        raise ValueError("no answer")

    rows = spark.createDataFrame([(1, "a", "b")], "k int, old string, new string")
    with pytest.raises(Exception, match="no answer"):
        classify.remembered(rows, f"{tmp_path}/store", broken)
    assert classify.remembered(rows, f"{tmp_path}/store").first()["ai_category"] == "business_rule_change"


def test_publication_is_whole_wherever_a_run_fails(spark, tmp_path, monkeypatch):
    path, legacy = f"{tmp_path}/state", tmp_path / "state.json"
    legacy.write_text(json.dumps({"a": {"edition_a": "1", "edition_b": "2"}, "z": {"edition_a": "0", "edition_b": "1"}}))
    frame = lambda *rows: spark.createDataFrame(list(rows), "slug string, edition_a string, edition_b string, title string")
    now = lambda: sorted(map(tuple, editions.load_state(spark, path, str(legacy)).collect()))
    before = [("a", "1", "2"), ("z", "0", "1")]
    point = editions._point

    def stop(*_):
        raise RuntimeError("lost before the pointer")

    monkeypatch.setattr(editions, "_point", stop)
    with pytest.raises(RuntimeError):
        editions.save_state(frame(("a", "2", "3", ""), ("b", "1", "2", "")), path, str(legacy))
    assert now() == before and legacy.exists()

    def late(*args):
        point(*args)
        raise RuntimeError("lost after the pointer")

    monkeypatch.setattr(editions, "_point", late)
    with pytest.raises(RuntimeError):
        editions.save_state(frame(("a", "2", "3", ""), ("b", "1", "2", "")), path, str(legacy))
    after = [("a", "2", "3"), ("b", "1", "2"), ("z", "0", "1")]
    assert now() == after and legacy.exists()
    monkeypatch.setattr(editions, "_point", point)
    for k in range(3, 6):
        editions.save_state(frame(("b", str(k), str(k + 1), "")), path, str(legacy))
        assert now() == [after[0], ("b", str(k), str(k + 1)), after[2]] and not legacy.exists()
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("v")]) == 2


def test_files_of_a_manual_wait_for_each_other(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put = lambda name, *rows: (inbox / name).write_text("\n".join(json.dumps({"manual": m, "edition": e, "text": t}) for m, e, t in rows))
    run = lambda wait=3_600_000: landing.land_together(spark, str(inbox), f"{tmp_path}/corpus", f"{tmp_path}/alerts", f"{tmp_path}/state", wait).awaitTermination()
    landed = lambda: sorted((r["manual"], r["edition"]) for r in spark.read.parquet(f"{tmp_path}/corpus").collect())
    told = lambda: sorted((r["manual"], r["edition"], r["verdict"]) for r in spark.read.json(f"{tmp_path}/alerts").collect())
    put("1.json", ("m", "20240101", "x"), ("p", "20240101", "q"), ("p", "20240601", "r"))
    run()
    assert landed() == [("p", "20240101"), ("p", "20240601")]  # m waits
    put("2.json", ("m", "20240601", "y"), ("n", "20240101", "z"), ("d", "20240101", "a"))
    run()  # another query, from the checkpoint
    assert landed() == [("m", "20240101"), ("m", "20240601"), ("p", "20240101"), ("p", "20240601")]
    put("3.json", ("d", "20240101", "b"), ("n", "20240101", "z"), ("t", "1", "a"), ("t", "2", "b"), ("t", "3", "c"))
    run()
    assert told() == [("d", "20240101", "dates"), ("d", "20240101", "dates"), ("t", "1", "size"), ("t", "2", "size"), ("t", "3", "size")]  # n's file came again
    put("4.json", ("p", "20250101", "new"), ("m", "20230101", "old"))
    run(1)
    put("5.json", ("q", "1", "x"))
    run()
    assert ("p", "20250101") in landed() and ("m", "20230101") not in landed()
    assert ("m", "20230101", "no older edition") in told()


def test_ranges_of_any_width_like_all_pairs(spark):
    r = random.Random(12)
    ranges = lambda n: [(r.choice([1, 2]), s, s + r.choice([0, 1, 7, 8, 30, 500, 60_000, 2_000_000]), r.choice(["Reserved", "Name"])) for s in (r.randint(-1000, 5000) for _ in range(n))]
    a, b = ranges(120), ranges(120) + [(1, None, 5, "Reserved"), (1, 9, 3, "Reserved")]
    A, B = (spark.createDataFrame(x, "k int, s int, e int, name string").repartition(4) for x in (a, b))
    want = sorted((k, s, e, n, t, f) for k, s, e, n in a if n == "Name" for q, t, f, m in b if q == k and m == "Reserved" and t is not None and t <= f and s <= f and t <= e)
    assert sorted(tuple(x) for x in diffing.reserved_merges(A, B, ["k"]).select("k", "a_s", "a_e", "a_name", "s", "e").collect()) == want and len(want) > 100
    ok = {(k, s, e) for k, s, e, n in a if n == "Reserved" for q, t, f, m in b if q == k and t == s and f <= e and t <= f and m == "Name"}
    assert {(x["k"], x["rs"], x["re"]) for x in diffing.reserved_splits(A, B, ["k"]).collect()} == ok
    wide = spark.createDataFrame([(1, 0, 2_000_000_000, "Name")], "k int, s int, e int, name string")
    assert diffing._binned(wide, "s", "e").count() <= 2  # not a row for each unit
