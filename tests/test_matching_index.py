"""The index of similar texts, greedy matching in rounds, and section moves, held against plain search."""

import random
from difflib import SequenceMatcher

import pytest

from deltafolio.operators import candidates, matching


def texts_like(n, seed, words=60, least=0, most=9, letters="abcdefgéñ"):
    """Texts of random words, some of them copies with a letter or a word changed."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(words)]
    out = []
    for _ in range(n):
        if out and r.random() < 0.4:
            t = list(r.choice(out))
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(t) + 1)
                t[k : k + r.randint(0, 1)] = r.choice(["x", " ", ""])
            out.append("".join(t))
        else:
            out.append(" ".join(r.choice(vocabulary) for _ in range(r.randint(least, most))))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "s int, k string, ord int, text string")


def sides(n, seed, **options):
    texts = texts_like(2 * n, seed, **options)
    r = random.Random(seed + 1)
    r.shuffle(texts)
    return [(r.choice([1, 1, 1, 2]), "q", j, t) for j, t in enumerate(texts[:n])], [(r.choice([1, 1, 1, 2]), "q", j, t) for j, t in enumerate(texts[n:])]


@pytest.mark.parametrize("threshold", [0.3, 0.76, 0.85, 0.95])
def test_no_similar_pair_is_missed_and_edges_are_all(spark, threshold):
    a, b = sides(150, int(threshold * 100))
    odd = ["", "a", "b", "ab", "ba", "aaa", "aab", "abc", "🙂🙂", "🙂a"]
    a += [(1, "q", 1000 + j, t) for j, t in enumerate(odd)] + [(None, "q", 2000, "abc"), (1, "q", 2001, None)]
    b += [(1, "q", 1000 + j, t) for j, t in enumerate(odd)] + [(None, "q", 2000, "abc"), (1, "q", 2001, None)]
    want = {}
    for s, _, i, x in a:
        for q, _, j, y in b:
            if s is not None and s == q and x is not None and y is not None and (ratio := SequenceMatcher(None, x, y).ratio()) >= threshold:
                want[s, "q", i, j] = ratio
    A, B = frame(spark, a), frame(spark, b)
    found = candidates.candidates(A, B, ["s", "k"], threshold).collect()
    assert set(want) <= {tuple(r) for r in found} and len(found) == len(set(found))
    assert {tuple(r)[:4]: r["ratio"] for r in matching.fuzzy_edges(A, B, ["s", "k"], threshold).collect()} == want


@pytest.mark.parametrize("words, most", [(40, 1.1), (7, 4.0)])
def test_candidates_are_few_in_a_large_scope(spark, words, most):
    """Paragraphs of which each is similar to one other have as many candidates as paragraphs, names a small multiple; all pairs are n * n."""
    r = random.Random(3)
    letters, n = "eeeeeetttttaaaaooooiiinnnsssrrrhhhlddduucmfpgwybvkxjqz", 1200
    texts = [" ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(r.randint(words - 2, words + 2))) for _ in range(n)]
    a, b = (frame(spark, [(1, "q", j, t + end) for j, t in enumerate(texts)]) for end in ("", "x"))
    found = candidates.candidates(a, b, ["s", "k"], 0.9).count()
    assert n <= found <= most * n, found


def plain_greedy(edges, mode):
    taken, used = [], set()
    for s, i, j, ratio, tag in sorted(edges, key=(lambda e: (str(e[0]), e[1], -e[3], e[2])) if mode == "serial" else (lambda e: (str(e[0]), -e[3], e[1], e[2]))):
        if (s, "a", i) not in used and (s, "b", j) not in used:
            used |= {(s, "a", i), (s, "b", j)}
            taken.append((s, i, j, ratio, tag))
    return sorted(taken, key=str)


@pytest.mark.parametrize("mode", ["serial", "global"])
@pytest.mark.parametrize("tail", [30, 1 << 20])
def test_rounds_give_the_greedy_choice(spark, mode, tail):
    r = random.Random(tail)
    edges = {(s, r.randrange(25), r.randrange(25)): r.choice([0.5, 0.75, 0.9, 0.9, 1.0]) for s in (1, 2, None) for _ in range(120)}
    rows = [(*k, v, f"t{k}") for k, v in edges.items()]
    got = matching.greedy_assign(spark.createDataFrame(rows, "s int, a_ord int, b_ord int, ratio double, tag string").repartition(6), ["s"], mode, tail).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain_greedy(rows, mode)


def test_a_long_chain_of_ever_lighter_edges(spark):
    """Each edge waits for the one before: as many rounds as every second edge, and no more."""
    rows = [(1, (k + 1) // 2, k // 2, 1.0 - k / 100, "") for k in range(12)]
    got = matching.greedy_assign(spark.createDataFrame(rows, "s int, a_ord int, b_ord int, ratio double, tag string"), ["s"], "global", 0)
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain_greedy(rows, "global")
    none = spark.createDataFrame([], "s int, a_ord int, b_ord int, ratio double, tag string")
    assert matching.greedy_assign(none, ["s"], "global", 0).count() == 0


def coverage_of(old, new):
    hits = 0
    pool_a, pool_b = [], []
    for tag, i, j, k, m in SequenceMatcher(None, old, new, autojunk=False).get_opcodes():
        if tag == "equal":
            hits += j - i
        elif tag == "replace":
            x, y = " ".join(old[i:j]), " ".join(new[k:m])
            if x == y:
                hits += j - i
            elif SequenceMatcher(None, x, y).ratio() >= 0.95:
                hits += 1
            else:
                pool_a += old[i:j]
                pool_b += new[k:m]
    for x in pool_a:
        best = max(((SequenceMatcher(None, x, y).ratio(), -n) for n, y in enumerate(pool_b) if len(x) >= 60 and len(y) >= 60), default=(0, 0))
        if best[0] >= 0.9:
            hits += 1
            pool_b.pop(-best[1])
    return hits / len(old)


def plain_moves(removed, added):
    found = []
    for (s, a), old in removed.items():
        for (q, b), new in added.items():
            if s == q and min(len(old), len(new)) >= 0.5 * max(len(old), len(new)) and coverage_of(old, new) >= 0.8:
                found.append((s, a, b, round(coverage_of(old, new), 3), len(old), len(new)))
    return sorted(x for x in found if sum(y[:2] == x[:2] for y in found) == 1 and sum((y[0], y[2]) == (x[0], x[2]) for y in found) == 1)


def moved(spark, removed, added):
    side = lambda d: spark.createDataFrame([(s, n, k, t) for (s, n), ps in d.items() for k, t in enumerate(ps)], "s int, section string, ord int, text string")
    return sorted(tuple(r) for r in matching.section_moves(side(removed), side(added), ["s"]).collect())


def test_moves_by_coverage(spark):
    long = "the amount of the fee that a member pays for each transaction of this kind is set out below"
    removed = {
        (1, "kept"): ["one", "two", "three", "four", "five"], (1, "half"): ["x", "x", "x", "p", "q", "r"], (1, "reflowed"): ["alpha beta", "gamma", "delta"], (1, "reworded"): [long + str(k) * 3 for k in range(5)],
        (1, "lone"): [long + " and " + long], (1, "twin"): ["t1", "t2"], (1, "common"): ["n/a"] * 3 + ["u1", "u2", "u3", "u4"], (2, "kept"): ["one"],
    }
    added = {
        (1, "k2"): ["one", "two", "three", "four", "six"], (1, "h2"): ["x", "x", "x", "u", "v", "w"], (1, "r2"): ["alpha", "beta gamma", "delta"], (1, "w2"): [long.replace("member", "bank") + str(k) * 3 for k in range(5)],
        (1, "l2"): [long, "and " + long + "."], (1, "t3"): ["t1", "t2"], (1, "t4"): ["t1", "t2", "t5"], (1, "c2"): ["n/a"] * 4, (2, "k3"): ["two"],
    }
    want = plain_moves(removed, added)
    assert moved(spark, removed, added) == want
    assert {x[1:3] for x in want} == {("kept", "k2"), ("reflowed", "r2"), ("reworded", "w2"), ("lone", "l2")}


def test_moves_like_all_pairs(spark):
    r = random.Random(8)
    pool = ["n/a", *texts_like(40, 5, words=40, least=1, most=25)]
    section = lambda: [r.choice(pool) for _ in range(r.randint(1, 7))]
    removed = {(r.choice([1, 2]), f"a{k}"): section() for k in range(25)}
    added = {}
    for k, ((s, _), ps) in enumerate(removed.items()):
        ps = list(ps) if k % 2 else section()
        if len(ps) > 1 and k % 3 == 0:
            ps[0:2] = [ps[0] + " " + ps[1]]
        if k % 5 == 0:
            ps[-1] += " x"
        added[s, f"b{k}"] = ps
    want = plain_moves(removed, added)
    assert moved(spark, removed, added) == want and len(want) > 3


def test_copies_count_a_repeated_paragraph_as_often_as_both_have_it(spark):
    side = lambda d: spark.createDataFrame([(1, n, t) for n, ps in d.items() for t in ps], "s int, section string, text string")
    removed, added = {"a": ["x", "x", "x", "p", "q", "r"], "c": ["m", "m", "n", "n", "o"]}, {"b": ["x", "x", "x", "u", "v", "w"], "d": ["n", "m", "n", "m", "z"]}
    got = matching.section_copies(side(removed), side(added), ["s"]).collect()
    assert [tuple(r) for r in got] == [(1, "c", "d", 4, 5, 5)]
    assert matching.section_copies(side(removed).limit(0), side(added), ["s"]).count() == 0


def plain_copies(removed, added, coverage=0.8, size_ratio=0.5):
    found = []
    for (s, a), old in removed.items():
        for (q, b), new in added.items():
            shared = sum(min(old.count(t), new.count(t)) for t in set(old) if t is not None)
            if s == q and shared and min(len(old), len(new)) >= size_ratio * max(len(old), len(new)) and shared >= coverage * len(old):
                found.append((s, a, b, shared, len(old), len(new)))
    return sorted(x for x in found if sum(y[:2] == x[:2] for y in found) == 1 and sum((y[0], y[2]) == (x[0], x[2]) for y in found) == 1)


@pytest.mark.parametrize("coverage, size_ratio", [(0.8, 0.5), (0.5, 0.2), (0.1, 0.9)])
def test_copies_like_all_pairs(spark, coverage, size_ratio):
    r = random.Random(int(coverage * 10))
    texts = ["common"] * 3 + ["often", None] + [f"t{k}" for k in range(30)]
    sections = lambda p: {(r.choice([1, 2]), f"{p}{k}"): [r.choice(texts) for _ in range(r.randint(1, 9))] for k in range(60)}
    removed, added = sections("a"), sections("b")
    for k, ((s, _), old) in enumerate(list(removed.items())[:25]):
        added[s, f"c{k}"] = [*old[k % 3 :], "more"][:: r.choice([1, -1])]
    side = lambda d: spark.createDataFrame([(s, n, t) for (s, n), ps in d.items() for t in ps], "s int, section string, text string")
    got = matching.section_copies(side(removed), side(added), ["s"], coverage, size_ratio).collect()
    want = plain_copies(removed, added, coverage, size_ratio)
    assert sorted(tuple(x) for x in got) == want and want


def test_sections_that_hold_the_same_are_compared_once(spark, monkeypatch):
    """300 sections of one content on either side: no table has a row for each pair of them."""
    rows = []

    def counted(df, label, make=matching.materialize):
        out = make(df, label)
        rows.append(matching.rows_of(out))
        return out

    monkeypatch.setattr(matching, "materialize", counted)
    side = lambda p: spark.createDataFrame([(1, f"{p}{k}", "n/a") for k in range(300)] + [(1, f"{p}x", t) for t in ("u", "v", "n/a")], "s int, section string, text string")
    got = matching.section_copies(side("a"), side("b"), ["s"]).collect()
    assert [tuple(r) for r in got] == [(1, "ax", "bx", 3, 3, 3)] and max(rows) < 10, rows


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_mutual_nearest_like_all_pairs(spark, block):
    from pyspark.sql import functions as F

    a, b = sides(40, 6, words=6, most=2)
    a += [(3, "q", 900, None), (3, "q", 901, "x"), (4, "q", 902, None), (None, "q", 903, "x")]
    b += [(3, "q", 900, "xy"), (4, "q", 901, None), (4, "q", 902, "x"), (None, "q", 903, "x")]
    A, B = frame(spark, a).withColumn("ord", F.col("ord").cast("bigint")), frame(spark, b).withColumn("ord", F.col("ord").cast("bigint"))
    edges = A.toDF("s", "k", "a_ord", "a_text").join(B.toDF("s", "k", "b_ord", "b_text"), ["s", "k"]).withColumn("distance", F.levenshtein("a_text", "b_text"))
    want = matching.mutual_best(edges.withColumn("ratio", -F.col("distance")), ["s", "k"]).select("s", "a_ord", "b_ord", "distance").collect()
    got = matching.mutual_nearest(A, B, ["s", "k"], block).select("s", "a_ord", "b_ord", "distance").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 5


def test_equal_texts_are_compared_once(spark, tmp_path):
    """20,000 rows of five texts on either side in one scope: 25 comparisons, not 400 million."""
    from pyspark.sql import functions as F

    from deltafolio.plans import catalogue

    rows = spark.range(40000).select(F.col("id").alias("p_partkey"), F.concat(F.lit("name"), F.floor(F.col("id") / 2) % 5).alias("p_name"), F.lit("Brand#1").alias("p_brand"), F.lit("SMALL").alias("p_type"))
    rows.write.parquet(f"{tmp_path}/part.parquet")
    found = catalogue.queries()["fuzzy_mutual_best"](spark, str(tmp_path))
    assert "levenshtein" not in found._jdf.queryExecution().toString()  # pairs are gone before the result is read
    assert sorted(map(tuple, found.collect())) == [(2 * k, 2 * k + 1, 0) for k in range(5)]


def test_opcodes_are_those_of_difflib():
    r = random.Random(4)
    for n in range(400):
        old = r.sample(range(60), r.randint(0, 40)) if n % 3 else [r.randrange(30) for _ in range(r.randint(0, 25))]
        new = [x for x in old if r.random() < 0.8]
        for _ in range(r.randint(0, 4)):
            k, m = sorted((r.randint(0, len(new)), r.randint(0, len(new))))
            new = new[m:] + new[k:m] + new[:k] if r.random() < 0.4 else new[:k] + [r.randint(100, 900)] + new[k:]
        old, new = [str(x) for x in old], [str(x) for x in new]
        assert matching.opcodes(old, new) == SequenceMatcher(None, old, new, autojunk=False).get_opcodes(), (old, new)


def test_a_long_section_with_many_small_changes_is_aligned_at_once():
    """60,000 rows of which each tenth goes and each tenth comes: difflib looks through the rest of the section for each of 12,000 stretches."""
    import time

    old, new = ([f"c{k}" for k in range(60000) if k % 10 != gone] for gone in (1, 2))
    began = time.process_time()
    found = matching.opcodes(old, new)
    assert time.process_time() - began < 5 and sum(j - i for tag, i, j, _, _ in found if tag == "equal") == 48000


def test_unlike_stretches_are_told_by_bounds(monkeypatch):
    """The quadratic ratio is not computed for replaced stretches whose lengths or characters rule it out."""

    class Counted(SequenceMatcher):
        def ratio(self):
            raise AssertionError("computed")

    with monkeypatch.context() as m:
        m.setattr(matching, "SequenceMatcher", Counted)
        assert [x[0] for x in matching.align(["a" * 500, "k", "abc" * 90], ["a" * 300, "k", "xyz" * 90])] == ["pool", "exact", "pool"]
    assert matching.align(["a long paragraph of words"], ["a long paragraph of word"])[0][0] == "fuzzy"


def test_an_index_is_never_broadcast(spark):
    """Spark takes an index, a row for each gram, for as small as its texts: 18.7 million rows went through the driver."""
    A, B = (frame(spark, rows) for rows in sides(20, 9))
    plan = candidates.candidates(A, B, ["s", "k"], 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def syllables(r, n):
    return " ".join("".join(r.choice(["an", "the", "er", "on", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_sections_of_one_language_are_no_candidates(spark, monkeypatch):
    """Texts of the same syllables share most of their grams; only sections that can reach the coverage are aligned."""
    r, sizes = random.Random(12), {}

    def counted(df, label, *flag, make=matching.materialize):
        out = make(df, label, *flag)
        sizes[label] = matching.rows_of(out)
        return out

    monkeypatch.setattr(matching, "materialize", counted)
    removed = {(1, f"a{k}"): [syllables(r, r.randint(14, 24)) for _ in range(3)] for k in range(40)}
    added = {(1, f"b{k}"): [syllables(r, r.randint(14, 24)) for _ in range(3)] for k in range(40)}
    for k in range(8):
        added[1, f"b{k}"] = [p + " more" for p in removed[1, f"a{k}"]]
    got = moved(spark, removed, added)
    assert got == plain_moves(removed, added) and len(got) == 8 and sizes["section-candidates"] < 20, sizes


@pytest.mark.parametrize("block, lengths", [(2, 64), (1024, 0), (1, 1)])
def test_similar_sections_miss_none(spark, monkeypatch, block, lengths):
    """Sections without an equal paragraph: small blocks, sections that are too large to look for partners, and no lengths."""
    from deltafolio.operators import alike

    monkeypatch.setattr(alike, "BLOCK", block)
    monkeypatch.setattr(alike, "LENGTHS", lengths)
    r = random.Random(block)
    removed = {(r.choice([1, 2]), f"a{k}"): [syllables(r, r.choice([2, 14, 16, 24])) for _ in range(r.randint(1, 6))] for k in range(40)}
    added = {(s, f"b{n}"): [p + " x" for p in ps][: r.choice([9, 9, 2])] + [syllables(r, 20)] * r.choice([0, 0, 1]) for (s, n), ps in removed.items()}
    r = random.Random(7)
    for ps in added.values():
        r.shuffle(ps)
    want = plain_moves(removed, added)
    assert moved(spark, removed, added) == want
    assert len(want) > 5


@pytest.mark.parametrize("threshold", [0.3, 0.8, 0.9, 0.95])
def test_a_common_subsequence_bounds_every_ratio(threshold):
    from deltafolio.operators import alike

    near = 0
    for x in texts_like(60, 3, most=40):
        for y in (*texts_like(30, 3, most=40), x[3:], x + "é", x[: len(x) // 2] + x[len(x) // 2 + 7 :], x[::-1], ""):
            if SequenceMatcher(None, x, y).ratio() >= threshold:
                near += 1
                assert alike.can_reach(x, alike.masks(x), y, threshold), (x, y)
                assert alike.pairs_of([len(x)], [len(y)], threshold) == 1
    assert near > 100 and not alike.can_reach("ab" * 300, alike.masks("ab" * 300), "cd" * 300, threshold)


@pytest.mark.parametrize("few", [0, 5, 1 << 20])
def test_pools_with_and_without_an_index(spark, few):
    a, b = sides(60, 21)
    A, B = (frame(spark, rows) for rows in (a, b))
    listed = lambda df: sorted(tuple(r) for r in df.collect())
    want = listed(matching.fuzzy_edges(A, B, ["s", "k"], 0.8, 5))
    assert listed(matching.pooled_edges(A, B, ["s", "k"], 0.8, 5, few)) == want and want


def test_pool_stretches_hold_their_own_paragraphs(spark, tmp_path):
    """A section with many replaced stretches isn't read again for each of them."""
    long = "the amount of the fee that a member pays for each transaction of this kind is set out below "
    old = [f"c{k}" if k % 3 else f"{k} {long}" for k in range(90)]
    new = [f"c{k}" if k % 3 else f"{long} {90 - k}" if k % 2 else f"gone {k}" for k in range(90)]
    spark.createDataFrame([("s", old, new), ("t", [], ["x"])], "k string, old array<string>, new array<string>").write.parquet(f"{tmp_path}/whole")
    got = matching.align_and_pool(spark.read.parquet(f"{tmp_path}/whole"), ["k"])
    assert not [f for f in got.inputFiles() if "/whole/" in f]
    rows = got.where("k = 's'").collect()
    for begin, end in (("a_from", "a_to"), ("b_from", "b_to")):
        assert sorted(p for r in rows if r[begin] is not None for p in range(r[begin], r[end])) == list(range(90))
    assert {r["status"] for r in rows} == {"exact", "fuzzy", "removed", "added"} and [tuple(r) for r in got.where("k = 't'").collect()] == [("t", "added", 0, 0, 0, 1)]
