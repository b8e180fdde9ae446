import random

import numpy as np

from deltafolio.llm import ngram_join as nj


def shingles(text):
    words = [bytes(w) for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def plain(rows):
    sets = {}
    for k, text in rows:
        sets.setdefault(k, []).append(shingles(text))
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            for x in sets[ids[a]]:
                for y in sets[ids[b]]:
                    i = len(x & y)
                    if i and 100 * i >= 80 * (len(x) + len(y) - i):
                        p, q = sorted((find(ids[a]), find(ids[b])))
                        parent[q] = p
    return sorted((k, len(shingles(t)), find(k)) for k, t in rows)


def got(docs):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.components(docs).collect())


def test_documents_like_all_pairs(documents):
    assert got(documents) == plain([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    assert got(odd_docs) == plain([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert got(no_docs) == []
    nulls = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f")], "doc_id bigint, text string")
    assert sorted(map(str, (tuple(r) for r in nj.components(nulls).collect()))) == ["(2, 2, 2)", "(3, 2, 2)", "(None, 2, None)"]


def test_large_leaves_chains_and_copies(spark):
    """Near copies that drift, so that links chain far beyond the threshold, in leaves of over SMALL sets; and one passage that all share."""
    r = random.Random(13)
    passage = [f"p{k}" for k in range(30)]
    rows, words = [], [f"w{k}" for k in range(100)]
    for k in range(120):
        if k % 4 == 0:
            words = list(words)
            words[r.randrange(100)] = f"n{k}"
        rows.append((1000 - k, " ".join(words)))
    for k in range(120):
        rows.append((2000 + k, " ".join(passage + [f"q{r.randrange(40)}" for _ in range(r.choice([4, 5, 6, 8, 60]))])))
    r.shuffle(rows)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)


def test_tree_finds_every_pair_within_the_bound():
    r = np.random.default_rng(5)
    for n in (1, 2, 17, 300):
        base = r.integers(0, 8, (max(1, n // 5), nj.GROUPS))
        points = np.clip(base[r.integers(0, len(base), n)] + r.integers(-1, 2, (n, nj.GROUPS)), 0, 255).astype(np.uint8)
        sizes = points.astype(int).sum(axis=1)
        found = {(min(a, b), max(a, b)) for i, j, _ in nj.CountTree(points, sizes).pairs() for a, b in zip(i.tolist(), j.tolist())}
        wanted = set()
        for a in range(n):
            bound = nj.overlap_bound(points[a], sizes[a : a + 1], points, sizes)
            ok = (bound >= nj.needed(sizes[a], sizes, 80)) & (100 * sizes >= 80 * sizes[a]) & (100 * sizes[a] >= 80 * sizes)
            wanted |= {(a, b) for b in np.flatnonzero(ok).tolist() if b > a}
        assert wanted <= found


def test_keep_one(spark, odd_docs):
    kept = nj.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in got(odd_docs)})


def test_wide_points_fold():
    import numpy as np

    from deltafolio.llm import ngram_join as N

    random = np.random.default_rng(3)
    for n in (1, 1024, 1025, 5000, 40000):
        h = random.integers(0, 1 << 64, n, np.uint64)
        groups = N.wide_groups(n)
        point = N.group_counts(h, groups).tobytes()
        assert groups == min(4096, max(256, 1 << (-(-n // 4) - 1).bit_length()))
        for g in (256, groups):
            assert (N.folded(point, g) == N.group_counts(h, g)).all()
    full = np.full(512, 200, np.uint8).tobytes()
    assert (N.folded(full, 256) == 255).all()


def test_rows_that_share_an_id_join_the_groups_of_their_sets(spark):
    one, two, other = ("a b c d e f g h", "p q r s t u v w", "k l m n o i j x")
    rows = [(3, one), (7, one), (5, two), (7, two), (9, two), (8, other), (8, None), (None, one)]
    found = {(r["doc_id"], r["component_id"]) for r in nj.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {(3, 3), (7, 3), (5, 3), (9, 3), (8, 8), (None, None)}


def test_lookup_by_hot_and_rare_keys(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(30)] + [(9, 90)], "key bigint, value bigint")
    facts = spark.createDataFrame([(0, "a"), (1, "b"), (4, "c")], "key bigint, fact string")
    hot = spark.createDataFrame([(0,), (2,)], "key bigint")
    names = {0: "a", 1: "b"}
    wanted = sorted(((k % 3, k, names.get(k % 3)) for k in range(30)), key=str) + [(9, 90, None)]
    left = nj.looked_up(rows, facts, "key", hot)
    assert sorted(map(tuple, left.select("key", "value", "fact").collect()), key=str) == sorted(wanted, key=str)
    inner = nj.looked_up(rows, facts, "key", hot, "inner")
    assert sorted(map(tuple, inner.select("key", "value", "fact").collect()), key=str) == sorted((w for w in wanted if w[2]), key=str)


def test_chains_of_any_order_settle(spark):
    n, r = 2000, random.Random(3)
    falling = [1, *range(n, 1, -1)]
    shuffled = r.sample(range(1, n + 1), n)
    for path in (list(range(1, n + 1)), falling, shuffled):
        edges = spark.createDataFrame(list(zip(path, path[1:])), "x bigint, y bigint")
        found = nj.connected(edges).collect()
        assert len(found) == n and {r["component"] for r in found} == {1}
    stars = [(k, 5000) for k in range(1, 300)] + [(5000 + k, 5001 + k) for k in range(50)] + [(9000, 9001)]
    found = {r["node"]: r["component"] for r in nj.connected(spark.createDataFrame(stars, "x bigint, y bigint")).collect()}
    assert set(found.values()) == {1, 9000} and len(found) == 299 + 51 + 2


def test_long_revision_history(spark):
    """Sliding documents, each linked with its neighbours only; ids run 1, n, n - 1, …, 2."""
    n = 600
    ids = [1, *range(n, 1, -1)]
    rows = [(ids[k], " ".join(f"w{j}" for j in range(k * 8, k * 8 + 94))) for k in range(n)]
    assert {c for _, _, c in got(spark.createDataFrame(rows, "doc_id bigint, text string"))} == {1}


def test_long_words_stay_apart(spark):
    one, two = "=" * 64 + "-" * 128 + "=" * 64, "-" * 64 + "=" * 128 + "-" * 64
    swapped = "a" * 64 + "b" * 64 + "c" * 64, "b" * 64 + "a" * 64 + "c" * 64
    hashes = [int(nj.Shingler()(w)[0]) for w in (one, two, *swapped, "a" * 64, "a" * 65, "a" * 128)]
    assert len(set(hashes)) == len(hashes)
    assert {c for _, _, c in got(spark.createDataFrame([(1, one), (2, two), (3, two)], "doc_id bigint, text string"))} == {1, 2}


def test_leaves_of_many_trees(spark, monkeypatch):
    """Blocks of a few sets only: near copies, clusters and a shared passage over many trees and pairs of blocks."""
    monkeypatch.setattr(nj, "BLOCK", 12)
    monkeypatch.setattr(nj, "SAMPLE", 1)
    r = random.Random(29)
    rows = []
    for cluster in range(4):
        base = [f"s{k}" for k in range(12)] + [f"c{cluster}_{k}" for k in range(70)]
        for k in range(40):
            words = list(base)
            for _ in range(r.randrange(3)):
                words[r.randrange(70, 82)] = f"e{r.randrange(9)}"
            rows.append((cluster * 100 + k, " ".join(words)))
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(docs) == plain(rows)
    found, members = nj.links(docs)
    sets = {k: shingles(t) for k, t in rows}
    of = {m["doc_id"]: m["node"] for m in members.collect()}
    assert set(of) == set(sets) and all(sets[k] == sets[v] for k, v in of.items())
    heads = sorted(set(of.values()))
    wanted = {(a, b) for a in heads for b in heads if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(x["x"], x["y"]) for x in found.collect()} == wanted and len(wanted) > 300


def test_the_tree_makes_the_pairs_of_large_leaves(spark, monkeypatch):
    """Tree pairs of sets in leaves of over SMALL sets, and that they are as many as the sets at most."""
    r = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[:20] + [w if r.random() > 0.02 else f"x{k}" for w in base[20:]])) for k in range(60)]
    seen, real = [], nj._tree_join

    def spied(trees, node, percent, labelled):
        out = real(trees, node, percent, labelled)
        if not labelled:
            seen.append(out.where("near").distinct().count())
        return out

    monkeypatch.setattr(nj, "_tree_join", spied)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)
    assert seen and 0 < seen[0]
    n = 400
    points = np.random.default_rng(1).integers(0, 3, (n, nj.GROUPS)).astype(np.uint8)
    points[: n // 2] = points[0]
    tree = nj.CountTree(points, points.astype(int).sum(axis=1))
    near = sum(len(i) for i, _, _ in tree.pairs())
    assert near >= (n // 2) * (n // 2 - 1) // 2 and tree.visited < n * n


def test_keep_one_of_rows_that_share_an_id(spark):
    rows = [(1, "b c d e f g"), (1, "a c d e f g"), (2, None), (2, "z"), (None, "q"), (None, "q")]
    kept = nj.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a c d e f g"), (2, None), (None, "q"), (None, "q")], key=str)


def test_long_documents_of_few_words(spark):
    """Long texts that share shingles by chance, some of them near copies of each other."""
    r = random.Random(41)
    words = [f"v{k}" for k in range(7)]
    rows = []
    for k in range(24):
        text = [r.choice(words) for _ in range(1500)]
        rows.append((10 * k, " ".join(text)))
        for j in range(r.randrange(3)):
            for _ in range(r.choice([5, 30, 60])):
                text[r.randrange(1500)] = r.choice(words)
            rows.append((10 * k + j + 1, " ".join(text)))
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)


def test_the_order_is_by_exact_counts_of_a_sample_and_bounded(spark):
    texts = [f"x{k} y{k} z{k} u{k} v{k} " + "a b c d e f g h " * (k % 3 > 0) + "p q r s t " * (k % 2) for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    hashes, ranks = nj.common_shingles(docs, one_in=1)
    count = {}
    for h in nj.Shingler().batch(texts):
        for x in h.tolist():
            count[x] = count.get(x, 0) + 1
    assert hashes.tolist() == sorted(h for h, n in count.items() if n > 1)
    assert sorted(ranks.tolist()) == list(range(len(hashes)))
    by_rank = [count[h] for _, h in sorted(zip(ranks.tolist(), hashes.tolist()))]
    assert by_rank == sorted(by_rank)
    few, _ = nj.common_shingles(docs, one_in=1, most=5)
    assert 0 < len(few) <= 5 and min(count[h] for h in few.tolist()) > max(count[h] for h in set(hashes.tolist()) - set(few.tolist()))
    own = nj.in_order(np.array(sorted(count), np.uint64), (hashes, ranks))
    rare = [p for p, h in zip(own.tolist(), sorted(count)) if count[h] == 1]
    assert max(rare) < 1 << 63 and all(p >= 1 << 63 for p, h in zip(own.tolist(), sorted(count)) if count[h] > 1) and len(set(own.tolist())) == len(own)
    assert [len(x) for x in nj.common_shingles(docs.where("doc_id < 0"))] == [0, 0]


def test_no_order_loses_a_link(spark, documents, monkeypatch):
    want = got(documents)
    for one_in, most in ((1, 1 << 20), (1000, 3), (2, 50)):
        made = nj.common_shingles
        monkeypatch.setattr(nj, "common_shingles", lambda frame, words, a=one_in, b=most: made(frame, words, a, b))
        assert got(documents) == want
        monkeypatch.undo()
