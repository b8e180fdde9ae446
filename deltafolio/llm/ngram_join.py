"""N-gram Jaccard self-join with a count-vector R-tree; exact for any threshold.

A document is its set of 64-bit shingle hashes. The tokens of a set are hashed into ``GROUPS`` groups and the group counts
are its point; the summed coordinate minima of two points bound the overlap of their sets from above, and the coordinate
maxima of an R-tree node bound it for all points below.

One R-tree over all points cannot prune unrelated sets: the maxima of a node of unrelated points are above what any pair
needs, so it visits nearly all pairs of its leaves (measured: README). Its top level is therefore a lossless routing: in one
global order (rare shingles first), two sets as similar as the threshold share at least one of the first n - ceil(t n) + 1
shingles of either. Every set goes to the leaf of each of those, and every leaf is an R-tree that joins itself:

1. equal sets become one representative;
2. leaves of up to ``SMALL`` sets are one node, whose points are all compared. The tree of a larger leaf finds for each set
   the set with a smaller id whose bound leaves most room: pairs are as many as the sets. Leaves of over ``BLOCK`` sets are
   cut into as many trees as that takes;
3. pairs that pass the finer bounds are verified by their true sets, and links make components;
4. larger leaves whose sets are not all in one component by now are joined again in full, but for pairs that already are in
   one component; a leaf of over ``BLOCK`` sets is cut into blocks, each pair of blocks that differs in components is a tree
   of its own. Pairs that share an early leaf are left to it; what is found is verified and joins components. No link between components is lost, and no group of near
   copies is ever expanded into all its pairs.

``links`` gives all pairs of different sets instead, for those who want them: that is quadratic in a group of near copies.

Scale: one row for each (set, prefix shingle) is shuffled, 0.2 of all shingles at 0.8; sets are only rebuilt for documents in
surviving pairs. The order puts common shingles last, the commonest at the very end, so leaves stay small: shingles are counted
exactly, without hashed counters whose noise would grow with the table, in one of ONE_IN documents, and the MOST commonest of those seen
twice there are told apart (any order is lossless; a worse one has larger leaves). Leaves that a sample of the sets shows to be hot
are counted with partial sums and their rows stay in place. No links, components or sets reach the driver: it sees
at most MOST common shingles with their counts, and row counts. What is broadcast is measured first.

Shingles are compared by 64-bit hashes.

Defined results: null, empty and blank texts have no shingles: n_shingles 0, own component, linked with nothing; texts with
fewer words than a shingle are one shingle; repeated rows of one document and all rows that share a doc_id are one node; a
null doc_id is in no component (null); an empty table gives an empty table; whole texts are read; other columns are ignored
by ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_fits, by_size, col, flagged_of, id_type, keyed_text, materialize, reads, release, rows_of

WORDS, PERCENT = 5, 80
GROUPS = 48
#: Groups of the finer point that bounds the pairs which leave the tree.
FINE = 256
#: Larger sets have more groups in the point that bounds candidate pairs: at most DENSITY shingles a group, up to WIDE groups.
DENSITY, WIDE = 4, 4096
#: Shingles are counted in one of so many documents, and at most so many of the commonest are told apart from the others.
ONE_IN, MOST = 8, 1 << 21
#: Leaves up to this size are one node: all their points are compared.
SMALL = 8
#: Sets in one tree; larger leaves are cut.
BLOCK = 512
#: Partners of a set in larger leaves that are verified at first, those it has in most leaves.
LEADS = 4
#: Leaves of a set that are looked up to see whether a pair is made elsewhere.
FIRSTS = 8
#: One in so many sets is looked at to find hot leaves; what it misses is only slower.
SAMPLE = 16
#: A key that holds at least 1/HOT_KEYS of the rows is hot, so there are at most HOT_KEYS of them and they may be broadcast.
HOT_KEYS = 1000
#: Children of an R-tree node.
FANOUT = 16
_MULTIPLIER = 0x9E3779B97F4A7C15


class Shingler:
    """Sorted distinct 64-bit hashes of texts' shingles; words are hashed by tables of random numbers, many texts at once."""

    def __init__(self, words: int = WORDS):
        import numpy as np

        self.words = words
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.table = np.random.default_rng(20240601).integers(0, 1 << 64, 64 * 256, np.uint64)

    def _mixed(self, parts):
        import numpy as np

        out = np.zeros(len(parts[0]), np.uint64)
        for h in parts:
            out = (out ^ h) * np.uint64(_MULTIPLIER)
            out ^= out >> np.uint64(29)
        return out

    def batch(self, texts: list[str | None]) -> list:
        import numpy as np

        k, none = self.words, np.empty(0, np.uint64)
        data = [(t or "").encode().lower() for t in texts]  # lower() of bytes is A-Z only
        buffer = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
        ends = np.cumsum([len(d) + 1 for d in data])
        solid = np.flatnonzero(~self.space[buffer])
        if not len(solid):
            return [none] * len(texts)
        first = np.flatnonzero(np.diff(solid, prepend=-2) > 1)
        starts = solid[first]
        place = solid - np.repeat(starts, np.diff(first, append=len(solid)))
        # Blocks of 64 bytes: a sum of random numbers each, mixed with the block's place before the word's blocks are summed.
        head = np.flatnonzero(place & 63 == 0)
        blocks = np.add.reduceat(self.table[(place & 63) << 8 | buffer[solid]], head)
        blocks = self._mixed([blocks, (place[head] >> 6).astype(np.uint64)])
        h = np.add.reduceat(blocks, np.searchsorted(head, first))
        bounds = np.searchsorted(starts, np.concatenate(([0], ends)))
        shingles = self._mixed([h[j : len(h) - k + 1 + j] for j in range(k)]) if len(h) >= k else none
        out = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = end - begin
            if n >= k:
                out.append(np.unique(shingles[begin : end - k + 1]))
            else:
                out.append(self._mixed([h[begin + j : begin + j + 1] for j in range(n)]) ^ np.uint64(n) if n else none)
        return out

    def __call__(self, text: str | None):
        return self.batch([text])[0]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def needed(n, m, percent: int):
    """Smallest overlap of linked sets of n and m shingles: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def group_counts(hashes, groups: int = GROUPS):
    """Counts by group, one byte each; 255 stands for 255 or more."""
    import numpy as np

    return np.minimum(np.bincount((hashes % np.uint64(groups)).astype(np.int64), minlength=groups), 255).astype(np.uint8)


def wide_groups(n: int) -> int:
    """FINE times a power of two, so that a point folds into any smaller one."""
    groups = FINE
    while groups * DENSITY < n and groups < WIDE:
        groups *= 2
    return groups


def folded(point: bytes, groups: int):
    """A point of fewer groups, as if counted there; full bytes stay full."""
    import numpy as np

    return np.minimum(np.frombuffer(point, np.uint8).reshape(-1, groups).sum(axis=0, dtype=np.int64), 255).astype(np.uint8)


def _opened(points, sizes):
    """Coordinates as whole numbers; a full byte bounds nothing but the set's own size."""
    import numpy as np

    wide = points.astype(np.int32)
    return np.where(points == 255, np.maximum(sizes[..., None].astype(np.int32), 255), wide)


def overlap_bound(a, n, b, m):
    import numpy as np

    return np.minimum(np.minimum(_opened(a, n), _opened(b, m)).sum(axis=-1), np.minimum(n, m))


class CountTree:
    """A bulk-loaded R-tree over count vectors that joins itself: nodes carry coordinate maxima and size ranges."""

    def __init__(self, points, sizes, percent: int = PERCENT):
        import numpy as np

        self.percent = percent
        wide = _opened(points, sizes)
        # Points of like size and like leading counts are packed together.
        self.order = np.lexsort((*wide.T[:3], sizes))
        self.points, self.sizes = wide[self.order], sizes[self.order].astype(np.int64)
        self.levels = [(self.points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            top, low, high = self.levels[-1]
            starts = np.arange(0, len(top), FANOUT)
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def _room(self, level: int, a, b):
        """What the bound leaves over what a link needs; negative where no link is possible."""
        import numpy as np

        top, low, high = self.levels[level]
        out = [np.empty(0, np.int64)]
        for k in range(0, len(a), 4096):
            x, y = a[k : k + 4096], b[k : k + 4096]
            bound = np.minimum(np.minimum(top[x], top[y]).sum(axis=1), np.minimum(high[x], high[y]))
            # With the smallest sizes below, sizes too far apart included: an overlap is at most the smaller size.
            near = (100 * high[x] >= self.percent * low[y]) & (100 * high[y] >= self.percent * low[x])
            out.append(np.where(near, bound - needed(low[x], low[y], self.percent), -1))
        return np.concatenate(out)

    def pairs(self, block: int = 1 << 20) -> Iterator[tuple]:
        """(i, j, room) arrays of input places, i != j, each unordered pair once. ``visited`` counts the node pairs."""
        import numpy as np

        level, self.visited = len(self.levels) - 1, 0
        n = len(self.levels[level][0])
        a, b = np.triu_indices(n)
        stack = [(level, a, b)]
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                keep = a != b
                a, b = a[keep], b[keep]
            self.visited += len(a)
            room = self._room(level, a, b)
            keep = room >= 0
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], self.order[b], room[keep]
                continue
            below = len(self.levels[level - 1][0])
            step = max(1, block // FANOUT**2)
            for k in range(0, len(a), step):
                x = (a[k : k + step, None] * FANOUT + np.arange(FANOUT)).repeat(FANOUT, axis=1).ravel()
                y = np.tile(b[k : k + step, None] * FANOUT + np.arange(FANOUT), (1, FANOUT)).ravel()
                ok = (x < below) & (y < below) & (x <= y)
                stack.append((level - 1, x[ok], y[ok]))


def common_shingles(docs: DataFrame, words: int = WORDS, one_in: int = ONE_IN, most: int = MOST) -> tuple:
    """(hashes, ranks): the commonest shingles as sorted 64-bit hashes, with their places by falling rarity.

    Counted exactly in one of ``one_in`` documents, by a hash of their ids; shingles seen once there are not common. At most ``most`` of
    them reach the driver: all that are seen more often than some count, which the number of shingles by count tells.
    """
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingles = Shingler(words)
        for batch in batches:
            for _, texts in by_size(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles.batch(texts)).view(np.int64))], ["h"])

    own = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0).select("text").mapInArrow(run, "h bigint")
    counted = materialize(own.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "common-shingles")
    levels, total = None, 0
    for row in counted.groupBy("n").agg(F.count("*").alias("times")).orderBy(F.desc("n")).toLocalIterator():
        total += row["times"]
        if total > most:
            break
        levels = row["n"]
    found = counted.where(F.col("n") >= levels).toArrow() if levels else None
    release(counted)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h, n = found.column("h").to_numpy().view(np.uint64), found.column("n").to_numpy()
    ranks = np.empty(len(h), np.uint64)
    ranks[np.lexsort((h, n))] = np.arange(len(h), dtype=np.uint64)
    order = np.argsort(h)
    return h[order], ranks[order]


def in_order(h, common: tuple):
    """The shingles' places in the global order as 64-bit numbers: first those that are not common, by their hash, then the common ones."""
    import numpy as np

    hashes, ranks = common
    places = h >> np.uint64(1)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        known = hashes[at] == h
        places[known] = np.uint64(1 << 63) | ranks[at[known]]
    return places


def sets_table(docs: DataFrame, common: tuple, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, fp (of the whole set), prefix: array<bigint> in the global order, counts, fine and (of larger sets) wide: points."""
    sent = docs.sparkSession.sparkContext.broadcast(common)  # at most MOST hashes and ranks

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        shingles = Shingler(words)
        for whole in batches:
            for batch, texts in by_size(whole, 1):
                sizes, prints, prefixes, points, fine, wide = [], [], [], [], [], []
                for h in shingles.batch(texts):
                    n = len(h)
                    sizes.append(n)
                    prints.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if n else None)
                    points.append(group_counts(h).tobytes() if n else None)
                    fine.append(group_counts(h, FINE).tobytes() if n else None)
                    wide.append(group_counts(h, wide_groups(n)).tobytes() if n > FINE * DENSITY else None)
                    if n:
                        p = prefix_length(n, percent)
                        h = np.sort(np.partition(in_order(h, sent.value), p - 1)[:p])
                    prefixes.append(h.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), *(pa.array(p, pa.binary()) for p in (points, fine, wide))],
                    ["doc_id", "n_shingles", "fp", "prefix", "counts", "fine", "wide"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type(docs, 'doc_id')}, n_shingles bigint, fp binary, prefix array<bigint>, counts binary, fine binary, wide binary")


def _tree_join(rows: DataFrame, node: str, percent: int, labelled: bool) -> DataFrame:
    """R-tree self-joins, one for each key. rows: key, node, n, pos, counts and, if labelled, leaf, side, fine, component and firsts.

    labelled: all pairs within the bounds whose components differ, across the sides where there are two. Else: in keys of up to
    SMALL sets all pairs, in others (near) the pair of each set with the smaller id whose bound leaves most room.

    Sets that share many leaves meet in each of them: a pair whose ``firsts`` (leaves that come first in the sets' order) have an
    earlier leaf in common is left to that one, so the first leaf that two sets share always makes the pair, and few others do.
    """
    spread = rows.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names, kind = ["x", "y", "near"], None

        def joined(held: list) -> Iterator:
            held = [b for b in held if b.num_rows]
            if not held:
                return
            batch = pa.Table.from_batches(held)
            keys = batch.column("key").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            ids, n, p = (batch.column(c).to_numpy() for c in ("node", "n", "pos"))
            points = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint8).reshape(len(ids), GROUPS)
            labels, side = (batch.column(c).to_numpy() if labelled else None for c in ("component", "side"))
            fine = np.frombuffer(b"".join(batch.column("fine").to_pylist()), np.uint8).reshape(len(ids), FINE) if labelled else points

            if labelled:
                order = batch.column("leaf").to_numpy().view(np.uint64)
                firsts = np.frombuffer(b"".join(batch.column("firsts").to_pylist()), np.uint64).reshape(len(ids), FIRSTS)

            def met(i, j):
                """Whether an earlier leaf makes the pair."""
                parts = [np.empty(0, bool)]
                for k in range(0, len(i), 4096):
                    x, y = firsts[i[k : k + 4096]], firsts[j[k : k + 4096]]
                    early = x < order[i[k : k + 4096]][:, None]
                    parts.append(((x[:, :, None] == y[:, None, :]).any(axis=2) & early).any(axis=1))
                return np.concatenate(parts)

            def bounded(i, j):
                """Places of the pairs that the finest points at hand allow."""
                parts = [np.empty(0, bool)]
                for k in range(0, len(i), 4096):
                    x, y = i[k : k + 4096], j[k : k + 4096]
                    parts.append(overlap_bound(fine[x], n[x], fine[y], n[y]) >= needed(n[x], n[y], percent))
                return np.concatenate(parts)

            def kept(i, j, two: bool):
                # The shared shingle's place in either order bounds what the sets share before and after it.
                bound = np.minimum(p[i], p[j]) + np.minimum(n[i] - p[i], n[j] - p[j])
                keep = (bound >= needed(n[i], n[j], percent)) & (ids[i] != ids[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                if labelled:
                    keep &= labels[i] != labels[j]
                return keep & (side[i] != side[j]) if two else keep

            def out(i, j, near: bool):
                return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(np.full(len(i), near))], names)

            sizes = np.diff(starts, append=len(keys))
            # Leaves that are one node, all of them at once: each point with the next, the next but one and so on.
            one = np.flatnonzero(np.repeat(sizes <= SMALL, sizes)) if not labelled else np.empty(0, np.int64)
            for apart in range(1, SMALL):
                i, j = one[:-apart], one[apart:]
                same = keys[i] == keys[j]
                if not same.any():
                    break
                i, j = i[same], j[same]
                keep = kept(i, j, False)
                i, j = i[keep], j[keep]
                ok = bounded(i, j)
                if ok.any():
                    yield out(i[ok], j[ok], False)
            many = np.ones(len(sizes), bool) if labelled else sizes > SMALL
            for begin, size in zip(starts[many].tolist(), sizes[many].tolist()):
                own = slice(begin, begin + size)
                two = labelled and bool(side[own].any())
                if not labelled:
                    rank = np.empty(size, np.int64)
                    rank[np.argsort(ids[own], kind="stable")] = np.arange(size)
                    best = np.full(size, -1, np.int64)
                for i, j, room in CountTree(points[own], n[own], percent).pairs():
                    keep = kept(i + begin, j + begin, two)
                    i, j = i[keep], j[keep]
                    if labelled:
                        keep = ~met(i + begin, j + begin)
                        i, j = i[keep], j[keep]
                        keep = bounded(i + begin, j + begin)
                        if keep.any():
                            yield out(i[keep] + begin, j[keep] + begin, False)
                    else:
                        # The most room first, then the smallest id.
                        low = np.minimum(rank[i], rank[j])
                        np.maximum.at(best, np.maximum(rank[i], rank[j]), room[keep] * size + (size - 1 - low))
                if not labelled:
                    at = np.argsort(rank)
                    child = np.flatnonzero(best >= 0)
                    if len(child):
                        parent = size - 1 - best[child] % size
                        yield out(at[child] + begin, at[parent] + begin, True)

        # Rows come sorted by key: keep those of the last key until it is complete.
        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index("key"))
            last, first = keys[-1].as_py(), keys[0].as_py()
            if held and first == last and first == kind:
                held.append(batch)
                continue
            cut = int(np.searchsorted(keys.to_numpy(), last))
            held.append(batch.slice(0, cut))
            yield from joined(held)
            held, kind = [batch.slice(cut)], last
        if held:
            yield from joined(held)

    return spread.mapInArrow(run, f"x {node}, y {node}, near boolean")


def _firsts(rows: DataFrame, points: DataFrame) -> DataFrame:
    """(node, firsts): the first FIRSTS leaves of each node in the global order, of rows (leaf, node, pos), as unsigned 64-bit
    integers, padded with the largest; no row for nodes that stand for several sets."""
    import numpy as np

    order = Window.partitionBy("node").orderBy("pos", "leaf")
    ranked = rows.select("node", "leaf", "pos").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FIRSTS)
    several = materialize(points.groupBy("node").agg(F.count("*").alias("sets")).where("sets > 1").select("node"), "several")
    lists = ranked.join(broadcast_if_fits(several), "node", "left_anti").groupBy("node").agg(F.collect_list("leaf").alias("firsts"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            packed = [np.array(x + [-1] * (FIRSTS - len(x)), np.int64).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["node", "firsts"])

    return lists.mapInArrow(run, f"node {id_type(rows, 'node')}, firsts binary")


def _in_full(rows: DataFrame, points: DataFrame) -> DataFrame:
    """What the second tree join reads of a table of rows (leaf, node, pos, component): keys and sides, points and firsts."""
    import numpy as np

    none = F.lit(np.full(FIRSTS, -1, np.int64).tobytes())
    of_nodes = points.select("node", "n", "counts", "fine").join(_firsts(rows, points), "node", "left").withColumn("firsts", F.coalesce("firsts", none))
    return _parted(rows).join(of_nodes, "node")


def _parted(rows: DataFrame) -> DataFrame:
    """rows (leaf, node, component, …) with key and side: a key is a leaf, or a pair of blocks of a leaf of over BLOCK sets.

    A component with many sets in the leaf has blocks of its own, and no two of these are paired; the other components are
    dealt to shared blocks.
    """
    per = rows.groupBy("leaf", "component").agg(F.count("*").alias("own"))
    wide = materialize(per.groupBy("leaf").agg(F.sum("own").alias("total")).where(F.col("total") > BLOCK), "wide-leaves")
    whole = rows.withColumns({"key": F.col("leaf"), "side": F.lit(0)})
    if not rows_of(wide):
        release(wide)
        return whole
    few = broadcast_if_fits(wide)
    whole = whole.join(few, "leaf", "left_anti")
    plan = materialize(per.join(few, "leaf").withColumn("cuts", F.when(F.col("own") > BLOCK // 2, F.ceil(F.col("own") / BLOCK))).drop("own"), "wide-plan")
    owned, shared = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("string"), F.pmod(F.xxhash64("component"), F.ceil(F.col("total") / BLOCK)).cast("string")
    block = F.when(F.col("cuts").isNotNull(), F.concat(F.lit("c"), F.col("component").cast("string"), F.lit("/"), owned)).otherwise(F.concat(F.lit("s"), shared))
    cut = rows.join(broadcast_if_fits(plan), ["leaf", "component"]).withColumns({"block": block, "only": F.when(F.col("cuts").isNotNull(), F.col("component"))}).drop("total", "cuts")
    blocks = cut.select("leaf", "block", "only").distinct()
    one, two = blocks.toDF("leaf", "b1", "only1"), blocks.toDF("leaf", "b2", "only2")
    pairs = one.join(two, "leaf").where("b1 <= b2 and coalesce(only1 <> only2, true)").select("leaf", "b1", "b2", F.xxhash64("leaf", "b1", "b2").alias("key"))
    pairs = materialize(pairs, "block-pairs")
    left = cut.join(broadcast_if_fits(pairs.withColumnRenamed("b1", "block"), pairs), ["leaf", "block"]).drop("b2").withColumn("side", F.lit(0))
    right = cut.join(broadcast_if_fits(pairs.where("b1 <> b2").withColumnRenamed("b2", "block"), pairs), ["leaf", "block"]).drop("b1").withColumn("side", F.lit(1))
    return whole.unionByName(left.unionByName(right).drop("block", "only"))


def _bounded(pairs: DataFrame, points: DataFrame, node: str, percent: int) -> DataFrame:
    """Pairs whose summed coordinate minima allow a link, by the finer points."""
    own = lambda c: points.select(F.col("node").alias(c), F.col("n").alias(c + "_n"), F.coalesce("wide", "fine").alias(c + "_fine"))
    both = pairs.join(own("x"), "x").join(own("y"), "y").where((100 * F.col("x_n") >= percent * F.col("y_n")) & (100 * F.col("y_n") >= percent * F.col("x_n")))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                at = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
                a, b = at["x_fine"].to_pylist(), at["y_fine"].to_pylist()
                n, m = at["x_n"].to_numpy(), at["y_n"].to_numpy()
                groups, keep = np.array([min(len(p), len(q)) for p, q in zip(a, b)]), np.zeros(len(a), bool)
                for g in np.unique(groups).tolist():
                    own = np.flatnonzero(groups == g)
                    left, right = (np.stack([folded(points[i], g) for i in own]) for points in (a, b))
                    keep[own] = overlap_bound(left, n[own], right, m[own]) >= needed(n[own], m[own], percent)
                yield pa.RecordBatch.from_arrays([at["x"], at["y"]], ["x", "y"]).filter(pa.array(keep))

    return both.select("x", "y", "x_n", "y_n", "x_fine", "y_fine").mapInArrow(run, f"x {node}, y {node}").distinct()


def _sets(docs: DataFrame, ids: DataFrame, node: str, words: int) -> DataFrame:
    """(node, tokens) of the documents that are in pairs; their texts are read again. Ids that fit are broadcast, so that no text is shuffled."""
    wanted = docs.join(broadcast_if_fits(ids), docs["doc_id"] == ids["node"], "left_semi")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        shingles = Shingler(words)
        for whole in batches:
            for batch, texts in by_size(whole, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.view(np.int64) for h in shingles.batch(texts)], pa.list_(pa.int64()))], ["node", "tokens"])

    return wanted.select("doc_id", "text").mapInArrow(run, f"node {node}, tokens array<bigint>")


def _verified(docs: DataFrame, pairs: DataFrame, node: str, words: int, percent: int) -> DataFrame:
    """Pairs (a table) that are links by their true sets, as a table; what it took is deleted."""
    if not rows_of(pairs):
        return pairs
    ids = materialize(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "pair-ids")
    sets = materialize(_sets(docs, ids, node, words), "pair-sets")
    # Pairs are few by now; each set moves once for each pair it is in.
    both = pairs.join(sets.select(F.col("node").alias("x"), F.col("tokens").alias("x_tokens")), "x").join(sets.select(F.col("node").alias("y"), F.col("tokens").alias("y_tokens")), "y")
    shared = F.size(F.array_intersect("x_tokens", "y_tokens"))
    links = materialize(both.where((100 + percent) * shared >= percent * (F.size("x_tokens") + F.size("y_tokens"))).select("x", "y").distinct(), "pair-links")
    release(ids, sets)
    return links


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have edges (x, y): the smallest node reachable.

    In each round every node points to its smallest neighbour. Such pointers have cycles of two nodes only, of which the smaller
    one is the root; following the pointers' pointers until they settle, as often as the logarithm of the depth, gives each node
    its root, and edges between roots are what the next round sees. A root stands for two nodes or more, so at least half of
    the nodes are gone after each round, whatever the graph: there are logarithmically many rounds and no cap.
    """
    labels = None
    both = materialize(edges.where("x <> y").select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")), F.struct(F.col("y").alias("a"), F.col("x").alias("b")))).alias("e")).select("e.*").distinct(), "links")
    if not rows_of(both):
        return materialize(both.select(F.col("a").alias("node"), F.col("b").alias("component")), "labels")
    while labels is None or rows_of(both):
        chosen = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")), "parents")
        above = lambda t, of: broadcast_if_fits(t.select(F.col("v").alias("p"), F.col("p").alias("g")), of)
        mutual = (F.col("g") == F.col("v")) & (F.col("v") < F.col("p"))
        pointers, parents = chosen.join(above(chosen, chosen), "p").select("v", F.when(mutual, F.col("v")).otherwise(F.col("p")).alias("p")), chosen
        while True:
            # Three steps at a time, so that paths shrink to a quarter.
            far = pointers.select("v", F.col("p").alias("before"), "p")
            for _ in range(3):
                far = far.join(above(pointers, parents), "p").select("v", "before", F.col("g").alias("p"))
            new = materialize(far.select("v", "p", (F.col("p") != F.col("before")).alias("moved")), "parents", flag="moved")
            release(parents)
            pointers = parents = new
            if not flagged_of(parents):
                break
        root = lambda node, name: broadcast_if_fits(parents.select(F.col("v").alias(node), F.col("p").alias(name)), parents)
        if labels is None:
            labels = materialize(parents.select(F.col("v").alias("node"), F.col("p").alias("component")), "labels")
        else:
            new = materialize(labels.join(root("component", "p"), "component", "left").select("node", F.coalesce("p", "component").alias("component")), "labels")
            release(labels)
            labels = new
        new = materialize(both.join(root("a", "ra"), "a").join(root("b", "rb"), "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        release(both, parents)
        both = new
    smallest = labels.groupBy("component").agg(F.min("node").alias("low"))
    out = materialize(labels.join(broadcast_if_fits(smallest, labels), "component").select("node", F.col("low").alias("component")), "labels")
    release(both, labels)
    return out


def looked_up(rows: DataFrame, facts: DataFrame, key: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """rows joined to the one fact of their key. Rows of hot keys (at most HOT_KEYS) meet their facts by a broadcast and are not moved."""
    hot = hot.select(key).distinct()
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    of_hot = marked.where("_hot").drop("_hot").join(F.broadcast(facts.join(F.broadcast(hot), key, "left_semi")), key, how)
    return of_hot.unionByName(marked.where("_hot is null").drop("_hot").join(facts, key, how))


class _Routed:
    """What components() and links() have in common: sets, representatives, and their leaves."""

    def __init__(self, frame: DataFrame, words: int, percent: int):
        self.node = id_type(frame, "doc_id")
        table = materialize(sets_table(frame, common_shingles(frame, words), words, percent), "sets")
        linked, rows = table.where("fp is not null and doc_id is not null"), rows_of(table)
        self.groups = materialize(linked.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("times")).where("times > 1"), "groups")
        self.hot = self.groups.where(F.col("times") * HOT_KEYS >= rows)
        # Documents with the set of another one are left out of all that follows.
        self.copies = materialize(looked_up(linked.select("fp", "doc_id"), self.groups.select("fp", "node"), "fp", self.hot, "inner").where("doc_id <> node").distinct(), "copies")
        kept = linked.join(broadcast_if_fits(self.copies.select("fp", "doc_id"), self.copies), ["fp", "doc_id"], "left_anti")
        self.points = materialize(kept.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "counts", "fine", "wide"), "points")
        self.leaves = materialize(self._leaves(kept, rows), "leaves", flag="hot")
        # Documents whose rows have several sets connect the groups of these sets.
        several = linked.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("doc_id")
        self.stitches = materialize(self.copies.join(several, "doc_id", "left_semi").select(F.col("node").alias("x"), F.col("doc_id").alias("y")), "stitches")
        # The sets are not needed any more: only what the result shows of them is kept.
        self.sizes = materialize(table.select("doc_id", "n_shingles"), "sizes")
        release(table)

    @staticmethod
    def _leaves(kept: DataFrame, rows: int) -> DataFrame:
        """leaf, node, pos, size, hot of the leaves with two sets or more."""
        routed = lambda df: df.select(F.col("doc_id").alias("node"), F.posexplode("prefix").alias("pos", "leaf"))
        sampled = routed(kept.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)).groupBy("leaf").agg(F.count("*").alias("seen"))
        few = materialize(sampled.where(F.col("seen") >= max(SMALL, rows // (SAMPLE * HOT_KEYS))).select("leaf", F.lit(True).alias("_hot")), "hot-leaves")
        if not rows_of(few):
            release(few)
            return routed(kept).withColumns({"size": F.count("*").over(Window.partitionBy("leaf")), "hot": F.lit(False)}).where("size > 1")
        marked = routed(kept).join(broadcast_if_fits(few), "leaf", "left")
        cold = marked.where("_hot is null").select("leaf", "node", "pos").withColumn("size", F.count("*").over(Window.partitionBy("leaf")))
        own = marked.where("_hot").select("leaf", "node", "pos")
        sizes = materialize(own.groupBy("leaf").agg(F.count("*").alias("size")), "hot-sizes")
        return cold.withColumn("hot", F.lit(False)).unionByName(own.join(broadcast_if_fits(sizes), "leaf").withColumn("hot", F.lit(True))).where("size > 1")

    def release(self) -> None:
        release(self.groups, self.copies, self.points, self.leaves, self.stitches, self.sizes)


def components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, one row for each input row."""
    frame = keyed_text(docs, id_col, text_col)
    r = _Routed(frame, words, percent)
    node, leaves, points = r.node, r.leaves, r.points

    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK))
    key = F.when(F.col("size") <= BLOCK, F.col("leaf")).otherwise(F.xxhash64("leaf", salt))
    trees = leaves.select(key.alias("key"), "node", "pos").join(points.select("node", "n", "counts"), "node")
    found = materialize(_tree_join(trees, node, percent, labelled=False).groupBy("x", "y", "near").agg(F.count("*").alias("times")), "tree-pairs")
    # The partners that a set has in most leaves: the sets of a group of near copies mostly agree on them, and step 4 finds what is missed.
    led = found.where("near").withColumn("rank", F.row_number().over(Window.partitionBy("y").orderBy(F.desc("times"), "x"))).where(F.col("rank") <= LEADS)
    candidates = found.where("not near").select("x", "y").unionByName(led.select("x", "y")).distinct()
    pairs = materialize(_bounded(candidates, points, node, percent), "pairs")
    links = _verified(frame, pairs, node, words, percent)
    labels = connected(links)

    large = leaves.where(F.col("size") > SMALL).select("leaf", "node", "pos", "hot")
    labelled = large.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    leaf = Window.partitionBy("leaf")
    mixed = labelled.where("not hot").withColumns({"low": F.min("component").over(leaf), "high": F.max("component").over(leaf)}).where("low <> high").select("leaf", "node", "pos", "component")
    if flagged_of(leaves):
        # Rows of hot leaves stay in place: partial minima and maxima say which leaves to join again.
        busy = labelled.where("hot").select("leaf", "node", "pos", "component")
        ends = materialize(busy.groupBy("leaf").agg(F.min("component").alias("low"), F.max("component").alias("high")), "hot-ends")
        mixed = mixed.unionByName(busy.join(broadcast_if_fits(ends.where("low <> high").select("leaf"), ends), "leaf", "left_semi"))
    mixed = materialize(mixed, "mixed")
    rows = _in_full(mixed, points)
    again = _tree_join(rows, node, percent, labelled=True).select("x", "y").distinct()
    more = materialize(_bounded(again.join(pairs, ["x", "y"], "left_anti"), points, node, percent), "pairs-2")
    links2 = _verified(frame, more, node, words, percent)
    # The first components stand for their members: only what links two of them is closed once more.
    own = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(c + "_of"))
    bridges = links2.unionByName(r.stitches).join(own("x"), "x", "left").join(own("y"), "y", "left").select(F.coalesce("x_of", "x").alias("x"), F.coalesce("y_of", "y").alias("y"))
    merged = connected(bridges.where("x <> y").distinct())
    # Copies have the component of their representative.
    of_copies = looked_up(r.copies.groupBy("doc_id").agg(F.min("node").alias("node")), labels, "node", r.hot).select("doc_id", F.coalesce("component", "node").alias("component"))
    known = labels.select(F.col("node").alias("doc_id"), "component").unionByName(of_copies).unionByName(merged.select(F.col("node").alias("doc_id"), F.col("node").alias("component")))
    tops = broadcast_if_fits(merged.select(F.col("node").alias("component"), F.col("component").alias("top")), merged)
    final = known.join(tops, "component", "left").groupBy("doc_id").agg(F.min(F.coalesce("top", "component")).alias("component"))
    out = materialize(r.sizes.join(final, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")), "components")
    release(found, pairs, links, labels, mixed, more, links2, merged)
    r.release()
    return out


def links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between different sets (x, y: representatives, x < y) and the membership of documents (doc_id, node).

    Every leaf is joined in full, so a group of k near copies with different sets takes k * k / 2 pairs.
    """
    frame = keyed_text(docs, id_col, text_col)
    r = _Routed(frame, words, percent)
    rows = _in_full(r.leaves.select("leaf", "node", "pos", F.col("node").alias("component")), r.points)
    pairs = materialize(_bounded(_tree_join(rows, r.node, percent, labelled=True).select("x", "y").distinct(), r.points, r.node, percent), "pairs")
    out = _verified(frame, pairs, r.node, words, percent)
    members = r.points.select(F.col("node").alias("doc_id"), "node").unionByName(r.copies.select("doc_id", "node")).distinct()
    release(pairs)
    return out, reads(members, r.groups, r.copies, r.points, r.leaves, r.stitches, r.sizes)


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns; rows without an id all stay.

    Of rows that share an id the one with the smallest text stays (nulls first), of equal texts the one whose columns make the
    smallest JSON. Ids to drop are broadcast if they fit, so that texts stay where they are.
    """
    found = components(docs, words, percent, id_col, text_col)
    # A document without shingles is its own component.
    gone = materialize(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct(), "gone")
    twice = materialize(found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1").select("_id"), "twice")
    row = docs.select(F.struct(*(col(c) for c in docs.columns)).alias("_row"), col(id_col).alias("_id"))
    stay = row.join(broadcast_if_fits(gone), "_id", "left_anti")
    few = broadcast_if_fits(twice)
    order = F.struct(F.col("_row")[text_col].cast("string").alias("t"), F.to_json("_row").alias("j"))
    again = stay.join(few, "_id", "left_semi").groupBy("_id").agg(F.min_by("_row", order).alias("_row"))
    stay = stay.join(few, "_id", "left_anti").select("_row").unionByName(again.select("_row"))
    return reads(stay.select(*(F.col("_row")[c].alias(c) for c in docs.columns)), found, gone, twice)
