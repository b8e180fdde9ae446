"""Vector code compression: one codebook for each part of the vectors, fitted by filtering Lloyd rounds; exact whole-number arithmetic.

A component x becomes floor(scale * x); a vector is cut into ``parts`` equal consecutive parts. Each codebook starts as that part
of the ``entries`` smallest vec_ids. A round assigns every part to its nearest entry (squared Euclidean distance, ties to the
lower index) and moves each entry to floor(sum / count) of its parts; unused entries stay.

The method: every partition builds kd-trees over the parts of CHUNK vectors at a time, one tree for each position, and stores
them. A tree's nodes carry bounding boxes, counts and sums. In a round the codebook goes down the tree: an entry that is nowhere
in a node's box nearer than the entry nearest to its middle is eliminated for all points below, and a node with one entry left
is assigned as a whole, by its count and sum. Only in leaves with several entries left are points compared one by one.

Scale: the vectors are read once; each round reads the trees (in the folder that executors share, so a lost executor costs its
tasks only), and only counts and sums of the entries leave a task: parts * entries * (1 + part length) numbers, which Spark adds
up before they reach the driver. No vector is shuffled. Errors by label are partial sums; hot labels are looked up by a broadcast.

Defined results: rows whose vector is null, empty, or holds null or non-finite components go, as do vectors of another length than
the commonest one (vectors.usable); a length that ``parts`` does not divide is padded with zeros; repeated rows are rows
of their own, but a vec_id starts one entry only (with the smallest of its vectors); a null vec_id starts none; with fewer
vec_ids than ``entries`` there are as many entries (no vec_id at all: one entry of zeros); components of any finite size are
exact, an error beyond a long is null; null labels are one label; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_fits, fits, materialize, reads, release, rows_of
from .ngram_join import HOT_KEYS, looked_up
from .vectors import matrix, usable

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors whose trees are built together: memory is bounded by this many.
CHUNK = 4096
#: Points of a tree's leaf, at most.
LEAF = 16
#: Components up to this size are 64-bit integers, larger ones whole numbers without a bound.
SMALL = 1 << 24


def whole(values):
    """float64 whole numbers as int64, or as Python integers where squares could pass a long."""
    import numpy as np

    if not values.size or np.abs(values).max() <= SMALL:
        return values.astype(np.int64)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(x) for x in values.ravel().tolist()]
    return out


def _cuts(n: int) -> list:
    """Places of the nodes of each level, ends included: every node is halved until leaves hold LEAF points or fewer."""
    import numpy as np

    levels = [np.array([0, n])]
    while np.diff(levels[-1]).max() > LEAF:
        ends = levels[-1]
        levels.append(np.insert(ends, np.arange(1, len(ends)), (ends[:-1] + ends[1:]) // 2))
    return levels


def tree_order(points):
    """Order of the points in their kd-tree: nodes are cut at the median of their widest dimension."""
    import numpy as np

    order = np.arange(len(points))
    for ends in _cuts(len(points))[:-1]:
        own = points[order]
        wide = (np.maximum.reduceat(own, ends[:-1]) - np.minimum.reduceat(own, ends[:-1])).argmax(axis=1)
        node = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        order = order[np.lexsort((own[np.arange(len(own)), wide[node]], node))]
    return order


class KdTree:
    """Points in tree order, with the boxes, counts and sums of all nodes, made from the leaves up."""

    def __init__(self, points):
        import numpy as np

        self.points, self.ends = points, _cuts(len(points))
        leaves = self.ends[-1][:-1]
        self.boxes = [(np.minimum.reduceat(points, leaves), np.maximum.reduceat(points, leaves), np.add.reduceat(points, leaves))]
        for _ in self.ends[:-1]:
            low, high, total = self.boxes[0]
            self.boxes.insert(0, (np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]), total[::2] + total[1::2]))

    def assigned(self, book):
        """(entry of each point, count and sum of each entry); ``compared`` counts the points compared one by one."""
        import numpy as np

        k, n = len(book), len(self.points)
        entry, counts, sums = np.empty(n, np.int64), np.zeros(k, np.int64), np.zeros_like(book)
        nodes, alive, index, self.compared = np.zeros(1, np.int64), np.ones((1, k), bool), np.arange(k), 0

        def places(ends, nodes):
            sizes = ends[nodes + 1] - ends[nodes]
            return np.repeat(ends[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()), sizes

        def nearest(far, alive):
            # The first of the least distances: ties go to the lower index.
            return np.where(alive, far, far.max() + 1).argmin(axis=1)

        for level, (ends, (low, high, total)) in enumerate(zip(self.ends, self.boxes)):
            low, high = low[nodes], high[nodes]
            best = nearest(((2 * book - (low + high)[:, None]) ** 2).sum(axis=2), alive)
            star = book[best][:, None]
            # The corner of the box where an entry gains most on the best one.
            corner = np.where(book > star, high[:, None], low[:, None])
            more = ((book - corner) ** 2 - (star - corner) ** 2).sum(axis=2)
            alive &= ~((more > 0) | ((more == 0) & (index > best[:, None])))
            alone = alive.sum(axis=1) == 1
            at, sizes = places(ends, nodes[alone])
            entry[at] = np.repeat(best[alone], sizes)
            np.add.at(counts, best[alone], sizes)
            np.add.at(sums, best[alone], total[nodes[alone]])
            nodes, alive = nodes[~alone], alive[~alone]
            if not len(nodes):
                break
            if level < len(self.ends) - 1:
                nodes, alive = np.repeat(2 * nodes, 2) + np.tile([0, 1], len(nodes)), np.repeat(alive, 2, axis=0)
                continue
            at, sizes = places(ends, nodes)
            own = self.points[at]
            entry[at] = near = nearest(((own[:, None] - book) ** 2).sum(axis=2), np.repeat(alive, sizes, axis=0))
            np.add.at(counts, near, 1)
            np.add.at(sums, near, own)
            self.compared = len(at)
        return entry, counts, sums


def _chunks(batches: Iterator, size: int) -> Iterator:
    """Record batches of ``size`` rows, whatever the size of those that come."""
    import pyarrow as pa

    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows, batch = rows + part.num_rows, batch.slice(part.num_rows)
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _trees(rows: DataFrame, length: int, scale: int, parts: int) -> DataFrame:
    """ids, labels, orders and points: CHUNK vectors in a row, orders and points as bytes by part, points in the order of their tree."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    width = -(-length // parts)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in _chunks(batches, CHUNK):
            own = np.zeros((batch.num_rows, width * parts))
            own[:, :length] = np.floor(scale * matrix(batch.column(1), length))
            orders, points = [], []
            for p in range(parts):
                part = own[:, p * width : (p + 1) * width]
                order = tree_order(part)
                small = np.abs(part).max() <= SMALL
                orders.append(order.astype(np.int32).tobytes())
                points.append((b"i" if small else b"d") + part[order].astype(np.int32 if small else np.float64).tobytes())
            as_list = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
            yield pa.RecordBatch.from_arrays([as_list(batch.column(0)), as_list(batch.column(2)), pa.array([orders], pa.list_(pa.binary())), pa.array([points], pa.list_(pa.binary()))], ["ids", "labels", "orders", "points"])

    return rows.select("vec_id", "v", "label").mapInArrow(run, f"ids array<{kinds['vec_id']}>, labels array<string>, orders array<binary>, points array<binary>")


def _opened(blob: bytes, width: int) -> KdTree:
    import numpy as np

    return KdTree(whole(np.frombuffer(blob, blob[:1].decode(), offset=1).astype(np.float64).reshape(-1, width)))


def _books(books: list[list[list[int]]]):
    import numpy as np

    return [whole(np.array(b, np.float64)) for b in books]


def _round(trees: DataFrame, books: list[list[list[int]]]) -> list[list[list[int]]]:
    """The codebooks after one round."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own, total = _books(books), {}
        for batch in batches:
            for k in range(batch.num_rows):
                for part, blob in enumerate(batch.column(0)[k].as_py()):
                    _, counts, sums = _opened(blob, len(books[part][0])).assigned(own[part])
                    for e in np.flatnonzero(counts).tolist():
                        for place, x in enumerate([int(counts[e]), *map(int, sums[e])]):
                            total[part, e, place] = total.get((part, e, place), 0) + x
        keys = list(total)
        yield pa.RecordBatch.from_arrays([*(pa.array([key[k] for key in keys], pa.int32()) for k in range(3)), pa.array([str(total[key]) for key in keys], pa.string())], ["part", "entry", "place", "x"])

    sums = trees.select("points").mapInArrow(run, "part int, entry int, place int, x string")
    found = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()  # as many rows as the codebooks have numbers, and counts
    total = {(r["part"], r["entry"], r["place"]): int(r["x"]) for r in found}
    moved = lambda p, e, old: [total[p, e, j + 1] // total[p, e, 0] for j in range(len(old))] if (p, e, 0) in total else old
    return [[moved(p, e, old) for e, old in enumerate(book)] for p, book in enumerate(books)]


def _first_books(rows: DataFrame, length: int, scale: int, parts: int, entries: int) -> list[list[list[int]]]:
    """Parts of the vectors of the smallest vec_ids. Rows are taken ``entries`` at a time until there are as many different ids."""
    import math

    ids, left = [], rows.select("vec_id").where("vec_id is not null")
    while len(ids) < entries:
        more = left if not ids else left.where(F.col("vec_id") > F.lit(ids[-1]))
        found = sorted({r[0] for r in more.orderBy("vec_id").limit(entries).collect()})
        if not found:
            break
        ids += found[: entries - len(ids)]
    first = {r["vec_id"]: r["v"] for r in rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).collect()}
    width = -(-length // parts)
    vectors = [[math.floor(scale * x) for x in first[i]] + [0] * (width * parts - length) for i in ids] or [[0] * (width * parts)]
    return [[v[p * width : (p + 1) * width] for v in vectors] for p in range(parts)]


def _coded(trees: DataFrame, books: list[list[list[int]]], kind: str) -> DataFrame:
    """vec_id, label, code, error of every vector."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = _books(books)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(j)[k] for j, name in enumerate(batch.schema.names)}
                n = len(row["ids"])
                codes, errors = np.empty((n, len(books)), np.uint8), np.zeros(n, np.int64)
                for part, (order, blob) in enumerate(zip(row["orders"].as_py(), row["points"].as_py())):
                    tree = _opened(blob, len(books[part][0]))
                    entry, _, _ = tree.assigned(own[part])
                    order = np.frombuffer(order, np.int32)
                    codes[order, part] = entry
                    far = np.empty(n, tree.points.dtype)
                    far[order] = ((tree.points - own[part][entry]) ** 2).sum(axis=1)
                    errors = errors + far
                text = codes.tobytes().hex()
                width = 2 * len(books)
                fits = [int(x) if x < 1 << 63 else None for x in errors.tolist()]
                yield pa.RecordBatch.from_arrays([row["ids"].values, row["labels"].values, pa.array([text[j * width : (j + 1) * width] for j in range(n)]), pa.array(fits, pa.int64())], ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"vec_id {kind}, label string, code string, error bigint")


def fit(trees: DataFrame, books: list[list[list[int]]], rounds: int) -> list[list[list[int]]]:
    for _ in range(rounds):
        books = _round(trees, books)
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code (a byte for each part, in hex), error, label_error, codebooks_sha256; at most 256 entries."""
    rows, length = usable(vectors, id_col, vector_col, label_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not length:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    # A label's own text, or nothing: nulls are one label.
    keyed = rows.withColumn("label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    trees = materialize(_trees(keyed, length, scale, parts), "code-trees")
    books = fit(trees, _first_books(rows, length, scale, parts, entries), rounds)
    coded = materialize(_coded(trees, books, kind), "codes")
    release(trees)
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    sums = materialize(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("times")), "code-labels")
    if fits(sums):
        known = coded.join(broadcast_if_fits(sums.drop("times"), sums), "label")
    else:
        known = looked_up(coded, sums.drop("times"), "label", sums.where(F.col("times") * HOT_KEYS >= rows_of(coded)))
    return reads(known.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), coded, sums)
