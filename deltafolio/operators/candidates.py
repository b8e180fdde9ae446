"""Which texts of two sides can be similar at all: a lossless index, so that no scope is compared all with all.

A sequence ratio of t between texts of m and n characters matches k >= t (m + n) / 2 of them, in order. Each of the m - k characters left
out of the first text breaks at most q of its m - q + 1 grams of q characters, each of the n - k inserted ones at most q - 1: the others,
(2 q - 1) k - (q - 1) (m + n + 1) or more, are in both texts. As n is at least m t / (2 - t), each text has such a bound of its own. In one
global order, rarest grams first, two bags that share s grams share r of the first (size - s + r) of either; only these are
indexed, with r a third of s, as unrelated texts share single rare grams more often than many. Grams are as long as leaves a bound (``gram_length``); texts too short for one of that length meet each other by shorter grams. The k-th
occurrence of a gram in a text is an item of its own, so bags are sets. All shared items up to the last one that is indexed on both sides are
seen, so their number and the items left behind it bound what a pair shares: what passes is a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a gram, at most, and the share of a long text's grams that a similar one must hold for grams of that length.
LONGEST, SHARE = 6, 0.2
#: Counters that tell rare grams from common ones; any order is lossless.
COUNTERS = 1 << 16
_LESS = 1e-9


def share(threshold: float, q: int) -> float:
    """Of both texts' characters, how many grams they share at least, but for a constant."""
    return (2 * q - 1) * threshold / 2 - (q - 1)


def gram_length(threshold: float) -> int:
    return max([1, *(q for q in range(2, LONGEST + 1) if 2 * share(threshold, q) / (2 - threshold) >= SHARE)])


def items(text: str, q: int):
    """64-bit numbers of the text's grams, the k-th occurrence of a gram apart from the others."""
    import numpy as np

    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(codes) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    grams = codes[:n]
    for k in range(1, q):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
        grams ^= grams >> np.uint64(31)
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    nth = np.arange(n) - np.repeat(first, np.diff(first, append=n))
    h = grams * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29)) + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(31)


def shared_at_least(length: int, threshold: float, q: int) -> int:
    """Grams that a text of this length shares with any text as similar as the threshold, at least."""
    return ceil(share(threshold, q) * 2 * length / (2 - threshold) - (q - 1) - _LESS)


def indexed(text: str, threshold: float, ranks) -> list[tuple[int, list[int], int, int]]:
    """(q, first items in the global order, how many of them a partner has, all items): of the longest grams, and of shorter ones down to those that leave the text a bound."""
    import numpy as np

    out = []
    for size in range(gram_length(threshold), 0, -1):
        least = shared_at_least(len(text), threshold, size)
        own = items(text, size)
        if len(own):
            own = own[np.lexsort((own, ranks[own % np.uint64(COUNTERS)]))]
            shared = max(1, least // 3)
            out.append((size, own[: len(own) - max(1, least) + shared].view(np.int64).tolist(), shared, len(own)))
        if least >= 1:
            break
    return out or [(0, [0], 1, 1)]  # empty texts meet each other


def _ranks(sides: list[DataFrame], threshold: float):
    """The counters of hashed grams over all texts: COUNTERS sums reach the driver."""
    import numpy as np

    q = gram_length(threshold)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            found = [np.empty(0, np.uint64), *(items(text, q) for text in batch.column(0).to_pylist())]
            total += np.bincount((np.concatenate(found) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["k", "n"])

    out = np.zeros(COUNTERS, np.int64)
    texts = sides[0].select("text").unionByName(sides[1].select("text"))
    for row in texts.mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[row["k"]] = row["n"]
    return out


def _index(side: DataFrame, scope: list[str], threshold: float, ranks) -> DataFrame:
    """k0, k1, … (scope and ord), q, item, pos, shared, size, chars: a row for each indexed item of a text."""
    kinds = ", ".join(f"k{j} {side.schema[c].dataType.simpleString()}" for j, c in enumerate((*scope, "ord")))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows, q, item, pos, shared, size, chars = [], [], [], [], [], [], []
            for k, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for own, first, least, n in indexed(text, threshold, ranks):
                    rows += [k] * len(first)
                    q += [own] * len(first)
                    item += first
                    pos += range(len(first))
                    shared += [least] * len(first)
                    size += [n] * len(first)
                    chars += [len(text)] * len(first)
            keys = batch.select(list(range(batch.num_columns - 1))).take(pa.array(np.array(rows, np.int64)))
            more = [pa.array(q, pa.int32()), pa.array(item, pa.int64()), *(pa.array(x, pa.int32()) for x in (pos, shared, size, chars))]
            yield pa.RecordBatch.from_arrays([*keys.columns, *more], [*(f"k{j}" for j in range(batch.num_columns - 1)), "q", "item", "pos", "shared", "size", "chars"])

    return side.select(*scope, "ord", "text").mapInArrow(run, f"{kinds}, q int, item bigint, pos int, shared int, size int, chars int")


def candidates(a: DataFrame, b: DataFrame, scope: list[str], threshold: float) -> DataFrame:
    """(scope, a_ord, b_ord) of all pairs in a scope whose ratio can reach the threshold (above 0), each once, and of few others.

    Frames: scope, ord, text; null texts and rows of null scopes are in no pair.
    """
    if threshold <= 0:
        raise ValueError("a threshold of 0 keeps every pair")
    sides = [s.select(*scope, "ord", "text").where(F.col("text").isNotNull()) for s in (a, b)]
    ranks = _ranks(sides, threshold)
    keys = [f"k{j}" for j in range(len(scope))]
    left, right = (_index(s, scope, threshold, ranks) for s in sides)
    side = lambda df, p: df.select(*keys, "q", "item", *(F.col(c).alias(f"{p}_{c}") for c in (f"k{len(scope)}", "pos", "shared", "size", "chars")))
    # Merged: Spark takes an index for as small as its texts' file and would broadcast it, through the driver.
    both = side(left, "a").join(side(right, "b").hint("merge"), [*keys, "q", "item"])
    chars = F.col("a_chars") + F.col("b_chars")
    matched = F.ceil(threshold * chars / 2 - _LESS)
    needed = (2 * F.col("q") - 1) * matched - (F.col("q") - 1) * (chars + 1)
    possible = (2 * F.least("a_chars", "b_chars") >= threshold * chars - _LESS) & ((F.col("q") == 0) | (F.least("a_pos", "b_pos") + F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos")) >= needed))
    place = f"k{len(scope)}"
    by = [*keys, f"a_{place}", f"b_{place}", "q", *(f"{p}_{c}" for p in "ab" for c in ("shared", "size", "chars"))]
    pairs = both.where(possible).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max("a_pos").alias("a_pos"), F.max("b_pos").alias("b_pos"))
    behind = F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos")) - 1
    found = pairs.where((F.col("q") == 0) | ((F.col("n") + behind >= needed) & (F.col("n") >= F.least("a_shared", "b_shared"))))
    return found.select(*(F.col(k).alias(c) for k, c in zip(keys, scope)), F.col(f"a_{place}").alias("a_ord"), F.col(f"b_{place}").alias("b_ord")).distinct()


class Bags:
    """Whether two texts' whole bags of grams allow the threshold; each text's bag is made once."""

    def __init__(self, threshold: float):
        self.threshold, self.made = threshold, {}

    def __call__(self, a: str, b: str) -> bool:
        import numpy as np

        chars = len(a) + len(b)
        matched, q = ceil(self.threshold * chars / 2 - _LESS), gram_length(self.threshold)
        needed = (2 * q - 1) * matched - (q - 1) * (chars + 1)
        if needed < 1:
            return True
        bags = []
        for t in (a, b):
            if t not in self.made:
                self.made[t] = items(t, q)
            bags.append(self.made[t])
        return len(np.intersect1d(*bags, assume_unique=True)) >= needed
