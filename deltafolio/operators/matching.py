"""Matching of entities of two editions: unique keys, ranked occurrences, fuzzy one-to-one, alignment, shifts, moves."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import character_bound, ratio_of
from ..storage import flagged_of, materialize, reads, release, rows_of
from .alike import similar_sections
from .candidates import Bags, candidates
from .scan import fresh, matches, scanned, total


def status(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), "added").when(b.isNull(), "removed").otherwise("matched")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the last one."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, *(F.col("_r")[c].alias(c) for c in rest))


def match_unique(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on unique keys; values become structs a and b, with a status."""
    pack = lambda df, name: df.select(*keys, F.struct(*(c for c in df.columns if c not in keys)).alias(name))
    return pack(a, "a").join(pack(b, "b"), keys, "full_outer").withColumn("status", status(F.col("a"), F.col("b")))


def match_occurrence(a: DataFrame, b: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The k-th occurrence of a key in one edition goes with the k-th in the other."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return match_unique(a.withColumn("nth", rank), b.withColumn("nth", rank), [*keys, "nth"])


def _edge_order(mode: str) -> list[Column]:
    by_ratio = F.desc("ratio")
    return {"serial": [F.asc("a_ord"), by_ratio, F.asc("b_ord")], "global": [by_ratio, F.asc("a_ord"), F.asc("b_ord")]}[mode]


#: Edges of a scope that one task streams through; larger scopes are matched in rounds until they have no more than that.
TAIL = 1 << 22


def greedy_assign(edges: DataFrame, scope: list[str], mode: str = "serial", tail: int = TAIL) -> DataFrame:
    """One-to-one choice among scored edges (scope, a_ord, b_ord, ratio, …): in the mode's order, an edge is taken if both its ends are free.

    Scopes of up to ``tail`` edges stream through a task in that order. In larger ones, an edge that comes first at both its ends is taken
    whatever else is: rounds take all of these at once and drop the edges at taken ends, by partial minima and joins on the ends, until a
    scope is small enough. There are as many rounds as the longest chain of edges each of which waits for the one before.
    """
    n, = fresh(edges.columns, "edges_of_scope")
    table = materialize(edges, "edges")
    large = materialize(table.groupBy(*scope).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > tail), "large-scopes")
    if not rows_of(large):
        release(large)
        return reads(_streamed(table, scope, mode), table)
    few = large.select(*scope)
    small = table.join(few, matches(table, few, scope), "left_anti")
    left, taken, rest = table.join(few, matches(table, few, scope), "left_semi"), [], []
    while True:
        left = materialize(left, "edges-left")
        if not rows_of(left):
            break
        chosen = materialize(_first_of_both(left, scope, mode), "edges-taken")
        taken.append(chosen)
        for end in ("a_ord", "b_ord"):
            ends = chosen.select(*scope, end)
            left = left.join(ends, matches(left, ends, [*scope, end]), "left_anti")
        sizes = materialize(left.groupBy(*scope).agg(F.count(F.lit(1)).alias(n)), "edges-by-scope")
        done, more = sizes.where(F.col(n) <= tail).select(*scope), sizes.where(F.col(n) > tail).select(*scope)
        rest.append(materialize(left.join(done, matches(left, done, scope), "left_semi"), "edges-rest"))
        left = left.join(more, matches(left, more, scope), "left_semi")
    for part in rest:
        small = small.unionByName(part)
    out = _streamed(small, scope, mode)
    for part in taken:
        out = out.unionByName(part)
    return reads(out, table, large, *taken, *rest)


def _first_of_both(edges: DataFrame, scope: list[str], mode: str) -> DataFrame:
    """The edges that come first for both ends, as they are."""
    falling = (-F.col("ratio")).alias("falling")
    order = {"serial": [F.col("a_ord"), falling, F.col("b_ord")], "global": [falling, F.col("a_ord"), F.col("b_ord")]}[mode]
    others = [c for c in edges.columns if c not in (*scope, "a_ord", "b_ord", "ratio")]
    key = F.struct(*order, *others)
    best = [edges.groupBy(*scope, end).agg(F.min(key).alias("best")).select(*scope, "best") for end in ("a_ord", "b_ord")]
    both = best[0].join(best[1], matches(best[0], best[1], [*scope, "best"]), "left_semi")
    own = {c: F.col("best")[c] for c in ("a_ord", "b_ord", *others)} | {"ratio": -F.col("best")["falling"]}
    return both.select(*(F.col(c) if c in scope else own[c].alias(c) for c in edges.columns))


def _streamed(edges: DataFrame, scope: list[str], mode: str) -> DataFrame:
    """Edges are sorted by Spark and stream through; only the ends taken in the scope at hand are held."""
    spread = edges.repartition(*scope).sortWithinPartitions(*scope, *_edge_order(mode))
    places = [edges.columns.index(c) for c in (*scope, "a_ord", "b_ord")]
    plain = lambda values: [tuple(v.values()) if isinstance(v, dict) else v for v in values]  # noqa: E731  ends may be structs

    def run(batches):
        import pyarrow as pa

        at, used_a, used_b = None, set(), set()
        for batch in batches:
            *keys, a, b = (plain(batch.column(k).to_pylist()) for k in places)
            keep = []
            for key, x, y in zip(zip(*keys), a, b):
                if key != at:
                    at, used_a, used_b = key, set(), set()
                free = x not in used_a and y not in used_b
                keep.append(free)
                if free:
                    used_a.add(x)
                    used_b.add(y)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return spread.mapInArrow(run, edges.schema)


def exact_pairs(a: DataFrame, b: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, a_ord, b_ord, ratio 1.0) of equal texts: the k-th of one edition with the k-th of the other. Frames: scope, ord, text."""
    nth = F.row_number().over(Window.partitionBy(*scope, "text").orderBy("ord"))
    side = lambda df, name: df.withColumn("_n", nth).select(*scope, "text", "_n", F.col("ord").alias(name))
    return side(a, "a_ord").join(side(b, "b_ord"), [*scope, "text", "_n"]).select(*scope, "a_ord", "b_ord", F.lit(1.0).alias("ratio"))


def fuzzy_edges(a: DataFrame, b: DataFrame, scope: list[str], threshold: float, min_length: int = 0) -> DataFrame:
    """Edges (scope, a_ord, b_ord, ratio) of at least the threshold (above 0) between texts of one scope (scope, ord, text).

    Only the pairs that the index of candidates.candidates gives are compared, each once, after bounds by the characters and the grams both texts have.
    """
    long = lambda df: df.select(*scope, "ord", "text").where(F.length("text") >= min_length)
    a, b = long(a), long(b)
    side = lambda df, p: df.select(*scope, F.col("ord").alias(f"{p}_ord"), F.col("text").alias(f"{p}_text"))
    pairs = candidates(a, b, scope, threshold).join(side(a, "a").hint("merge"), [*scope, "a_ord"]).join(side(b, "b").hint("merge"), [*scope, "b_ord"])
    return _compared(pairs.select(*scope, "a_ord", "b_ord", "a_text", "b_text"), scope, threshold)


def _compared(pairs: DataFrame, scope: list[str], threshold: float) -> DataFrame:
    """The pairs (scope, a_ord, b_ord, a_text, b_text) of at least the threshold, with their ratio; bounds come first."""
    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in (*scope, "a_ord", "b_ord")) + ", ratio double"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            old, new = batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()
            bags = Bags(threshold)
            ratios = [ratio_of(old[k], new[k]) if ok and bags(old[k], new[k]) else 0.0 for k, ok in enumerate(character_bound(old, new) >= threshold)]
            out = batch.select([*scope, "a_ord", "b_ord"]).append_column("ratio", pa.array(ratios, pa.float64()))
            yield out.filter(pa.array([r >= threshold for r in ratios], pa.bool_()))

    return pairs.mapInArrow(run, schema)


#: Pairs of texts of a scope that are compared without an index, which has a row for each gram.
FEW = 4096


def pooled_edges(a: DataFrame, b: DataFrame, scope: list[str], threshold: float, min_length: int = 0, few: int = FEW) -> DataFrame:
    """fuzzy_edges of stored texts in many scopes, most of them small: up to ``few`` pairs of a scope are compared at once, an index is made for larger ones only."""
    a, b = (df.select(*scope, "ord", "text").where(F.length("text") >= min_length) for df in (a, b))
    count = lambda df, n: df.groupBy(*scope).agg(F.count(F.lit(1)).alias(n))
    sizes = count(a, "_a").join(count(b, "_b").hint("merge"), scope)
    scopes = materialize(sizes.select(*scope, (F.col("_a") * F.col("_b") > few).alias("_many")), "pools", "_many")
    small, large = (scopes.where(c).select(*scope).hint("merge") for c in ("not _many", "_many"))
    side = lambda df, p: df.join(small, scope).select(*scope, F.col("ord").alias(f"{p}_ord"), F.col("text").alias(f"{p}_text"))
    pairs = side(a, "a").join(side(b, "b").hint("merge"), scope)
    edges = _compared(pairs.select(*scope, "a_ord", "b_ord", "a_text", "b_text"), scope, threshold)
    if flagged_of(scopes):
        edges = edges.unionByName(fuzzy_edges(a.join(large, scope, "left_semi"), b.join(large, scope, "left_semi"), scope, threshold, min_length))
    return reads(edges, scopes)


def fuzzy_match(a: DataFrame, b: DataFrame, scope: list[str], threshold: float = 0.85, mode: str = "serial", min_length: int = 0) -> DataFrame:
    """(scope, a_ord, b_ord, ratio, match_type): equal texts first, then what is left by similarity, one to one."""
    exact = exact_pairs(a, b, scope)
    rest = lambda df, name: df.join(exact.select(*scope, F.col(name).alias("ord")), [*scope, "ord"], "left_anti")
    fuzzy = greedy_assign(fuzzy_edges(rest(a, "a_ord"), rest(b, "b_ord"), scope, threshold, min_length), scope, mode)
    return exact.withColumn("match_type", F.lit("exact")).unionByName(fuzzy.withColumn("match_type", F.lit("fuzzy")))


def mutual_best(edges: DataFrame, scope: list[str]) -> DataFrame:
    """Edges that come first for both ends: one round of the global order, in windows only."""
    by = lambda end: F.row_number().over(Window.partitionBy(*scope, end).orderBy(F.desc("ratio"), "a_ord", "b_ord"))
    return edges.withColumns({"_a": by("a_ord"), "_b": by("b_ord")}).where("_a = 1 and _b = 1").drop("_a", "_b")


#: Texts of one side of a scope that meet the other side's in one group.
BLOCK = 1024


def mutual_nearest(a: DataFrame, b: DataFrame, scope: list[str], block: int = BLOCK) -> DataFrame:
    """(scope, a_ord, b_ord, distance): mutual_best of all pairs of a scope by edit distance, smallest first. Frames: scope, ord (each once), text.

    Of equal texts of a side only the first can be anyone's best, so different texts are compared, each pair once. A pair is never stored: it goes
    into the least (distance, other end) of either end, a number, which tasks gather in part; a scope's texts come in blocks, so that it is many tasks.
    """
    first = lambda df: df.groupBy(*scope, "text").agg(F.min("ord").alias("ord"))
    counted = lambda df, p: scanned(first(df), scope, ["ord"], {"at": total(F.lit(1))}).select(*scope, *(F.col(c).alias(f"{p}_{c}") for c in ("at", "ord", "text")))
    a, b = (materialize(counted(df, p), "different-texts") for df, p in ((a, "a"), (b, "b")))
    blocks = a.withColumn("block", F.floor(F.col("a_at") / block))
    spread = b.join(blocks.select(*scope, "block").distinct(), scope)
    # Null distances, of null texts, come last.
    last = (1 << 31) - 1
    pairs = blocks.join(spread, [*scope, "block"]).withColumn("distance", F.coalesce(F.levenshtein("a_text", "b_text"), F.lit(last)).cast("bigint"))
    ends = F.array(*(F.struct(F.lit(own).alias("side"), F.col(f"{own}_at").alias("at"), (F.shiftleft("distance", 32) + F.col(f"{other}_at")).alias("best")) for own, other in ("ab", "ba")))
    best = materialize(pairs.select(*scope, F.explode(ends).alias("e")).groupBy(*scope, "e.side", "e.at").agg(F.min("e.best").alias("best")), "best-ends")
    side = lambda own, other: best.where(F.col("side") == own).select(*scope, F.col("at").alias(f"{own}_at"), F.col("best").bitwiseAND((1 << 32) - 1).alias(f"{other}_at"), F.shiftright("best", 32).cast("int").alias("distance"))
    both = side("a", "b").join(side("b", "a").drop("distance"), [*scope, "a_at", "b_at"])
    named = both.join(a.drop("a_text"), [*scope, "a_at"]).join(b.drop("b_text"), [*scope, "b_at"])
    return reads(named.select(*scope, "a_ord", "b_ord", F.nullif("distance", F.lit(last)).alias("distance")), a, b, best)


def _runs(old: list[str], new: list[str]) -> list[tuple[int, int, int]] | None:
    """Longest stretches (old place, new place, length) that run on in both lists, in the old one's order; None if one has a common paragraph twice."""
    at: dict[str, int] = {}
    both = set(old) & set(new)
    for k, t in enumerate(new):
        if t in both and at.setdefault(t, k) != k:
            return None
    out: list[tuple[int, int, int]] = []
    found = 0
    for i, t in enumerate(old):
        if t in both:
            found += 1
            j = at[t]
            if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
                out[-1] = (out[-1][0], out[-1][1], out[-1][2] + 1)
            else:
                out.append((i, j, 1))
    return out if found == len(both) else None


def _matching_runs(runs: list[tuple[int, int, int]], width: int) -> list[tuple[int, int, int]]:
    """Of stretches in which no place is twice, those that difflib takes: the longest one, the first of equals, then the same before and behind it.

    Stretches lie wholly before or behind a taken one on either side. A tree of maxima gives the longest of those between two in the old
    order; one that is elsewhere in the new order stays out of all that lies between, so each is looked at once.
    """
    n = 1
    while n < len(runs):
        n *= 2
    tree = [-1] * (2 * n)  # a stretch's number, of the longest below

    def better(x: int, y: int) -> int:
        if x < 0 or y < 0:
            return max(x, y)
        return x if runs[x][2] >= runs[y][2] else y  # x is the earlier one

    tree[n : n + len(runs)] = range(len(runs))
    for k in range(n - 1, 0, -1):
        tree[k] = better(tree[2 * k], tree[2 * k + 1])

    def longest(lo: int, hi: int) -> int:
        left, right = -1, -1
        lo, hi = lo + n, hi + n
        while lo < hi:
            if lo & 1:
                left, lo = better(left, tree[lo]), lo + 1
            if hi & 1:
                hi -= 1
                right = better(tree[hi], right)
            lo, hi = lo // 2, hi // 2
        return better(left, right)

    taken, todo = [], [(0, len(runs), 0, width)]
    while todo:
        lo, hi, low, high = todo.pop()
        while (k := longest(lo, hi)) >= 0:
            _, j, size = runs[k]
            at = k + n
            tree[at] = -1
            while at > 1:
                at //= 2
                tree[at] = better(tree[2 * at], tree[2 * at + 1])
            if low <= j and j + size <= high:
                taken.append(runs[k])
                todo += [(lo, k, low, j), (k + 1, hi, j + size, high)]
                break
    return sorted(taken)


def opcodes(old: list[str], new: list[str]) -> list[tuple[str, int, int, int, int]]:
    """difflib's opcodes without its junk rule. Where no common paragraph is twice in a list, the work is n log n, not n for each stretch."""
    runs = _runs(old, new)
    if runs is None:
        return SequenceMatcher(None, old, new, autojunk=False).get_opcodes()
    out, i, j = [], 0, 0
    joined: list[tuple[int, int, int]] = []
    for x, y, size in _matching_runs(runs, len(new)):
        if joined and joined[-1][0] + joined[-1][2] == x and joined[-1][1] + joined[-1][2] == y:
            joined[-1] = (*joined[-1][:2], joined[-1][2] + size)
        else:
            joined.append((x, y, size))
    for x, y, size in [*joined, (len(old), len(new), 0)]:
        tag = "replace" if i < x and j < y else "delete" if i < x else "insert" if j < y else ""
        if tag:
            out.append((tag, i, x, j, y))
        if size:
            out.append(("equal", x, x + size, y, y + size))
        i, j = x + size, y + size
    return out


def _similar(x: str, y: str, threshold: float) -> bool:
    """Whether the ratio is at least the threshold; its bounds by length and by characters come first."""
    if x and y and 2.0 * min(len(x), len(y)) / (len(x) + len(y)) < threshold:
        return False
    matcher = SequenceMatcher(None, x, y)
    return matcher.quick_ratio() >= threshold and matcher.ratio() >= threshold


#: The ratio from which on a replaced stretch is a rewording of another as a whole.
REWORDED = 0.95


def align(old: list[str], new: list[str], threshold: float = REWORDED) -> list[tuple[str, int, int, int, int]]:
    """(status, a from, a to, b from, b to) of an alignment of paragraphs; a replaced stretch with equal joined text is a reflow."""
    out = []
    for tag, i, j, k, m in opcodes(old, new):
        if tag == "equal":
            out += [("exact", i + n, i + n + 1, k + n, k + n + 1) for n in range(j - i)]
        elif tag == "replace":
            x, y = " ".join(old[i:j]), " ".join(new[k:m])
            if x == y:
                out.append(("reflowed", i, j, k, m))
            elif _similar(x, y, threshold):
                out.append(("fuzzy", i, j, k, m))
            else:
                out.append(("pool", i, j, k, m))
        else:
            out.append(("removed" if tag == "delete" else "added", i, j, k, m))
    return out


#: Stretches that a task gathers before it hands them on.
HANDED = 1 << 16


def align_paragraphs(pairs: DataFrame, keys: list[str], held: bool = False) -> DataFrame:
    """pairs: keys, old and new (arrays of paragraphs) -> a row for each aligned stretch. held: with old and new, the paragraphs of a "pool" stretch."""
    schema = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys) + ", status string, a_from int, a_to int, b_from int, b_to int"
    columns = [*keys, "status", "a_from", "a_to", "b_from", "b_to"]
    if held:
        schema, columns = schema + ", old array<string>, new array<string>", [*columns, "old", "new"]

    def run(batches):
        for pdf in batches:
            rows = []
            for _, r in pdf.iterrows():
                own = [r[k] for k in keys]
                old, new = (list(r[s] if r[s] is not None else []) for s in ("old", "new"))
                for x in align(old, new):
                    _, i, j, k, m = x
                    rows.append((*own, *x, *(((old[i:j], new[k:m]) if x[0] == "pool" else (None, None)) if held else ())))
                    if len(rows) == HANDED:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            yield pd.DataFrame(rows, columns=columns)

    return pairs.select(*keys, "old", "new").mapInPandas(run, schema)


def align_and_pool(pairs: DataFrame, keys: list[str], threshold: float = 0.9, min_length: int = 60) -> DataFrame:
    """align_paragraphs, and one-to-one matches among the paragraphs of all "pool" stretches of a section.

    The pool's paragraphs are matched by similarity in their order if both have min_length characters; what stays unmatched is
    removed or added. A pool stretch holds its own paragraphs, so no row holds a whole section.
    """
    # Stored: matched, removed and added paragraphs all come from it.
    stretches = materialize(align_paragraphs(pairs, keys, held=True), "stretches")
    pool = stretches.where("status = 'pool'")

    def side(values: str, begin: str) -> DataFrame:
        return pool.select(*keys, begin, F.posexplode(values).alias("_at", "text")).select(*keys, (F.col(begin) + F.col("_at")).alias("ord"), "text")

    a, b = side("old", "a_from"), side("new", "b_from")
    edges = pooled_edges(a, b, keys, threshold, min_length)
    hits = greedy_assign(edges, keys)
    release(edges)
    row = lambda status, i, j, k, m: [F.lit(status).alias("status"), *(c.cast("int").alias(n) for c, n in ((i, "a_from"), (j, "a_to"), (k, "b_from"), (m, "b_to")))]
    x, y, o, none = F.col("a_ord"), F.col("b_ord"), F.col("ord"), F.lit(None)
    left = lambda df, name: df.join(hits.select(*keys, F.col(name).alias("ord")).hint("merge"), [*keys, "ord"], "left_anti")
    matched = hits.select(*keys, *row("fuzzy", x, x + 1, y, y + 1))
    removed, added = left(a, "a_ord").select(*keys, *row("removed", o, o + 1, none, none)), left(b, "b_ord").select(*keys, *row("added", none, none, o, o + 1))
    return reads(stretches.where("status <> 'pool'").drop("old", "new").unionByName(matched).unionByName(removed).unionByName(added), stretches, hits)


def reflow_adjacent(a: DataFrame, b: DataFrame, scope: list[str]) -> DataFrame:
    """Two neighbouring paragraphs of one edition that equal one of the other: every candidate (scope, a_ord, b_ord). Frames: scope, ord, text."""
    w = Window.partitionBy(*scope).orderBy("ord")
    two = a.withColumn("next", F.lead("text").over(w)).where("next is not null").select(*scope, F.col("ord").alias("a_ord"), F.concat_ws(" ", "text", "next").alias("text"))
    return two.join(b.select(*scope, F.col("ord").alias("b_ord"), "text"), [*scope, "text"])


def reflowed(old: list[str], new: list[str]) -> list[tuple[str, list[int], list[int]]]:
    """("joined" or "split", old places, new places): first two old paragraphs that make one new, then one old that two new make; each is used once."""
    out, gone_a, gone_b = [], set(), set()
    for status, two, one, used_two, used_one in (("joined", old, new, gone_a, gone_b), ("split", new, old, gone_b, gone_a)):
        places: dict[str, list[int]] = {}
        for k in range(len(one) - 1, -1, -1):
            places.setdefault(one[k], []).append(k)
        for k in range(len(two) - 1):
            if k in used_two or k + 1 in used_two:
                continue
            free = places.get(two[k] + " " + two[k + 1], [])
            while free and free[-1] in used_one:
                free.pop()
            if free:
                at = free.pop()
                used_two |= {k, k + 1}
                used_one.add(at)
                out.append((status, [k, k + 1], [at]) if status == "joined" else (status, [at], [k, k + 1]))
    return out


def reflow_paragraphs(pairs: DataFrame, keys: list[str], threshold: float = 0.9, min_length: int = 60) -> DataFrame:
    """keys, status, a_ord, b_ord: reflowed paragraphs both ways, then equal ones by occurrence, then similar ones, best first.

    pairs: keys, old and new (arrays of paragraphs, held for one section at a time). A reflow has a row for each place of the
    longer side; what stays unmatched is removed or added.
    """
    kinds = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                old, new = (list(r[s]) if r[s] is not None else [] for s in ("old", "new"))
                rows += [(*(r[k] for k in keys), status, x, y) for status, i, j in reflowed(old, new) for x in i for y in j]
            yield pd.DataFrame(rows, columns=[*keys, "status", "a_ord", "b_ord"]).astype({"a_ord": "int64", "b_ord": "int64"})

    moved = pairs.select(*keys, "old", "new").mapInPandas(run, f"{kinds}, status string, a_ord bigint, b_ord bigint")
    side = lambda c: pairs.select(*keys, F.posexplode(c).alias("ord", "text")).withColumn("ord", F.col("ord").cast("bigint"))
    rest = lambda df, gone, c: df.join(gone.select(*keys, F.col(c).alias("ord")).distinct(), [*keys, "ord"], "left_anti")
    a, b = rest(side("old"), moved, "a_ord"), rest(side("new"), moved, "b_ord")
    hits = fuzzy_match(a, b, keys, threshold, "global", min_length).select(*keys, F.col("match_type").alias("status"), "a_ord", "b_ord")
    none = F.lit(None).cast("bigint")
    removed = rest(a, hits, "a_ord").select(*keys, F.lit("removed").alias("status"), F.col("ord").alias("a_ord"), none.alias("b_ord"))
    added = rest(b, hits, "b_ord").select(*keys, F.lit("added").alias("status"), none.alias("a_ord"), F.col("ord").alias("b_ord"))
    return moved.unionByName(hits).unionByName(removed).unionByName(added)


def position_shift(removed: list[tuple[str, str]], added: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(name, old position, new position) of leftovers (position, name) whose names keep their order; reserved ones never move."""
    a, b = ([x for x in side if x[1].strip().lower() != "reserved"] for side in (removed, added))
    blocks = SequenceMatcher(None, [n for _, n in a], [n for _, n in b], autojunk=False).get_matching_blocks()
    return [(a[i + k][1], a[i + k][0], b[j + k][0]) for i, j, n in blocks for k in range(n)]


def shifted(groups: DataFrame, keys: list[str]) -> DataFrame:
    """groups: keys, removed and added as array<struct<position,name>> -> rows found again at another position."""
    schema = ", ".join(f"{k} {groups.schema[k].dataType.simpleString()}" for k in keys) + ", name string, old_position string, new_position string"

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                sides = [[(x["position"], x["name"]) for x in (r[s] if r[s] is not None else [])] for s in ("removed", "added")]
                rows += [(*(r[k] for k in keys), *x) for x in position_shift(*sides)]
            yield pd.DataFrame(rows, columns=[*keys, "name", "old_position", "new_position"])

    return groups.select(*keys, "removed", "added").mapInPandas(run, schema)


def _overlaps(a: DataFrame, b: DataFrame, scope: list[str]) -> DataFrame:
    """scope, a, b, exact: paragraphs that two sections share, each as often as in the section with fewer of it.

    An inverted index of (section, paragraph) counts: a paragraph that is k times in a section is one row there.
    """
    own = lambda df, p: df.groupBy(*scope, "section", "text").agg(F.count(F.lit(1)).alias(f"{p}_times")).withColumnRenamed("section", p)
    return own(a, "a").join(own(b, "b").hint("merge"), [*scope, "text"]).groupBy(*scope, "a", "b").agg(F.sum(F.least("a_times", "b_times")).alias("exact"))


def _sized(pairs: DataFrame, a: DataFrame, b: DataFrame, scope: list[str], size_ratio: float) -> DataFrame:
    """pairs (scope, a, b, …) with a_n and b_n, the sections' numbers of paragraphs, where these are near enough."""
    count = lambda df, p: df.groupBy(*scope, F.col("section").alias(p)).agg(F.count(F.lit(1)).alias(f"{p}_n"))
    both = pairs.join(count(a, "a").hint("merge"), [*scope, "a"]).join(count(b, "b").hint("merge"), [*scope, "b"])
    return both.where(F.least("a_n", "b_n") >= size_ratio * F.greatest("a_n", "b_n"))


def _only_candidates(pairs: DataFrame, scope: list[str], weights: dict[str, str] | None = None) -> DataFrame:
    """The pairs of which neither section is in another one: counts by section and joins, no window over a section's pairs.

    weights: for each end, the column that tells how many sections the pair's other end stands for; without, each is one.
    """
    table = materialize(pairs, "section-pairs")
    for end in ("a", "b"):
        met = F.sum(weights[end]) if weights else F.count(F.lit(1))
        alone = table.groupBy(*scope, end).agg(met.alias("_pairs")).where("_pairs = 1").drop("_pairs")
        pairs = (table if end == "a" else pairs).join(alone.hint("merge"), [*scope, end], "left_semi")
    return reads(pairs, table)


def _contents(df: DataFrame, scope: list[str], p: str) -> DataFrame:
    """scope, p (a section, the first of those that hold the same), content (its paragraphs, each with its times), p_n, p_sections (how many hold that)."""
    own = df.where(F.col("section").isNotNull()).groupBy(*scope, "section", "text").agg(F.count(F.lit(1)).alias("times"))
    packed = own.groupBy(*scope, "section").agg(F.array_sort(F.collect_list(F.struct("text", "times"))).alias("content"), F.sum("times").alias(f"{p}_n"))
    return packed.groupBy(*scope, "content", f"{p}_n").agg(F.min("section").alias(p), F.count(F.lit(1)).alias(f"{p}_sections"))


def section_copies(removed: DataFrame, added: DataFrame, scope: list[str], coverage: float = 0.8, size_ratio: float = 0.5) -> DataFrame:
    """(scope, a, b, exact, a_n, b_n): section_moves by equal paragraphs alone, in any order. Frames: scope, section, text.

    Sections that hold the same are compared as one, and rule each other out as anyone's only candidate by their number. What a section must share
    with another (``coverage`` of the removed one, hence ``coverage * size_ratio`` of the added one at least) leaves none to meet on its
    commonest paragraphs alone: of each section, only so many of the rarest are indexed that a partner has one of them.
    """
    a, b = (materialize(_contents(df, scope, p), "section-contents") for df, p in ((removed, "a"), (added, "b")))
    # The k-th of equal paragraphs is an item of its own, so contents are sets.
    rows = lambda df, p: df.select(*scope, p, f"{p}_n", f"{p}_sections", F.explode("content").alias("x")).select("*", "x.*").drop("x").where(F.col("text").isNotNull())
    items = lambda df, p: rows(df, p).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("times")
    item = [*scope, "text", "nth"]
    both = items(a, "a").select(*item).unionByName(items(b, "b").select(*item))
    common = both.groupBy(*item).agg(F.count(F.lit(1)).alias("common"))

    def first(df: DataFrame, p: str, least: float) -> DataFrame:
        section = Window.partitionBy(*scope, p)
        place = {"_at": F.row_number().over(section.orderBy("common", "text", "nth")), "_items": F.count(F.lit(1)).over(section)}
        needed = F.greatest(F.ceil(least * F.col(f"{p}_n") - 1e-9), F.lit(1))
        return items(df, p).join(common, item).withColumns(place).where(F.col("_at") <= F.col("_items") - needed + 1).drop("_at", "_items", "common")

    met = first(a, "a", coverage).join(first(b, "b", coverage * size_ratio), item).drop("text", "nth")
    near = met.where(F.least("a_n", "b_n") >= size_ratio * F.greatest("a_n", "b_n")).distinct()
    texts = lambda df, p: rows(df, p).select(*scope, p, "text", F.col("times").alias(f"{p}_times"))
    shared = near.join(texts(a, "a"), [*scope, "a"]).join(texts(b, "b"), [*scope, "b", "text"])
    found = shared.groupBy(*near.columns).agg(F.sum(F.least("a_times", "b_times")).alias("exact")).where(F.col("exact") >= coverage * F.col("a_n"))
    out = _only_candidates(found, scope, {"a": "b_sections", "b": "a_sections"})
    return reads(out.select(*scope, "a", "b", "exact", "a_n", "b_n"), a, b, out)


def section_moves(removed: DataFrame, added: DataFrame, scope: list[str], coverage: float = 0.8, size_ratio: float = 0.5, threshold: float = 0.9, min_length: int = 60) -> DataFrame:
    """(scope, a, b, coverage, a_n, b_n): removed sections whose paragraphs are found again in an added one, each the other's only candidate.

    Frames: scope, section, ord, text (the key of a paragraph: equal texts are equal paragraphs). Coverage is the share of the
    removed section's paragraphs that align_and_pool finds in the added one: equal, reflowed, or similar. It is computed for the pairs
    of near size that can have enough: an equal paragraph (an inverted index), one joined text in both, or similar texts alone
    (alike.similar_sections; a replaced stretch counts as one paragraph, so without equal ones it is enough for a short section only).
    No table here is broadcast: they grow with the input, and stored they are so small that Spark would.
    """
    a, b = (df.select(*scope, "section", "ord", "text") for df in (removed, added))
    packed = lambda df: df.groupBy(*scope, "section").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]).alias("paragraphs"))
    old, new = (materialize(packed(df), "sections") for df in (a, b))
    joined = lambda df, p: df.select(*scope, F.col("section").alias(p), F.xxhash64(F.array_join("paragraphs", " ")).alias("_joined"))
    whole = joined(old, "a").join(joined(new, "b").hint("merge"), [*scope, "_joined"]).select(*scope, "a", "b")
    alike = similar_sections(old, new, scope, coverage, size_ratio, threshold, min_length, REWORDED)
    some = _overlaps(a, b, scope).select(*scope, "a", "b").unionByName(whole).unionByName(alike).distinct()
    near = materialize(_sized(some, a, b, scope, size_ratio), "section-candidates")
    release(alike)
    of = lambda df, p, name: df.select(*scope, F.col("section").alias(p), F.col("paragraphs").alias(name)).hint("merge")
    texts = near.join(of(old, "a", "old"), [*scope, "a"]).join(of(new, "b", "new"), [*scope, "b"])
    found = align_and_pool(texts, [*scope, "a", "b"], threshold, min_length)
    hits = F.when(F.col("status").isin("exact", "fuzzy"), 1).when(F.col("status") == "reflowed", F.col("a_to") - F.col("a_from")).otherwise(0)
    shares = found.groupBy(*scope, "a", "b").agg(F.sum(hits).alias("hits"))
    scored = near.join(shares.hint("merge"), [*scope, "a", "b"]).withColumn("coverage", F.col("hits") / F.col("a_n"))
    out = _only_candidates(scored.where(F.col("coverage") >= coverage), scope)
    release(found, near, old, new)
    return reads(out.select(*scope, "a", "b", F.round("coverage", 3).alias("coverage"), "a_n", "b_n"), out)
