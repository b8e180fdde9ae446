"""Which sections can hold each other's paragraphs reworded: texts of near length meet in blocks, and cheap bounds leave few of the pairs.

Grams don't tell long texts of one language apart at such thresholds, so an index of them has as many rows as pairs of texts. Here each
pair is looked at once, in a group of two blocks that numbers bound: lengths first, then common characters, then whether the lengths of all
paragraphs of both sections allow enough of them to be similar, then the longest common subsequence, which no ratio exceeds. Of a section
that needs k similar ones of its n long paragraphs, any n - k + 1 hold one, so only the longest so many look for partners.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, reads
from .scan import scanned, total

#: Texts of one side in a group, and long paragraphs of a section that look for partners.
BLOCK = 1024
#: Lengths of a section that go with each of its texts.
LENGTHS = 64
#: Characters after which a comparison looks whether it can still succeed.
STEP = 64
_LESS = 1e-9


def masks(text: str) -> dict[str, int]:
    """For each character, the bits of its places."""
    out: dict[str, int] = {}
    for k, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << k
    return out


def can_reach(text: str, bits: dict[str, int], other: str, threshold: float) -> bool:
    """Whether the longest common subsequence allows the ratio. bits: the text's masks.

    The zeros among the first p bits are the longest one of p characters and what was read of the other text. If so many match, what p
    characters match lies in the other's first n - needed + p, and no more than the other m - p come behind: most pairs end there early.
    """
    m, n = len(text), len(other)
    needed = ceil(threshold * (m + n) / 2 - _LESS)
    full = free = (1 << m) - 1
    for at in range(0, n, STEP):
        for c in other[at : at + STEP]:
            if hit := free & bits.get(c, 0):
                free = (free + hit | free - hit) & full
        p = min(m, min(n, at + STEP) - (n - needed))
        if p > 0 and p - (free & (1 << p) - 1).bit_count() < needed - (m - p):
            return False
    return m - free.bit_count() >= needed


def pairs_of(old: list[int], new: list[int], threshold: float) -> int:
    """How many of the old lengths have a new one of their own near enough for the threshold, at most. Both are sorted."""
    found = j = 0
    for m in old:
        least, most = m * threshold / (2 - threshold) - _LESS, m * (2 - threshold) / threshold + _LESS
        while j < len(new) and new[j] < least:
            j += 1
        if j < len(new) and new[j] <= most:
            found += 1
            j += 1
    return found


def _letters(texts: list[str]):
    """Characters of each text by groups of 64."""
    import numpy as np

    out = np.zeros((len(texts), 64), np.int32)
    for k, text in enumerate(texts):
        out[k] = np.bincount(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") & 63, minlength=64)
    return out


def _met(old: dict, new: dict, size_ratio: float, threshold: float) -> list[tuple[int, int]]:
    """Rows (old, new) of one block of each side that show that their sections can be similar; a pair of sections has one."""
    import numpy as np

    chars, counts, letters = np.array([len(t) for t in new["text"]], np.int64), np.array(new["n"], np.int64), _letters(new["text"])
    order = np.argsort(chars, kind="stable")
    chars, counts, letters = chars[order], counts[order], letters[order]
    found, seen = [], {}
    for i, (text, own) in enumerate(zip(old["text"], _letters(old["text"]))):
        m = len(text)
        lo, hi = np.searchsorted(chars, m * threshold / (2 - threshold) - _LESS), np.searchsorted(chars, m * (2 - threshold) / threshold + _LESS, "right")
        near = np.minimum(old["n"][i], counts[lo:hi]) >= size_ratio * np.maximum(old["n"][i], counts[lo:hi])
        near &= 2 * np.minimum(own, letters[lo:hi]).sum(axis=1) >= threshold * (m + chars[lo:hi]) - _LESS
        bits = None
        for j in order[lo:hi][near]:
            pair = old["section"][i], new["section"][j]
            if pair not in seen:
                x, y = old["lengths"][i], new["lengths"][j]
                seen[pair] = x is None or y is None or pairs_of(x, y, threshold) >= old["needed"][i]
            if seen[pair]:
                bits = masks(text) if bits is None else bits
                if can_reach(text, bits, new["text"][j], threshold):
                    seen[pair] = False
                    found.append((i, int(j)))
    return found


def similar_sections(old: DataFrame, new: DataFrame, scope: list[str], coverage: float, size_ratio: float, threshold: float, min_length: int, whole: float) -> DataFrame:
    """(scope, a, b): all pairs of near size in which the coverage can come from similar texts alone, each once, and few others.

    Frames: scope, section, paragraphs (an array). Either ``coverage`` of the old section's paragraphs are similar to one of the new section's
    each, by ``threshold``, with ``min_length`` characters at least; or the sections' joined texts are, by ``whole``, which counts as one paragraph.
    """
    keys = [*scope, "kind"]
    long = F.filter("paragraphs", lambda t: F.length(t) >= min_length)
    sized = lambda df: df.select(*scope, "section", "paragraphs", F.size("paragraphs").alias("n"), long.alias("long"))
    needed = F.greatest(F.ceil(coverage * F.col("n") - _LESS), F.lit(1)).cast("int")
    rising = F.array_sort(F.transform("long", lambda t: F.struct(F.length(t).alias("chars"), t.alias("text"))))
    lengths = F.when(F.size("long") <= LENGTHS, F.array_sort(F.transform("long", lambda t: F.length(t))))
    a, b = sized(old).withColumn("needed", needed), sized(new).withColumn("needed", F.lit(1))
    enough = F.size("long") >= F.col("needed")
    looking = F.size("long") - F.col("needed") + 1

    def texts(df: DataFrame, own, some, least: float) -> DataFrame:
        columns = lambda kind, each, text: [*scope, F.lit(kind).alias("kind"), "section", "n", "needed", each.alias("lengths"), text.alias("text")]
        single = df.where(least * F.col("n") <= 1 + _LESS).withColumns({"needed": F.lit(1), "joined": F.array_join("paragraphs", " ")})
        rows = df.where(enough & some).select(*columns("paragraph", lengths, F.explode(F.array_distinct(own))))
        rows = rows.unionByName(single.select(*columns("whole", F.array(F.length("joined")), F.col("joined")))).withColumn("chars", F.length("text"))
        numbered = scanned(rows, keys, ["chars", "section", "text"], {"at": total(F.lit(1))})
        return materialize(numbered.withColumn("block", F.floor((F.col("at") - 1) / BLOCK)).drop("at"), "texts-in-blocks")

    probes = F.slice(F.reverse(F.transform(rising, lambda x: x["text"])), F.lit(1), F.greatest(looking, F.lit(1)))
    x, y = texts(a, probes, looking <= BLOCK, coverage), texts(b, F.col("long"), F.lit(True), coverage * size_ratio)
    reach = lambda df, p: df.groupBy(*keys, F.col("block").alias(f"{p}_block")).agg(F.min("chars").alias(f"{p}_least"), F.max("chars").alias(f"{p}_most"))
    low = min(threshold, whole)
    near = (F.col("a_most") * (2 - low) >= F.col("b_least") * low - _LESS) & (F.col("b_most") * (2 - low) >= F.col("a_least") * low - _LESS)
    meeting = materialize(reach(x, "a").join(reach(y, "b").hint("merge"), keys).where(near).select(*keys, "a_block", "b_block"), "blocks-that-meet")
    by = [*keys, "a_block", "b_block"]
    spread = lambda df, p: df.withColumnRenamed("block", f"{p}_block").join(meeting.hint("merge"), [*keys, f"{p}_block"]).groupBy(*by)
    schema = ", ".join(f"{c} {old.schema[c].dataType.simpleString()}" for c in scope) + f", a {old.schema['section'].dataType.simpleString()}, b {new.schema['section'].dataType.simpleString()}"

    def run(left, right):
        import pyarrow as pa

        sides = []
        for table in (left, right):
            values = {c: table.column(c).to_pylist() for c in ("n", "needed", "lengths", "text")}
            # Sections are told apart by number, whatever their type.
            numbers: dict = {}
            values["section"] = [numbers.setdefault(repr(s), len(numbers)) for s in table.column("section").to_pylist()]
            sides.append(values)
        kind = left.column("kind")[0].as_py() if left.num_rows else "whole"
        found = _met(*sides, size_ratio, whole if kind == "whole" else threshold) if left.num_rows and right.num_rows else []
        of = [pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)]
        columns = [*(left.column(c).take(of[0]) for c in scope), left.column("section").take(of[0]), right.column("section").take(of[1])]
        return pa.Table.from_arrays(columns, [*scope, "a", "b"])

    found = spread(x, "a").cogroup(spread(y, "b")).applyInArrow(run, schema)
    # Sections in which more than a block of paragraphs would look for partners are few in a scope: those of near size go on unseen.
    many = lambda df, p, most: df.where(enough & most).select(*scope, F.col("section").alias(p), F.col("n").alias(f"{p}_n"), F.size("long").alias(f"{p}_long"), "needed")
    large = many(a, "a", looking > BLOCK).join(many(b, "b", F.size("long") > 0).drop("needed").hint("merge"), scope)
    large = large.where((F.least("a_n", "b_n") >= size_ratio * F.greatest("a_n", "b_n")) & (F.col("b_long") >= F.col("needed")))
    return reads(found.unionByName(large.select(*scope, "a", "b")).distinct(), x, y, meeting)
