"""Sequence similarity with the standard library's semantics, in Arrow batches; asymmetric, so always (old, new)."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio_of(old: str, new: str, autojunk: bool = True) -> float:
    return SequenceMatcher(None, old or "", new or "", autojunk=autojunk).ratio()


def ratio(old: Column, new: Column, autojunk: bool = True) -> Column:
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio_of(x, y, autojunk) for x, y in zip(a, b)], dtype="float64")

    return run(old, new)


def with_ratio(df: DataFrame, old: Column, new: Column, name: str) -> DataFrame:
    """df with the ratio as a column that is computed once: a filter on it is not pushed below, where it would run again."""

    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        made = {pair: ratio_of(*pair) for pair in set(zip(a, b))}  # each pair of a batch once
        return pd.Series([made[pair] for pair in zip(a, b)], dtype="float64")

    return df.withColumn(name, F.pandas_udf(ratios, "double").asNondeterministic()(old, new))


def length_bound(old: Column, new: Column) -> Column:
    """No ratio is above twice the shorter length over both: a cheap condition before the exact one."""
    total = F.length(old) + F.length(new)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.least(F.length(old), F.length(new)) / total)


def character_bound(old: list[str], new: list[str]):
    """For each pair: twice the characters that both texts have, by groups of 64, over both lengths; no ratio is above it."""
    import numpy as np

    at: dict[str, int] = {}
    places = [[at.setdefault(t or "", len(at)) for t in side] for side in (old, new)]
    counts = np.zeros((len(at), 64), np.int32)
    for text, k in at.items():
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        counts[k] = np.bincount(codes & 63, minlength=64)
    sizes = counts.sum(axis=1)
    x, y = (np.array(p, np.int64) for p in places)
    shared = np.concatenate([np.empty(0, np.int64), *(np.minimum(counts[x[k : k + 8192]], counts[y[k : k + 8192]]).sum(axis=1) for k in range(0, len(x), 8192))])
    total = sizes[x] + sizes[y]
    return np.where(total == 0, 1.0, 2.0 * shared / np.maximum(total, 1))


# Words that join enumerated values.
CONJUNCTIONS = ("or", "and")


def disappeared_of(old: str, new: str, min_words: int = 5, bullets: frozenset[str] = frozenset()) -> list[str]:
    """Stretches of at least min_words old words that the new text has not; words in ``bullets`` count for nothing."""
    a, b = ([w for w in (t or "").split() if w not in bullets] for t in (old, new))
    return [" ".join(a[i:j]) for tag, i, j, _, _ in SequenceMatcher(None, a, b).get_opcodes() if tag in ("delete", "replace") and j - i >= min_words]


def removed_values_of(old: str, new: str, longest: int = 4) -> list[str]:
    """Deleted stretches of a conjunction and one short value, as "or B"."""
    a, b = (old or "").split(), (new or "").split()
    gone = (a[i:j] for tag, i, j, _, _ in SequenceMatcher(None, a, b).get_opcodes() if tag == "delete")
    return [" ".join(w) for w in gone if len(w) == 2 and w[0].lower() in CONJUNCTIONS and len(w[1].strip(".,;:")) <= longest]


def disappeared(old: Column, new: Column, min_words: int = 5, bullets: frozenset[str] = frozenset(), values: bool = False) -> Column:
    """disappeared_of and, with ``values``, removed_values_of."""

    @F.pandas_udf("array<string>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([disappeared_of(x, y, min_words, bullets) + (removed_values_of(x, y) if values else []) for x, y in zip(a, b)])

    return run(old, new)
