"""Running values along an order, in two levels, so that a scope of any size is spread over many tasks.

Scopes of up to SPLIT rows are one window each. Larger ones are cut into ranges of (scope, order): every range is scanned on its own, its
summary (a sum, a last value) is one row, a scan of these few rows gives what each range carries in, and a join adds it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import broadcast_if_fits, materialize, reads, release, rows_of

#: Rows of a scope that one window takes.
SPLIT = 1 << 20


class Scan(NamedTuple):
    kind: str
    value: Column


def total(value: Column) -> Scan:
    """The sum up to and with the row."""
    return Scan("total", value)


def latest(value: Column) -> Scan:
    """The last value, nulls left out, up to and with the row."""
    return Scan("latest", value)


def coming(value: Column) -> Scan:
    """The first value, nulls left out, from the row on."""
    return Scan("coming", value)


def highest(value: Column) -> Scan:
    """The greatest value up to and with the row."""
    return Scan("highest", value)


def before(value: Column) -> Scan:
    """The value of the row before."""
    return Scan("before", value)


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores in front until no column has them."""
    out = []
    for name in names:
        while name in taken or name in out:
            name = "_" + name
        out.append(name)
    return out


def matches(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equal columns, nulls equal to each other."""
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[c])
    return on


def merged(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """left joined with right on equal columns, nulls equal to each other; both are sorted, neither is broadcast.

    For tables of a row for each scope: they grow with the input, but stored they are so small that Spark takes them for broadcast tables.
    """
    names = dict(zip(columns, fresh([*left.columns, *right.columns], *("other_" + c for c in columns))))
    on = F.lit(True)
    for c, other in names.items():
        on = on & F.col(c).eqNullSafe(F.col(other))
    return left.join(right.withColumnsRenamed(names).hint("merge"), on, how).drop(*names.values())


def _local(scan: Scan, keys: list[str], order: list[str]) -> Column:
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # Backwards, as frames that end at the last row are computed anew for each row.
    back = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)).rowsBetween(Window.unboundedPreceding, 0)
    return {
        "total": lambda: F.sum(scan.value).over(upto),
        "highest": lambda: F.max(scan.value).over(upto),
        "latest": lambda: F.last(scan.value, ignorenulls=True).over(upto),
        "coming": lambda: F.last(scan.value, ignorenulls=True).over(back),
        "before": lambda: F.lag(scan.value).over(w),
    }[scan.kind]()


def _summary(scan: Scan, order: list[str]) -> Column:
    at = F.when(scan.value.isNotNull(), F.struct(*order))
    return {
        "total": lambda: F.sum(scan.value),
        "highest": lambda: F.max(scan.value),
        "latest": lambda: F.max_by(scan.value, at),
        "coming": lambda: F.min_by(scan.value, at),
        "before": lambda: F.max_by(F.struct(scan.value.alias("x")), F.struct(*order)),
    }[scan.kind]()


def _in_ranges(rows: DataFrame, scope: list[str], order: list[str], part: str, columns: dict[str, Scan]) -> tuple[DataFrame, DataFrame]:
    """One step over rows with the number of their range, and the table of what ranges carry in."""
    keys = [part, *scope]
    names = dict(zip(columns, fresh([*rows.columns, *columns], *("carry_" + c for c in columns))))
    own = rows.groupBy(*keys).agg(*(_summary(s, order).alias(names[c]) for c, s in columns.items()))
    up = Window.partitionBy(*scope).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*scope).orderBy(F.desc(part)).rowsBetween(Window.unboundedPreceding, -1)
    kinds = {
        "total": lambda c: F.sum(c).over(up),
        "highest": lambda c: F.max(c).over(up),
        "latest": lambda c: F.last(c, ignorenulls=True).over(up),
        "coming": lambda c: F.last(c, ignorenulls=True).over(down),
        "before": lambda c: F.lag(c).over(Window.partitionBy(*scope).orderBy(part)),
    }
    carry = materialize(own.select(*keys, *(kinds[s.kind](names[c]).alias(names[c]) for c, s in columns.items())), "carries")  # one row for each scope of a range
    first, = fresh([*rows.columns, *columns, *names.values()], "first")
    scans = {c: _local(s, keys, order) for c, s in columns.items()}
    scans[first] = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    local = rows.withColumns(scans)
    both = local.join(broadcast_if_fits(carry), matches(local, carry, keys), "left").select(*(local[c] for c in local.columns), *(carry[n] for n in names.values()))
    whole = {
        "total": lambda c: F.when(F.col(c).isNotNull() | F.col(names[c]).isNotNull(), F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(names[c]), F.lit(0))),
        "highest": lambda c: F.greatest(F.col(c), F.col(names[c])),
        "latest": lambda c: F.coalesce(c, names[c]),
        "coming": lambda c: F.coalesce(c, names[c]),
        "before": lambda c: F.when(F.col(first), F.col(names[c])["x"]).otherwise(F.col(c)),
    }
    return both.withColumns({c: whole[s.kind](c) for c, s in columns.items()}).drop(first, *names.values()), carry


def large_scopes(df: DataFrame, scope: list[str], split: int = SPLIT) -> DataFrame:
    """The scopes of more than ``split`` rows, stored."""
    n, = fresh(df.columns, "rows_of_scope")
    return materialize(df.groupBy(*scope).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > split), "large-scopes")


def scanned(df: DataFrame, scope: list[str], order: list[str], *steps: dict[str, Scan], split: int | None = SPLIT) -> DataFrame:
    """df with the steps' columns, in the scope's order; a step may use columns of those before.

    Rows that are equal in scope and order come in any order. Null scopes are a scope. ``split`` None: the caller knows that
    all scopes are small, as parts of scopes that were counted are; else they are counted, for which df is computed once more.
    """

    def plain(rows: DataFrame) -> DataFrame:
        for columns in steps:
            rows = rows.withColumns({c: _local(s, scope, order) for c, s in columns.items()})
        return rows

    if split is None:
        return plain(df)
    n, part = fresh(df.columns, "rows_of_scope", "range_of_scope")
    large = large_scopes(df, scope, split)
    if not rows_of(large):
        release(large)
        return plain(df)
    few = broadcast_if_fits(large)
    rows = large.agg(F.sum(n)).first()[0]
    # Written, so that a range keeps its rows if a task runs again.
    spread = df.join(few, matches(df, few, scope), "left_semi").repartitionByRange(-(-rows // split) + 1, *scope, *order).withColumn(part, F.spark_partition_id())
    ranges = materialize(spread, "ranges")
    out, used = ranges, [large, ranges]
    for columns in steps:
        out, carry = _in_ranges(out, scope, order, part, columns)
        used.append(carry)
    return reads(plain(df.join(few, matches(df, few, scope), "left_anti")).unionByName(out.drop(part)), *used)
