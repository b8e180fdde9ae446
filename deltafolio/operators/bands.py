"""One-dimensional geometry: clusters, bands, as-of and nearest assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan


def gap_cluster(df: DataFrame, scope: list[str], value: str, tolerance: float, order: list[str] | None = None, **limit) -> DataFrame:
    """cluster: 1, 2, … along the sorted values; a gap over the tolerance opens the next one. limit: split, as ``scan.scanned`` has it."""
    last, = scan.fresh(df.columns, "last")
    opens = F.when(F.col(value) - F.col(last) > tolerance, 1).otherwise(0)
    found = scan.scanned(df, scope, [value, *(order or [])], {last: scan.before(F.col(value))}, {"cluster": scan.total(opens)}, **limit)
    return found.withColumn("cluster", (F.col("cluster") + 1).cast("long")).drop(last)


def leaders(values: Column, tolerance: float) -> Column:
    """For each of the sorted values the first of its group: a value over ``tolerance`` behind it opens the next group."""
    start = F.struct(F.array().cast("array<double>").alias("out"), F.lit(None).cast("double").alias("at"))

    def step(acc, v):
        at = F.when(v - acc["at"] <= tolerance, acc["at"]).otherwise(v.cast("double"))
        return F.struct(F.concat(acc["out"], F.array(at)).alias("out"), at.alias("at"))

    return F.aggregate(values, start, step)["out"]


def row_bands(lines: Column) -> Column:
    """Band of each (y0, y1) in reading order, against the band's first line: joined iff they overlap by over half of the smaller height."""
    start = F.struct(F.array().cast("array<int>").alias("bands"), F.lit(0).alias("n"), F.lit(0.0).alias("y0"), F.lit(0.0).alias("y1"))

    def step(acc, x):
        shared = F.least(acc["y1"], x["y1"]) - F.greatest(acc["y0"], x["y0"])
        joins = (acc["n"] > 0) & (shared > 0.5 * F.least(acc["y1"] - acc["y0"], x["y1"] - x["y0"]))
        n = F.when(joins, acc["n"]).otherwise(acc["n"] + 1)
        return F.struct(F.concat(acc["bands"], F.array(n)).alias("bands"), n.alias("n"), F.when(joins, acc["y0"]).otherwise(x["y0"]).alias("y0"), F.when(joins, acc["y1"]).otherwise(x["y1"]).alias("y1"))

    return F.aggregate(lines, start, step)["bands"]


def merged_cells(cells: Column, tolerance: float = 3.0) -> Column:
    """Texts of sorted (x0, text), joined into the cell before while x0 is within the tolerance of that cell's first x0."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("double").alias("x0"))

    def step(acc, c):
        joins = F.coalesce(F.abs(c["x0"] - acc["x0"]) <= tolerance, F.lit(False))
        last = F.size(acc["out"])
        grown = F.transform(acc["out"], lambda t, k: F.when(k == last - 1, F.concat(t, F.lit("\n"), c["text"])).otherwise(t))
        return F.struct(F.when(joins, grown).otherwise(F.concat(acc["out"], F.array(c["text"]))).alias("out"), F.when(joins, acc["x0"]).otherwise(c["x0"]).alias("x0"))

    return F.aggregate(cells, start, step)["out"]


def nearest(rows: DataFrame, bands: DataFrame, scope: list[str], value: str, band: str, tie: str) -> DataFrame:
    """rows with the columns of the band at the least distance; of equally far ones the first by ``tie``. Rows of scopes without bands go.

    Only the last band at or before a row and the first at or after it can be nearest: two sorted sweeps instead of all pairs.
    """
    own = [c for c in bands.columns if c not in scope]
    first = bands.groupBy(*scope, F.col(band).alias("_at")).agg(F.min(F.struct(F.col(tie).alias("_tie"), *(F.col(c).alias("_v_" + c) for c in own))).alias("_b"))
    marks = first.select(*scope, F.col("_at").alias("_mark_at"), F.struct("_at", "_b").alias("_mark"))
    below = asof(rows, marks, scope, value, "_mark_at", "_mark").withColumnRenamed("_mark", "_below")
    both = asof(below, marks, scope, value, "_mark_at", "_mark", forward=True)
    far = lambda m: F.struct(F.abs(F.col(value) - F.col(m)["_at"]).alias("d"), F.col(m)["_b"].alias("b"))
    best = F.array_min(F.array_compact(F.array(*(F.when(F.col(m).isNotNull(), far(m)) for m in ("_below", "_mark")))))
    return both.withColumn("_best", best).where("_best is not null").select(*rows.columns, *(F.col("_best")["b"]["_v_" + c].alias(c) for c in own))


def asof(rows: DataFrame, marks: DataFrame, scope: list[str], at: str, mark_at: str, mark: str, forward: bool = False, **limit) -> DataFrame:
    """Adds the mark last at or before each row (forward: first at or after it); one sort of both sides, no range join. limit: split, as
    ``scan.scanned`` has it."""
    keys = [c for c in rows.columns if c not in (*scope, at)]
    place, side, row, found = scan.fresh([*scope, mark], "place", "side", "row", "found")
    # Of equal places, marks come before rows, or after them if the search goes forward.
    is_mark, is_row = (1, 0) if forward else (0, 1)
    left = rows.select(*scope, F.col(at).alias(place), F.lit(is_row).alias(side), F.struct(F.lit(True).alias("_"), *(F.col(k).alias(f"c{j}") for j, k in enumerate(keys))).alias(row), F.lit(None).cast(marks.schema[mark].dataType).alias(found))
    right = marks.select(*scope, F.col(mark_at).alias(place), F.lit(is_mark).alias(side), F.lit(None).cast(left.schema[row].dataType).alias(row), F.col(mark).alias(found))
    step = scan.coming if forward else scan.latest
    both = scan.scanned(left.unionByName(right), scope, [place, side], {found: step(F.col(found))}, **limit).where(F.col(row).isNotNull())
    return both.select(*scope, F.col(place).alias(at), *(F.col(row)[f"c{j}"].alias(k) for j, k in enumerate(keys)), F.col(found).alias(mark))
