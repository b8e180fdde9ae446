"""Which rows of a table of vectors an operator works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None) -> tuple[DataFrame, int]:
    """(vec_id, v[, label]) of the rows whose vector is there and holds finite numbers only, and the vectors' length (0: no rows).

    All vectors have one length, the commonest one, of equally common ones the greatest; rows of other lengths and empty vectors go.
    """
    kind = df.schema[vector_col].dataType.elementType.simpleString()
    v = col(vector_col) if kind in ("float", "double") else col(vector_col).cast("array<double>")
    columns = [col(id_col).alias("vec_id"), v.alias("v")] + ([col(label_col).alias("label")] if label_col else [])
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = df.select(*columns).where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    # One row for each length in the data leaves a task, one row reaches the driver.
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = common["n"] if common else 0
    return kept.where(F.size("v") == length), length


def matrix(column, length: int):
    """An Arrow list column of vectors of one length as float64 rows."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), length)
