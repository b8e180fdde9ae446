"""Embedding whitening: principal components of exactly centred vectors.

An entry c becomes the whole number x = floor(scale * c) + shift. The method: the sums S of all n vectors are exact; the exactly
centred rows (n * x - S) / n are the rows of Spark MLlib's RowMatrix, whose Gramian divided by n is the covariance; eigh of that
matrix on the driver gives the components, and the whitening matrix is broadcast to tasks that project every row on it.

Scale: three passes over the vectors (sums, Gramian, projection). Sums and Gramians are partial sums of each partition, combined
in a tree; the driver holds matrices of the vectors' length squared, never rows. The projections are stored once in the folder that
executors share, as the check of their covariance reads them twice and the result once.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries go, as do vectors of another length than
the commonest one (vectors.usable); a null vec_id stays a row; repeated rows are rows of their own in the fit and in the
result; there are as many components as the vectors are long, ``components`` at most; a component of no variance (below 1e-12 of
all) has whitened null and is left out of identity_error, explained of no variance at all is null; a deviation beyond a long is
null; an entry whose x does not fit a long is treated like a non-finite one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, reads
from .vectors import matrix, usable

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Share of all variance under which a component has none.
NONE = 1e-12
_LONG = 1 << 63


def whole(values, scale: int, shift: int):
    import numpy as np

    return np.floor(scale * values).astype(np.int64) + shift


def deviations(x, n: int, sums: list[int]):
    """n * x - S, exactly: 64-bit integers where they and their squares' sum fit, Python integers else."""
    import numpy as np

    most = n * max(int(np.abs(x).max()), 1) + max(map(abs, sums)) if x.size else 0
    if most * most * len(sums) < _LONG:
        return n * x - np.array(sums, np.int64)
    if most < _LONG:
        exact = n * x - np.array(sums, np.int64)
        return exact if float(np.abs(exact).max()) ** 2 * len(sums) < _LONG / 2 else exact.astype(object)
    return n * x.astype(object) - np.array(sums, object)


def _sums(rows: DataFrame, length: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        n, total = 0, [0] * length
        for batch in batches:
            # A batch has less than 2**21 rows: halves of 32 bits add up in 64.
            x = whole(matrix(batch.column(0), length), scale, shift)
            high, low = x >> 32, x & 0xFFFFFFFF
            n += len(x)
            total = [t + (int(h) << 32) + int(g) for t, h, g in zip(total, high.sum(axis=0), low.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, length), pa.int32()), pa.array([str(t) for t in [n, *total]])], ["dim", "x"])

    found = rows.select("v").mapInArrow(run, "dim int, x string").groupBy("dim").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()  # a row for each dimension
    by = {r["dim"]: int(r["x"]) for r in found}
    return by.get(-1, 0), [by.get(k, 0) for k in range(length)]


def covariance(centred: DataFrame, n: int, length: int):
    """The Gramian of rows (one column of arrays) that are centred already, divided by n."""
    vectors = MLUtils.convertVectorColumnsFromML(centred.select(array_to_vector(centred.columns[0]).alias("v")), "v")
    return RowMatrix(vectors, n, length).computeGramianMatrix().toArray() / n


def _centred(rows: DataFrame, n: int, sums: list[int], scale: int, shift: int) -> DataFrame:
    length = len(sums)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            c = (deviations(whole(matrix(batch.column(0), length), scale, shift), n, sums) / n).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), length).cast(pa.list_(pa.float64()))], ["c"])

    return rows.select("v").mapInArrow(run, "c array<double>")


def principal(covariances, components: int):
    """(unit eigenvectors as columns, eigenvalues), by falling eigenvalue; the largest entry of a vector is positive."""
    import numpy as np

    values, vectors = np.linalg.eigh((covariances + covariances.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    return vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]), values[order]


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    import numpy as np

    spark = vectors.sparkSession
    rows, length = usable(vectors, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    limit = (_LONG - 2 * abs(shift)) / scale * (1 - 2**-40)
    rows = rows.where(F.forall("v", lambda c: F.abs(c.cast("double")) < limit))
    n, sums = _sums(rows, length, scale, shift) if length else (0, [])
    if not n:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    cov = covariance(_centred(rows, n, sums, scale, shift), n, length)
    axes, values = principal(cov, components)
    trace = float(np.trace(cov))
    live = values > NONE * trace
    moved = spark.sparkContext.broadcast(np.where(live, axes / np.sqrt(np.where(live, values, 1.0)), np.nan))

    def project(frames: Iterator) -> Iterator:
        import pandas as pd

        for pdf in frames:
            x = whole(np.array([*pdf["v"]], np.float64).reshape(len(pdf), length), scale, shift)
            d = deviations(x, n, sums)
            spread = (d * d).sum(axis=1)
            white = (d / n).astype(np.float64) @ moved.value
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "deviation": pd.array([int(s) if s < _LONG else None for s in spread.tolist()], "Int64"), "whitened": list(white)})

    white = materialize(rows.mapInPandas(project, f"vec_id {kind}, deviation bigint, whitened array<double>"), "whitened")
    used = np.flatnonzero(live).tolist()
    worst = None
    if used:
        own = [F.get("whitened", F.lit(k)) for k in used]
        means = white.select(*(F.avg(w).alias(f"m{k}") for k, w in enumerate(own))).first()
        again = covariance(white.select(F.array(*(w - F.lit(m) for w, m in zip(own, means))).alias("w")), n, len(used))
        worst = float(np.abs(again - np.eye(len(used))).max())
    shares = F.array(*(F.lit(float(max(e, 0.0)) / trace if trace > 0 else None).cast("double") for e in values))
    long = white.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "w"))
    result = long.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", F.nanvl("w", F.lit(None).cast("double")).alias("whitened"), F.get(shares, F.col("k")).alias("explained"),
        F.lit(worst).cast("double").alias("identity_error"),
    )
    return reads(result, white)
