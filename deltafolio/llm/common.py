"""What the operators share: column picking and batches by size."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import broadcast_if_fits, fits, flagged_of, materialize, reads, release, rows_of  # noqa: F401

#: Words are maximal runs of anything but these six ASCII characters.
SPACES = r"[\x20\x09-\x0D]"


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the package must be installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): further columns of the input, whatever their names, cannot clash."""
    return docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))


def by_size(batch, column: int, limit: int = 1 << 20, rows: int = 4096) -> Iterator[tuple]:
    """(part of the batch, its texts), with about ``limit`` bytes and at most ``rows`` rows each; one text may be longer. Only the part
    at hand is turned into Python strings."""
    import numpy as np
    import pyarrow.compute as pc

    ends, begin = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while begin < batch.num_rows:
        full = int(ends[begin - 1] if begin else 0) + limit
        end = min(int(np.searchsorted(ends, full)) + 1, begin + rows, batch.num_rows)
        part = batch.slice(begin, end - begin)
        yield part, part.column(column).to_pylist()
        begin = end


def id_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


class Covered:
    """Whether a range meets any of some ranges."""

    def __init__(self, spans):
        ranges = sorted(spans)
        self.starts, self.ends = [s for s, _ in ranges], list(accumulate((e for _, e in ranges), max))

    def meets(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start
