"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

#: Bytes that a broadcast table may take, as ``_row_bytes`` estimates them.
BROADCAST_BYTES = 128 << 20


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, one of our own in local mode, as in tests, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="deltafolio-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _row_bytes(df: DataFrame):
    """A row's size when broadcast, about: 32 bytes, 16 a column and the bytes of its texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    return sum(texts, F.lit(32 + 16 * len(df.columns)).cast("bigint"))


def materialize(df: DataFrame, label: str, flag: str | None = None) -> DataFrame:
    """Cut the lineage: write Parquet to the shared folder and read it again. Lost executors lose none of it.

    What is written is counted on the way: ``rows_of`` tells the rows, ``flagged_of`` those whose ``flag`` column is true.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    flagged = F.col(flag) if flag else F.lit(False)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes"), F.count_if(flagged).alias("flagged"))
    counted.write.parquet(path)
    p, fs = _place(df.sparkSession, path)
    fs.deleteOnExit(p)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._deltafolio_paths, out._deltafolio_seen = [path], seen.get
    return out


def rows_of(table: DataFrame) -> int:
    return table._deltafolio_seen["rows"]


def flagged_of(table: DataFrame) -> int:
    return table._deltafolio_seen["flagged"]


def _place(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def reads(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """df, marked as a result that still reads these tables: releasing it deletes them."""
    df._deltafolio_paths = [path for t in tables for path in getattr(t, "_deltafolio_paths", [])]
    return df


def release(*frames: DataFrame) -> None:
    """Delete what materialize() wrote, once nothing reads it any more. What nobody releases goes when the driver's JVM ends."""
    for df in frames:
        for path in getattr(df, "_deltafolio_paths", []):
            p, fs = _place(df.sparkSession, path)
            fs.delete(p, True)


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a materialised table may be broadcast; nested columns never may."""
    if any(isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in df.schema):
        return False
    return (df._deltafolio_seen["bytes"] or 0) <= limit


def broadcast_if_fits(df: DataFrame, of: DataFrame | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df, broadcast if the materialised table it is (or is some columns and rows of) fits."""
    return F.broadcast(df) if fits(of if of is not None else df, limit) else df
