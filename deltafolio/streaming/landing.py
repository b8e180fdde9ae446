"""Landing as a stream: new files are validated batch by batch and appended, and a bad batch is rejected whole; or a manual's files wait for
each other in keyed state, however many batches lie between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.landing import validate_batch


def land(spark: SparkSession, inbox: str, corpus: str, alerts: str, checkpoint: str, older_needed: bool = False) -> StreamingQuery:
    """inbox: JSON files of (manual, edition, text). Each micro-batch goes to a folder of its own, so a repeated one is not doubled.

    older_needed: a manual's single file needs an older edition in the corpus, as landed by earlier batches.
    """

    def landed(number: int) -> DataFrame:
        place = spark._jvm.org.apache.hadoop.fs.Path(corpus)
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return spark.createDataFrame([], "manual string, edition string")
        return spark.read.schema("manual string, edition string, text string, batch bigint").parquet(corpus).where(F.col("batch") != number).select("manual", "edition")

    def each(batch: DataFrame, number: int) -> None:
        verdicts = validate_batch(batch, landed(number) if older_needed else None)
        bad = verdicts.where("verdict <> 'ok'")
        if bad.limit(1).count():
            bad.withColumn("batch", F.lit(number)).write.mode("overwrite").json(f"{alerts}/batch={number}")
        else:
            batch.write.mode("overwrite").parquet(f"{corpus}/batch={number}")

    stream = spark.readStream.schema("manual string, edition string, text string").json(inbox)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_JUDGED = "manual string, edition string, text string, verdict string"


def judge_together(wait_ms: int):
    """What the keyed state of a manual does: two files of different editions are a pair, at once; one that is alone waits; more are too many.

    State: the files that wait. They are judged when the second comes, or alone after ``wait_ms`` without another; a file that is there
    again, with the same edition and text, is the same file.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        if state.hasTimedOut:
            state.remove()
            yield judged(key, held, "alone")
            return
        for frame in frames:
            for edition, text in zip(frame["edition"], frame["text"]):
                file = (None if pd.isna(edition) else edition, None if pd.isna(text) else text)
                if file not in held:
                    held.append(file)
        if len(held) < 2:
            state.update(tuple(map(list, zip(*held))))
            state.setTimeoutDuration(wait_ms)
            return
        if state.exists:
            state.remove()
        verdict = "size" if len(held) > 2 else "dates" if held[0][0] == held[1][0] else "ok"
        yield judged(key, held, verdict)

    def judged(key: tuple, held: list, verdict: str) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *file, verdict) for file in held], columns=["manual", "edition", "text", "verdict"])

    return run


def land_together(spark: SparkSession, inbox: str, corpus: str, alerts: str, checkpoint: str, wait_ms: int = 3_600_000) -> StreamingQuery:
    """inbox: JSON files of (manual, edition, text). A manual's two files may come in different micro-batches and before and after a restart.

    Pairs go to the corpus; a file that stays alone goes there too if the corpus has an older edition of its manual and none as new,
    else it is an alert, as are pairs of one date and three files or more. Each micro-batch writes folders of its own, so a repeated one is not doubled.
    """

    def landed(number: int) -> DataFrame:
        place = spark._jvm.org.apache.hadoop.fs.Path(corpus)
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return spark.createDataFrame([], "manual string, edition string")
        return spark.read.schema("manual string, edition string, text string, batch bigint").parquet(corpus).where(F.col("batch") != number).select("manual", "edition")

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        newest = landed(number).groupBy("manual").agg(F.max("edition").alias("newest"))
        alone = F.col("verdict") == "alone"
        said = F.when(alone & F.coalesce(F.col("edition") > F.col("newest"), F.lit(False)), "ok").when(alone, "no older edition").otherwise(F.col("verdict"))
        rows = rows.join(newest, "manual", "left").withColumn("verdict", said).drop("newest").persist()
        good, bad = rows.where("verdict = 'ok'").drop("verdict"), rows.where("verdict <> 'ok'").drop("text")
        for part, write in ((good, lambda df: df.write.mode("overwrite").parquet(f"{corpus}/batch={number}")), (bad, lambda df: df.write.mode("overwrite").json(f"{alerts}/batch={number}"))):
            if part.limit(1).count():
                write(part)
        rows.unpersist()
        batch.unpersist()

    files = spark.readStream.schema("manual string, edition string, text string").json(inbox).where("manual is not null")
    state = "editions array<string>, texts array<string>"
    judged = files.groupBy("manual").applyInPandasWithState(judge_together(wait_ms), _JUDGED, state, "append", "ProcessingTimeTimeout")
    # One micro-batch: with timeouts by processing time there is always another one to run.
    return judged.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(once=True).start()
