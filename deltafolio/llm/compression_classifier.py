"""Quality classifier: two zstandard dictionaries, one built from text labelled good and one from text labelled bad.

A text is cut into blocks of BLOCK bytes and each block is compressed with either dictionary. The size difference, normalised by
the text's bytes, and the logarithm of the mean compressed size over these bytes (runs of one word hardly differ, but compress
far better than prose) go through a logistic curve, which is the score: the chance that the text is labelled 1. PAD is added
above and below the line, so that a few bytes say little.

The fit reads a bounded, documented sample: of either label at most ``max_rows`` rows, those with the smallest hash of their id, half
of them for the dictionaries (from each text at most TEXT_BLOCKS blocks, by hash) and half for the curve, which is weighted back to the
labels' true shares. Rows in the held-out fold (crc32 of the id as text, modulo 4, is 2) are never in it. Every whole text is scored, by
its bytes alone.

Scale: one pass stores the sample's texts in the folder that executors share, one pass scores; nothing is shuffled but the labels.
The driver sees blocks of 2 * max_rows / 2 * TEXT_BLOCKS * BLOCK bytes at most and two numbers for each row of the curve's sample; the dictionaries
(DICTIONARY bytes each) go with the tasks.

Defined results: null texts are empty texts, and empty texts have a score as others do (difference 0, ratio 1); repeated rows
give repeated rows; an id with two different labels, or a label other than 0 and 1, teaches nothing; a null id is not held out and
has no label; without labels of either kind all scores are the share of good labels (0.5 without any); an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_size, id_type, keyed_text, materialize, release

BLOCK = 1024
DICTIONARY = 65_536
LEVEL = 3
MAX_ROWS = 4096
TEXT_BLOCKS = 4
PAD = 100
#: Weight of the squared coefficients in the fit of the curve: it keeps them finite where a small sample separates.
RIDGE = 1e-3
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def blocks_of(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]


def build(samples: list[bytes]) -> bytes:
    """A dictionary of at most DICTIONARY bytes; where zstandard finds too few samples to train one, it is their bytes as they stand."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


class Sizes:
    """Compressed sizes of texts with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.tools = []
        for data in (good, bad):
            made = zstandard.ZstdCompressionDict(data)
            made.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[float, float]:
        """(difference for each byte, log of the mean size for each byte)."""
        import math

        blocks = blocks_of(text)
        good, bad = (sum(len(tool.compress(b)) for b in blocks) for tool in self.tools)
        n = sum(map(len, blocks))
        return (bad - good) / (n + PAD), math.log(((good + bad) / 2 + PAD) / (n + PAD))


def curve(points: list[tuple[float, float]], labels: list[int], weights: list[float], steps: int = 50) -> list[float]:
    """(constant, coefficients) of the weighted logistic fit, in the features' own units, by Newton's method."""
    import numpy as np

    x, y, w = np.array(points, float), np.array(labels, float), np.array(weights, float) / sum(weights)
    mean = w @ x
    width = np.sqrt(w @ (x - mean) ** 2) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / width]
    ridge = RIDGE * np.diag([0.0] + [1.0] * x.shape[1])
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(b)), z.T @ (w * (p - y)) + ridge @ b)
        b -= np.clip(step, -2, 2)
    return [float(b[0] - (b[1:] * mean / width).sum()), *(b[1:] / width).tolist()]


def chance(model: list[float], features: tuple[float, ...]) -> float:
    import math

    s = model[0] + sum(c * f for c, f in zip(model[1:], features))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, s))))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, quality, curve) of the sampled rows, as a table, and how many rows of each label may teach."""
    sure = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where(F.col("doc_id").isNotNull() & (F.col("quality") == F.col("other")) & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    shares = {r["quality"]: r["count"] for r in sure.groupBy("quality").count().collect()}
    few = None
    for q in (0, 1):
        own = sure.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("doc_id", "quality")
        few = own if few is None else few.unionByName(own)
    # At most 2 * max_rows ids.
    few = F.broadcast(few.withColumn("curve", F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(2)) == 1))
    return materialize(docs.join(few, "doc_id"), "classifier-sample"), shares


def _samples(rows: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """Blocks of the good and of the bad texts for the dictionaries, each in the order of a hash."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for whole in batches:
            for batch, texts in by_size(whole, 0):
                for text, quality in zip(texts, batch.column(1).to_pylist()):
                    own = sorted((xxhash.xxh64_intdigest(b, k) >> 1, b) for k, b in enumerate(blocks_of(text)))[:TEXT_BLOCKS]
                    yield pa.RecordBatch.from_arrays([pa.array([quality] * len(own), pa.int32()), pa.array([h for h, _ in own], pa.int64()), pa.array([b for _, b in own], pa.binary())], ["quality", "h", "block"])

    found = rows.where("not curve").select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(run, "quality int, h bigint, block binary").collect()
    ordered = sorted((r["h"], bytes(r["block"]), r["quality"]) for r in found)
    return [b for _, b, q in ordered if q == 1], [b for _, b, q in ordered if q == 0]


def _measured(rows: DataFrame, good: bytes, bad: bytes, model: list[float] | None = None) -> DataFrame:
    """rows (first column text) with their features, or with their score by a model."""
    names = rows.columns[1:]
    schema = ", ".join([*(f"{c} {id_type(rows, c)}" for c in names), "score double" if model else "difference double, ratio double"])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sizes = Sizes(good, bad)
        for whole in batches:
            for batch, texts in by_size(whole, 0):
                found = [sizes(t) for t in texts]
                out = [[chance(model, f) for f in found]] if model else [[f[0] for f in found], [f[1] for f in found]]
                kept = [batch.column(k + 1) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.float64()) for x in out)], [*names, *(["score"] if model else ["difference", "ratio"])])

    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[bytes, bytes, list[float]] | float:
    """(good dictionary, bad dictionary, curve), or the share of good labels where one label has no text to learn from."""
    rows, shares = sample(docs, labels, max_rows)
    good, bad = _samples(rows)
    points = []
    if good and bad:
        good, bad = build(good), build(bad)
        points = _measured(rows.where("curve").select("text", F.col("quality").cast("int").alias("quality")), good, bad).collect()
    release(rows)
    seen = {q: sum(p["quality"] == q for p in points) for q in (0, 1)}
    if not (seen[0] and seen[1]):
        return shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    points = sorted((p["difference"], p["ratio"], p["quality"]) for p in points)
    return good, bad, curve([p[:2] for p in points], [p[2] for p in points], [shares[p[2]] / seen[p[2]] for p in points])


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    frame = keyed_text(docs, id_col, text_col)
    model = fit(frame, labels, max_rows)
    rows = frame.select("text", "doc_id")
    scored = rows.select("doc_id", F.lit(model).alias("score")) if isinstance(model, float) else _measured(rows, *model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
