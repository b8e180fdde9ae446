import random

import pyarrow as pa

from deltafolio.llm.common import by_size


def test_parts_by_size_are_the_batch():
    r = random.Random(6)
    for _ in range(200):
        texts = [r.choice([None, "", "é" * r.randrange(30), "x" * r.randrange(400)]) for _ in range(r.randrange(40))]
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["k", "t"]).slice(min(3, len(texts)))
        parts = list(by_size(batch, 1, limit=200, rows=7))
        assert [t for _, own in parts for t in own] == batch.column(1).to_pylist()
        assert [k for part, _ in parts for k in part.column(0).to_pylist()] == batch.column(0).to_pylist()
        for part, own in parts:
            assert len(own) == part.num_rows <= 7 and sum(len((t or "").encode()) for t in own[:-1]) < 200
