import hashlib
import random
import zlib

from deltafolio.llm import matroska as mkv


def test_documents_and_odd_rows(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = mkv.media(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            data = (texts[r["doc_id"]] or "").encode()
            padded = data + b"\xff" * (576 * max(1, -(-len(data) // 576)) - len(data))
            assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (len(data), len(padded), zlib.crc32(padded[-32:]))
            assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest()
            assert r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest() and r["media_bytes"] == len(r["media"])
            assert r["n_packets"] * 576 == len(padded)
    assert mkv.media(no_docs).collect() == []


def test_every_lacing_reads_back():
    r = random.Random(9)
    for lacing in (mkv.XIPH, mkv.EBML_LACING, mkv.FIXED, mkv.NO_LACING):
        for _ in range(100):
            n = 1 if lacing == mkv.NO_LACING else r.randint(1, 9)
            size = r.choice([1, 200, 255, 256, 510, 5000])
            frames = [bytes([r.randrange(256)]) * (size if lacing == mkv.FIXED else r.choice([0, 1, 254, 255, 600, 9000])) for _ in range(n)]
            data = b"pad" + mkv.block(5, -7, frames, lacing)
            track, relative, key, _, ranges = mkv.frames_of(data, 3, len(data))
            assert (track, relative, key) == (5, -7, True) and [data[o : o + s] for o, s in ranges] == frames


def test_packets_clusters_and_cues():
    payload = bytes(range(256)) * 9 * 40
    for lacing in (mkv.FIXED, mkv.XIPH, mkv.EBML_LACING):
        data = mkv.mux(payload, lacing)
        packets, info = mkv.parse(data)
        assert b"".join(data[p.offset : p.offset + p.size] for p in packets) == payload
        assert [p.timestamp for p in packets] == [72 * k for k in range(len(packets))]
        assert len(info["clusters"]) == 2 and [c[0] for c in info["cues"]] == [0, 128 * 72] and all(c[3] for c in info["cues"])
        assert info["tracks"][1]["codec"] == "A_PCM/INT/LIT" and info["duration"] == len(packets) * 72


def test_unknown_sizes_block_groups_and_damage(spark):
    cluster = mkv.uint(mkv.TIMESTAMP, 5) + mkv.element(mkv.BLOCK_GROUP, mkv.element(mkv.BLOCK, mkv.block(1, 2, [b"abc"])))
    data = mkv._HEAD + mkv.SEGMENT.to_bytes(4, "big") + b"\xff" + mkv._TRACKS + (mkv.CLUSTER.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster) * 2
    packets, _ = mkv.parse(data)
    assert [(p.timestamp, data[p.offset : p.offset + p.size]) for p in packets] == [(7, b"abc")] * 2
    files = spark.createDataFrame([(1, bytearray(data)), (2, bytearray(data[:-2])), (3, None), (4, bytearray(b""))], "doc_id bigint, media binary")
    rows = mkv.packet_table(files).collect()
    assert sorted((r["doc_id"], r["packet"]) for r in rows if r["error"] is None) == [(1, 0), (1, 1)]
    assert sorted((r["doc_id"], r["error"]) for r in rows if r["error"]) == [(2, next(r["error"] for r in rows if r["doc_id"] == 2)), (3, "no file"), (4, "no packets")]


def test_features_like_plain_counting(documents, odd_docs):
    for docs in (documents, odd_docs):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        for row in mkv.media(docs).collect():
            data = (texts[row["doc_id"]] or "").encode()
            data += b"\xff" * (-len(data) % 576 if data else 576)
            x = [b - 128 for b in data]
            frames = len(data) // 576
            loudest = max(sum(map(abs, x[k * 576 : k * 576 + 576])) for k in range(frames))
            crossings = sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:]))
            clusters = -(-frames // 128)
            wanted = f"packets={frames};clusters={clusters};cues={clusters};ms={frames * 72};sum={sum(x)};energy={sum(a * a for a in x)};crossings={crossings};loudest={loudest}"
            assert row["feature"] == wanted and row["n_packets"] == frames
