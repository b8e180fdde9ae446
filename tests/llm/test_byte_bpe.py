import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from deltafolio.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def tool():
    return byte_bpe.text_encoder(PATH, public_tokenizers.PATTERN)


def same(rows, texts, library):
    assert len(rows) == len(texts)
    by_id = {r["doc_id"]: r for r in rows}
    for k, text in texts:
        ids = library.encode_ordinary(text or "")
        r = by_id[k]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_documents_encode_as_the_library_does(documents, library):
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    same(byte_bpe.encode(documents, keep_ids=False).collect(), texts, library)


def test_odd_rows(odd_docs, odd_texts, no_docs, library):
    rows = byte_bpe.encode(odd_docs).collect()
    same(rows[:-1], odd_texts, library)
    assert rows[-1] == rows[-2]
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
    assert byte_bpe.encode(no_docs).collect() == []


def test_random_bytes_like_plain_merging(tool):
    r, encoder = random.Random(3), tool.encoder
    for alphabet in (b"ab", b"a", b"the anion", bytes(range(256))):
        for _ in range(300):
            data = bytes(r.choice(alphabet) for _ in range(r.randint(1, 60)))
            assert encoder.encode_piece(data) == encoder.merged(data)
            assert encoder.decode(encoder.encode_piece(data)) == data


def test_every_character_splits_as_in_the_library(tool, library):
    for k in range(0, 0x30000, 7):
        if not 0xD800 <= k < 0xE000:
            text = f"a{chr(k)}1 {chr(k)}{chr(k)} b"
            assert list(struct.unpack(f"<{len(tool.packed(text)) // 4}I", tool.packed(text))) == library.encode_ordinary(text), hex(k)


def test_appends_and_edits_are_exact(tool):
    r, encoder = random.Random(5), tool.encoder
    piece = byte_bpe.GrowingPiece(encoder)
    for _ in range(200):
        new = bytes(r.choice(b"interational ") for _ in range(r.randint(0, 6)))
        if r.random() < 0.5:
            piece.append(new)
        else:
            a, b = sorted(r.randint(0, len(piece.data)) for _ in range(2))
            piece.splice(a, min(b, a + 8), new)
        assert piece.ids() == (encoder.merged(piece.data) if piece.data else [])
