"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can come last in the prefix's encoding. The encoder keeps that token for
each prefix length; a prefix of length ``end`` ends in token ``t`` iff ``t`` is a suffix of it and ``t`` may stand after the
last token of the shorter prefix. Two tokens may stand side by side iff merging their joined bytes gives just these two.
Appending bytes only adds entries, and an edit invalidates only what comes after it.

Defined results: a null text encodes as an empty one (0 ids, digests of no bytes); an empty table gives an empty table;
repeated rows give repeated rows; whole texts are encoded, of any length; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import by_size, id_type, keyed_text, tokenizer_path

#: Pieces kept with their ids by one worker; at most about 100 MB.
PIECE_MEMO = 500_000
#: Pairs of tokens known to fit or not.
PAIR_MEMO = 2_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        #: Every suffix of a token -> the token's id, or -1 if the suffix itself is none.
        self.suffixes: dict[bytes, int] = {}
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
            for k in range(1, len(token)):
                self.suffixes.setdefault(token[k:], -1)
        self.suffixes.update(ranks)
        self.fits: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost on ties. Only used on one token or two."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[k] + parts[k + 1], 1 << 40), k) for k in range(len(parts) - 1))
            if rank == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[x] for x in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """left < 0: right stands alone at the start."""
        key = (left + 1) << 24 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIR_MEMO:
                self.fits.clear()
            own = self.token_bytes[right]
            known = self.merged(own) == [right] if left < 0 else self.merged(self.token_bytes[left] + own) == [left, right]
            self.fits[key] = known
        return known

    def extend(self, data: bytes, last: list[int], start: int) -> list[int]:
        """Fill last[end] (the token that ends the prefix of that length) for start < end <= len(data); last[0] is -1."""
        suffixes, fits, may_follow = self.suffixes, self.fits, self.may_follow
        for end in range(start + 1, len(data) + 1):
            found: list[tuple[int, int]] = []
            begin = end - 1
            while begin >= 0:
                token = suffixes.get(data[begin:end])
                if token is None:
                    break
                if token >= 0:
                    found.append((begin, token))
                begin -= 1
            for begin, token in reversed(found):
                before = last[begin]
                ok = fits.get((before + 1) << 24 | token)
                if ok is None:
                    ok = may_follow(before, token)
                if ok:
                    last.append(token)
                    break
            else:
                raise ValueError("a byte of the text is no token of the vocabulary")
        return last

    def backtrack(self, last: list[int]) -> list[int]:
        out, end = [], len(last) - 1
        while end:
            out.append(last[end])
            end -= len(self.token_bytes[last[end]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None and self.may_follow(-1, whole):
            return [whole]
        return self.backtrack(self.extend(data, [-1], 0))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


class GrowingPiece:
    """One piece under edits: exact ids after every append, and after a splice only what follows it is redone."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        start, self.data = len(self.data), self.data + more
        self.encoder.extend(self.data, self.last, start)

    def splice(self, begin: int, end: int, new: bytes) -> None:
        self.data = self.data[:begin] + new + self.data[end:]
        del self.last[begin + 1 :]
        self.encoder.extend(self.data, self.last, begin)

    def ids(self) -> list[int]:
        return self.encoder.backtrack(self.last)


class TextEncoder:
    """Splits a text by the pattern and joins its pieces' ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.pieces = regex.compile(pattern).findall
        self.encoder = PrefixEncoder(load_ranks(path))
        self.memo: dict[str, bytes] = {}

    def packed(self, text: str) -> bytes:
        memo, out = self.memo, []
        if len(memo) > PIECE_MEMO:
            memo.clear()
        for piece in self.pieces(text):
            ids = memo.get(piece)
            if ids is None:
                got = self.encoder.encode_piece(piece.encode())
                ids = b"".join(x.to_bytes(4, "little") for x in got)
                if len(piece) <= 64:
                    memo[piece] = ids
            out.append(ids)
        return b"".join(out)


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One for each worker and vocabulary."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = TextEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_bytes and, with keep_ids, ids: array<int>. No shuffle."""
    import public_tokenizers

    frame = keyed_text(docs, id_col, text_col)
    pattern = pattern or public_tokenizers.PATTERN
    schema = f"doc_id {id_type(frame, 'doc_id')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded_bytes bigint" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tool = text_encoder(tokenizer_path(vocabulary), pattern)
        table_of = tool.encoder.token_bytes
        for whole in batches:
            for batch, texts in by_size(whole, 1):
                counts, digests, back, sizes, ids = [], [], [], [], []
                for text in texts:
                    packed = tool.packed(text or "")
                    numbers = np.frombuffer(packed, "<u4")
                    decoded = b"".join(map(table_of.__getitem__, numbers.tolist()))
                    counts.append(len(numbers))
                    digests.append(hashlib.sha256(packed).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
                    sizes.append(len(decoded))
                    if keep_ids:
                        ids.append(numbers.astype("i4"))
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string()), pa.array(sizes, pa.int64())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_bytes"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return frame.mapInArrow(run, schema)
