"""Secrets in texts: three fixed kinds, and random strings that a token vocabulary compresses badly.

Token-efficiency test: prose and identifiers need few tokens for their characters, random strings many. A candidate is a
run of characters of ``[A-Za-z0-9+/_=-]`` without the spans of the fixed kinds and the UUIDs in it. What has fewer than
``max_ratio`` characters a token is reported as kind ``random``; below ``min_length`` characters, down to ``SHORT``, the
evidence is weaker and fewer than ``SHORT_RATIO`` are asked for. A run that is not reported whole is tested by its parts
between ``/`` and ``=``, then between all separators, so words beside a random string do not dilute it. Digests (all
hexadecimal, of a usual digest length), UUIDs and plain numbers are known identifiers and are left out; so are words and
numbers joined by separators, except for what their parts hold.

Defined results: a null text is an empty one (no spans); repeated rows give repeated rows; an empty table gives an empty
table; whole texts are read; spans are code points, end exclusive; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .byte_bpe import load_ranks
from .common import Covered, by_size, id_type, keyed_text, tokenizer_path

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: A run of these characters is one match of [A-Z0-9]+ after AKIA or of [0-9a-f]+, so the lengths can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Lengths of usual digests in hexadecimal.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")
#: Words or numbers between single separators: names of things, dates, paths.
NAMED = re.compile(r"([A-Za-z]+|[0-9]+)([+/_=-]+([A-Za-z]+|[0-9]+))*[=/_-]*")
SHORT = 12
SHORT_RATIO = 1.5
#: What parts a run that is not reported whole, in this order.
PARTS = (re.compile(r"[^/=]+"), re.compile(r"[^+/_=-]+"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def known_identifier(run: str) -> bool:
    return bool(HEXADECIMAL.fullmatch(run) and len(run) in DIGEST_LENGTHS or UUID.fullmatch(run) or NAMED.fullmatch(run) and not run.isalpha())


def free_parts(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What the sorted ranges leave of start to end."""
    for s, e in taken:
        if s >= end:
            break
        if e > start:
            if s > start:
                yield start, s
            start = e
    if start < end:
        yield start, end


class TokenEfficiency:
    def __init__(self, path: str, pattern: str, min_length: int, max_ratio: float):
        import tiktoken

        self.encode = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}).encode_ordinary
        self.min_length, self.max_ratio = min_length, max_ratio
        self.short = min(SHORT, min_length)
        self.candidate = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % self.short)

    def random(self, run: str) -> bool:
        if not any(c.isalpha() for c in run) or known_identifier(run):
            return False
        ratio = self.max_ratio if len(run) >= self.min_length else min(SHORT_RATIO, self.max_ratio)
        return len(run) < ratio * len(self.encode(run))

    def parts(self, text: str, start: int, end: int, level: int = 0) -> Iterator[tuple[int, int]]:
        """The largest parts of text[start:end] that pass the test."""
        if end - start < self.short:
            return
        if self.random(text[start:end]):
            yield start, end
        elif level < len(PARTS):
            for m in PARTS[level].finditer(text, start, end):
                yield from self.parts(text, m.start(), m.end(), level + 1)

    def spans(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        out, fixed = [], [(s, e) for s, _, e in taken]
        covered, at = Covered(fixed), 0
        for m in self.candidate.finditer(text):
            start, end = m.span()
            known = [x.span() for x in UUID.finditer(m[0])]
            if not known and not covered.meets(start, end):
                out += [(s, 3, e) for s, e in self.parts(text, start, end)]
                continue
            while at < len(fixed) and fixed[at][1] <= start:
                at += 1
            near = []
            for k in range(at, len(fixed)):
                if fixed[k][0] >= end:
                    break
                near.append(fixed[k])
            within = sorted(near + [(start + s, start + e) for s, e in known])
            for s, e in free_parts(start, end, within):
                rest = text[s:e]
                s, e = s + len(rest) - len(rest.lstrip("+/_=-")), e - (len(rest) - len(rest.rstrip("+/_=-")))
                out += [(s, 3, e) for s, e in self.parts(text, s, e)]
        return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_TESTS: dict[tuple, TokenEfficiency] = {}


def scan(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", min_length: int = 20, max_ratio: float = 2.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans. One row for each input row, no shuffle."""
    import public_tokenizers

    frame, pattern = keyed_text(docs, id_col, text_col), public_tokenizers.PATTERN

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key = (tokenizer_path(vocabulary), pattern, min_length, max_ratio)
        if key not in _TESTS:
            _TESTS[key] = TokenEfficiency(*key)
        test = _TESTS[key]
        for whole in batches:
            for batch, texts in by_size(whole, 1):
                counts, base, full = [], [], []
                for text in texts:
                    found = base_spans(text) if text else []
                    more = test.spans(text, found) if text else []
                    counts.append([sum(k == kind for _, k, _ in found) for kind in range(3)] + [len(more)])
                    base.append(joined(found))
                    full.append(joined(sorted(found + more)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)), pa.array(base, pa.string()), pa.array(full, pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"],
                )

    return frame.mapInArrow(run, f"doc_id {id_type(frame, 'doc_id')}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_spans string, spans string")
