"""Matroska media columns: writing 8-bit sound without loss, and parsing files into packet tables.

A file is EBML: elements of a variable-length identifier, a variable-length size and data. Clusters hold blocks, a block
holds one frame or several by lacing (fixed-size, Xiph or EBML), and cues point to clusters. The parser gives one row for
each frame: track, timestamp, keyframe flag, byte range and the lacing it came from.

Defined results: a null text is an empty one, whose payload is one frame of padding; equal texts give equal files;
repeated rows give repeated rows; an empty table gives an empty table; texts of any length are stored whole; other columns
are ignored. A null, empty or damaged file, and one without packets, has one row that says so in ``error``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import by_size, col, id_type, keyed_text

# Element identifiers of the public format.
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, DEFAULT_DURATION = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x23E383
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

#: One frame: 576 samples of one byte, 72 ms at 8 kHz.
FRAME = 576
RATE = 8000
FRAME_MS = FRAME * 1000 // RATE
FRAMES_A_BLOCK, BLOCKS_A_CLUSTER = 8, 16


class Packet(NamedTuple):
    track: int
    timestamp: int
    keyframe: bool
    offset: int
    size: int
    lacing: int


# ---- writing ----------------------------------------------------------------------------------------------------------


def vint(value: int, width: int = 0) -> bytes:
    """A size: as many leading zero bits as bytes follow; all ones are kept for 'unknown'."""
    width = width or next(n for n in range(1, 9) if value < (1 << 7 * n) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(ident: int, data: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(data)) + data


def uint(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def block(track: int, relative: int, frames: list[bytes], lacing: int = FIXED) -> bytes:
    """The data of a block. One frame is never laced."""
    if len(frames) == 1:
        lacing = NO_LACING
    head = vint(track) + struct.pack(">hB", relative, 0x80 | lacing << 1)
    if lacing == NO_LACING:
        return head + frames[0]
    sizes = [len(f) for f in frames]
    head += bytes([len(frames) - 1])
    if lacing == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == EBML_LACING:
        head += vint(sizes[0])
        for before, now in zip(sizes, sizes[1:-1]):
            width = next(n for n in range(1, 9) if abs(now - before) < (1 << 7 * n - 1))
            head += vint(now - before + (1 << 7 * width - 1) - 1, width)
    elif len(set(sizes)) != 1:
        raise ValueError("fixed-size lacing needs frames of one size")
    return head + b"".join(frames)


_HEAD = element(
    EBML,
    uint(EBML_VERSION, 1) + uint(EBML_READ_VERSION, 1) + uint(EBML_MAX_ID, 4) + uint(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_TYPE_VERSION, 4) + uint(DOC_TYPE_READ_VERSION, 2),
)
_TRACKS = element(
    TRACKS,
    element(
        TRACK_ENTRY,
        uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + uint(DEFAULT_DURATION, FRAME_MS * 1_000_000)
        + element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8)),
    ),
)


def mux(payload: bytes, lacing: int = FIXED) -> bytes:
    """A file with one sound track of 8-bit samples; the payload is cut into frames of 576 bytes."""
    frames = [payload[k : k + FRAME] for k in range(0, len(payload), FRAME)]
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(frames) * FRAME_MS)) + element(MUXING_APP, b"deltafolio") + element(WRITING_APP, b"deltafolio"))
    parts, cues, at = [info, _TRACKS], [], len(info) + len(_TRACKS)
    for first in range(0, len(frames), FRAMES_A_BLOCK * BLOCKS_A_CLUSTER):
        own = frames[first : first + FRAMES_A_BLOCK * BLOCKS_A_CLUSTER]
        data = uint(TIMESTAMP, first * FRAME_MS) + b"".join(element(SIMPLE_BLOCK, block(1, k * FRAME_MS, own[k : k + FRAMES_A_BLOCK], lacing)) for k in range(0, len(own), FRAMES_A_BLOCK))
        cues.append(element(CUE_POINT, uint(CUE_TIME, first * FRAME_MS) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, at))))
        parts.append(element(CLUSTER, data))
        at += len(parts[-1])
    return _HEAD + element(SEGMENT, b"".join(parts) + element(CUES, b"".join(cues)))


# ---- parsing ----------------------------------------------------------------------------------------------------------


def read_vint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int, bool]:
    """(value, place after it, whether all value bits are ones)."""
    first = data[at]
    if not first:
        raise ValueError("a variable-length number of over 8 bytes")
    width = 9 - first.bit_length()
    if at + width > len(data):
        raise ValueError("the file ends inside a number")
    value = int.from_bytes(data[at : at + width], "big")
    bare = value & (1 << 7 * width) - 1
    return value if keep_marker else bare, at + width, bare == (1 << 7 * width) - 1


#: Elements that end an unknown-size cluster.
_TOP = {CLUSTER, CUES, INFO, TRACKS, SEGMENT}


def elements(data: bytes, at: int, end: int, within: int = 0) -> Iterator[tuple[int, int, int]]:
    """(identifier, first byte of the data, end) of the elements in a range; unknown sizes run to the parent's end."""
    while at < end:
        ident, at, _ = read_vint(data, at, keep_marker=True)
        if within == CLUSTER and ident in _TOP:
            return
        size, at, unknown = read_vint(data, at)
        stop = end if unknown else at + size
        if stop > end:
            raise ValueError(f"element {ident:#x} is cut short")
        if unknown and ident == CLUSTER:
            stop = at
            for _, _, inner_end in elements(data, at, end, CLUSTER):
                stop = inner_end
        yield ident, at, stop
        at = stop


def number(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def frames_of(data: bytes, at: int, end: int) -> tuple[int, int, bool, int, list[tuple[int, int]]]:
    """(track, relative timestamp, keyframe, lacing, [(offset, size)]) of a block."""
    track, at, _ = read_vint(data, at)
    relative, flags = struct.unpack_from(">hB", data, at)
    at, lacing = at + 3, flags >> 1 & 3
    if lacing == NO_LACING:
        return track, relative, bool(flags & 0x80), lacing, [(at, end - at)]
    n, at = data[at] + 1, at + 1
    if lacing == FIXED:
        each, rest = divmod(end - at, n)
        if rest:
            raise ValueError("fixed-size lacing doesn't divide the block")
        return track, relative, bool(flags & 0x80), lacing, [(at + k * each, each) for k in range(n)]
    sizes: list[int] = []
    for k in range(n - 1):
        if lacing == XIPH:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            size, at = size + data[at], at + 1
        else:
            start = at
            size, at, _ = read_vint(data, at)
            if k:
                size += sizes[-1] - (1 << 7 * (at - start) - 1) + 1
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laced frames pass the block's end")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return track, relative, bool(flags & 0x80), lacing, out


def parse(data: bytes) -> tuple[list[Packet], dict]:
    """Packets in file order, and what the headers and cues say; cue positions are checked against the clusters."""
    packets: list[Packet] = []
    info: dict = {"scale": 1_000_000, "duration": 0.0, "tracks": {}, "cues": [], "clusters": []}
    for ident, begin, end in elements(data, 0, len(data)):
        if ident != SEGMENT:
            continue
        for kind, at, stop in elements(data, begin, end):
            if kind == INFO:
                for k, a, b in elements(data, at, stop):
                    if k == TIMESTAMP_SCALE:
                        info["scale"] = number(data, a, b)
                    elif k == DURATION:
                        info["duration"] = struct.unpack(">d" if b - a == 8 else ">f", data[a:b])[0]
            elif kind == TRACKS:
                for k, a, b in elements(data, at, stop):
                    if k == TRACK_ENTRY:
                        own = {i: (x, y) for i, x, y in elements(data, a, b)}
                        info["tracks"][number(data, *own[TRACK_NUMBER])] = {
                            "type": number(data, *own[TRACK_TYPE]), "codec": data[slice(*own[CODEC_ID])].decode("ascii", "replace"), "frame_ns": number(data, *own[DEFAULT_DURATION]) if DEFAULT_DURATION in own else 0,
                        }
            elif kind == CLUSTER:
                info["clusters"].append(at)
                base = 0
                for k, a, b in elements(data, at, stop):
                    if k == TIMESTAMP:
                        base = number(data, a, b)
                    elif k in (SIMPLE_BLOCK, BLOCK_GROUP):
                        for a, b in [(a, b)] if k == SIMPLE_BLOCK else [(x, y) for i, x, y in elements(data, a, b) if i == BLOCK]:
                            track, relative, key, lacing, ranges = frames_of(data, a, b)
                            step = info["tracks"].get(track, {}).get("frame_ns", 0) / info["scale"]
                            packets += [Packet(track, base + relative + round(n * step), key, o, s, lacing) for n, (o, s) in enumerate(ranges)]
            elif kind == CUES:
                for k, a, b in elements(data, at, stop):
                    if k == CUE_POINT:
                        time, position, track = 0, -1, 0
                        for i, x, y in elements(data, a, b):
                            if i == CUE_TIME:
                                time = number(data, x, y)
                            elif i == CUE_TRACK_POSITIONS:
                                for j, p, q in elements(data, x, y):
                                    if j == CUE_CLUSTER_POSITION:
                                        position = number(data, p, q)
                                    elif j == CUE_TRACK:
                                        track = number(data, p, q)
                        info["cues"].append((time, track, begin + position, data[begin + position : begin + position + 4] == CLUSTER.to_bytes(4, "big")))
    return packets, info


# ---- tables -----------------------------------------------------------------------------------------------------------


def packet_table(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each frame of each file; a file that cannot be parsed gives one row with the reason in ``error``."""
    frame = files.select(col(id_col).alias("doc_id"), col(media_col).cast("binary").alias("media"))
    schema = f"doc_id {id_type(frame, 'doc_id')}, packet int, track int, timestamp_ms bigint, keyframe boolean, offset bigint, size bigint, lacing int, error string"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        target = pa.schema([("packet", pa.int32()), ("track", pa.int32()), ("timestamp_ms", pa.int64()), ("keyframe", pa.bool_()), ("offset", pa.int64()), ("size", pa.int64()), ("lacing", pa.int32()), ("error", pa.string())])
        for batch in batches:
            for k, data in enumerate(batch.column(1).to_pylist()):
                try:
                    found, info = parse(data or b"")
                    rows = [(n, p.track, p.timestamp * info["scale"] // 1_000_000, p.keyframe, p.offset, p.size, p.lacing, None) for n, p in enumerate(found)]
                    if not rows:
                        rows = [(None,) * 7 + ("no file" if data is None else "no packets",)]
                except (ValueError, IndexError, KeyError, struct.error) as e:
                    rows = [(None,) * 7 + (str(e) or type(e).__name__,)]
                if rows:
                    ids = batch.column(0).slice(k, 1).take(pa.array([0] * len(rows)))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, t) for x, t in zip(zip(*rows), target.types))], ["doc_id", *target.names])

    return frame.mapInArrow(run, schema)


def padded(text: str) -> tuple[int, bytes]:
    data = text.encode()
    return len(data), data + b"\xff" * (-len(data) % FRAME if data else FRAME)


def sound_features(payload: bytes, packets: list[Packet], info: dict) -> str:
    """Whole-number features of the samples that were read back."""
    import numpy as np

    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    loud = int(np.abs(x.reshape(-1, FRAME)).sum(axis=1).max()) if len(x) % FRAME == 0 and len(x) else 0
    crossings = int(np.count_nonzero((x[1:] >= 0) != (x[:-1] >= 0)))
    return f"packets={len(packets)};clusters={len(info['clusters'])};cues={sum(c[3] for c in info['cues'])};ms={packets[-1].timestamp + FRAME_MS if packets else 0};sum={int(x.sum())};energy={int((x * x).sum())};crossings={crossings};loudest={loud}"


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = True) -> DataFrame:
    """Stores each text as a file, reads the file back and computes features of what was read. No shuffle."""
    frame = keyed_text(docs, id_col, text_col)
    schema = f"doc_id {id_type(frame, 'doc_id')}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, n_packets bigint, feature string" + (", media binary" if keep_media else "")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch, texts in by_size(whole, 1):
                rows = []
                for text in texts:
                    n, payload = padded(text or "")
                    stored = mux(payload)
                    packets, info = parse(stored)
                    back = b"".join([stored[p.offset : p.offset + p.size] for p in packets])
                    rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), len(packets), sound_features(back, packets, info), stored if keep_media else None))
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "n_packets", "feature", "media"]
                columns = [batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types[: 9 if keep_media else 8]))]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return frame.mapInArrow(run, schema)
