"""ISO media containers as columns: boxes, sample tables and keyframe byte ranges.

``parse_container`` walks the nested boxes of an ISO base media file (MP4, MOV,
3GP and kin), decodes the sample tables and the runs of movie fragments with numpy
and reports codec, duration, sample and keyframe byte ranges. Payload bytes are never
decoded. Counts in headers are held against the file's length before anything is
made of them, so a small file takes little memory whatever it claims.

``build_container`` is its counterpart for raw 8-bit samples: one track of
uncompressed 8x8 grey frames, 64 bytes a sample, a keyframe every 32 samples.

Defined cases: null bytes give a row whose ``error`` is ``no bytes``; truncated or
malformed files give ``error`` and what was read before it; a file without a movie
has no tracks; equal bytes give equal rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_BYTES = 64
KEYFRAME_EVERY = 32
TIMESCALE = 1000
FRAME_TICKS = 40
#: Fixed values of ISO/IEC 14496-12: boxes that hold boxes.
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
IDENTITY = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


class Malformed(ValueError):
    """A box or table that does not fit its file."""


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def build_container(payload: bytes) -> bytes:
    """A movie of one raw grey track that holds ``payload``, whose length is a multiple of 64, as its samples."""
    if not payload or len(payload) % FRAME_BYTES:
        raise Malformed("payload is not a positive multiple of a frame")
    n = len(payload) // FRAME_BYTES
    ticks = n * FRAME_TICKS
    keys = np.arange(1, n + 1, KEYFRAME_EVERY, dtype=">u4")
    entry = _box(
        b"raw ",
        struct.pack(">6xH16xHHIIIH", 1, 8, 8, 0x480000, 0x480000, 0, 1) + bytes(32) + struct.pack(">Hh", 40, -1),
    )
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2", b"mp41")

    def movie(first: int) -> bytes:
        tables = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, FRAME_TICKS)),
            _full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            _full(b"stsc", struct.pack(">IIII", 1, 1, n, 1)),
            _full(b"stsz", struct.pack(">II", FRAME_BYTES, n)),
            _full(b"stco", struct.pack(">II", 1, first)),
        )
        return _box(
            b"moov",
            _full(b"mvhd", struct.pack(">IIIIiH10x", 0, 0, TIMESCALE, ticks, 0x10000, 0x100), IDENTITY, bytes(24), struct.pack(">I", 2)),
            _box(
                b"trak",
                _full(b"tkhd", struct.pack(">IIIII8xhhHH", 0, 0, 1, 0, ticks, 0, 0, 0, 0), IDENTITY, struct.pack(">II", 8 << 16, 8 << 16), flags=3),
                _box(
                    b"mdia",
                    _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, ticks, 0x55C4, 0)),
                    _full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"frames\0"),
                    _box(
                        b"minf",
                        _full(b"vmhd", bytes(8), flags=1),
                        _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))),
                        tables,
                    ),
                ),
            ),
        )

    first = len(ftyp) + len(movie(0)) + 8
    return ftyp + movie(first) + _box(b"mdat", payload)


def _boxes(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind, start and end of the body of each box in ``data[at:end]``; sizes of 64 bits and to the end are known."""
    while at < end:
        if end - at < 8:
            raise Malformed(f"{end - at} bytes after the last box")
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            if end - at < 16:
                raise Malformed("a long size is cut off")
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise Malformed(f"box {kind.decode('latin-1')} does not fit")
        yield bytes(kind), at + head, at + size
        at += size


def _bounded(n: int, least: int, data: memoryview) -> int:
    """A count of things that take ``least`` bytes each, if the file can hold as many."""
    if n * max(least, 1) > len(data):
        raise Malformed("more samples than bytes")
    return n


def _table(data: memoryview, at: int, end: int, kind: str, width: int = 1) -> np.ndarray:
    """The rows of a counted table whose count stands at ``at``."""
    n = struct.unpack_from(">I", data, at)[0]
    each = np.dtype(kind).itemsize * width
    if at + 4 + n * each > end:
        raise Malformed("a sample table is cut off")
    rows = np.frombuffer(data, kind, n * width, at + 4).astype(np.int64)
    return rows.reshape(n, width) if width > 1 else rows


def _track(data: memoryview, at: int, end: int) -> dict:
    """A trak box: its codec, times and sample tables."""
    t: dict = {"codec": None, "handler": None, "timescale": 0, "duration": 0, "sync": None}
    todo = [(at, end)]
    while todo:
        for kind, lo, hi in _boxes(data, *todo.pop()):
            if kind in NESTED:
                todo.append((lo, hi))
            elif kind == b"tkhd":
                t["id"] = struct.unpack_from(">20xI" if data[lo] == 1 else ">12xI", data, lo)[0]
            elif kind == b"mdhd":
                t["timescale"], t["duration"] = struct.unpack_from(">20xIQ" if data[lo] == 1 else ">12xII", data, lo)
            elif kind == b"hdlr":
                t["handler"] = bytes(data[lo + 8 : lo + 12]).decode("latin-1")
            elif kind == b"stsd":
                for code, _, _ in _boxes(data, lo + 8, hi):
                    t["codec"] = t["codec"] or code.decode("latin-1")
            elif kind == b"stts":
                t["times"] = _table(data, lo + 4, hi, ">u4", 2)
            elif kind == b"stss":
                t["sync"] = _table(data, lo + 4, hi, ">u4") - 1
            elif kind == b"stsc":
                t["runs"] = _table(data, lo + 4, hi, ">u4", 3)
            elif kind == b"stsz":
                one, n = struct.unpack_from(">II", data, lo + 4)
                t["sizes"] = np.full(_bounded(n, one, data), one, np.int64) if one else _table(data, lo + 8, hi, ">u4")
            elif kind == b"stco":
                t["chunks"] = _table(data, lo + 4, hi, ">u4")
            elif kind == b"co64":
                t["chunks"] = _table(data, lo + 4, hi, ">u8")
    return t


def _places(t: dict) -> np.ndarray:
    """Byte offset of each sample, from the chunk offsets and the samples-per-chunk runs."""
    sizes, chunks, runs = t.get("sizes", np.zeros(0, np.int64)), t.get("chunks", np.zeros(0, np.int64)), t.get("runs")
    if not len(sizes):
        return np.zeros(0, np.int64)
    if runs is None or not len(runs) or not len(chunks):
        raise Malformed("samples without chunks")
    until = np.append(runs[1:, 0], len(chunks) + 1)
    if runs[0, 0] != 1 or (until <= runs[:, 0]).any():
        raise Malformed("runs of chunks out of order")
    per = np.repeat(runs[:, 1], until - runs[:, 0])
    if len(per) != len(chunks) or per.sum() != len(sizes):
        raise Malformed("sample tables disagree")
    first = np.cumsum(per) - per
    before = np.cumsum(sizes) - sizes
    return np.repeat(chunks - before[np.minimum(first, len(sizes) - 1)], per) + before


#: Fixed values of ISO/IEC 14496-12: flags of the fields that tfhd and trun hold, and of samples that aren't keyframes.
TFHD = {"base": 0x1, "description": 0x2, "duration": 0x8, "size": 0x10, "flags": 0x20, "from_moof": 0x20000}
TRUN = {"offset": 0x1, "first_flags": 0x4, "duration": 0x100, "size": 0x200, "flags": 0x400, "shift": 0x800}
NOT_SYNC = 0x10000


def _defaults(data: memoryview, at: int, end: int) -> dict[int, tuple[int, int, int]]:
    """The mvex box's defaults of each track's fragments: duration, size, flags."""
    return {v[0]: v[2:] for kind, lo, _ in _boxes(data, at, end) if kind == b"trex" for v in [struct.unpack_from(">4x5I", data, lo)]}


def _fragment(data: memoryview, moof: int, at: int, end: int, defaults: dict[int, tuple[int, int, int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Track, starts, sizes, keyframe marks and duration of each run of samples in a moof box that begins at ``moof``."""
    last = moof  # where the data of the runs before end
    for kind, lo, hi in _boxes(data, at, end):
        if kind != b"traf":
            continue
        track, base, own = 0, moof, (0, 0, 0)
        place = last
        for inner, a, b in _boxes(data, lo, hi):
            if inner == b"tfhd":
                flags, track = struct.unpack_from(">II", data, a)
                own, p = list(defaults.get(track, (0, 0, 0))), a + 8
                base = moof if flags & TFHD["from_moof"] else last
                if flags & TFHD["base"]:
                    base, p = struct.unpack_from(">Q", data, p)[0], p + 8
                p += 4 if flags & TFHD["description"] else 0
                for k, name in enumerate(("duration", "size", "flags")):
                    if flags & TFHD[name]:
                        own[k], p = struct.unpack_from(">I", data, p)[0], p + 4
                place = base
            elif inner == b"trun":
                flags, n = struct.unpack_from(">II", data, a)
                p, first = a + 8, None
                if flags & TRUN["offset"]:
                    place, p = base + struct.unpack_from(">i", data, p)[0], p + 4
                if flags & TRUN["first_flags"]:
                    first, p = struct.unpack_from(">I", data, p)[0], p + 4
                names = [x for x in ("duration", "size", "flags", "shift") if flags & TRUN[x]]
                if p + 4 * len(names) * n > b:
                    raise Malformed("a run of samples is cut off")
                # Without a field of their own, samples take at least their default size of the file.
                rows = np.frombuffer(data, ">u4", _bounded(n, 0 if names else own[1], data) * len(names), p).reshape(n, len(names)).astype(np.int64)
                durations, sizes, marks = (rows[:, names.index(x)] if x in names else np.full(n, own[k], np.int64) for k, x in enumerate(("duration", "size", "flags")))
                if first is not None and n:
                    marks = np.append(first, marks[1:])
                starts = place + np.cumsum(sizes) - sizes
                place = last = int(place + sizes.sum())
                yield track, starts, sizes, (marks & NOT_SYNC) == 0, int(durations.sum())


def parse_container(data: bytes | None) -> dict:
    """Codec, duration, samples and keyframe byte ranges of each track; payload stays undecoded."""
    out: dict = {"brand": None, "tracks": [], "error": None}
    if data is None:
        return out | {"error": "no bytes"}
    view = memoryview(data)
    tracks, defaults, at_moof = {}, {}, 0
    try:
        for kind, lo, hi in _boxes(view, 0, len(view)):
            if kind == b"ftyp":
                out["brand"] = bytes(view[lo : lo + 4]).decode("latin-1")
            elif kind == b"moov":
                for inner, a, b in _boxes(view, lo, hi):
                    if inner == b"trak":
                        t = _track(view, a, b)
                        at, sizes = _places(t), t.get("sizes", np.zeros(0, np.int64))
                        sync = np.arange(len(sizes)) if t["sync"] is None else t["sync"]
                        if len(sync) and (sync.min() < 0 or sync.max() >= len(sizes)):
                            raise Malformed("keyframes outside the samples")
                        times = t.get("times", np.zeros((0, 2), np.int64))
                        _inside(at, sizes, view)
                        out["tracks"].append(
                            {"codec": t["codec"], "handler": t["handler"], "timescale": t["timescale"], "duration": t["duration"] or int((times[:, 0] * times[:, 1]).sum()), "starts": at, "sizes": sizes, "key_starts": at[sync], "key_ends": at[sync] + sizes[sync]}
                        )
                        tracks[t.get("id", len(out["tracks"]))] = (out["tracks"][-1], t["duration"] == 0)
                    elif inner == b"mvex":
                        defaults = _defaults(view, a, b)
            elif kind == b"moof":
                for track, starts, sizes, keys, duration in _fragment(view, at_moof, lo, hi, defaults):
                    if track not in tracks:
                        raise Malformed("a fragment of no track")
                    _inside(starts, sizes, view)
                    t, adds = tracks[track]
                    more = {"starts": starts, "sizes": sizes, "key_starts": starts[keys], "key_ends": starts[keys] + sizes[keys]}
                    t.update({k: np.concatenate([t[k], x]) for k, x in more.items()})
                    t["duration"] += duration if adds else 0
            at_moof = hi
    except (Malformed, struct.error, IndexError, ValueError, OverflowError, MemoryError) as e:
        out["error"] = str(e) or "malformed"
    return out


def _inside(at: np.ndarray, sizes: np.ndarray, data: memoryview) -> None:
    if len(at) and ((at < 0) | (at + sizes > len(data))).any():
        raise Malformed("samples outside the file")


def read_samples(data: bytes, track: dict) -> bytes:
    """The track's sample bytes in order, read from the file by its byte ranges; touching ranges are read as one."""
    at, sizes = track["starts"], track["sizes"]
    if not len(at):
        return b""
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1] + sizes[:-1]))
    stop = np.append(new[1:], len(at)) - 1
    return b"".join(data[a:b] for a, b in zip(at[new].tolist(), (at[stop] + sizes[stop]).tolist(), strict=True))


COLUMNS = "brand string, codec string, handler string, timescale long, duration long, samples long, keyframes array<struct<start:long,end:long>>, error string"


def media_columns(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """One row per track of each file in ``content`` (files without tracks: one row), with ``COLUMNS``."""
    schema = files.select(key).schema
    kind = schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = parse_container(data)
                for t in found["tracks"] or [None]:
                    keys = [] if t is None else [{"start": a, "end": b} for a, b in zip(t["key_starts"].tolist(), t["key_ends"].tolist(), strict=True)]
                    out.append({key: k, "brand": found["brand"], "codec": t and t["codec"], "handler": t and t["handler"], "timescale": t and t["timescale"], "duration": t and t["duration"], "samples": len(t["sizes"]) if t else 0, "keyframes": keys, "error": found["error"]})
            ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            types = [batch.schema.field(0).type, *[pa.string()] * 3, pa.int64(), pa.int64(), pa.int64(), ranges, pa.string()]
            names = [key, "brand", "codec", "handler", "timescale", "duration", "samples", "keyframes", "error"]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in zip(names, types, strict=True)], names)

    return files.select(key, content).mapInArrow(rows, f"`{key}` {kind}, {COLUMNS}")


def padded(text: bytes) -> bytes:
    """The bytes with zeros up to a positive multiple of a frame."""
    return text + bytes(-len(text) % FRAME_BYTES if text else FRAME_BYTES)


def stored_digests(body: bytes) -> tuple:
    """Stores bytes in a container, parses it, and digests what its byte ranges give back."""
    media = build_container(padded(body))
    found = parse_container(media)
    if found["error"]:
        raise Malformed(found["error"])
    t = found["tracks"][0]
    back = read_samples(media, t)
    spans = np.stack([t["key_starts"], t["key_ends"]], axis=1).astype("<i8").tobytes()
    feature = f"brand={found['brand']};codec={t['codec']};timescale={t['timescale']};duration={t['duration']};samples={len(t['sizes'])};keyframes={len(t['key_starts'])};first={t['key_starts'][0]}-{t['key_ends'][0]};last={t['key_starts'][-1]}-{t['key_ends'][-1]};ranges_crc32={zlib.crc32(spans)}"
    return len(body), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-FRAME_BYTES:]), len(media), hashlib.sha256(media).hexdigest(), feature


def op7_query(docs: DataFrame) -> DataFrame:
    """Every whole text, stored as 8-bit samples of a container and read back, as op7's contract has it."""
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [stored_digests(x or b"") for x in batch.column(1).to_pylist()]
            cols = [pa.array([g[i] for g in got], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", *names])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")).mapInArrow(rows, schema)
