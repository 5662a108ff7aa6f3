"""Fill-in-middle transformation over seekable compressed frames (operator 11).

A text is a sequence of units, ``[A-Za-z]+|[^A-Za-z]`` from left to right.  The
hash of a document's id chooses two cuts between units (prefix, middle, suffix)
and the form of the output:

plain   the text
psm     ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
spm     ``<S>`` suffix ``<P>`` prefix ``<M>`` middle

``write_frames`` stores the texts as independent zstandard frames of ``FRAME``
bytes.  A row of the store is a segment: documents laid end to end (up to
``SEGMENT`` bytes, a longer one alone) with, per frame and per document, the
bytes, units and code points before it.  A frame ends anywhere between two code
points; units are counted where they begin, so a letter run may go over any
number of frames, and the first unit of a document always begins one.

``transform`` reads the store.  A cut is a unit number: the cumulative counts
name the frame in which that unit begins, and only this frame is decompressed to
find its byte and code point.  Digests and outputs are streamed from the frames
in output order; the restored text is streamed from the output alone, cut at
its marks (which the text of a psm or spm output cannot hold).

Work and memory: two passes over the rows without a shuffle, so no key can be
hot; a task holds one segment, compressed, a few frames of it and, if asked
for, one output.

Defined cases: null and empty texts have no units and are plain; a null doc_id
is written ``null`` in what is hashed; rows of one doc_id have the same hash
and each its own cuts; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import text_batches

FRAME, SEGMENT, LEVEL = 1 << 16, 2 << 20, 3
PLAIN_OF_100, SPM_OF_100 = 10, 20
P, S, M = b"<P>", b"<S>", b"<M>"
_HELD = 1 << 20  # an output of at most so many bytes is put together once and kept for the passes over it

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_TAIL = np.zeros(256, bool)  # bytes of UTF-8 that begin no code point
_TAIL[0x80:0xC0] = True

STORE = (
    "doc_ids array<long>, marked array<boolean>, doc_byte array<long>, doc_unit array<long>, doc_char array<long>, "
    "frame_byte array<long>, frame_unit array<long>, frame_char array<long>, frame_open array<boolean>, frames array<binary>"
)
_LONGS, _FLAGS = pa.list_(pa.int64()), pa.list_(pa.bool_())
_STORE = pa.schema(
    [("doc_ids", _LONGS), ("marked", _FLAGS), *((c, _LONGS) for c in ("doc_byte", "doc_unit", "doc_char", "frame_byte", "frame_unit", "frame_char")), ("frame_open", _FLAGS), ("frames", pa.list_(pa.binary()))]
)


def unit_starts(buf: np.ndarray, begins: np.ndarray, joined: bool) -> np.ndarray:
    """Which bytes begin a unit.  ``begins``: where documents begin; ``joined``:
    whether the byte before the first is a letter."""

    letter = _LETTER[buf]
    before = np.empty(len(buf), bool)
    before[:1] = joined
    before[1:] = letter[:-1]
    start = ~_TAIL[buf] & ~(letter & before)
    start[begins[begins < len(buf)]] = True
    return start


def _counts(mask: np.ndarray) -> np.ndarray:
    """How many are set before each place, and in all."""

    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def pack(buf: np.ndarray, off: np.ndarray, compress: Callable[[bytes], bytes], frame: int = FRAME) -> dict[str, list]:
    """Frames and counts of texts laid end to end (bytes, offsets)."""

    units, chars = _counts(unit_starts(buf, off[:-1], False)), _counts(~_TAIL[buf])
    ends = np.arange(0, len(buf) + frame, frame)
    for k in range(1, len(ends)):
        while ends[k] < len(buf) and _TAIL[buf[ends[k]]]:
            ends[k] += 1
    ends = np.unique(np.minimum(ends, len(buf)))
    at = ends[:-1]
    raw = buf.tobytes()
    return {
        "marked": [any(m in raw[a:b] for m in (P, S, M)) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)],
        "doc_byte": off, "doc_unit": units[off], "doc_char": chars[off],
        "frame_byte": ends, "frame_unit": units[at], "frame_char": chars[at],
        "frame_open": [bool(a and _LETTER[buf[a - 1]]) for a in at.tolist()],
        "frames": [compress(raw[a:b]) for a, b in zip(at.tolist(), ends[1:].tolist(), strict=True)],
    }


def write_frames(docs: DataFrame, path: str, level: int = LEVEL, frame: int | None = None, segment: int | None = None) -> str:
    """Write the texts of ``docs`` (doc_id, text) as a store under ``path``."""

    frame, segment = frame or FRAME, segment or SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=level).compress
        for batch in batches:
            for i, j, buf, off in text_batches(batch, "text", segment):
                row = pack(buf, off, compress, frame) | {"doc_ids": batch.column("doc_id").slice(i, j - i).to_pylist()}
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _STORE], schema=_STORE)

    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, STORE).write.parquet(path)
    return path


class Segment:
    """Random access to the texts of a stored segment."""

    def __init__(self, row: dict):
        import zstandard

        self.doc_ids, self.marked, self.frames, self.open = (row[c] for c in ("doc_ids", "marked", "frames", "frame_open"))
        self.doc_byte, self.doc_unit, self.doc_char, self.frame_byte, self.frame_unit, self.frame_char = (
            np.array(row[c], np.int64) for c in ("doc_byte", "doc_unit", "doc_char", "frame_byte", "frame_unit", "frame_char")
        )
        self._decompress = zstandard.ZstdDecompressor().decompress
        self.frame = lru_cache(8)(lambda k: self._decompress(self.frames[k]))
        self.starts = lru_cache(8)(self._starts)

    def _starts(self, k: int) -> np.ndarray:
        a, b = self.frame_byte[k : k + 2]
        inside = self.doc_byte[np.searchsorted(self.doc_byte, a) : np.searchsorted(self.doc_byte, b)] - a
        return np.flatnonzero(unit_starts(np.frombuffer(self.frame(k), np.uint8), inside, self.open[k]))

    def seek(self, doc: int, unit: int) -> tuple[int, int]:
        """Byte and code point, within the segment, at which the document's
        ``unit``-th unit begins (its end after the last)."""

        for k in (doc, doc + 1):
            if self.doc_unit[k] - self.doc_unit[doc] == unit:
                return int(self.doc_byte[k]), int(self.doc_char[k])
        unit += int(self.doc_unit[doc])
        k = int(np.searchsorted(self.frame_unit, unit, "right")) - 1
        place = int(self.starts(k)[unit - self.frame_unit[k]])
        head = np.frombuffer(self.frame(k), np.uint8, place)
        return int(self.frame_byte[k]) + place, int(self.frame_char[k]) + place - int(_TAIL[head].sum())

    def between(self, a: int, b: int) -> Iterator[bytes]:
        """The bytes from ``a`` to ``b``, frame by frame."""

        k = int(np.searchsorted(self.frame_byte, a, "right")) - 1
        while a < b:
            base = int(self.frame_byte[k])
            part = self.frame(k)[a - base : b - base]
            yield part
            a += len(part)
            k += 1


def choose(doc_id: int | None, n: int, marked: bool, seed: int = 1) -> tuple[str, int, int]:
    """Form, units of the prefix, and units up to the end of the middle."""

    hashed = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hashed[k : k + 8], 16) for k in (0, 8, 16, 24))
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= 100 - PLAIN_OF_100:
        return "plain", *cuts
    return ("spm" if h4 % 100 < SPM_OF_100 else "psm"), *cuts


def _slice(chunks: Iterator[bytes], a: int, b: int | None) -> Iterator[bytes]:
    at = 0
    for c in chunks:
        if part := c[max(a - at, 0) : None if b is None else max(b - at, 0)]:
            yield part
        at += len(c)
        if b is not None and at >= b:
            return


def _places(chunks: Iterator[bytes], marks: tuple[bytes, ...]) -> list[int]:
    """Where the marks stand, each after the one before."""

    at, tail, out = 0, b"", []
    for c in chunks:
        data, here = tail + c, 0
        while len(out) < len(marks) and (k := data.find(marks[len(out)], here)) >= 0:
            out.append(at - len(tail) + k)
            here = k + 3
        if len(out) == len(marks):
            break
        at += len(c)
        tail = data[max(here, len(data) - 2) :]
    return out


def restored(output: Callable[[], Iterator[bytes]], form: str) -> Iterator[bytes]:
    """The text, from an output (that can be streamed more than once) and its form."""

    if form == "plain":
        yield from output()
        return
    first, second, last = _places(output(), (P, S, M) if form == "psm" else (S, P, M))
    one, two, middle = (first + 3, second), (second + 3, last), (last + 3, None)
    for a, b in (one, middle, two) if form == "psm" else (two, middle, one):
        yield from _slice(output(), a, b)


def restore(output: str, form: str) -> str:
    return b"".join(restored(lambda: iter([output.encode()]), form)).decode()


RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def transform(spark: SparkSession, path: str, seed: int = 1, output: bool = False) -> DataFrame:
    """Per document of the store: doc_id, n (units), form, prefix_chars and
    middle_chars (null if plain), digests of the output and of the text that is
    restored from it and, if asked for, the ``output``."""

    names = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
    schema = pa.schema(names + [("output", pa.string())] * output)

    def rows(seg: Segment) -> Iterator[tuple]:
        for k, doc_id in enumerate(seg.doc_ids):
            n = int(seg.doc_unit[k + 1] - seg.doc_unit[k])
            form, lo, hi = choose(doc_id, n, seg.marked[k], seed)
            (a, a_char), (d, _) = seg.seek(k, 0), seg.seek(k, n)
            sizes: tuple = (None, None)
            if form == "plain":
                order = [(a, d)]
            else:
                (b, b_char), (c, c_char) = seg.seek(k, lo), seg.seek(k, hi)
                sizes = (b_char - a_char, c_char - b_char)
                order = [P, (a, b), S, (c, d), M, (b, c)] if form == "psm" else [S, (c, d), P, (a, b), M, (b, c)]

            def stream(order: list = order) -> Iterator[bytes]:
                for part in order:
                    if type(part) is bytes:
                        yield part
                    else:
                        yield from seg.between(*part)

            if d - a <= _HELD:
                whole = b"".join(stream())
                again: Callable[[], Iterator[bytes]] = lambda whole=whole: iter((whole,))
            else:
                again = stream
            digests = []
            for chunks in (again(), restored(again, form)):
                h = hashlib.sha256()
                for chunk in chunks:
                    h.update(chunk)
                digests.append(h.hexdigest())
            yield (doc_id, n, form, *sizes, *digests, *([b"".join(again()).decode()] if output else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found, held = [], 0
                for r in rows(Segment({c: batch.column(c)[i].as_py() for c in batch.schema.names})):
                    found.append(r)
                    held += len(r[-1])
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
                        found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    return spark.read.schema(STORE).parquet(path).mapInArrow(run, RESULT + ", output string" * output)
