"""Shared helpers: staged tables, contiguous id ranges, numpy hashing of
words and shingles, and connected components as DataFrame joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import staged_copy


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can reach, so a lost executor
    costs a re-read, and gives later joins a plain scan on both sides (the
    shape AQE can split when one key is hot)."""

    return staged_copy(df, name)


def partitions(spark: SparkSession) -> int:
    """Width of the session's shuffles; ranges and buckets follow it."""

    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def id_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most ``n`` ascending values of ``key`` that cut it into ranges of
    about equal row counts; each is a value of the column and the last is its
    maximum.  ``n`` numbers reach the driver, whatever the table's size."""

    shares = ",".join(f"{i / n!r}D" for i in range(1, n + 1))
    row = df.agg(
        F.expr(f"percentile_approx(`{key}`, array({shares}), {20 * n + 1000})").alias("q"), F.max(F.col(f"`{key}`")).alias("m")
    ).first()
    return sorted({*(row.q or []), row.m} - {None})


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range that holds ``key`` (nulls: 0): the count of bounds
    below it, found by halving."""

    def halve(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= F.lit(bounds[mid]), halve(lo, mid)).otherwise(halve(mid + 1, hi))

    if not bounds:
        return F.lit(0)
    return F.when(key.isNull(), F.lit(0)).otherwise(halve(0, len(bounds) - 1))


# --- words and shingles ------------------------------------------------------

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BYTE_OTHER = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # a second hash, for 128 bits
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 19
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit words."""

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        m = 1 << max(20, (n - 1).bit_length())
        full = np.full(m, _BASE, np.uint64)
        full[0] = 1
        _POW = np.cumprod(full)
        full = np.full(m, pow(_BASE, -1, 1 << 64), np.uint64)
        full[0] = 1
        _INV = np.cumprod(full)
    return _POW, _INV


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, end to end, and their offsets (null: empty)."""

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every run of bytes that are not ``space``, within
    the texts that ``off`` delimits, in order."""

    solid = ~space[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[off] = True
    before = np.empty(len(buf), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.empty(len(buf), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    return starts, np.flatnonzero(solid & (~after | first[1:])) + 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, *tables: np.ndarray) -> list[np.ndarray]:
    """For each table of byte values, a 64-bit hash of every span (ascending
    and apart).

    Polynomial hashes come from prefix sums over blocks of bytes, so the work
    per byte is a few vectorised operations and memory is bounded by a block
    (or by one span, if that is longer)."""

    out = [np.empty(len(starts), np.uint64) for _ in tables]
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + _BLOCK, "right")))
        part = buf[at : ends[j - 1]]
        power, inverse = _powers(len(part) + 1)
        s, e = starts[i:j] - at, ends[i:j] - at
        sums = np.zeros(len(part) + 1, np.uint64)
        for k, table in enumerate(tables):
            np.cumsum(table[part] * power[: len(part)], out=sums[1:])
            out[k][i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def words(buf: np.ndarray, off: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` in order, and the
    index of the first word of each text (one more entry than texts)."""

    if not len(buf):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    starts, ends = word_spans(buf, off)
    return span_hashes(buf, starts, ends, _BYTE_LOWER if lower else _BYTE)[0], np.searchsorted(starts, off)


def shingles(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows in order, and the index of the first
    window of each text.  A text with 1 to k-1 words has its whole sequence as
    one window; a text without words has none."""

    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    first = np.zeros(len(at), np.int64)
    np.cumsum(count, out=first[1:])
    text = np.repeat(np.arange(len(n)), count)
    start = at[:-1][text] + (np.arange(first[-1]) - first[:-1][text])
    out = np.zeros(first[-1], np.uint64)
    length = np.minimum(n, k)[text]
    for j in range(k):
        inside = j < length
        nxt = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j + 1))
        nxt += hashes[np.minimum(start + j, max(len(hashes) - 1, 0))] if len(hashes) else np.uint64(0)
        out = np.where(inside, nxt, out)
    return mix(out + length.astype(np.uint64)), first


def text_batches(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts hold about ``most`` bytes at most (a longer
    text stands alone): first row, end row, bytes, offsets."""

    buf, off = text_buffer(batch.column(column))
    i, rows = 0, len(off) - 1
    while i < rows:
        j = min(rows, max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1))
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


# --- connected components ----------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that the undirected ``edges`` (a, b) of
    64-bit ids reach from each node that has an edge.

    Least labels spread along edges and labels jump to their label's label;
    each round is staged, so every join has plain scans on both sides (AQE can
    split a hub) and nothing of the graph reaches the driver but a count of
    changed labels."""

    both = stage(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a is not null and b is not null").distinct(),
        "edges",
    )
    label = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "labels")
    while True:
        near = (
            both.join(label.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hooked = stage(label.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = stage(hooked.join(up, "root").select("node", "old", F.least("root", "up").alias("root")), "jumped")
        label = jumped.select("node", "root")
        if not jumped.filter("root <> old").limit(1).count():
            return label
