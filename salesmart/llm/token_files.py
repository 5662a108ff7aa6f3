"""Token-ID files in Simple-8b (operator 8).

Documents are cut into contiguous ranges of ``doc_id`` (the bounds are as many
numbers as the shuffle has partitions), each range is sorted and written as
one shard.  A shard is a sequence of segments; a segment is a row of a Parquet
file whose binary column ``words`` holds the packed ids, so Spark's commit
protocol covers the files: a task that is retried replaces its own file.

Segment: ``shard`` and ``first`` (ids of the shard before it), ``doc_ids``,
``lengths`` (ids of each document), ``n_ids``, ``offsets`` (little-endian
uint32: index in ``words`` of the first word of every block of BLOCK ids) and
``words`` (little-endian uint64).  A word's top four bits select how many ids
it holds (COUNTS) and how wide they are (WIDTHS), lowest id first; selector
ESCAPE says that the next word is one id of up to 64 bits.  Each block starts a
new word, so blocks decode on their own and many at once.

Defined cases: a null or empty text is its end id alone; null doc_ids come
first; rows of the same doc_id are ordered by text; an empty table gives no
rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.bpe import RUN, encoder, read_spec
from salesmart.llm.common import id_bounds, partitions, range_of, text_batches

BLOCK = 1024
# Fixed values of Simple-8b: ids a word and bits an id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 14

SEGMENT = "shard int, first long, doc_ids array<long>, lengths array<int>, n_ids long, offsets binary, words binary"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and the index of each block's first word.

    The widest fitting selector is found for every position at once; the
    blocks then step from word to word side by side."""

    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    blocks = np.arange(0, n, BLOCK)
    left = (BLOCK - np.arange(n) % BLOCK).astype(np.int16)
    choice = np.full(n, ESCAPE, np.int8)
    for s in range(len(COUNTS) - 1, -1, -1):
        c, wide = int(COUNTS[s]), np.zeros(n + 1, np.int32)
        np.cumsum(ids >= np.uint64(1 << int(WIDTHS[s])), out=wide[1:])
        if n < c or n - wide[-1] < c:
            if wide[-1] == n:
                break
            continue
        choice[: n - c + 1][(wide[c:] == wide[: n - c + 1]) & (left[: n - c + 1] >= c)] = s
    step = np.append(COUNTS, 1)[choice]
    at, ends, taken = blocks.copy(), np.minimum(blocks + BLOCK, n), []
    alive = np.arange(len(blocks))
    while len(alive):
        taken.append(at[alive])
        at[alive] += step[at[alive]]
        alive = alive[at[alive] < ends[alive]]
    heads = np.sort(np.concatenate(taken))
    chosen = choice[heads]
    place = np.zeros(len(heads) + 1, np.int64)
    np.cumsum(1 + (chosen == ESCAPE), out=place[1:])
    out = np.zeros(place[-1], np.uint64)
    for s in range(len(COUNTS)):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            word = np.full(len(rows), s << 60, np.uint64)
            for k in range(COUNTS[s]):
                word |= ids[heads[rows] + k] << np.uint64(k * WIDTHS[s])
            out[place[rows]] = word
    rows = np.flatnonzero(chosen == ESCAPE)
    out[place[rows]] = np.uint64(ESCAPE << 60)
    out[place[rows] + 1] = ids[heads[rows]]
    return out, place[np.searchsorted(heads, blocks)].astype(np.uint32)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ids of the words: blocks step over the words side by side (so that
    a raw word after an escape is not taken for a selector), then each
    selector's words are spread at once."""

    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == ESCAPE).any():
        is_word = np.zeros(len(words), bool)
        at, ends = offsets.astype(np.int64), np.append(offsets[1:], len(words)).astype(np.int64)
        alive = np.arange(len(at))
        while len(alive):
            is_word[at[alive]] = True
            at[alive] += 1 + (selector[at[alive]] == ESCAPE)
            alive = alive[at[alive] < ends[alive]]
        heads = np.flatnonzero(is_word)
    else:
        heads = np.arange(len(words))
    chosen = selector[heads]
    to = np.zeros(len(heads) + 1, np.int64)
    np.cumsum(np.append(COUNTS, 1)[chosen], out=to[1:])
    for s in range(len(COUNTS)):
        rows = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(COUNTS[s] if len(rows) else 0):
            out[to[rows] + k] = (words[heads[rows]] >> np.uint64(k * WIDTHS[s])) & mask
    rows = np.flatnonzero(chosen == ESCAPE)
    out[to[rows]] = words[heads[rows] + 1]
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> str:
    """Encode ``docs`` (doc_id, text), end each document with ``end_id`` and
    write the shards under ``path`` in ascending doc_id order."""

    spark = docs.sparkSession
    spec = read_spec(tokenizer)
    docs = docs.select("doc_id", "text")
    bounds = id_bounds(docs, "doc_id", partitions(spark))
    shards = max(1, len(bounds))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, first = encoder(spec), 0
        for batch in batches:
            for i, j, buf, off in text_batches(batch, "text", 2 * RUN):
                rows = batch.slice(i, j - i)
                flat, counts = bpe.encode_buffer(buf, off)
                ids = np.insert(flat, np.cumsum(counts), end_id)
                words, offsets = pack(ids)
                row = {
                    "shard": [rows.column("shard")[0].as_py()],
                    "first": [first],
                    "doc_ids": [rows.column("doc_id").to_pylist()],
                    "lengths": [(counts + 1).tolist()],
                    "n_ids": [len(ids)],
                    "offsets": [offsets.astype("<u4").tobytes()],
                    "words": [words.astype("<u8").tobytes()],
                }
                first += len(ids)
                yield pa.RecordBatch.from_pydict(
                    row,
                    pa.schema([("shard", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("offsets", pa.binary()), ("words", pa.binary())]),
                )

    (
        docs.withColumn("shard", range_of(F.col("doc_id"), bounds).cast("int"))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .mapInArrow(run, SEGMENT)
        .write.parquet(path)
    )
    return path


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of
    the ids as little-endian uint32) and, if asked for, the ids."""

    segments = spark.read.schema(SEGMENT).parquet(path)
    # one row a shard, so the running sum over shards is small whatever the corpus
    base = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base")
    )
    extra = [("ids", pa.list_(pa.int64()))] if ids else []
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                found = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4"), row["n_ids"])
                raw = found.astype("<u4")
                at = np.zeros(len(row["lengths"]) + 1, np.int64)
                np.cumsum(row["lengths"], out=at[1:])
                columns = {
                    "shard": [row["shard"]] * len(row["doc_ids"]),
                    "doc_id": row["doc_ids"],
                    "at": row["first"] + at[:-1],
                    "n_tokens": np.diff(at),
                    "ids_crc32": [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)],
                }
                if ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found.astype(np.int64)))
                yield pa.RecordBatch.from_pydict(columns, schema)

    read = segments.mapInArrow(run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
    return read.join(base, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)
