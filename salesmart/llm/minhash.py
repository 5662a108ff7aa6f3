"""MinHash document fingerprints (operator 5).

A text's set is its distinct five-word shingles (fewer words: the whole
sequence as one).  ``PERMUTATIONS`` universal hash functions (multiply-add,
high half) are applied to all shingles of a run of texts at once in numpy; the
minima, cut to 16 bits, are the signature.  Two signatures' likeness, the share
of equal positions, estimates the sets' Jaccard similarity.

``near_duplicates`` joins signatures by bands: texts that share a band form
candidate groups (found by least labels over (band, text) rows, never as
pairs), and inside blocks of a group the Jaccard similarity of the full sets
is verified; one text stands for all its exact copies (a class whose doc_ids
are all null takes no part).  ``fingerprint_with_next`` gives both per document.

Defined cases: null texts are empty; texts without words have the signature of
all ones (equal to each other, in no group); rows of the same doc_id are
ordered by text; null doc_ids come last in descending order; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import components, id_bounds, mix, partitions, range_of, shingles, stage, text_batches, text_buffer, words
from salesmart.llm.ngram_join import class_id, connecting_links, least_of_components, needed

PERMUTATIONS, BANDS, SHINGLE = 128, 32, 5
_RNG = np.random.default_rng(5)
_A = _RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_RUN = 1 << 20


def signatures(texts: list[str], full: bool = False) -> np.ndarray:
    """PERMUTATIONS 16-bit minima of each text (``full``: all 32 bits)."""

    buf, off = text_buffer(pa.array(texts, pa.large_string()))
    return _signatures(buf, off, full)


def _signatures(buf: np.ndarray, off: np.ndarray, full: bool = False) -> np.ndarray:
    out = np.full((len(off) - 1, PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + _RUN, "right")) - 1)
        hashes, at = words(buf[off[i] : off[j]], off[i : j + 1] - off[i], lower=False)
        sh, first = shingles(hashes, at, SHINGLE)
        has = np.flatnonzero(np.diff(first))
        # a long text's shingles are folded in slices, so memory is bounded
        for a in range(0, len(sh), 1 << 18):
            part = sh[a : a + (1 << 18)]
            rows = has[(first[has + 1] > a) & (first[has] < a + len(part))]
            starts = np.maximum(first[rows] - a, 0)
            for p in range(PERMUTATIONS):
                h = part * _A[p]
                h += _B[p]
                h >>= np.uint64(32)
                low = np.minimum.reduceat(h, starts).astype(np.uint32)
                out[i + rows, p] = np.minimum(out[i + rows, p], low)
        i = j
    return out if full else (out & 0xFFFF).astype(np.uint16)


def hexed(sig: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in sig.astype(">u2")]


def likeness(a: Column, b: Column) -> Column:
    """Share of equal positions of two signatures (arrays of one length)."""

    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def _set_ids(buf: np.ndarray, off: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Sorted distinct shingles of each text, and their hashes (the texts' classes)."""

    sh, first = shingles(*words(buf, off, lower=False), SHINGLE)
    sets = [np.unique(sh[first[r] : first[r + 1]]) for r in range(len(off) - 1)]
    return sets, [class_id(s) for s in sets]


def _near_classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, id, n) of each document, its class and set size, and (id,
    component) of each class with words: the least doc_id of its group."""

    spark = docs.sparkSession
    n = partitions(spark)
    docs = docs.select("doc_id", "text")
    size = PERMUTATIONS // BANDS

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in text_batches(batch, "text"):
                sets, ids = _set_ids(buf, off)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id").slice(i, j - i).cast(pa.int64()), "id": pa.array(ids, pa.int64()), "n": pa.array([len(s) for s in sets], pa.int32())}
                )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in text_batches(batch, "text"):
                sets, ids = _set_ids(buf, off)
                has = np.array([len(s) > 0 for s in sets], bool)
                sig = _signatures(buf, off, full=True).astype(np.uint64).reshape(j - i, BANDS, size)[has]
                band = np.zeros(sig.shape[:2], np.uint64)
                for k in range(size):
                    band = mix(band * np.uint64(31) + sig[:, :, k])
                band = mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_pydict({"token": pa.array(band.ravel()), "b": pa.array(np.repeat(np.array(ids, np.int64)[has], BANDS))})

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by token and class, the distinct ones of tokens that
        several classes hold."""

        token = first = last = None  # the last row's token, its least class, and the last class
        for batch in batches:
            t, c = batch.column("token").to_numpy(), batch.column("b").to_numpy()
            if not len(t):
                continue
            if token is not None:  # what is known of the last token stands before the batch
                t, c = np.append(np.int64(token), t), np.append(np.int64(last), c)
            heads = np.append(True, t[1:] != t[:-1])
            new = np.append(False, c[1:] != c[:-1]) & ~heads
            least = c[np.maximum.accumulate(np.where(heads, np.arange(len(t)), 0))]
            if token is not None:
                least[: int(np.append(np.flatnonzero(heads[1:]) + 1, len(t))[0])] = first
            # each class after the least, and the least itself before the first of them
            second = new & np.append(False, c[:-1] == least[:-1])
            yield pa.RecordBatch.from_pydict({"token": np.append(t[second], t[new]), "b": np.append(least[second], c[new])})
            token, first, last = t[-1], least[-1], c[-1]

    named = stage(docs.mapInArrow(name, "doc_id long, id long, n int"), "shingle-classes")
    classes = stage(named.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("least")), "signature-classes")
    posted = docs.select("text").mapInArrow(post, "token long, b long").repartition(n, "token").sortWithinPartitions("token", "b")
    posted = stage(posted.mapInArrow(shared, "token long, b long"), "shared-bands")

    def payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in text_batches(batch, "text"):
                sets, ids = _set_ids(buf, off)
                sizes = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int32()),
                        "tokens": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                        "l": pa.array(np.ones(len(sets), np.int32)), "most": pa.array((sizes - needed(sizes, percent) + 1).astype(np.int32)),
                    }
                )

    near = posted.select(F.col("b").alias("id")).distinct()
    # one text of each class that shares a band brings its full set
    chosen = stage(classes.join(near, "id", "left_semi").filter("least is not null").select(F.col("least").alias("_id")), "candidates")
    texts = docs.join(chosen, F.col("doc_id") == F.col("_id"), "left_semi").select("text")
    held = texts.mapInArrow(payload, "id long, n int, tokens array<long>, l int, most int").dropDuplicates(["id"])
    held = stage(held, "candidate-sets")
    roots = components(connecting_links(held, posted, n, percent))
    return named, stage(least_of_components(classes, roots), "near-classes")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and near_id (the least doc_id of its group) of each
    document: groups are the components of the links ``100 * |A & B| >= percent
    * |A | B|`` among texts that share a band of their signatures.

    Bands miss a pair at the similarity s with probability
    ``(1 - s ** 4) ** 32`` (5e-8 at 0.8, less above)."""

    named, near = _near_classes(docs, percent)
    return named.join(near.withColumnRenamed("id", "_id"), (F.col("id") == F.col("_id")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("near_id")
    )


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles long, near_id long"


def fingerprint_with_next(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per document its fingerprint, that of its edited text (the last third
    replaced by the beginning of the next document in descending doc_id, the
    first after the last), the likeness to that and to the next document, and
    n_shingles and near_id as of ``near_duplicates``.

    Documents are cut into ranges of doc_id.  The bounds are doc_ids, so the
    first document of each range is known beforehand; it is sent along to the
    range before it as well, and each range is one sorted stream.  Small
    rows with the near_id of a document's class stand before its text in it."""

    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    named, near = _near_classes(docs, percent)
    named = stage(named.filter("n > 0").select("doc_id", "id").distinct().join(near, "id"), "near-ids")
    bounds = id_bounds(docs, "doc_id", partitions(spark))
    n = max(1, len(bounds))
    own = range_of(F.col("doc_id"), bounds)
    # the range above takes this range's greatest doc_id as its follower; the lowest range takes the greatest of all
    heads = docs.filter(F.col("doc_id").isin(bounds)) if bounds else docs.limit(0)
    follows = F.pmod(range_of(F.col("doc_id"), bounds) + 1, F.lit(n))
    none = F.lit(None).cast("long")
    rows = docs.select(own.cast("int").alias("at"), F.lit(0).alias("extra"), "doc_id", "text", none.alias("id"), none.alias("component")).union(
        heads.select(follows.cast("int").alias("at"), F.lit(1).alias("extra"), "doc_id", "text", none, none)
    )
    rows = rows.union(named.select(own.cast("int").alias("at"), F.lit(0).alias("extra"), "doc_id", F.lit(None).cast("string"), "id", "component"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last own row, whose next document is still to come
        start: tuple | None = None
        done = False
        near: dict[tuple, int | None] = {}  # near_id by doc_id and class

        def emit(ids: list, texts: list[str], sig: np.ndarray) -> pa.RecordBatch:
            """Rows for all but the last of ``texts``."""

            sets, classes = _set_ids(*text_buffer(pa.array(texts[:-1], pa.large_string())))
            edited = []
            for t, nxt in zip(texts, texts[1:], strict=False):
                k = len(t) // 3
                edited.append(t[: len(t) - k] + nxt[:k])
            changed = signatures(edited)
            mine, after = sig[:-1], sig[1:]
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids[:-1], pa.int64()),
                    "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
                    "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                    "fingerprint": hexed(mine),
                    "edited_fingerprint": hexed(changed),
                    "near_edited": (mine == changed).mean(axis=1),
                    "near_next": (mine == after).mean(axis=1),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "near_id": pa.array([near[d, c] if len(s) else d for d, c, s in zip(ids, classes, sets, strict=False)], pa.int64()),
                }
            )

        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                if done:
                    break
                rows = batch.slice(a, 500)
                small = rows.filter(rows.column("id").is_valid())
                for d, c, x in zip(*(small.column(k).to_pylist() for k in ("doc_id", "id", "component")), strict=True):
                    near[d, c] = x
                rows = rows.filter(rows.column("id").is_null())
                if not rows.num_rows:
                    continue
                ids, texts = rows.column("doc_id").to_pylist(), [t or "" for t in rows.column("text").to_pylist()]
                extra = rows.column("extra").to_pylist()
                if 1 in extra:  # what follows the range; its copies are not needed
                    cut = extra.index(1)
                    ids, texts, done = ids[: cut + 1], texts[: cut + 1], True
                    if held is None and cut == 0:
                        break
                sig = signatures(texts)
                if held is not None:
                    ids, texts, sig = [held[0], *ids], [held[1], *texts], np.vstack([held[2], sig])
                elif start is None:
                    start = (ids[0], texts[0], sig[0])
                if len(ids) > 1:
                    yield emit(ids, texts, sig)
                held = (ids[-1], texts[-1], sig[-1])
                if ids[0] != ids[-1] and len(near) > 1000:  # those of the doc_ids before are used up
                    near = {k: x for k, x in near.items() if k[0] == ids[-1] or k[0] is None or (ids[-1] is not None and k[0] < ids[-1])}
        if held is not None and not done:  # no doc_id at all: the stream is the table, and its first row follows its last
            yield emit([held[0], start[0]], [held[1], start[1]], np.vstack([held[2], start[2]]))

    order = [F.col("extra"), F.col("doc_id").desc_nulls_last(), F.col("id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    return rows.repartitionById(n, F.col("at")).sortWithinPartitions(*order).mapInArrow(run, RESULT)
