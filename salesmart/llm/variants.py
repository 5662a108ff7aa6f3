"""Spelling variant grouping (operator 13).

Words are maximal runs of letters ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z in lower
case; a fixed share of (document, run) pairs, chosen by a hash, loses one code
point.  Two words are near if one edit (a code point inserted, deleted or
replaced) turns one into the other.

1. ``count_words``  a task counts its documents' words (at most ``HELD`` at a
   time) and Spark adds the counts up.
2. Groups.  For a pair whose longer word has ``m`` code points, common prefix
   plus common suffix reach ``m - 1``: whatever ``hole`` of the word is left
   open, they share the part before it and its first half, or its second half
   and the part after it.  Beginning with the whole word as hole, words are
   posted under (m, part before, part after) for both halves, as words of
   length ``m`` and, for their longer neighbours, of ``m - 1``.  A group of more
   than ``TILE`` words is posted again with holes of half the length, so a very
   common beginning or ending is split until groups fit; with a hole of one
   code point a group cannot exceed the alphabet.  A word goes to two halves a
   round, and rounds are at most the logarithm of the longest word.
3. Dense tiling.  The words of many groups are laid into two padded code-point
   matrices, one flush left and one flush right.  Blocks of rows are compared
   with the blocks ``d`` rows below, for all ``d`` inside a group: the first
   unequal column is the length of the common prefix or suffix, and a pair is a
   single edit if their sum reaches the longer length minus one.  A pair meets
   in several groups but is returned by one: that of the half its first
   difference lies in.
4. A word's form is the near word of largest count (ties: the least), if that
   is ``RATIO`` times its own at least; roots follow the forms by pointer
   jumping over the words that have one.

Only words, never texts, are shuffled.  No pair but a near one leaves a task, and
a word has at most ``alphabet * (2 * length + 1)`` near words.

Defined cases: null and empty texts have no words; a null doc_id is written
``null`` in what is hashed; every row counts, repeated ones too; other columns
are ignored; without words there are no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import partitions, stage

LEAST_LENGTH, LEAST_COUNT, RATIO, ONE_IN = 6, 5, 5, 199
HELD = 400_000
TILE = 128  # more than the letters of the alphabet and one word more
_CELLS = 4 << 20

# the letters of a run, A-Z in lower case; any other byte of Latin-1 ends it
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_KEY = ("m", "i", "j", "around")


def runs(text: str) -> list[bytes]:
    """The lower-cased runs of a text, in Latin-1 (a byte a code point)."""

    return text.encode("latin-1", "replace").translate(_TABLE).split()


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text)."""

    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w.decode("latin-1"), n) for w, n in total.items()]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py()
                if not text:
                    continue
                doc_id = doc_id.as_py()
                begun = zlib.crc32(b"null:" if doc_id is None else b"%d:" % doc_id)
                for w, n in Counter([w for w in runs(text) if len(w) >= least_length]).items():
                    h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), begun)
                    if h % one_in == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1 :]
                        if len(w) < least_length:
                            continue
                    total[w] += n
                if len(total) > HELD:
                    yield flush()
        if total:
            yield flush()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row (m, i, j, word, n), whose hole is what ``i`` code points before
    and ``j`` after leave of ``m``, under both halves of the hole."""

    hole = F.col("m") - F.col("i") - F.col("j")
    first = F.ceil(hole / 2).cast("int")
    both = F.array(F.struct((F.col("i") + first).alias("i"), F.col("j").alias("j")), F.struct(F.col("i").alias("i"), (F.col("j") + hole - first).alias("j")))
    rows = rows.select("m", F.explode(both).alias("at"), "word", "n").select("m", "at.i", "at.j", "word", "n")
    return rows.withColumn("around", F.concat(F.expr("left(word, i)"), F.expr("right(word, j)")))


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of rows sorted by group."""

    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def compare(rows: pa.Table) -> pa.RecordBatch:
        words, counts = rows.column("word").combine_chunks(), rows.column("n").to_numpy()
        m, i, j = (rows.column(c).to_numpy() for c in ("m", "i", "j"))
        raw = [w.encode("latin-1") for w in words.to_pylist()]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        width = int(length.max())
        left, right = np.zeros((2, len(raw), width), np.uint8)
        flat, column = np.frombuffer(b"".join(raw), np.uint8), np.arange(width)
        left[column < length[:, None]] = flat
        right[column >= width - length[:, None]] = flat
        right = right[:, ::-1]
        group = _group_numbers(rows)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for d in range(1, int(np.bincount(group).max())):
            a = np.flatnonzero(group[d:] == group[:-d])
            b = a + d
            prefix, suffix = (left[a] != left[b]).argmax(axis=1), (right[a] != right[b]).argmax(axis=1)
            near = (np.maximum(length[a], length[b]) == m[a]) & (prefix + suffix >= m[a] - 1) & (prefix < m[a] - j[a])
            found.append((a[near], b[near]))
        a, b = (np.concatenate([f[k] for f in found] + [np.zeros(0, np.int64)]) for k in (0, 1))
        x, y = np.append(a, b), np.append(b, a)
        return pa.RecordBatch.from_arrays([words.take(pa.array(x)), words.take(pa.array(y)), pa.array(counts[y], pa.int64())], schema=schema)

    waiting: pa.Table | None = None
    for batch in batches:
        waiting = pa.Table.from_batches([*(waiting.to_batches() if waiting is not None else []), batch])
        while waiting.num_rows > 1:
            group = _group_numbers(waiting)
            most = max(2 * TILE, _CELLS // int(waiting.column("m").to_numpy()[: _CELLS].max()))
            end = int(np.searchsorted(group, group[min(most, len(group) - 1)]))  # whole groups; the last may go on
            if not end:
                break
            yield compare(waiting.slice(0, end))
            waiting = waiting.slice(end)
    if waiting is not None and waiting.num_rows > 1:
        yield compare(waiting)


def _group_numbers(rows: pa.Table) -> np.ndarray:
    """Numbers, from 0 and ascending, of the groups of sorted rows."""

    new = np.zeros(rows.num_rows, bool)
    for c in _KEY[:3]:
        v = rows.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    v = rows.column("around").combine_chunks().dictionary_encode().indices.to_numpy()
    new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n) of every two near words, both ways, from (word, n)."""

    n = partitions(vocabulary.sparkSession)
    length = F.char_length("word")
    zero = F.lit(0)
    whole = vocabulary.select(F.explode(F.array(length, length + 1)).alias("m"), zero.alias("i"), zero.alias("j"), "word", "n")
    pairs = None
    while True:
        posted = stage(_halved(whole), "variant-groups")
        sizes = stage(posted.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "variant-sizes")
        # plain scans on both sides: AQE splits a group that holds much of the words
        posted = stage(posted.join(sizes, list(_KEY)), "variant-members")
        one = F.col("m") - F.col("i") - F.col("j") == 1
        fits = posted.filter((F.col("members") <= TILE) | one).drop("members")
        found = fits.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "word").mapInArrow(_tiled, "word string, near string, near_n long")
        pairs = found if pairs is None else pairs.unionByName(found)
        whole = posted.filter((F.col("members") > TILE) & ~one).drop("members", "around")
        if whole.isEmpty():
            return pairs


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each word's chain of forms."""

    now = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stage(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now


def group_variants(docs: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``docs``."""

    vocabulary = stage(count_words(docs, **options), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = stage(near_words(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "variant-near")
    has = -F.col("best.less") >= ratio * F.col("n")
    named = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")
    )
    named = stage(named, "variant-forms")
    ends = roots(named.filter("form is not null"))
    return named.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
