"""N-gram Jaccard self-join with adaptive multi-match prefixes (operator 6).

A document's set is its distinct four-word shingles (ASCII letters in lower
case; with fewer words the whole sequence as one; none without words), as
64-bit hashes.  Documents link when ``100 * |A & B| >= PERCENT * |A | B|``.
Documents with equal sets are one class from the start; the join is between
classes and yields the connected components of the links.

1. ``_classes``  one pass gives each document's class and set size, and the
   shingles that are very common within a batch (candidates for the common list).
2. ``_ordered``  a second pass sends every shingle, in binary blocks, to its
   hash range, where its classes are counted; shingles of two or more classes
   go on, with that count, to their classes' hash range.  Shingles on the
   common list (those in more than a fixed share of all documents: their
   number is bounded by mean set size / share) skip the first step: their
   holders are not gathered anywhere.  In the class range each class's shared shingles are ordered by (count,
   hash), unshared ones before all; a class whose shared shingles are too few
   to reach the similarity ends here, which is almost all of them.
3. Prefixes.  With the order above, linked classes share ``l`` shingles within
   their prefixes of ``size - ceil(PERCENT % of size) + l``.  Each class picks the ``l`` of least
   estimated cost: a longer prefix meets more holders, but more of them have to
   coincide before a pair is verified.  A pair must share the smaller ``l``.
4. Classes whose shortest prefixes meet, directly or over others, form a
   candidate group (components of (shingle, class) rows, not of pairs).  Groups
   are dealt to tasks whole; a large one in pairs of blocks of ``BLOCK``
   classes.  A task counts coinciding prefix shingles, verifies on all shared
   shingles, skips pairs already connected and returns only the links that
   connect: at most one fewer than its classes.
5. Components of those links, and the least doc_id of each.

Defined cases: null and empty texts have the empty set and link with nothing
(component: their own doc_id); null doc_ids name no component (null if all
are); rows of one doc_id with different texts belong to their texts' classes;
other columns are ignored; an empty table gives no rows.  ``representatives``
keeps one row of each component, whatever the doc_ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import components, mix, partitions, shingles, stage, text_batches, words

SHINGLE, PERCENT = 4, 85
#: A shingle in more than this share of the documents is common; below AT_LEAST of them it never is.
COMMON, AT_LEAST = 0.002, 64
LONGEST, BLOCK = 8, 2048
_FLUSH = 2_000_000


def needed(n: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    """Least overlap of a set of ``n`` with any set it links to."""

    return (percent * n + 99) // 100


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sorted distinct shingles of runs of rows."""

    for i, j, buf, off in text_batches(batch, "text"):
        sh, first = shingles(*words(buf, off, lower=True), SHINGLE)
        yield i, [np.unique(sh[first[r] : first[r + 1]]) for r in range(j - i)]


def class_id(s: np.ndarray) -> int:
    """64-bit hash of a set."""

    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(s ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _classes(docs: DataFrame) -> DataFrame:
    """(kind 0, doc_id, row, class, set size) per document and (kind 1, null,
    null, shingle, holders) for shingles common within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("n", pa.int32())])
        for batch in batches:
            ids, sizes, own = [], [], {}
            for _, sets in _sets(batch):
                for s in sets:
                    ids.append(class_id(s))
                    sizes.append(len(s))
                    own[ids[-1]] = s
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(ids), pa.int32()), batch.column("doc_id").cast(pa.int64()), batch.column("row"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32())], schema=schema
            )
            found, count = np.unique(np.concatenate([*own.values(), np.zeros(0, np.uint64)]), return_counts=True)
            top = count >= max(16, COMMON * len(own))
            if top.any():
                none = pa.nulls(int(top.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(top.sum(), np.int32)), none, none, pa.array(found[top].view(np.int64)), pa.array(count[top].astype(np.int32))], schema=schema)

    return docs.select("doc_id", "text", row_hash(docs).alias("row")).mapInArrow(run, "kind int, doc_id long, row long, id long, n int")


def row_hash(docs: DataFrame) -> Column:
    """64-bit hash of a row: rows agree in it that agree in every column
    (maps, which have no hash, aside)."""

    names = [f"`{f.name}`" for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*names, *[F.col(c).isNull() for c in names])  # a null alone would leave no trace in the hash


def _at(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash range, of ``n``, of 64-bit hashes."""

    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


_BLOCKS = "at int, kind int, a binary, b binary, c binary"
_BLOCK_SCHEMA = pa.schema([("at", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
# kinds of block: 0 = shingles c of the classes a, b of them each; 1 = (class a, count b, shingle c); 2 = (class a, set size b)
HELD, SHARED, SIZE = 0, 1, 2


def _block(at: int, kind: int, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    values = [[at], [kind], [a.tobytes()], [b.astype(np.int32).tobytes()], [c.tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _BLOCK_SCHEMA, strict=True)], schema=_BLOCK_SCHEMA)


def _dealt(cls: np.ndarray, b: np.ndarray, c: np.ndarray, kind: int, n: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows by their class's range."""

    at = _at(mix(cls), n)
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(n + 1))
    for r in np.flatnonzero(np.diff(cuts)):
        rows = order[cuts[r] : cuts[r + 1]]
        yield _block(int(r), kind, cls[rows], b[rows], c[rows] if len(c) else c)


def _ordered(docs: DataFrame, common: dict[int, int], n: int) -> DataFrame:
    """id, n (set size), tokens and counts (its shared shingles in order),
    l, first and most (shared shingles in the prefixes for 1 and for l)."""

    listed = np.array(sorted(common), np.int64).view(np.uint64)
    listed_order = np.argsort(listed)
    listed = listed[listed_order]
    holders = np.array([common[k] for k in sorted(common)], np.int32)[listed_order]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        cls: list[int] = []
        sets: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            size = np.array([len(s) for s in sets], np.int64)
            own, tokens = np.repeat(np.array(cls, np.int64).view(np.uint64), size), np.concatenate(sets)
            yield from _dealt(np.array(cls, np.int64).view(np.uint64), size, np.zeros(0, np.uint64), SIZE, n)
            if len(listed):
                place = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
                known = listed[place] == tokens
                yield from _dealt(own[known], holders[place[known]], tokens[known], SHARED, n)
                own, tokens = own[~known], tokens[~known]
            at = _at(tokens, n)
            order = np.argsort(at, kind="stable")  # within a range still by class
            own, tokens = own[order], tokens[order]
            cuts = np.searchsorted(at[order], np.arange(n + 1))
            for r in np.flatnonzero(np.diff(cuts)):
                o, t = own[cuts[r] : cuts[r + 1]], tokens[cuts[r] : cuts[r + 1]]
                heads = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
                yield _block(int(r), HELD, o[heads], np.diff(np.append(heads, len(o))), t)

        for batch in batches:
            for _, found in _sets(batch):
                for s in found:
                    if not len(s) or (c := class_id(s)) in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(c)
                    cls.append(c)
                    sets.append(s)
                    held += len(s)
                if held >= _FLUSH:
                    yield from flush()
                    cls, sets, held = [], [], 0
        if sets:
            yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, own = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            yield batch.filter(pa.array(kinds != HELD))
            for i in np.flatnonzero(kinds == HELD):
                a, b, c = (batch.column(k)[int(i)].as_buffer() for k in "abc")
                own.append(np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(b, np.int32)))
                tokens.append(np.frombuffer(c, np.uint64))
        t, o = np.concatenate(tokens), np.concatenate(own)
        tokens, own = [], []
        order = np.lexsort((o, t))
        t, o = t[order], o[order]
        new = np.append(True, (t[1:] != t[:-1]) | (o[1:] != o[:-1]))[: len(t)]
        t, o = t[new], o[new]
        heads = np.flatnonzero(np.append(True, t[1:] != t[:-1])[: len(t)])
        number = np.diff(np.append(heads, len(t)))
        number = np.repeat(number, number)
        yield from _dealt(o[number > 1], number[number > 1], t[number > 1], SHARED, n)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {SHARED: [], SIZE: []}
        for batch in batches:
            for i in range(batch.num_rows):
                a, b, c = (batch.column(k)[i].as_buffer() for k in "abc")
                parts[batch.column("kind")[i].as_py()].append((np.frombuffer(a, np.uint64), np.frombuffer(b, np.int32), np.frombuffer(c, np.uint64)))
        if not parts[SIZE] or not parts[SHARED]:
            return
        ids, at = np.unique(np.concatenate([p[0] for p in parts[SIZE]]), return_index=True)
        size = np.concatenate([p[1] for p in parts[SIZE]])[at].astype(np.int64)
        cls, num, tok = (np.concatenate([p[k] for p in parts[SHARED]]) for k in range(3))
        parts.clear()
        order = np.lexsort((tok, num, cls))
        cls, num, tok = cls[order], num[order], tok[order]
        new = np.append(True, (cls[1:] != cls[:-1]) | (tok[1:] != tok[:-1]))  # a class that several tasks sent
        cls, num, tok = cls[new], num[new], tok[new]
        heads = np.append(np.flatnonzero(np.append(True, cls[1:] != cls[:-1])), len(cls))
        rows = []
        for a, b in zip(heads[:-1], heads[1:], strict=True):
            k = int(size[np.searchsorted(ids, cls[a])])
            if b - a < needed(k):
                continue
            level, first, most = _prefix(k, num[a:b])
            rows.append((int(cls[a : a + 1].view(np.int64)[0]), k, tok[a:b].view(np.int64), num[a:b], level, first, most))
            if len(rows) == 500:
                yield _record(rows)
                rows = []
        if rows:
            yield _record(rows)

    blocks = docs.select("text").mapInArrow(send, _BLOCKS).repartitionById(n, F.col("at"))
    blocks = blocks.mapInArrow(count, _BLOCKS).repartitionById(n, F.col("at"))
    return blocks.mapInArrow(finish, "id long, n int, tokens array<long>, counts array<int>, l int, first int, most int")


def _record(rows: list) -> pa.RecordBatch:
    ids, n, tokens, counts, level, first, most = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict(
        {
            "id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int32()), "tokens": pa.array(list(tokens), pa.list_(pa.int64())),
            "counts": pa.array(list(counts), pa.list_(pa.int32())), "l": pa.array(level, pa.int32()), "first": pa.array(first, pa.int32()), "most": pa.array(most, pa.int32()),
        }
    )


def _prefix(n: int, counts: np.ndarray) -> tuple[int, int, int]:
    """The ``l`` of least estimated cost, and how many shared shingles (with
    these numbers of holders) the prefixes for 1 and for ``l`` hold.

    Cost: every other holder of a prefix shingle is met; those of which ``l``
    coincide, at most the l-th part, are verified at about the set's size."""

    alone = n - len(counts)
    base = n - needed(n)
    others = np.append(0, np.cumsum(counts.astype(np.int64) - 1))
    held = lambda level: int(min(len(counts), max(0, base + level - alone)))
    levels = range(1, min(LONGEST, needed(n)) + 1)
    level = min(levels, key=lambda x: (others[held(x)] * (1 + n / 8 / x), x))
    return level, held(1), held(level)


class _Forest:
    """Disjoint sets of 0 to n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.root(b)] = self.root(a)


def links_within(ids: list[int], sizes: list[int], tokens: list[np.ndarray], levels: list[int], prefixes: list[int], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect the classes of a group: every linked pair is
    connected by them.  ``tokens``: shared shingles in the common order;
    ``prefixes``: how many of them are the prefix for ``levels``."""

    forest, holders, out = _Forest(len(ids)), {}, []
    sets = [np.sort(t) for t in tokens]
    for y in sorted(range(len(ids)), key=lambda k: sizes[k]):
        prefix = tokens[y][: prefixes[y]].tolist()
        met = [holders[t] for t in prefix if t in holders]
        if met:
            x, times = np.unique(np.concatenate([np.array(m, np.int64) for m in met]), return_counts=True)
            for k, c in sorted(zip(x.tolist(), times.tolist(), strict=True), key=lambda p: -p[1]):
                if c < min(levels[k], levels[y]) or 100 * sizes[k] < percent * sizes[y] or forest.root(k) == forest.root(y):
                    continue
                both = len(np.intersect1d(sets[k], sets[y], assume_unique=True))
                if 100 * both >= percent * (sizes[k] + sizes[y] - both):
                    forest.join(k, y)
                    out.append((ids[k], ids[y]))
        for t in prefix:
            holders.setdefault(t, []).append(y)
    return out


def connecting_links(held: DataFrame, posted: DataFrame, n: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that connect all linked classes of ``held`` (id, n, tokens,
    l, most) whose candidates share a ``token`` in ``posted`` (token, b)."""

    least = stage(posted.groupBy("token").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("token", "a"), "least-holder")
    groups = components(posted.join(least, "token").filter("a <> b").select("a", "b"))
    sizes = stage(groups.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "group-sizes")
    dealt = groups.join(sizes, "root").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(F.col("node").alias("id"), "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = held.join(dealt, "id").select("root", "i", "j", "id", "n", "tokens", "l", "most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def verified(rows: list[tuple]) -> pa.RecordBatch:
            _, ids, sizes, tokens, levels, prefixes = zip(*rows, strict=True)
            found = links_within(list(ids), list(sizes), list(tokens), list(levels), list(prefixes), percent)
            return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("root", "i", "j", "id", "n", "l", "most")}
            tokens = batch.column("tokens")
            for k in range(batch.num_rows):
                key = (cols["root"][k], cols["i"][k], cols["j"][k])
                if len(waiting) >= 2 * BLOCK and waiting[-1][0] != key:
                    yield verified(waiting)
                    waiting = []
                waiting.append((key, cols["id"][k], cols["n"][k], tokens[k].values.to_numpy(), cols["l"][k], cols["most"][k]))
        if waiting:
            yield verified(waiting)

    return rows.repartition(n, "root", "i", "j").sortWithinPartitions("root", "i", "j", "n", "id").mapInArrow(run, "a long, b long")


def least_of_components(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, component): the least doc_id of each class's component, from the
    classes (id, least) and the roots of the linked ones (node, root)."""

    linked = classes.join(roots, classes["id"] == roots["node"], "left").select("id", F.coalesce("root", "id").alias("root"), "least")
    # only linked classes are regrouped; a class without links is its own component
    least = linked.join(roots.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("component"))
    least = stage(least, "component-ids")
    both = linked.join(least.withColumn("_linked", F.lit(True)), "root", "left")
    return both.select("id", F.when(F.col("_linked"), F.col("component")).otherwise(F.col("least")).alias("component"))


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, row, id, n) of each document with its row's hash, its class and
    set size; (id, least) of each class with words; (node, root) of the linked
    classes."""

    spark = docs.sparkSession
    n = partitions(spark)
    found = stage(_classes(docs), "shingle-classes")
    each = found.filter("kind = 0").select("doc_id", "row", "id", "n")
    classes = stage(each.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("least")), "classes")
    limit = max(AT_LEAST, COMMON * classes.count())
    common = {r.id: int(r.n) for r in found.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") > limit).collect()}
    held = stage(_ordered(docs, common, n), "prefixes")
    posted = held.select(F.col("id").alias("b"), F.explode(F.slice("tokens", F.lit(1), F.col("first"))).alias("token"))
    return each, classes, components(connecting_links(held, posted, n))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each document."""

    each, classes, roots = linked_classes(docs)
    named = stage(least_of_components(classes, roots).withColumnRenamed("id", "_id"), "class-components")
    return each.join(named, (F.col("id") == F.col("_id")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: of its rows the least by
    (doc_id, nulls last; class; row hash), so the choice neither depends on
    doc_ids being unique or present nor on the order of the rows.  A row
    without words is in no component and stays.

    Classes and hashes decide; whole rows move once, in the join that keeps the
    chosen ones (a sort-merge join at any size: their number grows with the table).  Of chosen rows that are equal in every column one stays:
    only these few are grouped, after a partial aggregation."""

    each, _, roots = linked_classes(docs)
    rows = each.filter("n > 0").groupBy("id", "doc_id", "row").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id", "row", "copies")
    best = stage(rows.groupBy("id").agg(F.min(order).alias("best")), "class-rows")
    best = best.join(roots, best["id"] == roots["node"], "left").groupBy(F.coalesce("root", "id").alias("root")).agg(F.min("best").alias("best"))
    chosen = stage(best.select(F.col("best.row").alias("_chosen"), F.col("best.copies").alias("_copies")), "chosen-rows")
    hashed = docs.withColumn("_row_hash", row_hash(docs))
    wordless = F.coalesce(~F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(True))
    on = F.col("_row_hash") == F.col("_chosen")
    single = hashed.join(chosen.filter("_copies = 1").hint("merge"), on, "left").filter(F.col("_chosen").isNotNull() | wordless)
    repeated = hashed.join(chosen.filter("_copies > 1"), on, "left_semi").dropDuplicates(["_row_hash"])
    names = [f"`{c}`" for c in docs.columns]
    return single.select(*names).unionByName(repeated.select(*names))
