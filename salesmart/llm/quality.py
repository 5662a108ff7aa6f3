"""Quality classifier: naive Bayes support vectors (operator 4).

A text's features are indicators of its word n-grams (one and two words): of
the words in lower case, of their shapes (case, letters, digits, marks) and of
how each word relates to the one before (equal or not), plus how often shapes
and repeats come, in steps of powers of two.  They are hashed to
``DIMENSIONS``.  Each indicator is scaled by its class log-count ratio, the
vector brought to length one, and a linear hinge-loss model (L1 loss, L2
penalty) fitted by dual coordinate descent; its margin becomes a score between
0 and 1 by a logistic curve fitted to margins of training rows left out of the
descent.

Learning sees at most ``max_rows`` labelled rows, those of least hash of
doc_id: a documented bound, so the fit is one task whatever the corpus.  The
model (three numbers a dimension) is all that reaches the driver; every
document is scored, each whole text in one pass.

Defined cases: null and empty texts have no features and the score of the
intercept; labels that are null or other than 0 and 1 are ignored, of several
labels of a document the least counts; without labels of both classes every score is
0.5; repeated rows give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import mix

DIMENSIONS = 1 << 18
MAX_ROWS = 6_000
CACHE = 100_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SHAPE = str.maketrans({**{chr(c): "A" for c in range(65, 91)}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "0" for c in range(48, 58)}})


def _shape(word: str) -> str:
    """Case and marks of a word, runs as one."""

    if not word.isascii():
        word = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in word)
    s = word.translate(_SHAPE)
    return re.sub(r"(.)\1+", r"\1+", s)[:8]


def _distinct(a: np.ndarray) -> int:
    a = np.sort(a)
    return int((a[1:] != a[:-1]).sum()) + 1


class Featurizer:
    """Hashed features of texts; words seen before are looked up (one per task)."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.shapes: dict[str, int] = {}
        self.word_hash, self.shape_at = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64)
        self.shape_hash = np.zeros(1 << 8, np.uint64)

    def _learn(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        k, shape = len(self.words), _shape(word)
        at = self.shapes.setdefault(shape, len(self.shapes))
        if k == len(self.word_hash):
            self.word_hash, self.shape_at = np.resize(self.word_hash, 2 * k), np.resize(self.shape_at, 2 * k)
        if at == len(self.shape_hash):
            self.shape_hash = np.resize(self.shape_hash, 2 * at)
        self.words[word] = k
        self.word_hash[k], self.shape_at[k], self.shape_hash[at] = xxh64_intdigest(word.lower()), at, xxh64_intdigest(shape, 1)
        return k

    def features(self, text: str) -> np.ndarray:
        """Sorted distinct feature numbers."""

        found = _WORD.findall(text)
        if not found:
            return np.zeros(0, np.int32)
        if len(self.words) > CACHE:
            self.__init__()
        get, learn = self.words.get, self._learn
        k = np.array([x if (x := get(w)) is not None else learn(w) for w in found])
        n = len(k)
        word, shapes = self.word_hash[k], self.shape_at[k]
        shape = self.shape_hash[shapes]
        count = np.bincount(shapes)
        kinds = np.flatnonzero(count)
        parts = [word, mix(self.shape_hash[kinds])]
        if n > 1:
            parts += [mix(word[:-1] * np.uint64(3) + word[1:]), mix(shape[:-1] * np.uint64(5) + shape[1:] + np.uint64(1))]
        share = np.ceil(np.log2(n / count[kinds])).astype(np.uint64)
        parts.append(mix(self.shape_hash[kinds] * np.uint64(7) + share))
        distinct = _distinct(k) / n
        fresh = _distinct((k[:-2] << 40) ^ (k[1:-1] << 20) ^ k[2:]) / (n - 2) if n > 2 else 1.0
        same = int(8 * np.mean(k[1:] == k[:-1])) if n > 1 else 0
        size = int(np.log2(n))
        parts.append(mix(np.array([(1 << 32) + size * 64 + int(distinct * 20), (2 << 32) + int(fresh * 20), (3 << 32) + same], np.uint64)))
        all_parts = (np.concatenate(parts) & np.uint64(DIMENSIONS - 1)).astype(np.int32)
        all_parts.sort()
        return all_parts[np.append(True, all_parts[1:] != all_parts[:-1])]


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of (share of each feature in class 1 / share in class 0)."""

    def share(which: np.ndarray) -> np.ndarray:
        chosen = [rows[i] for i in np.flatnonzero(which)]
        n = np.bincount(np.concatenate([*chosen, np.zeros(0, np.int64)]), minlength=DIMENSIONS) + smooth
        return n / (which.sum() + 2 * smooth)

    return np.log(share(y == 1) / share(y != 1))


def _unit(r: np.ndarray, x: np.ndarray) -> np.ndarray:
    v = r[x]
    n = np.sqrt((v * v).sum())
    return (v / n if n > 0 else v).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 0) -> np.ndarray:
    """Weights (the last one the intercept) of the linear hinge-loss model.

    One dual variable a row between 0 and the row's cost; each is moved to its
    best value given the others, in random order, and the weights follow."""

    w, alpha = np.zeros(DIMENSIONS + 1), np.zeros(len(rows))
    norm = np.array([(v * v).sum() + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = y[i] * (w[x] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[x] += step * y[i] * v
                w[-1] += step * y[i]
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return w


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score as a logistic function of the margin, by
    Newton steps on smoothed targets."""

    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def fit_rows(texts: list[str], labels: list[int], cost: float = 1.0) -> np.ndarray | None:
    """Per dimension the weight times the ratio, the ratio, and (slope, offset,
    intercept) behind: 2 * DIMENSIONS + 3 numbers; None without both classes."""

    y = np.where(np.array(labels) == 1, 1.0, -1.0)
    if not (y > 0).any() or not (y < 0).any():
        return None
    rows = [Featurizer.features(f, t) for f in [Featurizer()] for t in texts]
    # the classes weigh alike
    each = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) * cost

    def model(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = [rows[i] for i in which]
        r = log_count_ratios(some, y[which])
        return dual_coordinate_descent(some, [_unit(r, x) for x in some], y[which], each[which]), r

    place = np.arange(len(y)) % 3 == 2
    if min((y[~place] > 0).sum(), (y[~place] < 0).sum(), (y[place] > 0).sum(), (y[place] < 0).sum()) > 0:
        w, r = model(np.flatnonzero(~place))
        left = [rows[i] for i in np.flatnonzero(place)]
        slope, offset = logistic_curve(np.array([w[x] @ _unit(r, x) + w[-1] for x in left]), y[place])
    else:
        slope, offset = 1.0, 0.0
    w, r = model(np.arange(len(y)))
    return np.concatenate([w[:-1] * r, r * r, [slope, offset, w[-1]]])


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 5 (0: held out)."""

    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> np.ndarray | None:
    """The model from labelled rows that are not held out."""

    marked = labels.filter(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.min("quality").alias("label"))
    # the bound is taken on ids, before any text is read
    chosen = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    ids = {r.doc_id: int(r.label) for r in chosen.collect()}
    if not ids:
        return None
    session = docs.sparkSession
    wanted = session.createDataFrame(list(ids.items()), "doc_id long, label int")
    # max_rows rows of two numbers: a broadcast of bounded size; of several texts with one id the least is learnt
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for batch in batches:
            found += zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)
        found.sort(key=lambda r: int(mix(np.array([r[0]], np.int64).view(np.uint64))[0]))
        model = fit_rows([r[1] or "" for r in found], [r[2] for r in found]) if found else None
        if model is not None:
            yield pa.RecordBatch.from_pydict({"model": pa.array([model.astype("<f8").tobytes()], pa.binary())})

    fitted = rows.coalesce(1).mapInArrow(run, "model binary").collect()
    return np.frombuffer(bytes(fitted[0].model), "<f8") if fitted else None


def score(docs: DataFrame, model: np.ndarray | None, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score of ``text``."""

    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, T.DoubleType(), False)])
    sent = docs.sparkSession.sparkContext.broadcast(None if model is None else model.astype("<f8").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None if sent.value is None else np.frombuffer(sent.value, "<f8")
        features = Featurizer()

        def margin(text: str | None) -> float:
            x = features.features(text or "")
            n = np.sqrt(model[DIMENSIONS + x].sum())
            return (model[x].sum() / n if n > 0 else 0.0) + model[-1]

        for batch in (b.slice(a, 500) for b in batches for a in range(0, b.num_rows, 500)):
            if model is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                slope, offset = model[-3], model[-2]
                m = np.array([margin(t) for t in batch.column("text").to_pylist()])
                scores = 1 / (1 + np.exp(-np.clip(slope * m + offset, -500, 500)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores)], [*kept, out])

    return docs.select(*dict.fromkeys([*(f"`{c}`" for c in kept), "`text`"])).mapInArrow(run, schema)
