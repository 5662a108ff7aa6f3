import hashlib
import re

import numpy as np
import pytest

from salesmart.llm import entry, minhash

SF = "/root/testdata/sf0.001"


def sets(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """doc_id -> (text, edited, next) by the contract, on the driver."""

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    out = []
    for i, (d, _) in enumerate(order):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        k = len(t) // 3
        out.append((d, t, t[: len(t) - k] + nxt[:k], nxt))
    return out


def check(rows, got):
    want = expected(rows)
    assert sorted((repr(d), len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in want) == sorted(
        (repr(r.doc_id), r.n_chars, r.edited_sha256) for r in got
    )
    by = {}
    for r in sorted(got, key=lambda r: -r.near_next):
        by.setdefault((r.doc_id, r.n_chars, r.edited_sha256), []).append(r)
    for d, t, e, nxt in sorted(want, key=lambda x: -jaccard(sets(x[1]), sets(x[3]))):
        r = by[d, len(t), hashlib.sha256(e.encode()).hexdigest()].pop(0)
        assert r.fingerprint == minhash.hexed(minhash.signatures([t]))[0]
        assert r.edited_fingerprint == minhash.hexed(minhash.signatures([e]))[0]
        assert r.near_edited == pytest.approx(jaccard(sets(t), sets(e)), abs=0.2)
        assert r.near_next == pytest.approx(jaccard(sets(t), sets(nxt)), abs=0.2)


def test_op5_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, entry.op5_minhash(spark, SF).collect())


def test_many_batches_and_ranges(spark):
    rows = [(i * 3, f"word{i} " * (i % 9) + "é🙂 shared tail of every text here") for i in range(1700)]
    check(rows, minhash.fingerprint_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect())


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "only one document here ok")],
        [(None, "a b c"), (None, "d e f g h i j")],
        [(2, None), (2, "x"), (1, ""), (None, "y z"), (2, None)],
        [(i % 3, "tie " * i) for i in range(30)],
        [(5, "long " * 60_000), (4, "x" * 100_000), (6, "s")],
    ],
)
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    check(rows, minhash.fingerprint_with_next(df).collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.fingerprint_with_next(df).count() == 0


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in range(600)]
    for share in (0.0, 0.05, 0.3):
        other = [w if rng.random() > share / 5 else w + "x" for w in base]
        a, b = " ".join(base), " ".join(other)
        s = minhash.signatures([a, b])
        assert (s[0] == s[1]).mean() == pytest.approx(jaccard(sets(a), sets(b)), abs=0.15)


def test_near_duplicates_against_all_pairs(spark):
    """Groups equal those of all pairs at 0.8; pairs stand clear of the
    threshold, where bands find them all but surely."""

    rng = np.random.default_rng(4)
    rows = []
    for f in range(12):
        base = [f"f{f}w{i}" for i in range(150 + 20 * f)]
        for c in range(8):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(0, len(w)))] = f"e{rng.integers(10**9)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(200, ""), (201, None), (202, ""), (203, "short one"), (204, "short one"), (None, rows[0][1]), (1, rows[1][1])]
    got = minhash.near_duplicates(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")).collect()
    assert len(got) == len(rows)
    s, up = [sets(t or "") for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and jaccard(s[i], s[j]) >= 0.8:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = sorted((repr(d), len(s[i]), repr(least[root(i)] if s[i] else d)) for i, (d, _) in enumerate(rows))
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.near_id)) for r in got) == want
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pairs_just_above_the_threshold_are_found(spark):
    """Pairs at 0.80 to 0.85, each the only link of its two texts."""

    rows = []
    for f in range(120):
        w = [f"f{f}w{i}" for i in range(204)]  # 200 shingles
        k = 18 + f % 5  # so many leading words differ: the same number of shingles of either text is its own
        a, b = " ".join(w), " ".join([f"e{f}x{i}" for i in range(k)] + w[k:])
        if 0.80 <= jaccard(sets(a), sets(b)) <= 0.85:
            rows += [(2 * f, a), (2 * f + 1, b)]
    assert len(rows) >= 200
    got = {r.doc_id: r.near_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}


def test_the_query_gives_near_duplicates(spark, tmp_path):
    rows = [(2 * i + k, " ".join(f"f{i}w{j}" for j in range(60 + k))) for i in range(900) for k in (0, 1)]
    rows += [(5000, ""), (5001, None), (None, rows[0][1]), (None, "no other text is like this one"), (7, rows[40][1]), (7, rows[41][1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.op5_minhash(spark, str(tmp_path)).collect()
    want = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr((r.doc_id, r.n_shingles, r.near_id)) for r in got) == sorted(repr((r.doc_id, r.n_shingles, r.near_id)) for r in want)
    assert sum(r.near_id is not None and r.near_id != r.doc_id for r in got) >= 900
