import zlib

import numpy as np
import pytest

from salesmart.llm import entry, quality

SF = "/root/testdata/sf0.01"


def test_op4_held_out_accuracy_and_columns(spark):
    rows = entry.op4_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 1000
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in labels:
            right.append(r.predicted == labels[r.doc_id])
    assert np.mean(right) >= 0.94
    again = entry.op4_quality(spark, SF).collect()
    assert sorted(rows) == sorted(again)


def test_held_out_labels_are_never_learnt(spark):
    docs = spark.createDataFrame([(i, f"word{i % 2} " * 20) for i in range(200)], "doc_id long, text string")
    wrong = [(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(200)]
    model = quality.train(docs, spark.createDataFrame(wrong, "doc_id long, quality int"))
    for r in quality.score(docs, model, keep=["doc_id"]).collect():
        assert (r.score > 0.5) == (r.doc_id % 2 == 1)


def test_several_texts_of_one_id_give_one_model(spark):
    """Whatever the order and partitions of the rows."""

    rows = [(i % 40, f"{'fine prose' if i % 2 else '$$ buy ##'} number {i} " * 8) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    one, other = (quality.train(spark.createDataFrame(r, "doc_id long, text string").repartition(k), labels) for r, k in ((rows, 1), (rows[::-1], 7)))
    assert (one == other).all()


def test_bound_and_odd_rows(spark):
    rows = [(i, "good plain words here " * 5 if i % 2 else "## $$ %% " * 9, 0.0) for i in range(60)] + [(None, None, 1.0), (61, "", 1.0), (62, "x " * 50_000, 1.0), (1, "good plain words here " * 5, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (6, 7), (1, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels, max_rows=20)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id < 60)
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.train(docs, labels.filter("quality = 1")) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 30, 6)) for _ in range(80)]
    values = [np.ones(len(x)) / np.sqrt(len(x)) for x in rows]
    y = np.where([x.sum() % 2 == 0 for x in rows], 1.0, -1.0)
    cost = np.ones(80)
    w = quality.dual_coordinate_descent(rows, values, y, cost, epochs=2000)

    def primal(w):
        return 0.5 * (w * w).sum() + sum(c * max(0, 1 - t * (w[x] @ v + w[-1])) for x, v, t, c in zip(rows, values, y, cost))

    best = primal(w)
    used = np.append(np.arange(30), len(w) - 1)
    for _ in range(200):
        other = w.copy()
        other[used] += rng.normal(0, 0.02, len(used))
        assert primal(other) >= best - 1e-2


def test_log_count_ratios():
    r = quality.log_count_ratios([np.array([1, 2]), np.array([2])], np.array([1.0, -1.0]))
    assert r[1] == pytest.approx(np.log((2 / 3) / (1 / 3))) and r[2] == pytest.approx(0)
