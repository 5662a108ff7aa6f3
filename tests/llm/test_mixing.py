import re

import pytest

from salesmart.llm import entry, mixing
from tests.llm.oracle import compare

SF = "/root/testdata/sf0.001"


def water_fill(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing, capping and sharing the excess anew."""

    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over


def check(rows):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = water_fill(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    return taken, want


def test_op7_equals_its_sql(spark):
    compare(spark, "op7_mixing", SF)


@pytest.mark.parametrize("range_units", [1, 7, 4096])
def test_budgets_are_met_exactly_and_caps_hold(spark, range_units):
    rows = [(i, "w " * (i % 13), f"s{i % 4}" if i % 5 else None) for i in range(400)] + [(1000 + i, "x y z", "tiny") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, range_units=range_units).collect()
    assert len(got) == len(rows)
    taken, want = check(got)
    for s in taken:
        assert taken[s] == int(want[s] + 0.5)
    again = mixing.mix(df.repartition(5), range_units=range_units).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_odd_rows(spark):
    rows = [(None, None, None, 1), (1, "", "a", 1), (1, "", "a", 1), (2, "a b c d", "a", 1), (2, "a b c d", "a", 1), (3, "x " * 5000, "b", 1), (4, "y", "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    check(got)
    out = mixing.mixed_documents(df).collect()
    assert sum(len((r.text or "").split()) for r in out) == sum(r.taken for r in got)
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mixed_documents(df.limit(0)).columns == df.columns


def test_mixed_documents_hold_the_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.mix(docs).collect()
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    word = re.compile(r"[^\x20\x09-\x0D]+")
    original = {r.doc_id: r.text for r in docs.collect()}
    got = {}
    for r in out.collect():
        assert original[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(word.findall(r.text))
    assert got == {r.doc_id: r.taken for r in plan if r.taken}


def test_registered():
    assert "op7_mixing" in entry.queries()


def test_documents_hold_what_the_plan_takes(spark):
    """Repeated rows, one doc_id in several texts and sources, null keys, sizes of zero."""

    rows = [(i % 60, "w " * (i % 13), f"s{i % 4}" if i % 5 else None) for i in range(300)] + [(7, "x y z", "tiny")] * 3 + [(None, "a b", None)] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, got = {}, {}
    for r in mixing.mix(df).collect():
        want[r.doc_id, r.source] = want.get((r.doc_id, r.source), 0) + r.taken
    for r in mixing.mixed_documents(df.repartition(3)).collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(r.text.split())
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n}
