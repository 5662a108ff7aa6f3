import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from salesmart.llm import entry, mixing, quality
from tests.llm.test_native import pii_base
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, f) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_order_and_columns(staged):
    assert [n for n, _, _ in staged] == ["quality classifier", "n-gram Jaccard join", "PII", "mixing sources", "BPE encoding and decoding"]
    for _, before, after in staged[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()


def test_quality_keeps_what_the_score_says(spark, staged):
    _, before, after = staged[0]
    model = quality.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(before, model, keep=["doc_id"]).collect() if r.score >= 0.3}
    assert as_rows(after) == Counter({k: 1 for k in as_rows(before) if k[0] in good})


def test_one_document_of_each_component_stays(staged):
    _, before, after = staged[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    least = {d for d, _, c in brute(rows) if d == c}
    assert sorted(repr(r.doc_id) for r in after.collect()) == sorted(least)


def test_personal_data_is_replaced(staged):
    _, before, after = staged[2]
    new = {r.doc_id: r for r in after.collect()}
    assert len(new) == before.count()
    for r in before.collect():
        spans = sorted((a, -b, k) for k, s in pii_base(r.text).items() for a, b in s)
        want, at = "", 0
        for a, b, k in spans:
            if a >= at:
                want += r.text[at:a] + f"[{k.upper()}]"
            at = max(at, -b)
        assert new[r.doc_id].text == want + r.text[at:]
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)


def test_mix_holds_the_words_of_its_plan(staged):
    _, before, after = staged[3]
    plan = {r.doc_id: r.taken for r in mixing.mix(before).collect() if r.taken}
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert dict(got) == plan


def test_tokens_equal_the_library(staged):
    _, before, after = staged[4]
    lib = Tokenizer.from_file(entry.tokenizer_path())
    want = Counter()
    for r in before.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, r.source, tuple(ids), len(ids), lib.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.source, tuple(r.ids), r.n_tokens, r.decoded) for r in after.collect()) == want


ODD = [(1, "", "en", "a", 0), (None, None, None, None, None), (None, None, None, None, None), (2, "call +1 (988) 555-2485 now " * 20, "en", "a", 1), (2, "call +1 (988) 555-2485 now " * 20, "en", "a", 1),
       (3, "call +1 (988) 555-2485 now " * 20, None, "b", 1), (4, "plain text of some words " * 4000, "de", None, 1)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_every_stage_takes_odd_rows(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id int, ids string, _score int"
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], schema)
    for i, (_, f) in enumerate(cp.STAGES):
        out = f(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns
        got = out.collect()
        assert not (got and not rows)
    kept = cp.drop_near_copies(spark, docs, SF).collect()
    assert sorted(repr(r.doc_id) for r in kept) == (["1", "2", "4", "None", "None"] if rows else [])


def test_dedup_loses_no_unique_text(spark):
    """Shared and missing doc_ids: each component keeps one row, unique texts stay."""

    c = "the river ran past the old mill and the miller counted his sacks of grain before the rain came down " * 3
    near = c + "again"
    unique, low, other = ("quite another story about ships and the sea and the men who sailed " * 3, "low lands by the sea " * 9, "over the hills and far away " * 9)
    null = "nobody knows who wrote this line of words " * 5
    rows = [(3, c), (5, near), (5, unique), (7, low), (7, other), (None, null), (None, null)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = cp.drop_near_copies(spark, docs, SF).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(3, c), (5, unique), (7, low), (7, other), (None, null)])
