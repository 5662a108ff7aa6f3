import random
import re

import numpy as np
import pytest

from salesmart.llm import entry, ngram_join
from tests.llm.oracle import compare

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) > 3 else frozenset({tuple(w)} - {()})


def brute(rows):
    """doc_id -> (set size, component) comparing all pairs."""

    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 85 * (len(a) + len(b) - both):
                    up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((repr(d), len(sets[i]), repr(least.get(root(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


def edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
    return " ".join(w)


def test_op6_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(entry.op6_ngram_join(spark, SF)) == brute(rows)


def test_op6_equals_its_sql(spark):
    compare(spark, "op6_ngram_join", SF)


def family_rows(seed, families, members):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for f in range(families):
        base = [rng.choice(vocab) for _ in range(rng.choice([5, 40, 120]))]
        if f % 3 == 0:
            base = passage + base
        for _ in range(members):
            texts.append(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3])))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [2048, 7])
def test_families_with_a_shared_passage(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = family_rows(block, 12, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(ngram_join.join(df)) == brute(rows)


def test_common_list_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "AT_LEAST", 1)
    rows = family_rows(3, 4, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert got(ngram_join.join(df)) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"x{i % 977}y{i % 31}" for i in range(20_000))
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "One two\x0bthree"), (7, "one two three four"), (8, None),
            (None, "one"), (None, "null only here"), (9, long), (10, long + " tail"), (9, long), (11, "É è"), (12, "é è"), (7, "other words of doc seven again")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int")
    assert got(ngram_join.join(df)) == brute(rows)
    assert ngram_join.join(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_in_task_links_connect_every_linked_pair(seed):
    """The prefix filter loses no link, whatever l each class picks."""

    rng = random.Random(seed)
    sets = [np.array(sorted(rng.sample(range(60), rng.randrange(8, 40))), np.int64) for _ in range(30)]
    sets += [np.array(sorted(set(s.tolist()) ^ {rng.randrange(60)}), np.int64) for s in sets for _ in range(3)]
    count = np.bincount(np.concatenate(sets), minlength=60)
    tokens, levels, prefixes = [], [], []
    for s in sets:
        s = s[np.lexsort((s, count[s]))]
        n = len(s)
        tokens.append(s[count[s] > 1])
        level = rng.randrange(1, min(8, ngram_join.needed(n)) + 1)
        levels.append(level)
        prefixes.append(max(0, min(len(tokens[-1]), n - ngram_join.needed(n) + level - (n - len(tokens[-1])))))
    found = ngram_join.links_within(list(range(len(sets))), [len(s) for s in sets], tokens, levels, prefixes)
    forest = ngram_join._Forest(len(sets))
    for a, b in found:
        forest.join(a, b)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                assert forest.root(i) == forest.root(j)
