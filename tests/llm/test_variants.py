import random
import re
import zlib
from collections import Counter

import pytest

from salesmart.llm import entry, variants

SF = "/root/testdata/sf0.001"


def words_of(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def single_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped(n):
    near = {w: [] for w in n}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    for k, own in by_length.items():
        for x, a in enumerate(own):
            for b in [*own[x + 1 :], *by_length.get(k + 1, [])]:
                if single_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    out, form = {}, {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def got(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_op13_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = grouped(words_of(rows))
    assert len(want) > 500 and any(x[2] for x in want.values())
    assert got(entry.op13_variants(spark, SF)) == want


@pytest.mark.parametrize("tile", [2, 128])
def test_groups_of_any_size(spark, monkeypatch, tile):
    """Common beginnings and endings far beyond a tile, repeated letters, chains
    of forms; a tile of two splits every group down to a hole of one code point."""

    monkeypatch.setattr(variants, "TILE", tile)
    rng = random.Random(13)
    stems = ["aaaaaa", "prefixed" * 4, "zyxwvuts", "éèàüßÿöä"]
    words = set()
    for s in stems:
        for _ in range(250):
            w = list(s)
            for _ in range(rng.randrange(4)):
                k, kind = rng.randrange(len(w)), rng.randrange(3)
                w[k : k + 1] = {0: [], 1: [rng.choice("abcé")], 2: [w[k], rng.choice("aßq")]}[kind]
            words.add("".join(w))
    text = [(i, " ".join([w] * rng.choice([5, 6, 30, 200, 1500]))) for i, w in enumerate(sorted(words))]
    want = grouped(words_of(text))
    assert got(variants.group_variants(spark.createDataFrame(text, "doc_id long, text string").repartition(5))) == want
    assert any(x[4] != x[2] for x in want.values() if x[2])  # some chains are longer than one step


def test_odd_rows(spark):
    long = "q" * 30_000
    rows = [(1, None), (1, ""), (None, "Colour colour COLOUR cölour×÷ÀÉ " * 5), (None, "Colour colour COLOUR cölour×÷ÀÉ " * 5), (2, f"{long} {long}x " * 6), (3, "color " * 3), (3, "color, color🙂color"), (4, "Ünder ünder " * 9)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    assert got(variants.group_variants(df)) == grouped(words_of(rows))
    empty = variants.group_variants(df.limit(0))
    assert empty.collect() == [] and set(empty.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
