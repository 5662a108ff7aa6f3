import hashlib
import random
import re

import pytest

from salesmart.llm import entry, fim
from tests.llm.oracle import compare

SF = "/root/testdata/sf0.001"


def brute(doc_id, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[k : k + 8], 16) for k in (0, 8, 16, 24))
    lo, hi = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (doc_id, len(u), "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def odd_texts():
    rng = random.Random(11)
    letters = "abcXYZ ,.é🙂\n\x00<>PSM"
    return [
        None, "", " ", "a", "🙂", "a" * 5000, "é" * 3000, "<P> marked", "not < P> marked <", "x<M>", "word " * 4000, "🙂é\r\n" * 700, "<S" * 900, "abc" * 900 + "!" + "z" * 900,
        *("".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(120)),
        *("".join(rng.choice(letters) * rng.randrange(1, 90) for _ in range(rng.randrange(1, 60))) for _ in range(60)),
    ]


def test_op11_equals_its_sql(spark):
    compare(spark, "op11_fim", SF)


@pytest.mark.parametrize("frame,segment,held", [(1, 64, 0), (7, 300, 0), (64, 5000, 0), (1 << 16, 2 << 20, 1 << 20)])
def test_any_frame_size_gives_the_same(spark, tmp_path, monkeypatch, frame, segment, held):
    """Cuts in the middle of frames, at their borders, and runs over many frames."""

    monkeypatch.setattr(fim, "_HELD", held)
    rows = [(i, t, 1) for i, t in enumerate(odd_texts())] + [(None, "nobody's text, in parts", 1), (3, "another text of three", 1), (3, "another text of three", 1)]
    if frame == 1:
        rows = [r for r in rows if len(r[1] or "") < 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    got = fim.transform(spark, fim.write_frames(docs, str(tmp_path / "frames"), frame=frame, segment=segment), output=True).collect()
    want = sorted((brute(d, t) for d, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    for r in got:
        assert hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256
        assert hashlib.sha256(fim.restore(r.output, r.form).encode()).hexdigest() == r.restored_sha256
    texts = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in rows)
    assert sorted(r.restored_sha256 for r in got) == texts


def test_a_cut_reads_only_its_frame():
    """Seeking a unit decompresses the one frame in which it begins."""

    import numpy as np
    import zstandard

    text = ("some words " * 5000).encode()
    row = fim.pack(np.frombuffer(text, np.uint8), np.array([0, len(text)]), zstandard.ZstdCompressor().compress, 1000)
    seg = fim.Segment(row | {"doc_ids": [1]})
    seen = []
    inner = seg._decompress
    seg._decompress = lambda data: seen.append(1) or inner(data)
    assert seg.seek(0, 4001) == (11004, 11004)  # four units, eleven bytes
    assert len(seen) == 1 and len(seg.frames) == 55


def test_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = fim.transform(spark, fim.write_frames(docs, str(tmp_path / "f")))
    assert got.collect() == [] and got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_registered(spark):
    assert entry.op11_fim(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
