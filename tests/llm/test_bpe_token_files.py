import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm import bpe, entry, token_files

SF = "/root/testdata/sf0.001"
TRICKY = [
    None, "", " ", "\n\t", "Don't we'll I'VE it's", "İstanbul ΟΔΥΣΣΕΥΣ Straße", "á éx ́", "x　y z\x1c!\x85?",
    "ab<|endoftext|>cd <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "日本語テキスト 한국어 ①½٣", "🙂🙃 x🙂y", "a" * 5000, "zqxj" * 500, "ñ" * 300,
    "\u0000 ﻿bom", "1234567890 12.5%", "ﬁ Å Å K ſ", "word " * 3000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TRICKY)] + [(3, TRICKY[4], "clash", 1), (None, "null id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids int")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(entry.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoding_and_decoding_equal_the_library(docs, name):
    path = entry.tokenizer_path(name)
    lib = Tokenizer.from_file(path)
    coded = bpe.encode_documents(docs, path)
    assert coded.columns == ["doc_id", "text", "decoded", "ids"]
    rows = bpe.decode_ids(coded, path, out="back").collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want, r.text
        assert r.back == lib.decode(want, skip_special_tokens=False)


def test_one_pass_gives_what_two_give(docs):
    path = entry.tokenizer_path()
    two = bpe.decode_ids(bpe.encode_documents(docs, path), path)
    one = bpe.encode_and_decode(docs, path)
    assert one.columns == ["doc_id", "text", "ids", "decoded"]
    key = lambda r: repr((r.doc_id, r.text, r.ids, r.decoded))
    assert sorted(map(key, one.collect())) == sorted(map(key, two.collect()))


def test_random_texts_and_evicted_words(library, monkeypatch):
    """Simple and other words, overlapping merges, forced boundaries; generations
    of a few words are replaced many times over."""

    import random

    monkeypatch.setattr(bpe, "CACHE", 300)
    monkeypatch.setattr(bpe, "PIECES", 50)
    rng = random.Random(3)
    alphabet = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]] + list("   \n\t\r\x0b\x85 日🙂\u0301\u017fK") + list("aeioutnrsthe" * 6)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice("aab") for _ in range(rng.randrange(80))) for _ in range(500)]
    texts += ["".join(rng.choice("ÀéßÞþabÉ12<|>' ") for _ in range(rng.randrange(40))) for _ in range(1000)]
    coder = bpe.ForcedBoundaryBPE(bpe.read_spec(entry.tokenizer_path()))
    for k in range(0, len(texts), 90):
        part = texts[k : k + 90]
        got = [np.frombuffer(x, np.int32).tolist() for x in coder.encode(part)]
        assert got == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_words_of_one_first_hash_are_told_apart(monkeypatch, library):
    """All words collide in the first hash: the second still tells them apart."""

    monkeypatch.setattr(bpe, "_BYTE", np.zeros(256, np.uint64))
    coder = bpe.ForcedBoundaryBPE(bpe.read_spec(entry.tokenizer_path()))
    for texts in (["one two six", "ten two one"], ["six ten", "one"]):
        got = [np.frombuffer(x, np.int32).tolist() for x in coder.encode(texts)]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_unknown_ids_and_nulls_decode(spark):
    df = spark.createDataFrame([(1, [5, 10**6, -1, 6]), (2, []), (3, None)], "k int, ids array<int>")
    lib = Tokenizer.from_file(entry.tokenizer_path())
    got = {r.k: r.decoded for r in bpe.decode_ids(df, entry.tokenizer_path()).collect()}
    assert got == {1: lib.decode([5, 6]), 2: "", 3: ""}


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert bpe.decode_ids(bpe.encode_documents(none, entry.tokenizer_path()), entry.tokenizer_path()).count() == 0


def test_op3_over_the_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = entry.op3_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(6))
def test_simple8b_round_trip(seed):
    rng = np.random.default_rng(seed)
    bits = rng.integers(0, 65, 5000) if seed else np.full(5000, 16)
    ids = np.array([int(rng.integers(0, 2**63)) >> max(0, 63 - int(b)) if b < 64 else 2**64 - 1 for b in bits], np.uint64)
    ids[:1500] = ids[:1500] % 2
    for part in (ids, ids[:1], ids[:0], ids[:1024], ids[:1025]):
        words, offsets = token_files.pack(part)
        assert (token_files.unpack(words, offsets, len(part)) == part).all()
        assert len(offsets) == -(-len(part) // token_files.BLOCK)


def _check_files(rows, texts, library):
    start = 0
    for r, text in zip(sorted(rows, key=lambda r: r.start), texts, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_op8_over_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    _check_files(entry.op8_token_files(spark, SF).collect(), [r.text for r in docs], library)


def test_token_files_of_odd_rows(spark, docs, library, tmp_path):
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).collect()
    path = token_files.write_token_files(docs, str(tmp_path / "a"), entry.tokenizer_path())
    rows = token_files.read_token_files(spark, path, ids=True).collect()
    _check_files(rows, [r.text for r in ordered], library)
    assert sorted(rows, key=lambda r: r.start)[0].doc_id is None
    assert all(r.ids[-1] == 2 for r in rows)
    path = token_files.write_token_files(docs.limit(0), str(tmp_path / "b"), entry.tokenizer_path())
    assert token_files.read_token_files(spark, path).count() == 0
