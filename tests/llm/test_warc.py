import base64
import hashlib
import pathlib

import pytest

from salesmart.llm import entry, warc
from tests.llm.oracle import compare

SF = "/root/testdata/sf0.001"


def brute(rows, least=0):
    """(page_id, size, digest, type, refers_to) by grouping equal payloads."""

    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    groups = {}
    for k, (p, x) in enumerate(payloads):
        groups.setdefault(x, []).append((p is not None, p or 0, k))
    out = []
    for k, (p, x) in enumerate(payloads):
        known, best, _ = max(groups[x], key=lambda g: g[:2])
        first = next(g[2] for g in groups[x] if g[:2] == (known, best))
        response = len(x) < least or k == first
        digest = base64.b32encode(hashlib.sha1(x).digest()).decode()
        out.append((p, len(x), digest, "response" if response else "revisit", None if response or not known else best))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


ROWS = (
    [(i, f"http://h{i % 7}.example/é {i}\r\nx", f"<p>{i % 40} ü🙂</p>" * (i % 9)) for i in range(300)]
    + [(10**15 + i, None, "same page") for i in range(50)]
    + [(None, f"u{i}", f"null {i % 5}") for i in range(60)]
    + [(77, f"v{i}", f"version {i}") for i in range(60)]
    + [(-(2**62), "", None), (2**62, "a", ""), (5, "twice", "twice"), (5, "twice", "twice"), (2**63 - 1, "l", "long " * 200_000), (None, None, None)]
)


def frame(spark, rows=ROWS, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, shard string, digest int").repartition(parts)


def test_op12_equals_its_sql(spark):
    compare(spark, "op12_warc", SF)


@pytest.mark.parametrize("least", [0, 30])
def test_odd_rows(spark, tmp_path, least):
    path = warc.write_archives(frame(spark), f"file://{tmp_path}/a", least=least, roll=3000)
    assert got(warc.read_archives(spark, path)) == brute(ROWS, least)


def test_the_same_rows_give_the_same_files(spark, tmp_path):
    """Whatever their order and partitions; files roll by compressed size, hold
    whole gzip members and only those of the manifest remain."""

    def files(name, parts):
        path = warc.write_archives(frame(spark, parts=parts), str(tmp_path / name), roll=3000)
        found = {p.name: p.read_bytes() for p in pathlib.Path(path).iterdir() if p.is_file() and not p.name.startswith(".")}
        listed = {r.name: r for r in spark.read.parquet(f"{path}/manifest").collect()}
        assert found.keys() == listed.keys()
        assert all(len(found[k]) == r.bytes for k, r in listed.items()) and sum(r.records for r in listed.values()) == len(ROWS)
        return found

    one, other = files("one", 1), files("other", 7)
    assert one == other and len(one) > 8
    # each file but a range's last reached the size, and none by more than a record
    assert sum(len(x) >= 3000 for x in one.values()) > 2
    heads = [h for x in one.values() for h, _ in warc.records(iter([x]))]
    assert len({h["WARC-Record-ID"] for h in heads}) == len(heads)


def test_heavy_and_missing_ids_are_spread(spark, tmp_path):
    """A third of the rows without an id, a third with one id: their payloads
    are dealt to several ranges, each about as large as the others."""

    rows = [(None, f"u{i}", f"{i} " * 50) for i in range(400)] + [(7, f"v{i}", f"v{i} " * 50) for i in range(400)] + [(i * 1000, "w", f"w{i} " * 50) for i in range(400)]
    path = warc.write_archives(frame(spark, rows), str(tmp_path / "a"))
    sizes = [r.records for r in spark.read.parquet(f"{path}/manifest").collect()]
    assert max(sizes) < 400 and got(warc.read_archives(spark, path)) == brute(rows)


def test_damage_is_found(spark, tmp_path):
    path = warc.write_archives(frame(spark, ROWS[:20]), str(tmp_path / "a"))
    file = next(p for p in pathlib.Path(path).iterdir() if p.name.endswith(".warc.gz"))
    data = file.read_bytes()
    file.write_bytes(data[:-40])
    with pytest.raises(Exception, match="manifest|inside a record"):
        warc.read_archives(spark, path).collect()


def test_a_repeated_move_is_no_error(spark, tmp_path):
    """A lost task's moves are done again: files that stand at their names are left."""

    path = warc.write_archives(frame(spark, ROWS[:50]), str(tmp_path / "a"))
    manifest = spark.read.schema(warc.MANIFEST).parquet(f"{path}/manifest")
    assert warc._moved(path, manifest).count() == manifest.count()
    assert got(warc.read_archives(spark, path)) == brute(ROWS[:50])


def test_an_empty_table(spark, tmp_path):
    path = warc.write_archives(frame(spark, ROWS).limit(0), str(tmp_path / "a"))
    assert warc.read_archives(spark, path).collect() == []


def test_registered(spark):
    assert "op12_warc" in entry.oracle_sql() and "op12_warc" in entry.queries()
