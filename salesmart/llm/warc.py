"""Deterministic sharded WARC writer and its reader (operator 12).

1. Revisits.  Payloads are told apart by SHA-1 and size.  Of the records with
   equal payloads of at least ``least`` bytes the one of largest page_id is the
   response and the others revisit it.  Only (page_id, digest, size) rows are
   grouped and joined for this.
2. Ranges.  Page ids are cut into ranges of about equal bytes by exact counts
   over equal-width buckets, dense buckets being cut again; an id that holds
   more than a range's share is cut by its payloads' digests.  The bounds follow
   from the rows alone, not from their order or partitions, so the same rows
   give the same files.  They are at most a few numbers for each range.
3. Writing.  Each range is one sorted stream (page_id, digest, url, all
   decided rows of a payload standing behind its decision), written as gzip
   members, a record each, to files that roll at ``roll`` compressed bytes.
   Headers and digests are made anew from the row.
4. Commit.  A task writes under temporary names that no other attempt has and
   returns a manifest row per file; Spark's own commit keeps one attempt's rows.
   The files of the manifest are then moved to their final names, which a lost
   and repeated move finds done, and the manifest with the final names is
   written last: an archive is what its manifest lists, and files of lost
   attempts are never read.

``read_archives`` streams the files of the manifest and checks every digest.

Files go to the folder through pyarrow's file systems (local and shared
folders, s3, gs, hdfs), member by member, and never to an executor's own disk.

Defined cases: a null html is the empty payload; a null page_id is the
smallest (the response only if all are null) and is null again when read; of
rows equal in page_id and payload the first by url is the response if their
page_id is, the others revisit it; a null url is ``urn:page:<page_id>``;
characters of a url that would break a header line are percent-encoded; other
columns are ignored; an empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import partitions, range_of, stage

ROLL, LEAST, DATE = 64 << 20, 0, "2024-01-01T00:00:00Z"
BUCKETS = 4096
OVERHEAD = 500  # bytes of a record beside its payload, for the ranges' sizes

MANIFEST = "shard long, part int, temporary string, name string, records long, bytes long, crc32 long"


# --- ranges ----------------------------------------------------------------


def _bounds(sizes: DataFrame, n: int) -> tuple[list[int], dict[int | None, int]]:
    """Bounds that cut the ids of ``sizes`` (page_id, weight) into about ``n``
    ranges of equal weight, and the parts of each id (or null) that alone is
    heavier than a range.  At most ``BUCKETS`` rows reach the driver at once;
    each round narrows the dense buckets, so 64-bit ids take six at most."""

    row = sizes.agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi"), F.sum("weight").alias("w"), F.sum(F.when(F.col("page_id").isNull(), F.col("weight"))).alias("none")).first()
    share = max(1, -(-(row.w or 0) // n))
    heavy = {None: -(-row.none // share)} if (row.none or 0) > share else {}
    if row.lo is None:
        return [], heavy
    found: list[tuple[int, int]] = []  # (last id of a bucket, weight)
    spans = [(row.lo, row.hi)]
    while spans:
        per = max(1, BUCKETS // len(spans))
        widths = [-(-(b - a + 1) // per) for a, b in spans]
        number = F.when(F.lit(False), F.lit(0).cast("long"))
        for k, ((a, b), w) in enumerate(zip(spans, widths, strict=True)):
            exact = lambda x: f"cast('{x}' as decimal(38,0))"  # noqa: E731  (ids may be 64 bits apart)
            place = F.expr(f"(cast(page_id as decimal(38,0)) - {exact(a)}) div {exact(w)}")
            number = number.when(F.col("page_id").between(a, b), place + k * per)
        rows = sizes.select(number.alias("bucket"), "weight").filter("bucket is not null").groupBy("bucket").agg(F.sum("weight").alias("w")).collect()
        dense = []
        for r in rows:
            k, place = divmod(r.bucket, per)
            a, w = spans[k][0] + place * widths[k], widths[k]
            last = min(a + w - 1, spans[k][1])
            if r.w <= share or a == last:
                found.append((last, r.w))
                if r.w > share:
                    heavy[last] = -(-r.w // share)
                    found.append((last - 1, 0))
            else:
                dense.append((a, last))
        spans = dense
    bounds, held = [], 0
    for last, w in sorted(found):
        held += w
        if held >= share or last in heavy or last + 1 in heavy:
            bounds.append(last)
            held = 0
    return sorted({*bounds, row.hi}), heavy


def _shard(bounds: list[int], heavy: dict[int | None, int], lead: Column) -> tuple[Column, int]:
    """Number of a row's range, ids without one first, and how many there are."""

    first, parts, at = [], [], heavy.get(None, 1)
    for b in bounds:
        first.append(at)
        parts.append(heavy.get(b, 1))
        at += parts[-1]
    share = lambda k: F.floor(lead * k / F.lit(2**32)).cast("long")
    shard = share(F.lit(heavy.get(None, 1)))
    if bounds:
        k = range_of(F.col("page_id"), bounds) + 1
        pick = lambda v: F.element_at(F.array(*map(F.lit, v)), k).cast("long")
        shard = F.when(F.col("page_id").isNull(), shard).otherwise(pick(first) + share(pick(parts)))
    return shard, at


# --- records ---------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(lines: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def _target(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{_name(page_id)}"
    return urllib.parse.quote(url, safe="".join(chr(c) for c in range(33, 127)))


def _name(page_id: int | None) -> str:
    return "null" if page_id is None else str(page_id)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, ordinal: int, refers_to: str | None, date: str = DATE) -> bytes:
    """One record; a revisit (``refers_to``: a record id) has the HTTP headers only."""

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page_id, digest, ordinal)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _target(url, page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if refers_to is not None:
        lines += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(lines) + block + b"\r\n\r\n"


def record_id(page_id: int | None, digest: str, ordinal: int) -> str:
    return f"urn:page:{_name(page_id)}:{digest}:{ordinal}"


def warcinfo(shard: int, part: int, date: str = DATE) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    lines = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:shard:{shard}:{part}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(body)))]
    return _header(lines) + body + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without time or name: equal bytes for equal data."""

    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file of one member a record."""

    out, d = [], zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            out.append(d.decompress(chunk))
            chunk = d.unused_data
            if not d.eof:
                break
            head, _, body = b"".join(out).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            n = int(fields["Content-Length"])
            if version != "WARC/1.1" or body[n:] != b"\r\n\r\n":
                raise ValueError("damaged record")
            yield fields, body[:n]
            out, d = [], zlib.decompressobj(31)
    if any(out):
        raise ValueError("a file ends inside a record")


# --- files -----------------------------------------------------------------


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class _Files:
    """A task's files of one range, under temporary names."""

    def __init__(self, path: str, shard: int, roll: int, date: str):
        self.path, self.shard, self.roll, self.date, self.done, self.out = path, shard, roll, date, [], None
        self.fs, self.base = _open(path)

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.row = {"shard": self.shard, "part": len(self.done), "temporary": f"_temporary-{uuid.uuid4().hex}", "name": f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz", "records": 0, "bytes": 0, "crc32": 0}
            self.out = self.fs.open_output_stream(f"{self.base}/{self.row['temporary']}", compression=None)
            self._write(member(warcinfo(self.shard, len(self.done), self.date)))
        self._write(member(data))
        self.row["records"] += 1
        if self.row["bytes"] >= self.roll:
            self.close()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.row["bytes"] += len(data)
        self.row["crc32"] = zlib.crc32(data, self.row["crc32"])

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append(self.row)
            self.out = None


def _moved(path: str, manifest: DataFrame) -> DataFrame:
    """The manifest, its files moved to their names.  A move that a lost task
    had done already is found by the file's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(path)
        for batch in batches:
            for r in batch.select(["temporary", "name", "bytes"]).to_pylist():
                old, new = f"{base}/{r['temporary']}", f"{base}/{r['name']}"
                if fs.get_file_info(old).type == pafs.FileType.File:
                    fs.move(old, new)
                if fs.get_file_info(new).size != r["bytes"]:
                    raise OSError(f"{new} is not what the manifest says")
            yield batch

    return manifest.mapInArrow(run, MANIFEST)


def write_archives(pages: DataFrame, path: str, least: int = LEAST, roll: int = ROLL, date: str = DATE) -> str:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files under ``path``,
    a folder that all executors reach, with the manifest ``path``/manifest."""

    spark = pages.sparkSession
    n = partitions(spark)
    fs, base = _open(path)
    fs.create_dir(base, recursive=True)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    keys = stage(hashed.select("page_id", "digest", F.octet_length("payload").cast("long").alias("size")), "warc-keys")
    bounds, heavy = _bounds(keys.select("page_id", (F.col("size") + OVERHEAD).alias("weight")), n)
    groups = keys.filter(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("rows"))
    groups = stage(groups.filter("rows > 1").select(F.col("digest").alias("_d"), "response"), "warc-groups")
    # both sides are plain scans of small rows: AQE splits a payload that very many pages share
    decided = keys.join(groups, F.col("digest") == F.col("_d")).select("page_id", "digest", "response").distinct()
    shard, shards = _shard(bounds, heavy, F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))
    none = F.lit(None)
    rows = hashed.select(shard.cast("int").alias("shard"), "page_id", "digest", F.lit(1).alias("kind"), "url", "payload", none.cast("long").alias("response")).union(
        decided.select(shard.cast("int"), "page_id", "digest", F.lit(0), none.cast("string"), none.cast("binary"), "response")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: _Files | None = None
        at: tuple | None = None  # page_id and digest at hand, how many of its rows were written, its decision
        ordinal, decision = 0, None
        for batch in batches:
            column = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                number, page_id, digest, kind, url, response = (column[c][i].as_py() for c in ("shard", "page_id", "digest", "kind", "url", "response"))
                if files is None or files.shard != number:
                    if files is not None:
                        files.close()
                        yield manifest(files)
                    files = _Files(path, number, roll, date)
                if (page_id, digest) != at:
                    at, ordinal, decision = (page_id, digest), 0, None
                if kind == 0:
                    decision = (response,)
                    continue
                name = base64.b32encode(bytes.fromhex(digest)).decode()
                first = decision is None or (decision[0] == page_id and ordinal == 0)
                files.add(record(page_id, url, column["payload"][i].as_py(), name, ordinal, None if first else record_id(decision[0], name, 0), date))
                ordinal += 1
        if files is not None:
            files.close()
            yield manifest(files)

    def manifest(files: _Files) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["shard", "part", "temporary", "name", "records", "bytes", "crc32"]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in files.done], t) for c, t in zip(names, types, strict=True)], names)

    order = [F.col("shard"), F.col("page_id").asc_nulls_first(), F.col("digest"), F.col("kind"), F.col("url").asc_nulls_first()]
    written = stage(rows.repartitionById(max(1, shards), F.col("shard")).sortWithinPartitions(*order).mapInArrow(run, MANIFEST), "warc-manifest")
    _moved(path, written).write.parquet(f"{path}/manifest")
    return path


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the archive: page_id, payload_bytes, payload_digest,
    record_type and refers_to.  Digests are computed from what was read; a
    record that differs from its headers, or a file from its manifest row, stops
    the read."""

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def id_of(urn: str) -> int | None:
        name = urn.strip("<>").split(":")[2]
        return None if name == "null" else int(name)

    def chunks(file, expected: int) -> Iterator[bytes]:
        crc = 0
        while chunk := file.read(1 << 20):
            crc = zlib.crc32(chunk, crc)
            yield chunk
        if crc != expected:
            raise ValueError("a file is not what the manifest says")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(path)
        for batch in batches:
            for entry in batch.select(["name", "crc32"]).to_pylist():
                found = []
                with fs.open_input_stream(f"{base}/{entry['name']}", compression=None) as file:
                    for fields, block in records(chunks(file, entry["crc32"])):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                            raise ValueError(f"{fields['WARC-Record-ID']}: block digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
                        if not revisit and (size != len(payload) or digest != base32_sha1(payload)):
                            raise ValueError(f"{fields['WARC-Record-ID']}: payload digest")
                        found.append((id_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], id_of(fields["WARC-Refers-To"]) if revisit else None))
                        if len(found) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
                            found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    # the manifest is small; its files are dealt out by name, whole
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("name", "crc32")
    return files.repartition(partitions(spark), "name").mapInArrow(run, READ)
