"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table and derives the digest columns of the result from the operator's real
outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, fim, line_rules, minhash, mixing, ngram_join, pii, quality, secrets, token_files, urls, variants, warc
from salesmart.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return urls.filter_captures(urls.page_captures(pages), urls.page_list(pages)).select(
        F.col("capture_id").alias("page_id"), "fetched", "blocked", "n_entries", "categories", "first_entry"
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")), secrets.KINDS[:3])


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode_and_decode(_table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (quality.fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_with_next(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.read_token_files(spark, path)


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean(_table(spark, sf_dir, "documents"), min_kept=0.5).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words", F.sha2("cleaned", 256).alias("cleaned_sha256"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(pii.scan(_table(spark, sf_dir, "documents")), pii.KINDS)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text-frames")
    fim.write_frames(_table(spark, sf_dir, "documents"), path)
    return fim.transform(spark, path)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_secrets": op2_secrets,
        "op3_bpe": op3_bpe,
        "op4_quality": op4_quality,
        "op5_minhash": op5_minhash,
        "op6_ngram_join": op6_ngram_join,
        "op7_mixing": op7_mixing,
        "op8_token_files": op8_token_files,
        "op9_line_rules": op9_line_rules,
        "op10_pii": op10_pii,
        "op11_fim": op11_fim,
        "op12_warc": op12_warc,
        "op13_variants": op13_variants,
    }


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
         DATE '2024-01-01' + CAST(coalesce(page_id, 0) * 37 % 366 AS INTEGER) AS fetched
  FROM pages
),
numbered AS (SELECT *, row_number() OVER () AS r, regexp_extract(path, '^/([^/]+)', 1) AS s1 FROM p),
parts AS (SELECT *, string_split(host, '.') AS labels FROM numbered),
keys AS (
  SELECT DISTINCT r, page_id, fetched, key FROM (
    SELECT r, page_id, fetched, 'domain:' || array_to_string(labels[i:], '.') AS key FROM parts, (SELECT unnest(range(1, 64)) AS i) WHERE i < len(labels) AND host <> ''
    UNION ALL SELECT r, page_id, fetched, 'prefix:' || host || '/' || s1 FROM parts WHERE host <> '' AND s1 <> ''
    UNION ALL SELECT r, page_id, fetched, 'page:' || host || path FROM parts WHERE host <> '' AND path <> ''
  )
),
listable AS (
  SELECT DISTINCT key, md5(key) AS m FROM (
    SELECT 'domain:' || host AS key FROM p WHERE host <> '' AND starts_with(host, 'www.') = FALSE
    UNION ALL SELECT 'prefix:' || host || '/' || s1 FROM parts WHERE host <> '' AND s1 <> ''
    UNION ALL SELECT 'page:' || host || path FROM p WHERE host <> '' AND path <> ''
  )
),
events AS (
  SELECT key, ['adult', 'malware', 'spam', 'piracy'][instr('0123456789abcdef', m[2]) % 4 + 1] AS category, change,
         DATE '2024-01-01' + CAST(CASE change WHEN 0 THEN a WHEN 1 THEN a + 40 + b ELSE a + 90 + 2 * b END AS INTEGER) AS day, (change <> 1)::INTEGER AS listed
  FROM (SELECT key, m, (instr('0123456789abcdef', m[3]) - 1) * 16 + instr('0123456789abcdef', m[4]) - 1 AS a, instr('0123456789abcdef', m[5]) - 1 AS b FROM listable
        WHERE m[1] IN ('0', '1', '2', '3')), (SELECT unnest([0, 1, 2]) AS change)
),
spans AS (SELECT key, category, day AS valid_from, lead(day) OVER (PARTITION BY key, category ORDER BY day, listed) AS valid_to, listed FROM events),
hits AS (SELECT r, keys.key, category FROM keys JOIN spans ON keys.key = spans.key AND listed = 1 AND fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to)),
found AS (SELECT r, count(*) AS n, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories, min(key) AS first_entry FROM hits GROUP BY r)
SELECT page_id, fetched, found.r IS NOT NULL AS blocked, coalesce(n, 0)::BIGINT AS n_entries, coalesce(categories, '') AS categories, first_entry
FROM numbered LEFT JOIN found USING (r)
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 3], ' ') AS x FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT r, count(*) AS n FROM s GROUP BY r),
met AS (SELECT a.r AS a, b.r AS b, count(*) AS same FROM s a JOIN s b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT a, b FROM met JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * same >= 85 * (x.n + y.n - same)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT r, r FROM sizes UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
least AS (SELECT reach.a AS r, min(w.doc_id) AS component FROM reach JOIN w ON w.r = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component END AS component_id
FROM w LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)
"""

OP7_SQL = r"""
WITH RECURSIVE units AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
),
weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM units GROUP BY source
),
total AS (SELECT sum(source_size)::DOUBLE AS t FROM weighed),
fill(round, level) AS (
  SELECT 0, (SELECT t FROM total) / (SELECT sum(w) FROM weighed)
  UNION ALL
  SELECT f.round + 1,
         (SELECT (any_value(t) - sum(CASE WHEN f.level * w > 3 * source_size THEN 3 * source_size ELSE 0 END))
                 / sum(CASE WHEN f.level * w > 3 * source_size THEN 0 ELSE w END) FROM weighed, total)
  FROM fill f WHERE f.round < 100
),
targets AS (
  SELECT source, source_size, least(3.0 * source_size, w * (SELECT level FROM fill WHERE round = 100))::DOUBLE AS target FROM weighed
),
placed AS (
  SELECT u.doc_id, u.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(u.size) OVER (PARTITION BY u.source ORDER BY md5('mix:' || coalesce(u.doc_id::VARCHAR, 'null')), u.doc_id, u.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
             + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) END)::BIGINT AS taken
FROM placed
"""


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS k
  FROM documents
),
windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS x FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) > 2)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
lines AS (
  SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS has, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         regexp_replace(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), '[0-9]+', '0', 'g') AS norm
  FROM (SELECT r, host, k, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM d)
),
hosts AS (SELECT host, count(DISTINCT k) AS texts FROM lines WHERE has GROUP BY host),
counted AS (SELECT host, norm, count(DISTINCT k) AS texts, max(n) AS n, min(k) AS holder FROM lines WHERE has GROUP BY host, norm),
above AS (
  SELECT c.host, c.norm, c.holder FROM counted c JOIN hosts h ON c.host IS NOT DISTINCT FROM h.host
  WHERE c.texts > CASE WHEN c.n >= 20 THEN 3 ELSE greatest(5, 0.002 * h.texts) END
),
judged AS (
  SELECT l.*, has AND o.norm IS NOT NULL AS gone FROM lines l LEFT JOIN above o ON l.host IS NOT DISTINCT FROM o.host AND l.norm = o.norm AND l.k <> o.holder
),
rest AS (
  SELECT r, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS cleaned, coalesce(sum(n) FILTER (WHERE gone), 0) AS removed,
         count(*) FILTER (WHERE has) - count(DISTINCT line) FILTER (WHERE has) AS dup
  FROM judged GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (length(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')))::BIGINT AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
       len(ws) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(ws) AS base_failed,
       NOT (len(ws) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(ws)) AND len(ws) - removed >= 0.5 * len(ws) AS kept,
       removed::BIGINT AS n_removed_words, sha256(cleaned) AS cleaned_sha256
FROM d JOIN rest USING (r) LEFT JOIN covered c USING (r)
"""

OP11_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents
),
hashed AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM units
),
formed AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                 WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi
  FROM hashed
),
parts AS (
  SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:n], '') AS suffix FROM formed
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

OP12_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
numbered AS (SELECT *, max(page_id) OVER same AS first_id, row_number() OVER (same ORDER BY page_id DESC NULLS LAST) AS place FROM p WINDOW same AS (PARTITION BY payload))
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       -- five bits a letter, read from two hexadecimal digits
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         ((instr('0123456789abcdef', substr(h, 1 + 5 * i // 4, 1)) - 1) * 16 + instr('0123456789abcdef', substr(h, 2 + 5 * i // 4, 1)) - 1) >> (3 - 5 * i % 4) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first_id END AS refers_to
FROM numbered
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL, "op6_ngram_join": OP6_SQL, "op7_mixing": OP7_SQL, "op9_line_rules": OP9_SQL, "op11_fim": OP11_SQL, "op12_warc": OP12_SQL}
