"""Quality rules and cross-document line frequency (operator 9, native).

Rules on one text: words, symbols, repeated lines and words inside three-word
windows that occur twice or more.  Over the corpus, lines are normalised
(ASCII white space collapsed, lower case, digit runs as 0), hashed and counted
by distinct texts within each host, so copies of a document count once.  A line
is removed when more texts of its host hold it than ``SHARE`` of the host's
texts, ``FLOOR`` at least; a line of ``LONG`` words or more, which is not
repeated by chance in hosts of any size, when more than ``LONG_FLOOR`` do.  The
text of least hash among a line's holders keeps it, so one of a group of near
copies stays whole, and so do the copies of it.  A document that keeps less
than ``min_kept`` of its words is rejected.  With ``max_documents`` a line goes
from all its holders when more documents than this hold it.

Windows of a text are compared as 64-bit hashes, sorted once per text that has
equal ones: the work is n log n in the text's words.  Only (host, line,
document) rows are shuffled, counted per task first; the lines above the limit
meet the documents' lines in a join of two staged tables, which AQE can split
where one line is very common.

Defined cases: a null text has no words (and fails the base rules); null hosts
are one host, null doc_ids one document; rows equal in doc_id, host and text
are one document and give equal rows; a host's texts are those with words; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stage
from salesmart.llm.spans import let

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
SHARE, FLOOR = 0.002, 5
LONG, LONG_FLOOR = 20, 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""

    return F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def covered(places: Column) -> Column:
        ahead = F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0)))
        steps = F.zip_with(places, ahead, lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda n, x: n + x)

    def equal_ones(windows: Column) -> Column:
        def places(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            marked = F.transform(s, lambda x, k: F.when(F.when(k > 0, same(x, k - 1)).otherwise(False) | same(x, k + 1), x["i"]))
            return let(F.sort_array(F.array_compact(marked)), covered)

        paired = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(paired, places))

    def hashed(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))
        )
        return let(windows, equal_ones)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), hashed))


def text_rules(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text
    (null: none); n_words and n_repeat_words from one split."""

    t = F.coalesce(text, F.lit(""))
    lines = lines_of(t)
    return [
        let(words_of(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))).alias("_w"),
        (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ]


def line_hash(line: Column) -> Column:
    one = F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, SPACE + "+", " "))), "[0-9]+", "0")
    return F.xxhash64(one)


def text_key(text: Column) -> Column:
    """60 bits of a text's md5: what tells texts apart and orders them."""

    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def clean(docs: DataFrame, host: str = "source", max_documents: int | None = None, min_kept: float = 0.2, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words, and
    ``cleaned``, the text without the lines above the limit."""

    one = F.lit(1).alias("one")

    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select("doc_id", F.col(f"`{host}`").cast("string").alias("host"), t.alias("_text")).withColumn("_key", text_key(F.col("_text")))
    found = F.transform(lines_of(F.col("_text")), lambda x: F.struct(line_hash(x).alias("line"), F.size(words_of(x)).alias("n")))
    each = rows.select("doc_id", "host", "_key", F.posexplode(found).alias("at", "x"))
    # distinct by place: equal rows are one document
    lines = stage(each.select("doc_id", "host", "_key", "at", "x.line", "x.n").distinct(), "lines")
    same_line = ["host", "line"]
    if max_documents is None:
        counted = lines.groupBy(*same_line, "_key").agg(F.max("n").alias("n")).groupBy(*same_line).agg(
            F.count(F.lit(1)).alias("texts"), F.max("n").alias("n"), F.min("_key").alias("_first")
        )
        counted = counted.filter(F.col("texts") > min(FLOOR, LONG_FLOOR))
        hosts = lines.groupBy("host", "_key").agg(one).groupBy(F.col("host").alias("_host")).agg((SHARE * F.count(F.lit(1))).alias("_share"))
        limit = F.when(F.col("n") >= LONG, F.lit(LONG_FLOOR)).otherwise(F.greatest(F.lit(FLOOR), "_share"))
        over = counted.join(stage(hosts, "line-hosts"), F.col("host").eqNullSafe(F.col("_host"))).filter(F.col("texts") > limit)
    else:
        counted = lines.groupBy(*same_line, "doc_id").agg(one).groupBy(*same_line).agg(F.count(F.lit(1)).alias("documents"))
        over = counted.filter(F.col("documents") > max_documents).withColumn("_first", F.lit(None).cast("long"))
    over = stage(over.select(F.col("host").alias("_h"), F.col("line").alias("_l"), "_first"), "lines-over")
    removed = (
        lines.join(over, F.col("host").eqNullSafe(F.col("_h")) & (F.col("line") == F.col("_l")) & ~F.col("_key").eqNullSafe(F.col("_first")))
        .groupBy("doc_id", "host", "_key")
        .agg(F.sum("n").alias("_n"), F.collect_set("line").alias("_lines"))
    )
    removed = stage(removed.select(F.col("doc_id").alias("_d"), F.col("host").alias("_h"), F.col("_key").alias("_k"), "_n", "_lines"), "lines-removed")
    ruled = rows.select("doc_id", "host", "_key", "_text", *text_rules(F.col("_text"))).select("*", "_w.n_words", "_w.n_repeat_words")
    both = ruled.join(
        removed, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("host").eqNullSafe(F.col("_h")) & (F.col("_key") == F.col("_k")), "left"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    gone = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    rest = F.filter(
        F.split("_text", "\n", -1), lambda x: ~(F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")) & F.array_contains("_lines", line_hash(x)))
    )
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("n_words") - gone >= min_kept * F.col("n_words"))).alias("kept"),
        gone.alias("n_removed_words"),
        F.when(F.col("_lines").isNull(), F.col("_text")).otherwise(F.array_join(rest, "\n")).alias("cleaned"),
    )
