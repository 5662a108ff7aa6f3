"""Mixing sources to target weights (operator 7).

Every document gets a hash-random key.  Keys are uniform, so ``(source,
leading bits of the key)`` cuts each source into key ranges of about equal
size, however large the source; ranges are sorted and summed on their own and
the sums of the ranges before them added.  A source of ``size`` words with the
budget ``B`` gives every document ``B // size`` times and, in key order, the
documents up to the remaining words; the last one is cut at the exact word.

Targets: sources in code point order (null last) weigh ``weights`` in turn and
share the words of the whole table; a target stops at ``most`` times its
source's size and the excess goes to the others by weight, until none is
above (water-filling over one row a source).

Rows that agree in doc_id, source and size are one unit of the draw (counted
before anything is joined or sorted) and share its words evenly, rounded down.

Defined cases: a null text has size 0; a document of size 0 is taken as often
as its source is taken whole, 0 words each; null sources are one source; null
doc_ids are one doc_id; an empty table gives no rows.  Only doc_id, source and
size are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(seed: str) -> Column:
    """Hash-random sort key of a document: 32 hex digits."""

    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def source_targets(units: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, n_units, target from (source, size, rows): one row
    a source, the only rows that a single task ever orders."""

    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    # sources reach their cap in the order cap / weight; the level is the first at which a source stays below its own
    per = per.withColumn("_cap", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(
        "_level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    )
    per = per.withColumn("_level", F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(whole))
    return per.select("source", "source_size", "n_units", F.least(F.col("_cap"), F.col("_level") * F.col("_w")).alias("target"))


def mix_plan(docs: DataFrame, seed: str = "mix", range_units: int = 4096, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row for each (doc_id, source, size): rows, source_size, target,
    epochs (whole copies of each row) and part (words of one more copy of each
    row)."""

    units = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    units = stage(units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    targets = stage(source_targets(units, weights, most), "mix-targets").withColumnRenamed("source", "_s")
    # both sides are plain scans: AQE can split a source that holds much of the rows
    keyed = units.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_key", hash_key(seed))
    ranges = F.greatest(F.ceil(F.col("n_units") / range_units), F.lit(1))
    lead = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("_range", F.floor(lead * ranges / F.lit(2**32)).cast("long")).withColumn("_n", F.col("size") * F.col("rows"))
    sums = keyed.groupBy("source", "_range").agg(F.sum("_n").alias("_n"))
    upto = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    here = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_start", F.coalesce(F.sum("_n").over(here), F.lit(0)))
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size") - F.col("_start") - F.col("_before")
    part = F.floor(F.greatest(F.least(left, F.col("_n")), F.lit(0)) / F.col("rows")).cast("long")
    return placed.select("doc_id", "source", "size", "rows", "source_size", "target", epochs.alias("epochs"), part.alias("part"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source, source_size, target, epochs, part and taken (words
    the mix takes of the row, repeats counted), one row per row of ``docs``."""

    plan = mix_plan(docs, **options).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    copies = plan.withColumn("_c", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    return copies.select("doc_id", "size", "source", "source_size", "target", "epochs", "part", "taken")


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word, white space kept."""

    lengths = F.zip_with(
        F.split(text, WORD, -1), F.regexp_extract_all(text, F.lit(f"({WORD})")), lambda gap, word: F.length(gap) + F.coalesce(F.length(word), F.lit(0))
    )
    end = F.aggregate(F.slice(lengths, F.lit(1), n.cast("int")), F.lit(0), lambda total, x: total + x)
    return F.substring(text, F.lit(1), end)


def source_cuts(plan: DataFrame, seed: str = "mix") -> DataFrame:
    """The plan as one row a source: ``_src``, ``_e`` (whole copies of each
    row) and ``_cut``, the last place in key order that is taken once more, with
    the words that each row there gives."""

    place = F.struct(hash_key(seed).alias("key"), "doc_id", "size")
    last = F.max(F.when(F.col("part") > 0, F.struct(place.alias("place"), "part")))
    return plan.groupBy(F.col("source").alias("_src")).agg(F.max("epochs").alias("_e"), last.alias("_cut"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each row of ``docs`` as often as it is taken, the
    copy at a source's cut shortened to its words (and ``n_chars``, where there
    is such a column, to its length).

    Every row finds out by itself on which side of its source's cut it is, so
    the texts meet one row a source and are not shuffled for it."""

    seed = options.get("seed", "mix")
    cuts = stage(source_cuts(mix_plan(docs, **options), seed), "mix-cuts")
    both = docs.withColumn("_own", n_words(F.col("text"))).join(cuts, F.col("source").eqNullSafe(F.col("_src")))
    place = F.struct(hash_key(seed).alias("key"), "doc_id", F.col("_own").alias("size"))
    # in key order the rows up to the cut are taken whole once more, the row at the cut in part
    part = F.when(place < F.col("_cut.place"), F.col("_own")).when(place == F.col("_cut.place"), F.col("_cut.part")).otherwise(0)
    both = both.withColumn("_p", F.coalesce(part, F.lit(0)).cast("long"))
    whole = F.col("_e") + F.when((F.col("_own") > 0) & (F.col("_p") == F.col("_own")), 1).otherwise(0)
    cut = (F.col("_p") > 0) & (F.col("_p") < F.col("_own"))
    nothing = F.array().cast("array<long>")
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.when(cut, F.array("_p")).otherwise(nothing))
    both = both.withColumn("_copy", F.explode(copies))
    both = both.withColumn("text", F.when(F.col("_copy") < 0, F.col("text")).otherwise(first_words(F.col("text"), F.col("_copy"))))
    if "n_chars" in docs.columns:
        both = both.withColumn(
            "n_chars", F.when(F.col("_copy") < 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
        )
    return both.select(*[f"`{c}`" for c in docs.columns])
