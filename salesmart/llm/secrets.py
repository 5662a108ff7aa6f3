"""Secret scan with corpus-wide ownership frequency (operator 2, native).

Every text is searched for the base kinds (assign, access, hex: fixed
patterns) and for ``opaque`` candidates, long runs that mix letters and
digits.  The values' hashes are counted over the whole corpus by distinct
repositories and owners; copies of one text count as one repository.  A value
that more owners than the limit hold, or several owners in more repositories
than the limit, is a widely copied example; the others are owner-specific and
look live, a single owner's always.  Base spans are always reported, opaque ones where their value looks
live and they overlap no base span.

Only rows with candidates are grouped or joined; a value that very many
documents hold meets its count in a join of two staged tables, which AQE can
split.

Defined cases: a null text is empty; null owners and repositories count as one
owner or repository; equal rows give equal rows; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stage
from salesmart.llm.spans import SPAN, listed, matches, tagged

# The base patterns.  ``(?i:...)`` is ASCII only in Java; of its
# matches those with a value of six characters or more count.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "opaque")

_FOUND = "array<struct<rank:int,start:int,end:int,found:string>>"


def candidates(docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, repository, owner, ``page`` (the text's hash) and ``found``: all base and opaque matches."""

    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    opaque = F.filter(
        matches(t, OPAQUE), lambda s: (F.regexp_count(s["found"], F.lit("[0-9]")) >= 3) & (F.regexp_count(s["found"], F.lit("[A-Za-z]")) >= 3)
    )
    kinds = [F.filter(matches(t, ASSIGN, group=1), lambda s: F.length(s["found"]) >= 6), matches(t, ACCESS), matches(t, HEX), opaque]

    def ranked(spans, rank):
        return F.transform(spans, lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found")))

    found = F.concat(*[ranked(k, i) for i, k in enumerate(kinds)]).cast(_FOUND)
    return docs.select("doc_id", F.col(f"`{repository}`").cast("string").alias("repository"), F.col(f"`{owner}`").cast("string").alias("owner"), F.xxhash64(t).alias("page"), found.alias("found"))


def scan(docs: DataFrame, max_owners: int = 3, max_repositories: int = 50, **columns: str) -> DataFrame:
    """doc_id, base and spans (arrays of start, rank, end, kind), n_live and
    n_shared (spans by the frequency of their value), one row per document."""

    found = stage(candidates(docs, **columns), "secret-candidates")
    some = F.size("found") > 0
    units = found.filter(some).groupBy("doc_id", "repository", "owner", "page", "found").agg(F.count(F.lit(1)).alias("rows"))
    units = stage(units.withColumn("unit", F.sha2(F.to_json(F.struct("doc_id", "repository", "owner", "page", "found")), 256)), "secret-units")
    each = units.select("unit", "repository", "owner", F.col("page").cast("string").alias("page"), F.posexplode("found").alias("at", "span")).withColumn("value", F.sha2(F.col("span.found"), 256))
    # distinct (value, owner), (value, repository) and (value, page) first, so a value held everywhere is one row per holder and task
    sides = [F.struct(F.lit(i).alias("side"), F.col(c).alias("by")) for i, c in enumerate(("owner", "repository", "page"))]
    held = each.select("value", F.explode(F.array(*sides)).alias("h"))
    held = held.groupBy("value", "h.side", "h.by").agg(F.lit(1).alias("one")).groupBy("value").agg(
        F.count_if(F.col("side") == 0).alias("owners"),
        F.least(F.count_if(F.col("side") == 1), F.count_if(F.col("side") == 2)).alias("repositories"),
    )
    held = stage(held, "secret-frequency")
    live = (F.col("owners") <= max_owners) & ((F.col("owners") == 1) | (F.col("repositories") <= max_repositories))
    flags = (
        each.select("unit", "at", "value")
        .join(held, "value")
        .groupBy("unit")
        .agg(F.collect_list(F.when(live, F.col("at"))).alias("live"), F.count_if(~live).alias("n_shared"))
    )

    def as_spans(rows, keep=None):
        return F.transform(rows, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1).alias("kind"))).cast(SPAN)

    base = F.filter("found", lambda s: s["rank"] < 3)
    own = F.filter(
        "found",
        lambda s, i: (s["rank"] == 3)
        & F.array_contains("live", i)
        & ~F.exists("found", lambda b: (b["rank"] < 3) & (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    hits = units.join(flags, "unit").select(
        "doc_id",
        as_spans(base).alias("base"),
        F.sort_array(F.concat(as_spans(base), as_spans(own))).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.col("n_shared").cast("long").alias("n_shared"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_copy"),
    )
    none = F.array().cast(SPAN)
    clean = found.filter(~some).select("doc_id", none.alias("base"), none.alias("spans"), F.lit(0).cast("long").alias("n_live"), F.lit(0).cast("long").alias("n_shared"))
    return hits.drop("_copy").unionByName(clean)


def digest(scanned: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """The columns of a report: counts of base kinds, hash of the base spans,
    all spans as text, then the scan's other columns."""

    def of(kind: str):
        return F.filter("base", lambda s: s["kind"] == kind)

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    rest = [c for c in scanned.columns if c not in ("doc_id", "base", "spans")]
    return scanned.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), *rest)
