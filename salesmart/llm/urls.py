"""URL filter: temporal list join (operator 1).

A blocklist is a table of dated changes (an entry is listed or delisted on a
day).  Changes become validity intervals: from a listing to the entry's next
change.  A capture is looked up under every key its URL answers to (its host
and each parent domain, the host with the first path segment, the page), as of
its fetch day: an entry counts if it was active then, whatever the list says
today.

Captures are first counted by (URL, day), so a URL fetched very often is looked up
once; intervals and keys meet in an equi-join of two staged tables, which AQE
can split where very many captures share a host.

Defined cases: a null URL or one without scheme and host answers to no key and
is not blocked; a null fetch day is in no interval; several changes of an entry on
one day leave the listing in force, as a delisting sorts first; repeated captures give
repeated rows; repeated changes count once; empty tables are allowed; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stage

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def keys_of(url: Column) -> Column:
    """All list keys that a URL answers to: ``domain:`` the host and its
    parents of two labels or more, ``prefix:`` host and first path segment,
    ``page:`` host and path without query."""

    host, path = host_of(url), path_of(url)
    segment = F.regexp_extract(path, "^/([^/]+)", 1)
    labels = F.split(host, r"\.")
    # the host's last label alone is a public suffix and names no site
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.when(
        i < F.size(labels), F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ))
    others = F.array(
        F.when(segment != "", F.concat(F.lit("prefix:"), host, F.lit("/"), segment)), F.when(path != "", F.concat(F.lit("page:"), host, path))
    )
    return F.when(F.coalesce(host, F.lit("")) != "", F.array_distinct(F.array_compact(F.concat(domains, others)))).otherwise(F.array().cast("array<string>"))


def intervals(changes: DataFrame) -> DataFrame:
    """key, category, valid_from, valid_to (null: still listed) from the dated
    changes (key, category, day, listed)."""

    order = Window.partitionBy("key", "category").orderBy("day", "listed")
    changes = changes.select("key", "category", "day", "listed").filter("day is not null and key is not null").distinct()
    return (
        changes.withColumn("valid_to", F.lead("day").over(order))
        .filter("listed and (valid_to is null or valid_to > day)")
        .select("key", "category", F.col("day").alias("valid_from"), "valid_to")
    )


def filter_captures(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """capture_id, url, fetched, blocked, n_entries (entries active at fetch),
    categories (theirs, in order, comma-joined) and first_entry (the least key),
    one row per capture."""

    listed = stage(intervals(changes), "list-intervals")
    units = captures.groupBy("capture_id", "url", "fetched").agg(F.count(F.lit(1)).alias("rows"))
    units = stage(units, "captures")
    looked = units.select("url", "fetched").distinct().withColumn("key", F.explode(keys_of(F.col("url"))))
    looked = stage(looked, "capture-keys")
    active = (F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    found = looked.join(listed, "key").filter(active).groupBy("url", "fetched").agg(
        F.count(F.lit(1)).alias("n_entries"), F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"), F.min("key").alias("first_entry")
    )
    found = stage(found, "capture-verdicts").withColumnsRenamed({"url": "_u", "fetched": "_f"})
    both = units.join(found, (F.col("url") == F.col("_u")) & (F.col("fetched") == F.col("_f")), "left")
    return both.select(
        "capture_id", "url", "fetched", F.col("n_entries").isNotNull().alias("blocked"), F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("categories", F.lit("")).alias("categories"), "first_entry", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_copy"),
    ).drop("_copy")


# --- captures and a list derived from the table of pages ---------------------


def page_captures(pages: DataFrame) -> DataFrame:
    """Each page as a capture, fetched on a day of 2024 that follows from its id."""

    day = (F.coalesce(F.col("page_id"), F.lit(0)) * 37 % 366).cast("int")
    return pages.select(F.col("page_id").alias("capture_id"), "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched"))


def page_list(pages: DataFrame) -> DataFrame:
    """Dated changes for about a quarter of the hosts, host prefixes and pages
    that the pages name: listed, delisted and listed again on days that follow
    from the entry's md5."""

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    segment = F.regexp_extract(path, "^/([^/]+)", 1)
    names = F.array_compact(
        F.array(
            F.when(~host.startswith("www."), F.concat(F.lit("domain:"), host)),
            F.when(segment != "", F.concat(F.lit("prefix:"), host, F.lit("/"), segment)),
            F.when(path != "", F.concat(F.lit("page:"), host, path)),
        )
    )
    entries = pages.filter(host != "").select(F.explode(names).alias("key")).distinct().withColumn("m", F.md5("key"))
    digit = lambda i: F.instr(F.lit("0123456789abcdef"), F.substring("m", i, 1))
    entries = entries.filter(F.substring("m", 1, 1).isin("0", "1", "2", "3"))
    a, b = (digit(3) - 1) * 16 + digit(4) - 1, digit(5) - 1
    change = F.explode(F.array(
        F.struct(a.alias("day"), F.lit(True).alias("listed")), F.struct((a + 40 + b).alias("day"), F.lit(False).alias("listed")), F.struct((a + 90 + 2 * b).alias("day"), F.lit(True).alias("listed"))
    ))
    category = F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam", "piracy"))), digit(2) % 4 + 1)
    return entries.select("key", category.alias("category"), change.alias("c")).select(
        "key", "category", F.date_add(F.lit("2024-01-01").cast("date"), F.col("c.day").cast("int")).alias("day"), "c.listed"
    )


