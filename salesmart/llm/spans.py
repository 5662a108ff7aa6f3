"""Regex matches with their places, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_RUN = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""

    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda n, x: n + x)


def sums_before(a: Column) -> Column:
    """For each number of the array the sum of those before it.

    Runs of 64 are summed first, so a text with very many matches costs about
    64 steps a match and not their square."""

    def whole_runs(runs: Column) -> Column:
        return let(
            F.transform(F.sequence(F.lit(0), F.size(runs) - 1), lambda i: _sum(F.slice(runs, F.lit(1), i))),
            lambda before: F.transform(
                a,
                lambda _, i: F.get(before, F.floor(i / _RUN).cast("int"))
                + _sum(F.slice(a, (F.floor(i / _RUN) * _RUN + 1).cast("int"), (i % _RUN).cast("int"))),
            ),
        )

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _RUN).cast("int")), lambda r: _sum(F.slice(a, r * _RUN + 1, F.lit(_RUN))))
    return F.when(F.size(a) > 0, let(runs, whole_runs)).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str, group: int = 0, around: int = 0) -> Column:
    """Leftmost non-overlapping matches of a Java pattern that matches no empty
    text: array of (start, end, found), code points, end exclusive, ``found``
    the group's text; with ``around`` also that many characters ``before`` and
    ``after`` the match at most (up to the neighbouring matches)."""

    def place(gaps: Column, hits: Column, found: Column) -> Column:
        lengths = F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))

        def one(h: Column, i: Column, before: Column) -> Column:
            start = F.get(before, i) + F.length(F.get(gaps, i))
            fields = [start.alias("start"), (start + F.length(h)).alias("end"), F.get(found, i).alias("found")]
            if around:
                fields += [F.right(F.get(gaps, i), F.lit(around)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(around)).alias("after")]
            return F.struct(*fields)

        return let(lengths, lambda ls: let(sums_before(ls), lambda before: F.transform(hits, lambda h, i: one(h, i, before))))

    def all_matches(found: Column) -> Column:
        return let(
            F.split(text, pattern, -1),
            lambda gaps: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: place(gaps, hits, found)),
        )

    placed = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), all_matches)
    kind = "array<struct<start:int,end:int,found:string" + (",before:string,after:string" if around else "") + ">>"
    return F.when(F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False)), placed.cast(kind)).otherwise(F.array().cast(kind))


def tagged(spans: Column, rank: int, kind: str) -> Column:
    """(start, rank, end, kind) of each span: the natural order is by start, then kind."""

    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def listed(spans: Column) -> Column:
    """kind:start:end of the spans in order, comma-joined."""

    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by [KIND]; spans that overlap are one
    replacement under the first one's kind."""

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), last["rank"].alias("rank"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(done) > 0) & (last["end"] > s["start"]), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(s))
        )

    def cut(merged: Column) -> Column:
        pieces = F.transform(
            merged,
            lambda s, i: F.concat(
                F.substring(text, F.when(i == 0, 0).otherwise(F.get(merged, i - 1)["end"]) + 1, s["start"] - F.when(i == 0, 0).otherwise(F.get(merged, i - 1)["end"])),
                F.lit("["),
                F.upper(s["kind"]),
                F.lit("]"),
            ),
        )
        return F.concat(F.array_join(pieces, ""), F.substring(text, F.element_at(merged, -1)["end"] + 1, F.length(text)))

    merged = F.aggregate(F.sort_array(spans), F.array().cast(SPAN), merge)
    return F.when(F.size(spans) > 0, let(merged, cut)).otherwise(text)
