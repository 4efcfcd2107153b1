"""Spans of regular expressions in whole texts, with SQL functions only and inside one row.

A text is cut once by ``regexp_extract_all`` (the matches) and once by
``split`` (what lies between them); a running sum over the pieces' lengths
gives code point offsets.  Nothing is shuffled: a document's spans are an array
in its own row.  Patterns use possessive quantifiers and look-behinds, so that
long runs of one character class cost linear time; each note says why the
matches stay the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import bound, running


@dataclass(frozen=True)
class Kind:
    """``guard`` is a cheap necessary condition on the text; ``valid`` a condition on the match."""

    name: str
    regex: str
    guard: str
    valid: Callable[[Column], Column] | None = None
    #: Whether ``before`` is given: the last three pieces, cut at white space, of what lies between the last match and this one.
    lead: bool = False


SPAN = "struct<kind:int,start:bigint,end:bigint,match:string,before:array<string>>"


def _found(no: int, kind: Kind) -> Column:
    text = F.col("text")

    def before(gap: Column) -> Column:
        if not kind.lead:
            return F.lit(None).cast("array<string>")
        return F.slice(F.concat(F.array(F.lit(""), F.lit("")), F.split(F.lower(gap), r"[\x20\x09-\x0D]+", -1)), -3, 3)

    def placed(pieces: Column) -> Column:
        steps = F.transform(pieces, lambda p: (F.length(p["g"]) + F.length(p["m"])).cast("long"))
        rows = F.zip_with(pieces, running(steps, F.lit(0).cast("long"), lambda a, b: a + b), lambda p, end: F.struct(end.alias("end"), p["m"].alias("m"), p["g"].alias("g")))
        good = rows if kind.valid is None else F.filter(rows, lambda r: kind.valid(r["m"]))
        return F.transform(good, lambda r: F.struct(F.lit(no).alias("kind"), (r["end"] - F.length(r["m"])).alias("start"), r["end"].alias("end"), r["m"].alias("match"), before(r["g"]).alias("before")))

    def cut(matches: Column) -> Column:
        # the text behind the last match is no gap
        gaps = F.slice(F.split(text, kind.regex, -1), 1, F.size(matches))
        pieces = F.zip_with(matches, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))
        return F.when(F.size(matches) > 0, bound(pieces, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))

    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.expr(kind.guard), bound(F.regexp_extract_all(text, F.lit(kind.regex), F.lit(0)), cut)).otherwise(none)


def scan(docs: DataFrame, kinds: list[Kind], base: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, own, more``: arrays of ``kind, start, end, match, before``, one row per row of ``docs``.

    ``own`` holds the valid matches of the first ``base`` kinds, ``more`` those
    of the others; ``kind`` is the number in ``kinds``; positions are code
    points, the end exclusive.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    groups = {"own": kinds[:base], "more": kinds[base:]}
    arrays = {n: F.concat(*[_found(kinds.index(k), k) for k in ks]) for n, ks in groups.items()}
    return rows.select("doc_id", *[a.alias(n) for n, a in arrays.items()])


def apart(items: Column, fixed: Column) -> Column:
    """Those of ``items`` that overlap none of ``fixed``; both are arrays of structs with ``start`` and ``end``.

    Both are sorted together by start; an item overlaps iff the furthest end of
    what is fixed up to it passes its start, or the next fixed start lies
    before its end.  The items come back in order of their starts.
    """
    low, high = F.lit(-(2**62)).cast("long"), F.lit(2**62).cast("long")
    free = lambda p: F.struct(p["start"].cast("long").alias("start"), F.lit(1).alias("free"), p["end"].cast("long").alias("end"), p.alias("item"))

    def judged(both: Column) -> Column:
        reach = running(F.transform(both, lambda p: F.when(p["free"] == 0, p["end"]).otherwise(low)), low, F.greatest)
        ahead = F.reverse(running(F.reverse(F.transform(both, lambda p: F.when(p["free"] == 0, p["start"]).otherwise(high))), high, F.least))
        marked = F.arrays_zip(both.alias("p"), reach.alias("reach"), ahead.alias("ahead"))
        left = F.filter(marked, lambda m: (m["p"]["free"] == 1) & (m["reach"] <= m["p"]["start"]) & (m["ahead"] >= m["p"]["end"]))
        return F.transform(left, lambda m: m["p"]["item"])

    def sort(pair: Column) -> Column:
        def together(nothing: Column) -> Column:
            held = lambda p: F.struct(p["start"].cast("long").alias("start"), F.lit(0).alias("free"), p["end"].cast("long").alias("end"), F.get(nothing, F.lit(0)).alias("item"))
            return F.sort_array(F.concat(F.transform(pair["items"], free), F.transform(pair["fixed"], held)))

        return bound(bound(F.filter(pair["items"], lambda p: F.lit(False)), together), judged)

    both = F.struct(items.alias("items"), fixed.alias("fixed"))
    return bound(both, lambda b: F.when((F.size(b["items"]) == 0) | (F.size(b["fixed"]) == 0), b["items"]).otherwise(sort(b)))


def joined(spans: Column, names: list[str], by_kind: bool) -> Column:
    """``kind:start:end`` of an array of (kind, start, end), comma-joined, in order of kind and start or of start and kind."""
    label = F.array(*[F.lit(n) for n in names])
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"]) if by_kind else F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.get(label, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(rows: DataFrame, names: list[str], base: int, by_kind: bool) -> DataFrame:
    """One row per document: counts of the base kinds, hash of the base spans, all spans.

    ``rows``: ``doc_id, own, added``, arrays with ``kind, start, end``.
    """
    plain = lambda c: F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def number(kind: int) -> Column:
        return F.size(F.filter("own", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{n}") for i, n in enumerate(names[:base])]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("own"), names, by_kind), 256).alias("base_sha256"),
        joined(F.concat(plain(F.col("own")), plain(F.col("added"))), names, by_kind).alias("spans"),
    )
