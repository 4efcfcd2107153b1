"""Event clusters over any number of titles: a similarity join and the greedy rule in rounds.

The rule: in order, a title joins the cluster of the most similar earlier
*head*, the first title of a cluster, if the similarity is at least
``threshold``; equals go to the earlier head; else it is a head itself.

:func:`relations.cluster_titles` folds a block of titles in one task.  Here no
block is needed.  Two titles are compared only if they can reach the
threshold, which takes one of two things:

* the scaled bigram coverage: of the smaller title's bigrams a known share is
  common, so its rarest ones, as many as may be missing and one more, hold a
  common one (prefix filter);
* the sequence ratio, at most twice the common characters over all, so the
  titles' characters, counted with repeats, overlap by a known share: the same
  filter on both sides, and neither is much longer than the other.

Where tokens are so common that this join would make more pairs than there are
titles to compare, as in prose of a few languages, all pairs are compared
instead, as arrays (:mod:`blocks`).

Who is a head depends on earlier heads alone.  Titles are resolved in parts of
the order: a part is as long as the pairs that its filters let through, counted
before they are made, stay within a budget.  In a part, a title without an
undecided earlier neighbour is a head, its neighbours are none, and so on in
rounds.  The part's heads then meet all later titles, and what they claim is no
head: of a group of a million copies only as many meet each other as the budget
holds, then one head meets the rest.

Equal keys are one row until the end, so a title that is most of the table is
one row too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.functions.text import bigrams, title_key
from feedloom.operators import blocks
from feedloom.operators.relations import Head
from feedloom.operators.staging import bound, broadcast_checked, stage

THRESHOLD, SCALE = 0.72, 0.72 / 0.55
#: Pairs before verification that a part may make, and at least this many for each title.
PAIR_BUDGET, PAIRS_PER_TITLE = 20_000_000, 200
EPS = 1e-9
#: Titles by which the way to compare is chosen, and pairs of arrays that cost as much as a pair of rows.
TRIED, PAIRS_PER_ROW = 2048, 4


def _characters(key: Column) -> Column:
    """The characters of a key with their number so far: ``a1 b1 a2``."""
    each = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.substring(key, i, F.lit(1)))
    return bound(F.array_sort(each), lambda chars: F.transform(chars, lambda c, i: F.concat(c, (i - F.array_position(chars, c) + 2).cast("string"))))


def _with_tokens(keys: DataFrame) -> DataFrame:
    return keys.withColumns({"grams": bigrams(F.col("key")), "chars": _characters(F.col("key"))})


def _tokens(keys: DataFrame, threshold: float, scale: float) -> DataFrame:
    """``at, last, kind, token, place, size, probe``: a key's tokens, rarest first; ``probe`` marks its prefix.

    Kind 0 are bigrams, kind 1 characters.  A key of one kind without tokens has none.
    """
    each = keys.select("at", "last", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("grams").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("chars").alias("t")))).alias("k"))
    flat = each.select("at", "last", "k.kind", F.size("k.t").alias("size"), F.explode("k.t").alias("token"))
    often = stage(flat.groupBy("kind", "token").agg(F.count("*").alias("often")), "token-counts")
    ranked = flat.join(broadcast_checked(often), ["kind", "token"])
    place = F.row_number().over(Window.partitionBy("at", "kind").orderBy("often", "token")) - 1  # tokens of one title
    least = F.when(F.col("kind") == 0, F.lit(threshold / scale)).otherwise(F.lit(threshold / (2 - threshold)))
    need = F.greatest(F.lit(1), F.ceil(least * F.col("size") - EPS))
    return ranked.withColumn("place", place).withColumn("probe", F.col("place") <= F.col("size") - need).drop("often")


def _possible(threshold: float, scale: float) -> Column:
    """Whether the pair ``p`` (in its prefix) and ``q`` can still reach the threshold at this common token."""
    rest = F.least(F.col("p.size") - F.col("p.place"), F.col("q.size") - F.col("q.place"))
    cover = (F.col("p.size") <= F.col("q.size")) & (rest >= (threshold / scale) * F.col("p.size") - EPS)
    ratio = F.col("q.probe") & (2 * rest >= threshold * (F.col("p.size") + F.col("q.size")) - EPS)
    return F.when(F.col("p.kind") == 0, cover).otherwise(ratio)


def _pairs(earlier: DataFrame, later: DataFrame, threshold: float, scale: float, both: bool) -> DataFrame:
    """``head, item``: distinct pairs that the filters let through, ``head`` from ``earlier``, in order of ``at``.

    ``both``: the two are the same rows.  Else each side probes the other.
    """

    def met(probes: DataFrame, index: DataFrame, head: str, item: str) -> DataFrame:
        joined = probes.filter("probe").alias("p").join(index.alias("q"), (F.col("p.kind") == F.col("q.kind")) & (F.col("p.token") == F.col("q.token")))
        return joined.filter(_possible(threshold, scale)).select(F.col(f"{head}.at").alias("head"), F.col(f"{item}.at").alias("item"), F.col(f"{item}.last").alias("last"))

    if both:
        one = met(earlier, later, "p", "q").filter("head <> item")
        return one.select(F.least("head", "item").alias("head"), F.greatest("head", "item").alias("item")).distinct()
    found = met(earlier, later, "p", "q").unionByName(met(later, earlier, "q", "p"))
    return found.filter("head <> item and last > head").select("head", "item").distinct()


def _verified(pairs: DataFrame, keys: DataFrame, threshold: float, scale: float) -> DataFrame:
    """``head, item, similarity`` of the pairs that reach the threshold, as the rule compares them.

    Common bigrams and characters are counted first, so that only pairs that
    can reach it by what they have in common are compared letter by letter.
    """
    columns = ["key", "grams", "chars"]
    named = lambda side: keys.select(F.col("at").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
    rows = pairs.join(named("head"), "head").join(named("item"), "item")
    common = lambda c: F.size(F.array_intersect(f"head_{c}", f"item_{c}"))
    size = lambda side, c: F.size(f"{side}_{c}")
    covers = common("grams") >= (threshold / scale) * F.least(size("head", "grams"), size("item", "grams")) - EPS
    alike = 2 * common("chars") >= threshold * (size("head", "chars") + size("item", "chars")) - EPS
    rows = rows.filter((F.least(size("head", "grams"), size("item", "grams")) > 0) & covers | alike)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, set[str]] = {}
        for rows in batches:
            found = []
            if len(grams) > 100_000:
                grams.clear()
            for (head, key), of in rows.groupby(["head", "head_key"], sort=False):
                h = Head(key, head)
                for item, other in zip(of["item"], of["item_key"], strict=True):
                    if other not in grams:
                        grams[other] = {other[i : i + 2] for i in range(len(other) - 1)}
                    s = h.beats(other, grams[other], threshold, 0.0, scale)
                    if s is not None:
                        found.append((head, item, s))
            if found:
                yield pd.DataFrame(found, columns=["head", "item", "similarity"])

    return rows.select("head", "head_key", "item", "item_key").mapInPandas(compare, "head long, item long, similarity double")


def _pairs_at_most(tokens: DataFrame) -> int:
    """Rows that the join of these tokens with themselves makes before its filters."""
    per = tokens.groupBy("kind", "token").agg(F.count_if("probe").cast("double").alias("p"), F.count("*").cast("double").alias("n"))
    return int(per.agg(F.coalesce(F.sum(F.col("p") * F.col("n")), F.lit(0.0))).first()[0])


def _heads_of_part(part: DataFrame, edges: DataFrame) -> DataFrame:
    """``at`` of the part's heads: the greedy rule over ``edges`` (``head < item``), in rounds."""
    heads = []
    while True:
        first = part.join(edges.select(F.col("item").alias("at")), "at", "left_anti")
        first = stage(first, "heads")
        heads.append(first)
        claimed = edges.join(first.select(F.col("at").alias("head")), "head", "left_semi").select(F.col("item").alias("at")).distinct()
        part = stage(part.join(first, "at", "left_anti").join(claimed, "at", "left_anti"), "undecided")
        if part.limit(1).count() == 0:
            break
        open_ = part.select("at")
        edges = stage(edges.join(open_.withColumnRenamed("at", "head"), "head", "left_semi").join(open_.withColumnRenamed("at", "item"), "item", "left_semi").select("head", "item"), "open-edges")
    out = heads[0]
    for h in heads[1:]:
        out = out.unionByName(h)
    return out


def _first_part(undecided: DataFrame, tokens: DataFrame, budget: int) -> tuple[DataFrame, DataFrame]:
    """The longest halving of the undecided titles whose pairs stay within the budget; one title at least."""
    part, its = undecided, tokens
    while _pairs_at_most(its) > budget:
        n = part.count()
        if n <= 1:
            break
        cut = part.agg(F.percentile_approx("at", 0.5, 10_000).alias("c")).first()["c"]
        cut = cut if part.filter(F.col("at") > cut).limit(1).count() else cut - 1
        part, its = part.filter(F.col("at") <= cut), its.filter(F.col("at") <= cut)
    return part, its


def tokens_are_common(keys: DataFrame, threshold: float = THRESHOLD, scale: float = SCALE) -> bool:
    """Whether a join on tokens costs more than to compare all pairs, by some titles' tokens; the result is the same either way."""
    some = stage(_with_tokens(keys.orderBy(F.xxhash64("key")).limit(TRIED)), "some-keys")
    n = some.count()
    return PAIRS_PER_ROW * _pairs_at_most(stage(_tokens(some, threshold, scale), "some-tokens")) > n * (n - 1) / 2


def head_edges(keys: DataFrame, threshold: float = THRESHOLD, scale: float = SCALE, pair_budget: int = PAIR_BUDGET, by_blocks: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """``at`` of all heads; and ``head, item, similarity`` of each key and the heads that it reaches.

    ``keys``: ``key`` (distinct, not empty), ``at`` and ``last``, the first and
    last place of each.  Edges are given where the key comes again after the head.
    ``by_blocks``: how titles are compared, where it is not left to :func:`tokens_are_common`.
    """
    keys = stage(keys, "keys")
    budget = max(pair_budget, PAIRS_PER_TITLE * keys.count())
    if by_blocks is None:
        by_blocks = tokens_are_common(keys, threshold, scale)
    if not by_blocks:
        keys = stage(_with_tokens(keys), "keys-with-tokens")
    # what is compared: keys as they are, or their tokens
    each = keys.select("at", "last", "key") if by_blocks else stage(_tokens(keys, threshold, scale), "tokens")

    def alike(earlier: DataFrame, later: DataFrame, both: bool) -> DataFrame:
        if by_blocks:
            return blocks.compared(earlier, later, threshold, scale, both)
        return _verified(_pairs(earlier, later, threshold, scale, both), keys, threshold, scale)

    undecided, heads, edges = keys.select("at"), None, None
    while undecided.limit(1).count():
        if by_blocks:
            part = stage(undecided.orderBy("at").limit((1 + math.isqrt(1 + 8 * budget)) // 2), "part")
            its = each.join(part, "at", "left_semi")
        else:
            part, its = _first_part(undecided, each.join(undecided, "at", "left_semi") if heads is not None else each, budget)
            part = stage(part, "part")
        within = stage(alike(its, its, both=True).select("head", "item"), "part-edges")
        new = stage(_heads_of_part(part, within), "part-heads")
        mine = each.join(new, "at", "left_semi")
        # what an earlier head claimed may still find a better one, unless it matches that head in full
        rest = each.filter(F.col("last") > new.agg(F.min("at")).first()[0])
        if edges is not None:
            rest = rest.join(edges.filter("similarity >= 1 and head < item").select(F.col("item").alias("at")).distinct(), "at", "left_anti")
        claims = stage(alike(mine, rest, both=False), "claims")
        heads = new if heads is None else heads.unionByName(new)
        edges = claims if edges is None else edges.unionByName(claims)
        claimed = claims.filter("head < item").select(F.col("item").alias("at")).distinct()
        undecided = stage(undecided.join(part, "at", "left_anti").join(claimed, "at", "left_anti"), "undecided")
    if heads is None:
        empty = keys.sparkSession.createDataFrame([], "head long, item long, similarity double")
        return keys.select("at"), empty
    return heads, edges


def cluster(df: DataFrame, title: str = "title", order: str = "ordinal", threshold: float = THRESHOLD, scale: float = SCALE, pair_budget: int = PAIR_BUDGET) -> DataFrame:
    """Add ``cluster``, the ``order`` of the head of each title's cluster.

    ``order`` is a whole number, different for each row.  Titles without a key
    (null, empty, punctuation alone) are clusters of their own.
    """
    keyed = stage(df.withColumn("_key", title_key(F.col(title))), "titles")
    keys = keyed.filter("_key <> ''").groupBy(F.col("_key").alias("key")).agg(F.min(order).alias("at"), F.max(order).alias("last"))
    keys = stage(keys, "first-places")
    heads, edges = head_edges(keys, threshold, scale, pair_budget)
    heads, edges = stage(heads, "all-heads"), stage(edges, "all-edges")
    # nothing beats a full match, so what comes after a key's first one is of no use
    full = edges.filter("similarity >= 1").groupBy("item").agg(F.min("head").alias("_full"))
    use = edges.join(full, "item", "left").filter("_full is null or head <= _full").join(heads.select(F.col("at").alias("item")), "item", "left_anti")
    best = F.max("similarity").over(Window.partitionBy("item").orderBy("head").rowsBetween(Window.unboundedPreceding, -1))
    rises = use.withColumn("_before", best).filter("_before is null or similarity > _before")
    until = F.lead("head").over(Window.partitionBy("item").orderBy("head"))
    spans = rises.select("item", F.col("head").alias("_from"), until.alias("_until"))
    own = heads.select(F.col("at").alias("item"), F.col("at").alias("_from"), F.lit(None).cast("long").alias("_until"))
    timeline = spans.unionByName(own).join(keys.select(F.col("at").alias("item"), F.col("key").alias("_k")), "item").select("_k", "_from", "_until")
    timeline = stage(timeline, "timeline")
    at = F.col(order)
    within = (F.col("_key") == F.col("_k")) & (at >= F.col("_from")) & (F.col("_until").isNull() | (at <= F.col("_until")))
    return keyed.join(broadcast_checked(timeline), within, "left").withColumn("cluster", F.coalesce("_from", at)).drop("_key", "_k", "_from", "_until")
