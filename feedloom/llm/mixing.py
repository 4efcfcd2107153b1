"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key whose rate is its quality weight
(Efraimidis-Spirakis); sorted by key, a source's documents are a weighted
random order.  A source's target is met by whole epochs first; what is left is
the prefix of that order whose sizes add up to it, and the document that
crosses the end gives only its first words.  Keys come from a hash of the id,
so reruns agree.

The prefix sums need no sort of a whole source: keys map monotonically to
4096 x 4096 buckets of their logarithm, whose width no scale of the weights
changes, sizes are summed per bucket (map-side combined), a window over at most
4096 buckets finds the one that crosses, once per digit, and only the rows of
that last bucket, some two in a million of a source, are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import WORD, broadcast_checked, lookup, stage, text_or_empty

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix's size as a share of all sizes, and the most epochs of a source.
SHARE, MOST = 1.5, 2
BUCKETS = 4096
#: Logarithms of keys that the buckets span; the end buckets take what lies beyond.
LOG_LOW, LOG_HIGH = -40.0, 40.0
SEED = "mix-1"
#: Characters that lower a document's default quality weight.
SYMBOLS = "#*$%&|<>"


def n_words(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def quality_weight(col: str = "text") -> Column:
    """The default weight: near 1 for prose, lower the more symbols a text has."""
    text = text_or_empty(col)
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * symbols.cast("double") / (F.lit(1) + F.length(text)).cast("double"))


def key(id_col: str, weight: Column, seed: str = SEED, text_col: str = "text") -> Column:
    """The exponential key: 52 bits of a hash of the id as a uniform number.

    Rows without an id draw by their text, so that they do not share one key.
    """
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(text_or_empty(text_col).cast("binary"))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 13), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(2**52))) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Targets share ``share`` of all sizes by weight; none exceeds ``most`` times
    its source, and the excess is shared anew by weight.  In the order of cap
    per weight the capped sources are a prefix, so the level of the others
    comes from prefix sums.  This table has one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn("rank", F.row_number().over(order)).withColumn("weight", F.element_at(nth, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    before, whole = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.withColumns(
        {
            "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights_from": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "budget": F.sum("source_size").over(whole) * F.lit(share),
            "place": F.row_number().over(by_cap),
        }
    )
    rows = rows.withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weights_from"))
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))).over(whole)
    rows = rows.withColumn("held", first["level"])
    return rows.select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("held") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def _buckets(k: Column) -> tuple[Column, Column]:
    at = F.greatest(F.lit(0.0), (F.log(k) - LOG_LOW) / (LOG_HIGH - LOG_LOW) * BUCKETS)
    one = F.least(F.floor(at), F.lit(BUCKETS - 1))
    two = F.greatest(F.lit(0), F.least(F.floor((at - one) * BUCKETS), F.lit(BUCKETS - 1)))
    return one, two


def _crossing(sums: DataFrame, bucket: str) -> DataFrame:
    """Per source the bucket in which ``rest`` is passed, and what of it remains.

    ``sums``: source, ``bucket``, size, rest.
    """
    before = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    cum = sums.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return (
        cum.filter(F.col("before") + F.col("size") > F.col("rest"))
        .groupBy("source")
        .agg(F.min(F.struct(bucket, (F.col("rest") - F.col("before")).alias("rest"))).alias("x"))
        .select("source", F.col(f"x.{bucket}").alias(bucket), F.col("x.rest").alias("rest"))
    )


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source from rows ``source, size, key``.

    ``source, source_size, target, epochs, x1, x2, rest``: whole epochs, then
    the bucket that crosses and the words still due inside it.
    """
    one, two = _buckets(F.col("key"))
    rows = sized.select("source", "size", one.alias("b1"), two.alias("b2"))
    first = stage(rows.groupBy("source", "b1").agg(F.sum("size").alias("size")), "sums")
    sizes = first.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = source_targets(sizes, weights, share, most)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goal = stage(goal.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size")), "targets")
    small = broadcast_checked(goal)
    x1 = stage(_crossing(lookup(first, small.select("source", "rest"), ["source"]), "b1"), "crossing")
    at = x1.select("source", F.col("b1").alias("x1"), "rest")
    inside = lookup(rows, broadcast_checked(at), ["source"], "inner").filter(F.col("b1") == F.col("x1"))
    second = inside.groupBy("source", "b2").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    x2 = _crossing(second, "b2").withColumnsRenamed({"b2": "x2"})
    edge = lookup(at.drop("rest"), x2, ["source"])
    return stage(lookup(goal.drop("rest"), edge, ["source"]), "plan")


def mix(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``source_size, target, epochs, extra, taken`` to rows with ``doc_id, source, size, key``.

    ``extra`` is what the document gives beyond whole epochs, in words.
    """
    one, two = _buckets(F.col("key"))
    rows = lookup(rows.withColumns({"b1": one, "b2": two}), broadcast_checked(sources), ["source"])
    place = F.when(F.col("x1").isNull() | (F.col("b1") > F.col("x1")), 1).when(F.col("b1") < F.col("x1"), -1)
    place = place.when(F.col("x2").isNull() | (F.col("b2") > F.col("x2")), 1).when(F.col("b2") < F.col("x2"), -1).otherwise(0)
    rows = rows.withColumn("place", place)
    clear = rows.filter("place <> 0").withColumn("extra", F.when(F.col("place") < 0, F.col("size")).otherwise(F.lit(0)))
    before = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    due = F.col("rest") - F.coalesce(F.sum("size").over(before), F.lit(0))
    edge = rows.filter("place = 0").withColumn("extra", F.greatest(F.lit(0), F.least("size", due)))
    out = clear.unionByName(edge).drop("b1", "b2", "x1", "x2", "rest", "place")
    return out.withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None) -> DataFrame:
    """``doc_id, source, size, key`` of each document."""
    w = quality_weight(text_col) if weight is None else weight
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), key(id_col, w, text_col=text_col).alias("key"))


def mix_sizes(docs: DataFrame, **columns: str) -> DataFrame:
    """``doc_id, source, size, key, source_size, target, epochs, extra, taken`` for each document.

    Defined cases: a null text has size 0; a null source is a source of its
    own, last in order; a source without words has target 0; a null id draws
    its key by the text; repeated rows share a key and are
    mixed each; equal keys are
    ordered by id, then size; an empty table gives no rows.
    """
    rows = stage(sized(docs, **columns), "sized")
    return mix(rows, plan(rows))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document once per epoch, and once more for what it gives beyond.

    The rows have the columns of ``docs``.  The document that crosses its
    source's end keeps its first ``extra`` words with the white space before
    and between them.
    """
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        n_words().alias("size"),
        key("doc_id", quality_weight()).alias("key"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"),
    )
    sources = plan(stage(rows.select("source", "size", "key"), "sized"))
    out = mix(rows, sources)
    partial = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    runs = F.regexp_extract_all(text_or_empty("doc.text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    head = F.when(partial, F.array_join(F.slice(runs, 1, F.greatest(F.col("extra"), F.lit(1)).cast("int")), ""))
    copies = F.concat(
        F.array_repeat(F.lit(None).cast("string"), F.col("epochs").cast("int")),
        F.when(F.col("extra") > 0, F.array(head)).otherwise(F.array().cast("array<string>")),
    )
    spread = out.select("doc", F.explode(copies).alias("head"))
    return spread.select(*[F.coalesce("head", F.col("doc.text")).alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
