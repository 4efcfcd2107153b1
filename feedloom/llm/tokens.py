"""Token ids of a public byte-level BPE vocabulary, and the exact length histogram.

Ids are those of the ``tokenizers`` library for the vocabulary's JSON file with
``add_special_tokens=False``.  The same ranks run through ``tiktoken``, which
gives the same ids several times faster; a text that spells out a special
token goes to ``tokenizers`` itself.  Tests compare the two.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import stage

#: Vocabulary name in the public tokenizers' folder.
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY) -> Callable[[str | None], np.ndarray]:
    """Text to an array of little-endian unsigned 32-bit ids; null gives none."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact: list[Tokenizer] = []

    def ids(text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<u4")
        if SPECIAL in text:
            if not exact:
                exact.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return ids


def length_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``length, n_docs``: documents of each encoded length, counted in the task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen = encoder(vocabulary), Counter()
        for b in batches:
            seen.update(len(ids(t.as_py())) for t in b.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["length", "n_docs"])

    counted = docs.select(text_col).mapInArrow(count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def histogram(counts: DataFrame, block: int = 64) -> DataFrame:
    """Suffix sums over exact lengths.

    ``length, n_docs, docs_at_least, tokens_at_least, docs_up_to,
    truncated_total``: the documents and tokens of this length or longer, the
    documents up to it, and all tokens when every document is cut at it.

    The sums run within blocks of ``block`` lengths and over the blocks'
    totals, so no task holds all lengths.  An empty table gives no rows; null
    and empty texts have length 0.
    """
    counts = stage(counts, "lengths")  # two branches below read it
    rows = counts.withColumns({"block": F.floor(F.col("length") / block), "tokens": F.col("length") * F.col("n_docs")})
    total = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = total.select(
        F.col("block").alias("_block"),
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d_before"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t_before"),
    )
    joined = rows.join(offset, rows["block"] == offset["_block"])
    down = Window.partitionBy("block").orderBy(F.desc("length"))
    up = Window.partitionBy("block").orderBy("length")
    return joined.select(
        "length",
        "n_docs",
        (F.col("d_after") + F.sum("n_docs").over(down)).alias("docs_at_least"),
        (F.col("t_after") + F.sum("tokens").over(down)).alias("tokens_at_least"),
        (F.col("d_before") + F.sum("n_docs").over(up)).alias("docs_up_to"),
        (F.col("t_before") + F.sum("tokens").over(up) + F.col("length") * (F.col("d_after") + F.sum("n_docs").over(down) - F.col("n_docs"))).alias("truncated_total"),
    )


def _answers(hist: DataFrame, name: str, asked: list, kind: str, found: list[Column]) -> DataFrame:
    """One row per question from one aggregate over the histogram, an expression each."""
    told = F.array(*[F.struct(F.lit(q).cast(kind).alias(name), e.alias("got")) for q, e in zip(asked, found, strict=True)]) if asked else F.array().cast(f"array<struct<{name}: {kind}, got: string>>")
    return hist.agg(told.alias("told")).select(F.explode("told").alias("x")).select(f"x.{name}", "x.got")


def totals(hist: DataFrame, contexts: list[int]) -> DataFrame:
    """``context, tokens, truncated_docs`` for each context limit.

    The suffix sums of the next longer length answer a limit: what lies above
    it is cut to the limit, the rest is whole.  Limits without documents have 0.
    """
    whole, none = F.coalesce(F.max("tokens_at_least"), F.lit(0)), F.struct(F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("t"))

    def above(limit: int) -> Column:
        longer = F.col("length") > limit
        got = F.coalesce(F.min_by(F.when(longer, F.struct(F.col("docs_at_least").alias("d"), F.col("tokens_at_least").alias("t"))), F.when(longer, F.col("length"))), none)
        return F.struct((whole - got["t"] + limit * got["d"]).alias("tokens"), got["d"].alias("truncated_docs"))

    return _answers(hist, "context", [int(c) for c in contexts], "long", [above(int(c)) for c in contexts]).select("context", "got.tokens", "got.truncated_docs")


def quantiles(hist: DataFrame, at: list[float]) -> DataFrame:
    """``quantile, length``: the smallest length that holds at least that share of documents; no row for an empty table."""
    docs = hist.agg(F.max("docs_up_to")).first()[0]
    if docs is None:
        return hist.sparkSession.createDataFrame([], "quantile double, length long")
    first = [F.min(F.when(F.col("docs_up_to") >= float(q) * docs, F.col("length"))) for q in at]
    return _answers(hist, "quantile", [float(q) for q in at], "double", first).select("quantile", F.col("got").alias("length")).filter("length is not null")
