"""Staging, joins and text helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.staging import BROADCAST_ROWS, bound, broadcast_checked, shared_dir, stage  # noqa: F401 - the operators take them from here

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of ``keys``; the right side names them ``_k_<key>``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_k_{k}"])
    return cond


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``table`` (at most one row per key) null-safely.

    ``table`` must not share non-key column names with ``rows``.
    """
    right = table.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return rows.join(right, same(rows, right, keys), how).drop(*[f"_k_{k}" for k in keys])


def keep_rows(docs: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` occur in ``kept``; all columns of docs stay."""
    right = kept.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return docs.join(right, same(docs, right, keys), "left_semi")


def running(values: Column, start: Column, f: Callable[[Column, Column], Column], block: int = 64) -> Column:
    """The running results of an associative ``f`` over an array, ``start`` being neutral.

    Appending to an array copies it, so the results are built in blocks, and
    the blocks' last results are carried over: n values cost about
    n x ``block`` copies, not n x n.
    """

    def fold(part: Column) -> Column:
        empty = F.struct(F.slice(F.array(start), 1, 0).alias("all"), start.alias("last"))
        step = lambda a, x: bound(f(a["last"], x), lambda y: F.struct(F.array_append(a["all"], y).alias("all"), y.alias("last")))
        return F.aggregate(part, empty, step, lambda a: a["all"])

    def carried(parts: Column) -> Column:
        totals = fold(F.transform(parts, lambda p: F.element_at(p, -1)))
        return F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(bound(F.get(totals, i - 1), lambda t: F.transform(p, lambda x: f(t, x))))))

    def blocks(whole: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(whole), F.lit(block))
        return F.when(F.size(whole) == 0, whole).when(F.size(whole) <= block, fold(whole)).otherwise(bound(F.transform(starts, lambda i: fold(F.slice(whole, i, block))), carried))

    return bound(values, blocks)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def sample_documents(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``h, text`` of the ``n`` documents whose ids have the smallest hashes: a bounded sample for training.

    Only hashes are ordered; texts are read by a filter on the largest of them.
    Rows that share an id count once, with their smallest text.
    """
    h = F.xxhash64(F.col(id_col).cast("string"))
    largest = docs.select(h.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    few = docs.select(h.alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return few.filter(F.col("h") <= F.lit(largest)).groupBy("h").agg(F.min("text").alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
