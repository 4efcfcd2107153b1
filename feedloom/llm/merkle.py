"""A Merkle manifest of a table of documents: checkpoint some levels, recompute the others for proofs.

Each row is a leaf; the leaves of a language, in the order of their ids, form
a tree of runs of ``ARITY`` nodes, and the languages' roots form one more.
Stored are only the leaves and every ``STRIDE``-th level above them, cut into
aligned subtrees of ``ARITY ** STRIDE`` nodes, one row each.  Proofs regenerate
the levels in between from the stored nodes of a subtree, give each node its
siblings, and keep none of them.

How it runs: leaves are hashed where their rows are read and written once;
after that only digests move.  Places are counted by ranges of
(language, id): rows are sorted in ranges, and prefix sums of the ranges'
counts number them, so a language that holds most rows is still spread over
all tasks.  A subtree is one group of at most 512 nodes; a proof meets its
subtree's own proof by a join of subtrees, not of documents.  The number of
passes is the logarithm of the largest language to base 512.

``H`` is the lowercase hexadecimal SHA-256 of its inputs joined, where digests
are their hexadecimal text.

Defined cases: any column of a leaf may be null; a null language is one of its
own, first in order; null ids come first in their language; rows of equal id
are ordered by their leaf; equal rows are equal leaves, each with its own
place.  A single document has an empty proof; an empty table has no root and
no rows.  Columns that a leaf does not name are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import bound, broadcast_checked, lookup, stage

#: Nodes of a run, and levels from one stored level to the next.
ARITY, STRIDE = 8, 3
SUBTREE = ARITY**STRIDE
#: Columns of a leaf, in order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
#: Rows of a range in which places are counted.
RANGE_ROWS = 1 << 20

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_digest(values: list[Column]) -> Column:
    """``H`` of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def placed(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``place``, from 0, in each ``group`` by ``order``, and the group's ``size``; ``nodes`` is staged."""
    n = max(1, -(-nodes.count() // RANGE_ROWS), nodes.sparkSession.sparkContext.defaultParallelism)
    ranges = nodes.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    rows = stage(ranges.withColumn("_at", F.monotonically_increasing_id()), "placed")
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stage(counts.select(group, "_range", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")), "ranges")
    met = lookup(rows, broadcast_checked(starts), [group, "_range"], "inner")
    return met.withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _runs(nodes: Column) -> Column:
    """The level above: ``H`` of each run of nodes."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY))
    return F.transform(starts, lambda i: digest(F.array_join(F.slice(nodes, i, ARITY), "")))


def levels(nodes: Column, size: Column) -> Column:
    """All levels of a subtree from its lowest nodes up to its top, as an array of arrays.

    ``size``: nodes of the whole group on the lowest level, which tells how
    many of the levels above there are.
    """

    def one_more(below: int):
        return lambda got: F.when(size > ARITY**below, F.array_append(got, _runs(F.element_at(got, -1)))).otherwise(got)

    out = F.array(nodes)
    for below in range(STRIDE):
        out = bound(out, one_more(below))
    return out


def siblings(got: Column, at: Column) -> Column:
    """``before, after`` of the node ``at`` (from 0) of a subtree on each level but the top, from its :func:`levels`."""

    def one(level: Column, i: Column) -> Column:
        place = F.floor(at / F.pow(F.lit(ARITY), i)).cast("int")
        first = (place - place % ARITY).cast("int")
        return F.struct(
            F.array_join(F.slice(level, first + 1, place - first), "").alias("before"),
            F.array_join(F.slice(level, place + 2, first + ARITY - 1 - place), "").alias("after"),
        )

    return F.transform(F.slice(got, 1, F.size(got) - 1), one)


class Tree(NamedTuple):
    """Stored subtrees, lowest first: ``group, block, size, nodes``, one row a subtree; and each group's ``root``."""

    stored: list[DataFrame]
    roots: DataFrame


def grow(nodes: DataFrame, group: str, carried: list[str]) -> Tree:
    """The tree of each group; ``nodes``: ``group, place, size, node`` and what leaves carry besides."""
    stored: list[DataFrame] = []
    extra = carried
    while True:
        member = F.struct("place", "node", *extra)
        blocks = nodes.groupBy(group, F.floor(F.col("place") / SUBTREE).alias("block"), "size").agg(F.sort_array(F.collect_list(member)).alias("nodes"))
        stored.append(stage(blocks, f"subtrees-{len(stored)}"))
        top = F.element_at(F.element_at(levels(F.transform("nodes", lambda x: x["node"]), F.col("size")), -1), 1)
        tops = stored[-1].select(group, F.col("block").alias("place"), "size", top.alias("node"))
        nodes = stage(tops.withColumn("size", F.ceil(F.col("size") / SUBTREE)), f"tops-{len(stored)}")
        extra = []
        if nodes.filter("size > 1").limit(1).count() == 0:
            return Tree(stored, nodes.select(group, F.col("node").alias("root")))


def with_siblings(tree: Tree, group: str, above: DataFrame | None = None) -> DataFrame:
    """Every stored lowest node with its whole proof: ``group, node, place, ..., proof``.

    ``above``: ``group, proof`` to put behind each, the proof of the group's root.
    Subtrees take the proof of their top before their nodes are unfolded.
    """
    proofs: DataFrame | None = None
    for blocks in reversed(tree.stored):
        if proofs is not None:
            rows = lookup(blocks, proofs.select(group, F.col("place").alias("block"), F.col("proof").alias("_above")), [group, "block"])
        elif above is not None:
            rows = lookup(blocks, above.select(group, F.col("proof").alias("_above")), [group])
        else:
            rows = blocks.withColumn("_above", F.array().cast("array<struct<before string, after string>>"))
        # bound in a lambda: regenerated once a subtree, and gone after it
        own = bound(
            levels(F.transform("nodes", lambda x: x["node"]), F.col("size")),
            lambda got: F.transform("nodes", lambda x, i: F.struct(x.alias("x"), siblings(got, i).alias("own"))),
        )
        unfolded = rows.select(group, "_above", F.explode(own).alias("r"))
        proofs = unfolded.select(group, "r.x.*", F.concat("r.own", "_above").alias("proof"))
    return proofs


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def proof_digest(proof: Column) -> Column:
    """``H`` of all siblings of a proof, from the leaf to the root, left to right."""
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""))


class Manifest(NamedTuple):
    """``langs``: the tree of each language; ``top``: that of their roots; ``root``: one row, none for an empty table."""

    langs: Tree
    top: Tree
    root: DataFrame


def build(leaves: DataFrame) -> Manifest:
    """The manifest over leaf rows: ``lang, doc_id, node`` and what they carry besides."""
    carried = [c for c in leaves.columns if c not in ("lang", "node")]
    rows = placed(stage(leaves, "leaves"), "lang", ["doc_id", "node"])
    langs = grow(rows, "lang", carried)
    subroots = langs.roots.select(F.lit(0).alias("all"), "lang", F.col("root").alias("node"))
    top = grow(placed(stage(subroots, "subroots"), "all", ["lang"]), "all", ["lang"])
    return Manifest(langs, top, top.roots.select("root"))


def proofs(m: Manifest) -> DataFrame:
    """Each leaf's row, with ``place`` in its language, ``subroot``, ``root`` and ``proof``, the siblings up to the root."""
    up = lookup(with_siblings(m.top, "all"), m.top.roots, ["all"], "inner")
    up = stage(up.select("lang", F.col("node").alias("subroot"), "root", "proof"), "proofs-top")
    rows = with_siblings(m.langs, "lang", up.select("lang", "proof"))
    return lookup(rows, broadcast_checked(up.drop("proof")), ["lang"], "inner")


def tampered_rows(id_col: str = "doc_id") -> Column:
    """Rows that a check tampers with: crc32 of the decimal id divisible by 3; none without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.lit(False))


def check(docs: DataFrame) -> DataFrame:
    """Manifest, proofs, and what becomes of rows whose text was put in lower case after it was made.

    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one
    row a document; columns other than :data:`LEAF` are ignored.
    """
    cols = [F.col(c) for c in LEAF]
    lower = F.when(tampered_rows(), F.translate("text", CAPITALS, SMALL)).otherwise(F.col("text"))
    leaves = docs.select("lang", "doc_id", leaf_digest(cols).alias("node"), leaf_digest([*cols[:-1], lower]).alias("later"))
    found = proofs(build(leaves)).withColumns({"proof_sha256": proof_digest(F.col("proof")), "folded_root": fold(F.col("later"), F.col("proof"))})
    return found.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
