"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of 0 to ``ORDER`` bytes with counts
of the byte that followed.  A text's code length under a language is the sum
of its bytes' costs: a byte is coded in the longest context that was seen; if
it did not follow there, an escape is coded (method C: as often as there are
different followers) and the next shorter context is tried, whose counts leave
out the followers that the longer one had (exclusion); what no context knows
costs an even share of the bytes left.  The language with the shortest code
wins.  Statistics are frozen, so a byte's cost depends on the ``ORDER`` bytes
before it alone: costs are computed once for each different string of
``ORDER + 1`` bytes in a chunk of texts, exactly, and summed by text.

Training is bounded: of each language the rows with the smallest hashes, at
most ``SAMPLE_DOCS`` and as many bytes as ``SAMPLE_BYTES`` over the number of
languages (``LANGUAGE_BYTES`` at most) give; whole texts, at least one.  So
all trees together have fewer than ``SAMPLE_BYTES`` nodes an order, whatever
the table holds, and can be broadcast.  Ranks are taken on hashes and sizes
alone, among the ``MARGIN * SAMPLE_DOCS`` smallest hashes to be expected of a
language.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
so is every text where there is nothing to learn from.  Rows with a null
language or a null id teach nothing; a null id is not held out.  Equal code
lengths go to the smaller name.  Rows that repeat an id or a text are scored
each; an empty table gives no rows; further columns are ignored by
:func:`predict` and never inputs.  The score is the language's share of
``2 ** -length`` over all languages; it nears 1 for all but short texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import broadcast_checked, lookup

#: Bytes of the longest context.
ORDER = 4
#: Bounds of the training sample: rows of a language, bytes of a language, bytes of all.
SAMPLE_DOCS, LANGUAGE_BYTES, SAMPLE_BYTES = 4096, 4 << 20, 64 << 20
#: Rows that are ranked, over those wanted.
MARGIN = 1.25
#: Bytes of text whose different strings are evaluated together.
CHUNK_BYTES = 8 << 20
UNDETERMINED = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text, remainder 2 of 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def strings(texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """Each byte of the texts with the ``order`` bytes before it, as a number; a text begins after line ends."""
    data = np.frombuffer(b"".join(b"\n" * order + t for t in texts), dtype=np.uint8).astype(np.int64)
    n = len(data) - order
    out = np.zeros(max(n, 0), np.int64)
    for j in range(order + 1):
        out <<= 8
        out |= data[j : j + n]
    ends = np.cumsum([len(t) + order for t in texts])
    keep = np.ones(len(out), bool)
    for e in ends[:-1]:
        keep[e - order : e] = False  # these end in the line ends before the next text
    return out[keep]


class Level(NamedTuple):
    """Contexts of one length: sorted, with all followers, different followers, and the shorter context's counts of those."""

    strings: np.ndarray  #: context and follower, sorted
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    covered: np.ndarray


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def tree(keys: np.ndarray, counts: np.ndarray, order: int = ORDER) -> list[Level]:
    """The levels, shortest context first, of the counts of strings of ``order + 1`` bytes."""
    levels: list[Level] = []
    for k in range(order + 1):
        own, inverse = np.unique(keys & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        n = np.bincount(inverse, weights=counts, minlength=len(own)).astype(np.int64)
        contexts, inverse = np.unique(own >> 8, return_inverse=True)
        covered = np.zeros(len(contexts), np.int64)
        if k:
            shorter = levels[-1]
            at, _ = _found(shorter.strings, own & ((1 << 8 * k) - 1))
            covered = np.bincount(inverse, weights=shorter.counts[at], minlength=len(contexts)).astype(np.int64)
        total = np.bincount(inverse, weights=n, minlength=len(contexts)).astype(np.int64)
        levels.append(Level(own, n, contexts, total, np.bincount(inverse, minlength=len(contexts)), covered))
    return levels


def costs(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each string after the bytes before it."""
    bits = np.zeros(len(keys))
    left = np.arange(len(keys))  # strings whose last byte is not coded yet
    excluded, excluded_kinds = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, own = levels[k], keys[left] & ((1 << 8 * (k + 1)) - 1)
        node, seen = _found(level.contexts, own >> 8)
        at, hit = _found(level.strings, own)
        kinds = np.where(seen, level.kinds[node] - excluded_kinds, 0)
        whole = np.where(seen, level.total[node] - excluded, 0) + kinds
        bits[left[hit]] += np.log2(whole[hit] / level.counts[at[hit]])
        escaped = ~hit & (kinds > 0)
        bits[left[escaped]] += np.log2(whole[escaped] / kinds[escaped])
        stay = ~hit
        left, node, seen = left[stay], node[stay], seen[stay]
        excluded, excluded_kinds = np.where(seen, level.covered[node], 0), np.where(seen, level.kinds[node], 0)
    bits[left] += np.log2(256 - len(levels[0].strings))
    return bits


class Model(NamedTuple):
    names: list[str]
    trees: list[list[Level]]


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``lang, text``: the bounded sample that is learnt from."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    usable = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
    rows = usable.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), text).alias("h"), text.alias("text")).filter("text <> ''")
    # the hash is uniform: a cut at a little over the share wanted leaves few rows to rank, whatever a language holds
    sizes = rows.groupBy("lang").agg(F.count("*").alias("docs"))
    share = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    near = lookup(rows.select("lang", "h", F.octet_length("text").cast("long").alias("size")), broadcast_checked(sizes), ["lang"], "inner")
    near = near.filter(share <= MARGIN * SAMPLE_DOCS / F.col("docs")).drop("docs")
    by = Window.partitionBy("lang").orderBy("h", "size")
    ranked = near.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= SAMPLE_DOCS)
    n = F.size(F.collect_set("lang").over(Window.partitionBy(F.lit(0))))
    langs = ranked.select("lang").distinct().withColumn("room", F.least(F.lit(LANGUAGE_BYTES), F.floor(F.lit(SAMPLE_BYTES) / n)))
    summed = ranked.withColumn("bytes", F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    fits = lookup(summed, langs, ["lang"], "inner").filter((F.col("rank") == 1) | (F.col("bytes") <= F.col("room")))
    last = fits.groupBy("lang").agg(F.max("h").alias("last"))
    return lookup(rows, broadcast_checked(last), ["lang"], "inner").filter(F.col("h") <= F.col("last")).select("lang", "text")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER) -> Model:
    """The trees of all languages, from the sample's strings, which Spark counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text.encode())
            for lang, of in texts.items():
                keys, n = np.unique(strings(of, order), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n.astype(np.int64))], names=["lang", "string", "n"])

    counted = sample(docs, id_col, text_col, lang_col).mapInArrow(count, "lang string, string long, n long")
    found = counted.groupBy("lang", "string").agg(F.sum("n").alias("n")).toPandas()  # bounded by SAMPLE_BYTES
    names = sorted(found["lang"].unique())
    groups = {name: of for name, of in found.groupby("lang")}
    return Model(names, [tree(groups[x]["string"].to_numpy(np.int64), groups[x]["n"].to_numpy(np.int64), order) for x in names])


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text (none empty) under each language."""
    order = len(model.trees[0]) - 1
    codes, kinds = pd.factorize(strings(texts, order))
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))
    return np.stack([np.add.reduceat(costs(t, kinds)[codes], starts) for t in model.trees], axis=1)


def decide(model: Model, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the shortest code and its share; names are sorted, so the first of equals is the smaller."""
    best = np.argmin(lengths, axis=1)
    gap = lengths - lengths[np.arange(len(lengths)), best][:, None]
    return best, 1.0 / np.exp2(-gap).sum(axis=1)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits``: one row a document; ``bits`` is the code length, null for ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, held_out boolean, lang_pred string, score double, bits double"

    def chunk(rows: list[tuple]) -> pa.RecordBatch:
        m = shared.value
        names, scores, bits = [UNDETERMINED] * len(rows), [0.0] * len(rows), [None] * len(rows)
        known = [i for i, r in enumerate(rows) if r[2]] if m.names else []
        if known:
            lengths = code_lengths(m, [rows[i][3].encode() for i in known])
            best, share = decide(m, lengths)
            for k, i in enumerate(known):
                names[i], scores[i], bits[i] = m.names[best[k]], float(share[k]), float(lengths[k, best[k]])
        cols = [[r[0] for r in rows], [r[1] for r in rows], names, scores, bits]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.bool_(), pa.string(), pa.float64(), pa.float64()), strict=True)], names=[c.split()[0] for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, n = [], 0
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), (t.as_py() for t in b.column(3)), strict=True):
                held.append(row)
                n += len(row[3])
                if n >= CHUNK_BYTES:
                    yield chunk(held)
                    held, n = [], 0
            if held:
                yield chunk(held)

    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    text = F.when(letter, F.col(text_col)).otherwise("")
    return docs.select(F.col(id_col).cast("long"), held_out(id_col), letter, text).mapInArrow(run, schema)
