"""Near-duplicate detection: SimHash fingerprints under an anchor-point covering.

Fingerprint: bit ``i`` is set when more than half of a document's shingle
hashes have it.  Links: fingerprints at most two bits apart.

Covering: all 64 bits are covered by perfect codes, part by part.  Bits 0-22 and
23-45 by the binary Golay code (every word is within 3 bits of exactly one
codeword), bits 46-60 by the Hamming code of length 15 (within 1 bit), bits
61-63 by themselves.  The anchors are the 2^38 tuples of codewords; a
fingerprint's home is the tuple nearest to it.  For a link x-y with t_p
differing bits in part p, home(x) lies within radius + t_p of y in each part,
so y is replicated to every anchor within covering radius plus threshold,
counted per part: about 204 anchors, however large the corpus.  Fingerprints
are compared with the homes of their anchor only; no pair of a group is ever
emitted unless it is a link.

An anchor that is home to more than ``HOMES`` distinct fingerprints, as only a
crowd of near copies gives it, is not compared directly.  Every fingerprint
replicated to it goes, once, through an exact linear route: it is keyed by
itself and by its 64 one-bit variants; two fingerprints are within two bits
exactly if they share such a key.  No more than 65 distinct fingerprints can
share one, so that route has no hot key.

Copies of a text share one fingerprint and are collapsed before replication.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from feedloom.llm.common import keep_rows, lookup, stage
from feedloom.llm.components import connected_components

SEED = 42
SHINGLE = 3
#: Homes of one anchor that are compared directly.
HOMES = 128
#: Distinct fingerprints of a task that replicates them.
TASK_ROWS = 1 << 15
#: Generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101
#: Differing bits of a link.
THRESHOLD = 2


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of one text; 0 where it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), dtype=np.uint64, count=b.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got)], names=["doc_id", "fp"])


@dataclass(frozen=True)
class Part:
    """A perfect code over ``width`` bits from ``shift`` on.

    ``bits``: the syndrome of each single bit.  ``flat``: for each excess over
    the covering radius, start, count and values of the error words by syndrome.
    """

    shift: int
    width: int
    bits: list[int]
    flat: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def word(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> np.uint64(self.shift) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        s = np.zeros(len(v), dtype=np.int64)
        for i, bit in enumerate(self.bits):
            if bit:
                s ^= np.where(v >> i & 1, bit, 0)
        return s


def _part(shift: int, bits: list[int], radius: int) -> Part:
    size = 1 << max(bits).bit_length()
    found: list[list[list[int]]] = [[[] for _ in range(THRESHOLD + 1)] for _ in range(size)]
    for weight in range(radius + THRESHOLD + 1):
        for at in combinations(range(len(bits)), weight):
            s = e = 0
            for i in at:
                s ^= bits[i]
                e |= 1 << i
            found[s][max(0, weight - radius)].append(e)
    flat = []
    for k in range(THRESHOLD + 1):
        count = np.array([len(x[k]) for x in found])
        flat.append((np.concatenate([[0], np.cumsum(count)[:-1]]), count, np.array(sum((x[k] for x in found), []), dtype=np.int64)))
    return Part(shift, len(bits), bits, flat)


@lru_cache(maxsize=1)
def parts() -> list[Part]:
    golay = []
    for i in range(23):
        v = 1 << i
        for b in range(22, 10, -1):
            if v >> b & 1:
                v ^= GOLAY << (b - 11)
        golay.append(v)
    return [_part(0, golay, 3), _part(23, golay, 3), _part(46, list(range(1, 16)), 1), _part(61, [0] * 3, 0)]


def home(fps: np.ndarray) -> np.ndarray:
    """The anchor nearest to each unsigned fingerprint."""
    out = np.zeros(len(fps), dtype=np.uint64)
    for p in parts():
        at, _, e = p.flat[0]
        word = p.word(fps)
        out |= (word ^ e[at[p.syndrome(word)]]).astype(np.uint64) << np.uint64(p.shift)
    return out


def replicas(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor and whether it is the home, for unsigned fingerprints."""
    words = [p.word(fps) for p in parts()]
    syndromes = [p.syndrome(w) for p, w in zip(parts(), words, strict=True)]
    rows, anchors, homes = [], [], []
    for excess in product(range(THRESHOLD + 1), repeat=len(words)):
        if sum(excess) > THRESHOLD:
            continue
        tables = [p.flat[k] for p, k in zip(parts(), excess, strict=True)]
        counts = [n[s] for (_, n, _), s in zip(tables, syndromes, strict=True)]
        count = np.prod(counts, axis=0)
        row = np.repeat(np.arange(len(fps)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        anchor = np.zeros(len(row), dtype=np.uint64)
        for p, (at, _, e), n, s, w in zip(parts(), tables, counts, syndromes, words, strict=True):
            anchor |= (w[row] ^ e[at[s][row] + nth % n[row]]).astype(np.uint64) << np.uint64(p.shift)
            nth //= n[row]
        rows.append(row)
        anchors.append(anchor)
        homes.append(np.full(len(row), sum(excess) == 0))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 1024):
            part = fps[at : at + 1024]
            row, anchor, _ = replicas(part)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(part[row].view(np.int64))], names=["anchor", "fp"])


def _home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(home(fps).view(np.int64)), b.column(0)], names=["anchor", "home_fp"])


def links(fps: DataFrame, homes: int = HOMES) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``, long).

    Not every linked pair need be a row: those of an anchor beyond ``homes``
    come as a path through the smallest member of a shared one-bit variant.
    """
    pair = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("fp", T.LongType())])
    at_home = fps.select("fp").mapInArrow(_home, T.StructType([pair["anchor"], T.StructField("home_fp", T.LongType())]))
    first = at_home.withColumn("rn", F.row_number().over(Window.partitionBy("anchor").orderBy("home_fp"))).filter(F.col("rn") <= homes + 1)
    lists = stage(first.groupBy("anchor").agg(F.collect_list("home_fp").alias("homes")), "homes").withColumnRenamed("anchor", "_anchor")
    # each makes some 200 anchor rows: deal them out by number, however few files hold them
    tasks = max(fps.sparkSession.sparkContext.defaultParallelism, -(-fps.count() // TASK_ROWS))
    placed = fps.select("fp").repartition(tasks, "fp").mapInArrow(_replicate, pair)
    # the planner takes the anchor rows for as few as the fingerprints they come from: never broadcast them
    met = placed.hint("merge").join(lists, placed["anchor"] == lists["_anchor"])
    near = F.filter("homes", lambda h: (h < F.col("fp")) & (F.bit_count(h.bitwiseXOR(F.col("fp"))) <= 2))
    many = F.size("homes") > homes
    met = stage(
        met.select("fp", many.alias("many"), F.when(~many, near).alias("near")).filter(F.col("many") | (F.size("near") > 0)), "met"
    )
    direct = met.filter("not many").select(F.explode("near").alias("a"), F.col("fp").alias("b")).distinct()
    crowd = met.filter("many").select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    shared = crowd.select("fp", F.explode(flips).alias("variant")).groupBy("variant").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    path = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()
    return direct.union(path)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``.  Ids are cast to long, so they must be integers.

    ``component_id`` is the smallest id reachable over links, the document's
    own included.  Defined cases: null and empty texts, and texts of white
    space, have fingerprint zero and link like any other; a null id counts as
    larger than every other, so a component of null ids has a null
    ``component_id``; repeated rows give repeated rows; an empty table gives
    no rows; other columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = stage(texts.mapInArrow(_fingerprints, schema), "fingerprints")
    fps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    roots = connected_components(links(fps)).withColumnRenamed("node", "fp")
    rooted = stage(lookup(fps, roots, ["fp"]).select("fp", "rep", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = stage(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "lowest")
    table = stage(lookup(rooted, lowest, ["root"]).select("fp", "component_id"), "components")
    return lookup(marked, table, ["fp"]).select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is their component's smallest, with all columns."""
    kept = near_duplicates(docs, id_col, text_col).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return keep_rows(docs, kept.select(F.col("doc_id").alias(id_col)), [id_col])
