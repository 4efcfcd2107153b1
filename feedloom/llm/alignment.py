"""Alignment of two tokenizers' ids over the same bytes, and how often each pair of ids meets.

Side A is a byte-level BPE over a space and the text, side B a piece model that
adds the space itself.  Both cover the same bytes, so each token is an
interval of them.  All intervals of a chunk of documents are sorted by start
(``lexsort``), the running maximum of their ends is taken, and a new group
begins where a start reaches it: there tokens of both sides end together.
Within a group every A interval expands to the B intervals it overlaps.
Neighbouring documents lie end to end, so no group crosses from one into the
next and a whole chunk is one pass of array operations.

How it runs: one pass over the texts makes a row per document, with its
distinct linked pairs, as a staged table, so nothing is tokenised twice.  The
pairs are counted over the corpus (combined in the task first), and met with
the documents again.  The table of pairs is broadcast while it has at most
``PAIR_ROWS`` rows; beyond that the same join shuffles, pre-aggregated to one
row per document and pair, and adaptive execution splits pairs that most
documents hold.  No task holds more than ``CHUNK_BYTES`` of text at once, or
one document.

Defined cases: a null or empty text, and one whose tokens of either side do
not spell the space and the text (a text that holds U+2581, for one), has no
tokens: all figures are 0 and the digest is empty.  Strings of special tokens
are plain text.  Rows that repeat an id, or have none, are apart; each counts
in the corpus figures.  An empty table gives no rows; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import broadcast_checked, stage

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k", "piece_bpe_32k"
#: Bytes of text that are aligned in one pass.
CHUNK_BYTES = 1 << 20
#: Distinct pairs (some 60 bytes each as a hashed row) up to which their table is broadcast.
PAIR_ROWS = 1_000_000
#: A pair is one number: A's id times this, plus B's.
SIDE = 1 << 15

ROWS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


class Sides(NamedTuple):
    """Both tokenizers: texts to ids, and the bytes and lengths of each id."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    lengths_a: np.ndarray
    lengths_b: np.ndarray
    #: Decimal ids with what may follow: A ``,`` and ``|``, B ``,`` and ``;``.
    spelled: list[bytes]


@lru_cache(maxsize=2)
def sides(vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> Sides:
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary_a}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    a = tiktoken.Encoding(vocabulary_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{vocabulary_b}.model"))
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        bytes_a[rank] = token
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    if len(bytes_b) > SIDE:
        raise ValueError(f"{vocabulary_b} has over {SIDE} ids")
    spelled = [b"%d%s" % (i, after) for side, ends in ((bytes_a, b",|"), (bytes_b, b",;")) for after in (ends[:1], ends[1:]) for i in range(len(side))]
    return Sides(
        a.encode_ordinary, lambda texts: b.encode(texts, num_threads=1), bytes_a, bytes_b, np.array([len(x) for x in bytes_a]), np.array([len(x) for x in bytes_b]), spelled
    )


class Aligned(NamedTuple):
    """Groups and links of two tokenizations of the same bytes."""

    group_a: np.ndarray  #: group of each A token
    group_b: np.ndarray
    link_a: np.ndarray  #: place of the A token of each link
    link_b: np.ndarray


def coalesce_intervals(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Groups and overlaps of two rows of intervals that cover the same range without gaps."""
    end_a, end_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    start_a, start_b = end_a - lengths_a, end_b - lengths_b
    start, end = np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b))
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), dtype=np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks) - 1
    first = np.searchsorted(end_b, start_a, side="right")
    many = np.searchsorted(start_b, end_a, side="left") - first
    link_a = np.repeat(np.arange(len(lengths_a)), many)
    within = np.arange(len(link_a)) - np.repeat(np.cumsum(many) - many, many)
    return Aligned(group[: len(lengths_a)], group[len(lengths_a) :], link_a, np.repeat(first, many) + within)


def _spelling(at: Aligned, ids_a: np.ndarray, ids_b: np.ndarray, s: Sides) -> tuple[list[bytes], np.ndarray]:
    """The pieces of ``a1,a2|b1;...`` in order, and where each group starts in them."""
    n_a, n_b = len(s.bytes_a), len(s.bytes_b)
    last_a = np.append(at.group_a[1:] != at.group_a[:-1], True)
    last_b = np.append(at.group_b[1:] != at.group_b[:-1], True)
    codes = np.concatenate((ids_a + n_a * last_a, ids_b + 2 * n_a + n_b * last_b))
    group = np.concatenate((at.group_a, at.group_b))
    side = np.concatenate((np.zeros(len(ids_a), np.int8), np.ones(len(ids_b), np.int8)))
    order = np.lexsort((side, group))
    starts = np.searchsorted(group[order], np.arange(int(group.max()) + 2))
    return list(map(s.spelled.__getitem__, codes[order].tolist())), starts


def align_chunk(texts: list[str], s: Sides) -> list[tuple[int, int, int, int, str, list[int], list[int]]]:
    """``n_a, n_b, n_groups, n_links, digest, pairs, times`` of each text, empty or not."""
    found: list[tuple] = [(0, 0, 0, 0, "", [], [])] * len(texts)
    whole, a, b = [], [], []
    for i, (text, y) in enumerate(zip(texts, s.encode_b(texts), strict=True)):
        if not text:
            continue
        data, x = b" " + text.encode(), s.encode_a(" " + text)
        if b"".join(map(s.bytes_a.__getitem__, x)) == data and b"".join(map(s.bytes_b.__getitem__, y)) == data:
            whole.append(i)
            a.append(x)
            b.append(y)
    if not whole:
        return found
    n_a, n_b = np.array([len(x) for x in a]), np.array([len(y) for y in b])
    ids_a, ids_b = np.concatenate([np.array(x, np.int64) for x in a]), np.concatenate([np.array(y, np.int64) for y in b])
    at = coalesce_intervals(s.lengths_a[ids_a], s.lengths_b[ids_b])
    pieces, starts = _spelling(at, ids_a, ids_b, s)
    groups = at.group_a[np.cumsum(n_a) - 1] + 1  # up to the end of each text
    before = np.concatenate(([0], groups[:-1]))
    doc_of = np.repeat(np.arange(len(whole)), n_a)[at.link_a]
    links = np.bincount(doc_of, minlength=len(whole))
    keys, times = np.unique((doc_of << 32) | (ids_a[at.link_a] * SIDE + ids_b[at.link_b]), return_counts=True)
    cut = np.searchsorted(keys, np.arange(len(whole) + 1) << 32)
    pairs = (keys & 0xFFFFFFFF).astype(np.int32)
    for k, i in enumerate(whole):
        digest = hashlib.sha256(b"".join(pieces[starts[before[k]] : starts[groups[k]]])[:-1]).hexdigest()
        part = slice(cut[k], cut[k + 1])
        found[i] = (int(n_a[k]), int(n_b[k]), int(groups[k] - before[k]), int(links[k]), digest, pairs[part], times[part].astype(np.int32))
    return found


def chunks(rows: Iterator[tuple], size: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Rows whose last value is a text, in lists of about ``size`` characters."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1] or "")
        if n >= size or len(held) >= 4096:
            yield held
            held, n = [], 0
    if held:
        yield held


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """One row per document: :data:`ROWS`; ``pairs`` are the distinct linked pairs, ``times`` their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(vocabulary_a, vocabulary_b)
        for b in batches:
            for rows in chunks(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (t.as_py() for t in b.column(2)), strict=True)):
                found = align_chunk([text or "" for _, _, text in rows], s)
                cols = list(zip(*[(row, doc_id, *f) for (row, doc_id, _), f in zip(rows, found, strict=True)], strict=True))
                types = [pa.int64()] * 6 + [pa.string()] + [pa.list_(pa.int32())] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[c.split()[0] for c in ROWS.split(", ")])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ROWS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, id_a, id_b, n, best``: links that hold each pair, and whether no pair of its B id has more."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counted = each.groupBy("pair").agg(F.sum("times").alias("n")).withColumns({"id_a": F.floor(F.col("pair") / SIDE).cast("int"), "id_b": (F.col("pair") % SIDE).cast("int")})
    most = F.max("n").over(Window.partitionBy("id_b"))  # at most one row per A id
    return counted.select("pair", "id_a", "id_b", "n", (F.col("n") == most).alias("best"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, pair_rows: int = PAIR_ROWS) -> tuple[DataFrame, DataFrame]:
    """Figures per document (``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``) and the pair table."""
    rows = stage(alignments(docs, id_col, text_col, vocabulary_a, vocabulary_b), "alignments", compression="zstd")
    counts = stage(pair_counts(rows), "pairs")
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    met = each.join(broadcast_checked(counts.select("pair", "n", "best"), pair_rows), "pair")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = {"n_best": F.coalesce("n_best", F.lit(0).cast("long")), "count_sum": F.coalesce("count_sum", F.lit(0).cast("long"))}
    out = rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left").withColumns(zero)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), counts
