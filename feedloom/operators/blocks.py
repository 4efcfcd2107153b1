"""Titles compared block by block: every pair of two chunks at once, as arrays.

Where titles share most of their bigrams and characters, as prose of a few
languages does, a join on tokens makes more pairs than there are.  Here no pair
becomes a row unless it reaches the threshold.  Common bigrams and characters
are counted by a product of incidence matrices.  What may still reach it by the
sequence ratio meets a tighter bound, the longest common subsequence, found for
thousands of pairs at a time in the bits of a word; the letters are compared
only where that bound leaves it open.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.staging import stage

#: Titles of a chunk, and pairs whose subsequences are counted at a time.
CHUNK, AT_ONCE = 1024, 8192
#: Past the last code point: what fills a short title's row.
NONE = 0x110000
ALL = np.uint64(2**64 - 1)


def _letters(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row per key, and the keys' lengths."""
    size = np.array([len(k) for k in keys])
    text = np.array(keys, dtype=f"U{max(size.max(), 1)}").view(np.uint32).reshape(len(keys), -1).astype(np.int64)
    text[np.arange(text.shape[1]) >= size[:, None]] = NONE
    return text, size


def _bigrams(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, bigram``, each once a row."""
    row, at = np.nonzero(text[:, 1:] < NONE)
    width = (NONE + 1) ** 2
    both = np.unique(row * width + text[row, at] * (NONE + 1) + text[row, at + 1])
    return both // width, both % width


def _counted(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, character`` with the character's number so far, so that repeats are common as often as both have them."""
    text, at = np.sort(text, axis=1), np.arange(text.shape[1])
    new = np.ones(text.shape, bool)
    new[:, 1:] = text[:, 1:] != text[:, :-1]
    nth = at - np.maximum.accumulate(np.where(new, at, 0), axis=1)
    row, at = np.nonzero(text < NONE)
    return row, (text[row, at] << 32) + nth[row, at]


def _common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """How many tokens each row of ``a`` shares with each of ``b``."""
    shared = np.intersect1d(a[1], b[1])
    if not len(shared):
        return np.zeros(shape, np.float32)

    def marked(rows: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
        known = shared[at] == tokens
        out = np.zeros((n, len(shared)), np.float32)
        out[rows[known], at[known]] = 1
        return out

    return marked(*a, shape[0]) @ marked(*b, shape[1]).T


def subsequences(a: np.ndarray, size: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of rows ``i`` of ``a``, at most 64 letters each, and ``j`` of ``b``."""
    letters, code = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    ours, theirs, n = code[: a.size].reshape(a.shape), code[a.size :].reshape(b.shape), len(letters)
    places = np.zeros((len(a), n), np.uint64)
    for at in range(min(64, a.shape[1])):
        rows = np.nonzero(size > at)[0]
        places[rows, ours[rows, at]] |= np.uint64(1 << at)
    places[:, letters == NONE] = 0
    places, whole = places.ravel(), np.array([(1 << min(int(s), 64)) - 1 for s in size], np.uint64)
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), AT_ONCE):
        rows = i[k : k + AT_ONCE]
        left, own = np.full(len(rows), ALL), rows * n
        for letter in np.ascontiguousarray(theirs[j[k : k + AT_ONCE]].T):
            met = left & places[own + letter]
            left = (left + met) | (left - met)
        out[k : k + AT_ONCE] = np.bitwise_count(~left & whole[rows])
    return out


def similar(ones: pd.DataFrame, others: pd.DataFrame, threshold: float, scale: float, both: bool) -> pd.DataFrame:
    """``head, item, similarity`` of the pairs that reach the threshold, as ``relations.Head`` gives it.

    ``at, last, key``: heads are of ``ones``; ``both``: the earlier of two.
    """
    (a, n), (b, m) = _letters(list(ones["key"])), _letters(list(others["key"]))
    shape, at, to = (len(n), len(m)), ones["at"].to_numpy(), others["at"].to_numpy()
    open_ = at[:, None] != to if both else (at[:, None] != to) & (at[:, None] < others["last"].to_numpy())
    x, y = _bigrams(a), _bigrams(b)
    small = np.minimum(np.bincount(x[0], minlength=shape[0])[:, None], np.bincount(y[0], minlength=shape[1]))
    cover = np.minimum(1.0, _common(x, y, shape) / np.maximum(small, 1).astype(float) * scale)
    most = 2.0 * _common(_counted(a), _counted(b), shape) / (n[:, None] + m)
    may = open_ & (most >= threshold) & (most > cover) & (cover < 1.0)
    i, j = np.nonzero(may & (n[:, None] <= 64))
    most = 2.0 * subsequences(a, n, b, i, j) / (n[i] + m[j])
    may[i, j] = (most >= threshold) & (most > cover[i, j])
    matcher, head = difflib.SequenceMatcher(), None
    for i, j in zip(*np.nonzero(may), strict=True):
        first, second = (others["key"].iat[j], ones["key"].iat[i]) if both and to[j] < at[i] else (ones["key"].iat[i], others["key"].iat[j])
        if first != head:
            matcher.set_seq2(first)
            head = first
        matcher.set_seq1(second)
        cover[i, j] = max(cover[i, j], matcher.ratio())
    i, j = np.nonzero(open_ & (cover >= threshold))
    head, item = (np.minimum(at[i], to[j]), np.maximum(at[i], to[j])) if both else (at[i], to[j])
    return pd.DataFrame({"head": head, "item": item, "similarity": cover[i, j]})


def compared(heads: DataFrame, items: DataFrame, threshold: float, scale: float, both: bool) -> DataFrame:
    """``head, item, similarity`` of all pairs that reach the threshold and whose item comes, or comes again, after the head.

    ``at, last, key`` on either side; ``both``: the two are the same rows.  The
    heads' chunks are broadcast: they are as many as one part of the order has.
    """

    def chunks(rows: DataFrame, side: str) -> tuple[DataFrame, int]:
        n = max(1, math.ceil(rows.count() / CHUNK))
        chunk = F.pmod(F.xxhash64("key"), F.lit(n)).alias(f"{side}_chunk")
        return stage(rows.groupBy(chunk).agg(F.collect_list(F.struct("at", "last", "key")).alias(side)), "chunks"), n

    (ones, _), (others, n) = chunks(heads, "ones"), chunks(items, "others")
    met = others.repartition(n).crossJoin(F.broadcast(ones))
    if both:
        # each two chunks meet once, and each chunk meets about half of them
        apart = F.pmod(F.col("others_chunk") - F.col("ones_chunk"), F.lit(n))
        met = met.filter((2 * apart < n) | (2 * apart == n) & (F.col("ones_chunk") < F.col("others_chunk")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for a, b in zip(rows["ones"], rows["others"], strict=True):
                found = similar(pd.DataFrame(list(a)), pd.DataFrame(list(b)), threshold, scale, both)
                yield found.drop_duplicates(["head", "item"]) if both else found

    return met.select("ones", "others").mapInPandas(run, "head long, item long, similarity double")
