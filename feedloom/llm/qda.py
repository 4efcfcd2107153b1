"""Quality classifier: a regularised quadratic discriminant on text statistics.

Statistics of the whole text are transformed (logs, smoothed square roots of
shares) so that each class is roughly normal.  Class covariances are shrunk
towards the pooled one and then towards the identity.  A document's score
comes from the difference of the two log densities, each a Mahalanobis
distance through a Cholesky factor inverted once per model, and is calibrated
by a logistic curve fitted on a histogram of that difference.

Only label, count, sum and cross-product totals of the labelled rows reach the
driver: a fixed number of values whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import broadcast_checked, stage

THRESHOLD = 0.7
#: Share of the pooled covariance in a class's, then of the identity.
TO_POOLED, TO_IDENTITY = 0.2, 0.05
#: Range and bins of the calibration histogram of the compressed margin.
CLIP, BINS = 20.0, 800

STATISTICS = ("words", "word_length", "symbols", "pipes", "bangs", "capitals", "digits", "repeats", "variety", "dup_lines", "stops", "lines")
_DIM = len(STATISTICS)
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def statistics(text: str | None) -> tuple[float, ...]:
    """The transformed statistics of one text; a null text is empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    width = sum(map(len, words))

    def share(chars: bytes, add: float = 0.0) -> float:
        return math.sqrt((size - len(raw.translate(None, chars)) + add) / (size + 20))

    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (
        math.log1p(n),
        math.log1p(width / n if n else 0.0),
        share(b"#*$%&<>"),
        share(b"|"),
        share(b"!?"),
        share(_CAPITALS, 0.4),
        share(_DIGITS),
        math.sqrt(sum(map(eq, words, words[1:])) / (n + 5)),
        math.log(len(set(words)) + 1) / math.log(n + 2),
        math.sqrt((len(lines) - len(set(lines))) / (len(lines) + 3)),
        share(b".,;:"),
        share(b"\n"),
    )


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py()) for t in texts], dtype=np.float64).reshape(-1, _DIM)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and one column per statistic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[:, i]) for i in range(_DIM))], names=["doc_id", *STATISTICS])

    schema = "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """Centre and scale of the statistics, per class mean, inverse Cholesky factor and log term, and the calibration."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    roots: tuple[np.ndarray, ...]
    terms: tuple[float, ...]
    slope: float
    offset: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density under label 1 less that under label 0, its tails compressed by the inverse hyperbolic sine."""
        if not self.means:
            return np.zeros(len(x))
        z = (x - self.centre) / self.scale
        dens = [t - 0.5 * np.square((z - m) @ r.T).sum(axis=1) for m, r, t in zip(self.means, self.roots, self.terms, strict=True)]
        return np.arcsinh(dens[1] - dens[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.slope * self.margin(x) + self.offset)))


def _calibrated(counts: np.ndarray, at: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset from the histogram ``counts`` (2 x bins) at margins ``at``, by Newton steps."""
    n = counts.sum(axis=0)
    one = counts[1]
    total = counts.sum(axis=1)
    hit, miss = (total[1] + 1) / (total[1] + 2), 1 / (total[0] + 2)  # smoothed targets
    goal = one * hit + counts[0] * miss
    x = np.stack([at, np.ones_like(at)])
    w = np.array([0.1, math.log((total[1] + 1) / (total[0] + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(w @ x)))
        grad = x @ (goal - n * p) - 1e-3 * np.array([w[0], 0.0])
        hess = (x * (n * p * (1 - p))) @ x.T + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-6), float(w[1])


def fit(rows: DataFrame, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Model:
    """Fit on rows with the statistics and ``label`` 0 or 1.

    With fewer than two rows of a class every score is the smoothed share of label 1.
    """
    pairs = [(i, j) for i in range(_DIM) for j in range(i, _DIM)]
    sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(STATISTICS)]
    cross = [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"c{i}_{j}") for i, j in pairs]
    got = {r["label"]: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), *sums, *cross).collect()}  # two rows
    n = [float(got[k]["n"]) if k in got else 0.0 for k in (0, 1)]
    if min(n) < 2:
        return Model(np.zeros(_DIM), np.ones(_DIM), (), (), (), 1.0, math.log((n[1] + 1) / (n[0] + 1)))
    means, covs = [], []
    for k in (0, 1):
        mean = np.array([got[k][f"s{i}"] for i in range(_DIM)]) / n[k]
        second = np.zeros((_DIM, _DIM))
        for i, j in pairs:
            second[i, j] = second[j, i] = got[k][f"c{i}_{j}"] / n[k]
        means.append(mean)
        covs.append(second - np.outer(mean, mean))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    centre = (n[0] * means[0] + n[1] * means[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    whole = pooled / np.outer(scale, scale)
    roots, terms = [], []
    for k in (0, 1):
        own = (1 - to_pooled) * covs[k] / np.outer(scale, scale) + to_pooled * whole
        low = np.linalg.cholesky((1 - to_identity) * own + to_identity * np.eye(_DIM))
        roots.append(np.linalg.inv(low))
        terms.append(-float(np.log(np.diag(low)).sum()))
    model = Model(centre, scale, tuple((m - centre) / scale for m in means), tuple(roots), tuple(terms), 1.0, 0.0)
    marked = rows.select(F.col("label").cast("int").alias("label"), *STATISTICS).mapInArrow(_margins(model), "label int, bin int")
    counts = np.zeros((2, BINS))
    for r in marked.groupBy("label", "bin").count().collect():  # at most 2 x BINS rows
        counts[r["label"], r["bin"]] = r["count"]
    at = (np.arange(BINS) + 0.5) * (2 * CLIP / BINS) - CLIP
    slope, offset = _calibrated(counts, at)
    return Model(centre, scale, model.means, model.roots, model.terms, slope, offset)


def _margins(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(_DIM)])
            at = np.clip((model.margin(x) + CLIP) * (BINS / (2 * CLIP)), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at)], names=["label", "bin"])

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no label is learnt from: crc32 of the id as text, remainder 2 of 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics with ``label`` for the labelled rows outside the held-out fold.

    Several labels of one id count as their largest.
    """
    marks = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("label"))
    usable = feats.filter(~held_out())
    return usable.join(marks, usable["doc_id"] == marks["_id"]).select("label", *STATISTICS)


def train_on_labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model, from the texts of the labelled rows alone: other texts are not measured."""
    ids = labels.filter("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("_id")).distinct()
    few = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    few = few.join(broadcast_checked(stage(ids, "ids")), few["doc_id"] == F.col("_id"), "left_semi")
    return fit(stage(training_rows(features(few), labels), "training"))


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the staged statistics of all documents, for a caller that scores them too."""
    feats = stage(features(docs), "statistics")
    return fit(stage(training_rows(feats, labels), "training")), feats


def scores(feats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of statistics.

    Ids are cast to long, so they must be integers.  Defined cases: null and
    empty texts are scored as empty texts; a null id is scored and is not held
    out; labels of a null id, and null labels, are not learnt; equal scores are
    no ties to break; repeated rows repeat; an empty table gives no rows; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(_DIM)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = feats.select("doc_id", *STATISTICS).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents the model accepts, all columns, in one pass without a shuffle.

    A model that saw too few labels to tell the classes apart rejects none.
    """
    if not model.means:
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(model.score(_matrix(b.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
