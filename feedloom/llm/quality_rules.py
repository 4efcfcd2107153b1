"""Quality rules whose cutoffs come with a bound on false rejection.

A rule rejects a document when its risk value exceeds the cutoff of the
document's stratum.  Cutoffs are chosen on labelled documents, which a hash of
the id splits in two.  One half draws a path for each stratum: a list of
settings of all rules, each at least as strict as the one before.  The rules
come in one by one, those that reject most bad documents first, with cutoffs
``MARGINS[0]`` grid points looser than the strictest that rejects no good
document of that half; then all margins shrink, then the shares in ``LADDER``
may be rejected.  The other half walks the path: at each setting an exact
binomial test asks whether the share of good documents that *any* rule rejects
is shown to be at most ``RISK``.  The walk stops at the first setting that
fails (fixed-sequence testing), so a stratum costs one test, and the doubt is
shared among the strata (Bonferroni): with confidence ``1 - DOUBT`` no stratum
rejects more than ``RISK`` of its good documents.  A stratum with too few
labels to show it has no cutoff and its documents pass.

The test supposes independent draws, and copies are none: equal texts among the
labelled documents have one vote, that of their smallest id, and so fall into
one half.  What is bounded is the share of different texts.  Near copies still
count each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import broadcast_checked, lookup, stage

RISK, DOUBT = 0.03, 0.05
#: Grid points between a rule's cutoff and the strictest one that rejects no good document; then the shares of them that may be rejected.
MARGINS, LADDER = (2, 1, 0), (0.001, 0.002)
SYMBOLS = b"#*$%&|<>"
#: Cutoffs of each rule, ascending: the grid is stated, not fitted.
GRID = {
    "symbol_share": [0.0025 * 1.25**i for i in range(28)],
    "bang_share": [0.0025 * 1.25**i for i in range(28)],
    "capital_share": [0.02 * 1.15**i for i in range(28)],
    "dup_line_share": [0.025 * i for i in range(1, 40)],
    "repeat_share": [0.005 * 1.25**i for i in range(24)],
    "adjacent_share": [0.005 * 1.25**i for i in range(24)],
    "long_words": [6.0 * 1.06**i for i in range(40)],
    "short_words": [-0.25 * i for i in range(24, 3, -1)],
}
RULES = tuple(GRID)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first included."""
    n = len(words)
    if n <= width:
        return 0
    codes: dict[bytes, int] = {}
    a = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=n)
    v = len(codes)
    key = a[: n - width + 1]
    size = v
    for i in range(1, width):
        if size * v >= 2**62:  # renumber, so that the exact key stays within 64 bits
            seen, key = np.unique(key, return_inverse=True)
            size = len(seen)
        key = key * v + a[i : n - width + 1 + i]
        size *= v
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    if not equal.any():
        return 0
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    cover = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    cover[at] += 1
    cover[at + width] -= 1
    return int((np.cumsum(cover[:n]) > 0).sum())


def measures(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and risk values of one whole text; a null text has no word."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    if not n:
        return [0, chars, symbols, dup, repeat], [0.0] * len(RULES)
    letters = raw.translate(None, bytes(range(65, 91)))
    bangs = len(raw) - len(raw.translate(None, b"!"))
    same = sum(x == y for x, y in zip(words, words[1:], strict=False))
    risk = [
        symbols / (chars + 100),
        bangs / (chars + 100),
        (len(raw) - len(letters)) / (chars + 20),
        dup / (len(lines) + 3),
        repeat / (n + 20),
        same / (n + 20),
        (chars + 5 * 20) / (n + 20),
        -(chars + 5 * 20) / (n + 20),
    ]
    return [n, chars, symbols, dup, repeat], risk


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id, stratum``, the counts, one risk value per rule and a hash of the text of each document."""
    names = ["doc_id", "stratum", *COUNTS, *RULES, "text_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [measures(t.as_py()) for t in b.column(2)]
            counts = [pa.array([g[0][i] for g in got], pa.int64()) for i in range(len(COUNTS))]
            risks = [pa.array([g[1][i] for g in got], pa.float64()) for i in range(len(RULES))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *counts, *risks, b.column(3)], names=names)

    schema = "doc_id long, stratum string, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{r} double" for r in RULES] + ["text_hash long"])
    columns = (F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    return docs.select(*columns).mapInArrow(run, schema)


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), summed exactly; 1 where k reaches the mean."""
    if k >= n * p:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return math.exp(top) * sum(math.exp(x - top) for x in logs)


def settings(good: list[list[int]], bad: list[list[int]], grid: list[list[float]]) -> list[list[float | None]]:
    """The path of one stratum: settings of all rules, from the loosest to the strictest.

    ``good`` and ``bad`` hold, for each rule, the numbers of documents that
    exceed exactly ``i`` of its cutoffs.
    """

    def strictest(i: int, share: float) -> int | None:
        """Number of the lowest cutoff that rejects at most that share of the good documents."""
        most, over = share * sum(good[i]), 0
        for j in range(len(grid[i]) - 1, -1, -1):
            over += good[i][j + 1]
            if over > most:
                return j + 1 if j + 1 < len(grid[i]) else None
        return 0

    def at(i: int, j: int | None) -> float | None:
        return None if j is None or j >= len(grid[i]) else grid[i][j]

    base = [strictest(i, 0.0) for i in range(len(grid))]
    loose = [None if j is None else j + MARGINS[0] for j in base]
    gain = [0 if j is None or j >= len(grid[i]) else sum(bad[i][j + 1 :]) for i, j in enumerate(loose)]
    order = sorted((i for i in range(len(grid)) if gain[i] > 0), key=lambda i: (-gain[i], i))
    path = [[at(i, loose[i]) if i in order[:k] else None for i in range(len(grid))] for k in range(1, len(order) + 1)]
    for margin in MARGINS[1:]:
        path.append([at(i, None if base[i] is None else base[i] + margin) if i in order else None for i in range(len(grid))])
    for share in LADDER:
        path.append([at(i, strictest(i, share)) if i in order else None for i in range(len(grid))])
    return path if order else []


def cutoffs(marked: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """``stratum, cutoffs``: an array in the order of ``RULES``, null where no cutoff is shown safe.

    ``marked``: measured documents with ``good``.  Only counts over the grid
    leave the tasks; a stratum's counts are at most rules x grid x 2 rows.
    """
    rows = marked.withColumn("half", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)))
    over = [F.struct(F.lit(i).alias("rule"), sum(((F.col(r) > F.lit(g)).cast("int") for g in GRID[r]), F.lit(0)).alias("over")) for i, r in enumerate(RULES)]
    first = rows.filter("half = 0").select("stratum", "good", F.explode(F.array(*over)).alias("x"))
    counts = stage(first.groupBy("stratum", "good", "x.rule", "x.over").agg(F.count("*").alias("n")), "counts")
    grid = [GRID[r] for r in RULES]

    def draw(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        tables = [[[0] * (len(cuts) + 1) for cuts in grid] for _ in range(2)]
        for r in found.itertuples():
            tables[int(r.good)][r.rule][r.over] = int(r.n)
        return pd.DataFrame({"stratum": [key[0]], "path": [settings(tables[1], tables[0], grid)]})

    paths = stage(counts.groupBy("stratum").applyInPandas(draw, "stratum string, path array<array<double>>"), "paths")
    values = F.array(*RULES)
    rejects = lambda cuts: F.exists(F.zip_with(cuts, values, lambda c, v: F.coalesce(v > c, F.lit(False))), lambda x: x)
    second = lookup(rows.filter("half = 1 and good"), broadcast_checked(paths), ["stratum"], "inner")
    # the settings get stricter, so the first one that rejects a document says all
    loose = F.size(F.filter("path", lambda cuts: ~rejects(cuts)))
    tested = stage(second.groupBy("stratum", loose.alias("survives")).agg(F.count("*").alias("n")), "tested")
    level = doubt / max(1, paths.count())

    def walk(key: tuple, path: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        settled: list[float | None] = [None] * len(grid)
        total = int(found["n"].sum())
        for t, cuts in enumerate(path["path"].iloc[0]):
            if at_most(int(found.loc[found["survives"] <= t, "n"].sum()), total, risk) > level:
                break
            settled = [None if c is None or c != c else float(c) for c in cuts]
        return pd.DataFrame({"stratum": [key[0]], "cutoffs": [settled]})

    name = F.coalesce("stratum", F.lit("")), F.col("stratum").isNull()  # a null stratum meets itself
    return paths.groupBy(name[0], name[1]).cogroup(tested.groupBy(name[0], name[1])).applyInPandas(lambda key, a, b: walk((None if key[1] else key[0],), a, b), "stratum string, cutoffs array<double>")


def marked_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Measured rows that are labelled, with ``good`` (by their largest label)."""
    marks = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg((F.max("quality") == 1).alias("good"))
    return rows.join(marks, rows["doc_id"] == marks["_id"]).drop("_id")


def votes(marked: DataFrame) -> DataFrame:
    """Of equal texts among the marked rows the one with the smallest id; of rows that repeat it the smallest."""
    one = marked.groupBy("text_hash").agg(F.min(F.struct("doc_id", *[c for c in marked.columns if c not in ("doc_id", "text_hash")])).alias("vote"))
    return one.select("vote.*", "text_hash")


def verdicts(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Measured rows with ``base_failed``, ``failed_rules`` and ``kept``."""
    joined = lookup(rows, broadcast_checked(limits), ["stratum"])
    failed = [F.when(F.col(r) > F.col("cutoffs")[i], F.lit(r)) for i, r in enumerate(RULES)]
    out = joined.withColumn("failed_rules", F.array_compact(F.array(*failed)))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cutoffs")


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, risk values, ``failed_rules, base_failed, kept`` for each document.

    Columns other than ``doc_id, text, lang`` are not read, whatever their
    names.  Defined cases: null and empty texts have no word and fail the base rule; a
    null stratum is a stratum of its own; ids with several labels take the
    largest; repeated rows repeat; without labels no cutoff applies; an empty
    table gives no rows.
    """
    rows = stage(measured(docs), "measures")
    return verdicts(rows, stage(cutoffs(votes(marked_rows(rows, labels))), "cutoffs"))
