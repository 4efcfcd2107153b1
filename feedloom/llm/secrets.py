"""Secrets: base patterns, and random strings told by two character Markov models.

Two first-order character models are trained on labelled samples: random
strings (hex, base64 and upper-case keys derived from hashes) and ordinary
identifiers (words of the corpus, alone and joined in the usual styles).  A
run of ``LEAST_LENGTH`` or more key characters is a secret when its
log-likelihood ratio per character passes a threshold set on held-out ordinary
identifiers.  Where a whole run does not pass, as a key behind a path does not,
its parts between ``/ = _ -`` are judged by themselves.

Training reads a bounded sample: the ``SAMPLE`` documents of smallest hash
give the words, and ``RANDOM`` random strings are made.  Scoring covers every
whole text.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import bound, running, sample_documents, stage
from feedloom.llm.spans import Kind, apart, digest, scan

SAMPLE, RANDOM = 500, 4000
#: Characters of the shortest run, or part of a run, that is judged.
LEAST_LENGTH = 20
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Ordinary identifiers held out that may pass, as a share; the least ratio per character.
PASS, LEAST = 0.001, 0.5

#: The quotes and spaces are no characters of what follows them, so possessive quantifiers change no match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
#: Whole runs only: shorter ones fail the count.
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}+"

NAMES = ["assign", "access", "hex", "random"]
BASE = 3


def _kinds() -> list[Kind]:
    return [
        Kind("assign", ASSIGN, "text rlike '[:=]'", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8),
        Kind("access", ACCESS, "contains(text, 'AKIA')", lambda m: F.length(m) >= 16),
        Kind("hex", HEX, "true"),
        Kind("random", TOKEN, "true"),
    ]


def random_strings(spark, n: int = RANDOM) -> DataFrame:
    """``token, label`` 1: strings without structure, in the usual alphabets of keys."""
    seed = F.sha2(F.concat(F.lit("random:"), F.col("id").cast("string")).cast("binary"), 512)
    base64 = F.regexp_replace(F.base64(F.unhex(seed)), "=+$", "")
    key = F.upper(F.regexp_replace(base64, "[^A-Za-z0-9]", ""))
    kind = F.col("id") % 4
    token = F.when(kind == 0, F.substring(seed, 1, 40)).when(kind == 1, F.substring(base64, 1, 40)).when(kind == 2, F.substring(key, 1, 24)).otherwise(F.translate(F.substring(base64, 1, 32), "+/", "-_"))
    return spark.range(n).select(token.alias("token"), F.lit(1).alias("label"))


def ordinary_identifiers(docs: DataFrame, n: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``token, label`` 0: words of a bounded sample of documents, and names joined from them."""
    few = sample_documents(docs, n, id_col, text_col)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?<![A-Za-z])[A-Za-z]{2,}+"), F.lit(0))
    rows = few.select(words.alias("w"))
    trio = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - 2)), lambda i: F.filter(F.slice("w", i, 3), lambda x: x.isNotNull()))
    parts = rows.filter(F.size("w") > 2).select(F.explode(trio).alias("p"))
    low = F.transform("p", lambda x: F.lower(x))
    pick = F.abs(F.xxhash64(F.array_join("p", "|"))) % 12
    camel = F.array_join(F.transform(low, lambda x: F.initcap(x)), "")
    numbered = F.concat(F.array_join(low, "-"), F.lit("-"), (F.abs(F.xxhash64("p")) % 100).cast("string"))
    name = (
        F.when(pick == 0, F.array_join(low, "_"))
        .when(pick == 1, camel)
        .when(pick == 2, F.upper(F.array_join("p", "_")))
        .when(pick == 3, F.array_join(low, "-"))
        .when(pick == 4, F.array_join(low, "/"))
        .when(pick == 5, numbered)
        .when(pick == 6, F.array_join(low, ""))
        .when(pick == 7, F.upper(F.array_join("p", "")))
    )
    made = parts.select(F.coalesce(name, F.col("p")[0]).alias("token"))
    return made.select("token", F.lit(0).alias("label"))


def log_ratios(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters, row by row of the alphabet.

    ``samples``: ``token, label``.  At most alphabet x alphabet x 2 counts
    reach the driver.  Add-one smoothing.
    """
    pairs = F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, F.lit(2)))
    counts = samples.filter(F.length("token") > 1).select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").count()
    size, at = len(ALPHABET), {c: i for i, c in enumerate(ALPHABET)}
    table = [[1.0] * (size * size) for _ in range(2)]
    for r in counts.collect():
        if len(r["pair"]) == 2 and all(c in at for c in r["pair"]):
            table[r["label"]][at[r["pair"][0]] * size + at[r["pair"][1]]] += r["count"]
    sums = [[sum(t[i * size : (i + 1) * size]) for i in range(size)] for t in table]
    return [math.log(table[1][k] / sums[1][k // size]) - math.log(table[0][k] / sums[0][k // size]) for k in range(size * size)]


def ratio(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of characters of ``token`` (two characters at least)."""
    size = len(ALPHABET)
    table = F.from_json(F.lit(json.dumps([round(x, 6) for x in ratios])), "array<double>")
    at = lambda c: F.instr(F.lit(ALPHABET), c) - 1

    def mean(codes: Column) -> Column:
        steps = F.zip_with(codes, F.slice(codes, 2, F.size(codes)), lambda a, b: F.when(b.isNull() | (a < 0) | (b < 0), F.lit(0.0)).otherwise(F.get(table, a * size + b)))
        return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.lit(1), F.size(codes) - 1)

    return bound(F.transform(F.filter(F.split(token, ""), lambda c: c != ""), at), mean)


def random_parts(run: Column, ratios: list[float], least: float) -> Column:
    """Spans ``kind, start, end`` of a run (a struct with ``start, end, match``): itself where it passes, else its parts that do."""
    passes = lambda c: ratio(c, ratios) >= least
    span = lambda a, b: F.struct(F.lit(BASE).alias("kind"), a.alias("start"), b.alias("end"))
    pieces = F.regexp_extract_all(run["match"], F.lit(r"[/=_-]++|[A-Za-z0-9+]++"), F.lit(0))

    def parts(p: Column) -> Column:
        ends = running(F.transform(p, lambda x: F.length(x).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
        rows = F.zip_with(p, ends, lambda x, end: F.struct(x.alias("x"), (run["start"] + end).alias("end")))
        good = F.filter(rows, lambda r: (F.length(r["x"]) >= LEAST_LENGTH) & F.when(F.length(r["x"]) >= LEAST_LENGTH, passes(r["x"])).otherwise(F.lit(False)))
        return F.transform(good, lambda r: span(r["end"] - F.length(r["x"]), r["end"]))

    return F.when(passes(run["match"]), F.array(span(run["start"], run["end"]))).otherwise(bound(pieces, parts))


def train(docs: DataFrame) -> tuple[list[float], float]:
    """The ratios and the threshold: passed by at most ``PASS`` of held-out ordinary identifiers of 20 characters or more."""
    spark = docs.sparkSession
    samples = stage(random_strings(spark).unionByName(ordinary_identifiers(docs)), "samples").withColumn("fold", F.abs(F.xxhash64("token")) % 3)
    ratios = log_ratios(samples.filter("fold < 2"))
    held = samples.filter((F.col("fold") == 2) & (F.col("label") == 0) & (F.length("token") >= 20))
    cut = held.select(ratio(F.col("token"), ratios).alias("r")).agg(F.percentile("r", 1 - PASS)).first()[0]
    return ratios, max(LEAST, cut if cut is not None else LEAST)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[list[float], float] | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row per row of ``docs``.

    ``model``: what :func:`train` gives; trained on ``docs`` where absent.
    Defined cases: a null text is empty; null and repeated ids are told apart
    by row; random strings that overlap a base span are not added; an empty
    table gives no rows; other columns are not read.
    """
    ratios, least = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))) if model is None else model
    found = scan(docs, _kinds(), BASE, id_col, text_col)
    extra = F.flatten(F.transform("more", lambda r: random_parts(r, ratios, least)))
    return digest(found.select("doc_id", "own", apart(extra, F.col("own")).alias("added")), NAMES, BASE, by_kind=False)
