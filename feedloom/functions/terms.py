"""Many terms at once: one automaton (Aho-Corasick) finds all of them in one pass over a text.

The cost of a row is its text's length and its hits, however many terms there
are.  Terms are broadcast, a chunk of at most ``CHUNK_TERMS`` at a time, and
each Python worker builds a chunk's automaton once.  For a handful of fixed
words the Column functions in ``text`` stay inside the JVM and are cheaper.

Matching is that of ``contains`` on lower-cased text; counts are those of
non-overlapping occurrences from the left, each term by itself.  Empty and
null terms match nothing.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

#: Terms of one automaton (some 100 bytes a character at most).
CHUNK_TERMS = 500_000

FOUND = ArrayType(StructType().add("place", "integer").add("term", "string").add("times", "integer"))
_FOUND = pa.list_(pa.struct([("place", pa.int32()), ("term", pa.string()), ("times", pa.int32())]))

_built: OrderedDict[str, ahocorasick.Automaton] = OrderedDict()


def automaton(terms: list[tuple[int, str | None, str]]) -> ahocorasick.Automaton:
    """``place, group, term`` by lower-cased term."""
    by_word: dict[str, list[tuple[int, str | None, str]]] = {}
    for place, group, term in terms:
        by_word.setdefault(term.lower(), []).append((place, group, term))
    out = ahocorasick.Automaton()
    for word, of in by_word.items():
        out.add_word(word, (len(word), of))
    out.make_automaton()
    return out


def _shared(name: str, terms: list[tuple[int, str | None, str]]) -> ahocorasick.Automaton:
    """The worker's automaton of a broadcast chunk; the last few stay."""
    if name not in _built:
        _built[name] = automaton(terms)
        while len(_built) > 4:
            _built.popitem(last=False)
    return _built[name]


def hits(found: ahocorasick.Automaton, text: str | None, group: str | None = None) -> list[tuple[int, str, int]]:
    """``place, term, times`` of the terms (of ``group`` or of none) that occur, in the order of their places."""
    if not text or not len(found):
        return []
    times: dict[int, int] = {}
    ends: dict[int, int] = {}
    terms: dict[int, str] = {}
    for end, (n, of) in found.iter(text.lower()):
        for place, own, term in of:
            if own is not None and own != group:
                continue
            if end - n >= ends.get(place, -1):
                times[place] = times.get(place, 0) + 1
                ends[place] = end
                terms[place] = term
    return [(p, terms[p], times[p]) for p in sorted(times)]


def find_terms(df: DataFrame, text: str, terms: DataFrame, group: str | None = None, out: str = "found") -> DataFrame:
    """Add ``out``: an array of ``place, term, times`` of the terms that occur in the column ``text``.

    ``terms``: ``place`` (a whole number, their order), ``term`` and, with
    ``group``, the value of that column in the rows that it is for.
    """
    spark = df.sparkSession
    usable = terms.filter(F.coalesce(F.col("term"), F.lit("")) != "")
    chunks = max(1, -(-usable.count() // CHUNK_TERMS))
    wanted = usable.select(F.col("place").cast("int"), (F.col(group) if group else F.lit(None)).cast("string").alias("own"), "term", F.pmod(F.xxhash64("term"), F.lit(chunks)).alias("chunk"))
    parts: list[str] = []
    for i in range(chunks):
        # one collect a chunk, about CHUNK_TERMS rows
        few = [(r["place"], r["own"], r["term"]) for r in wanted.filter(F.col("chunk") == i).collect()]
        shared, name = spark.sparkContext.broadcast((uuid.uuid4().hex, few)), f"{out}_{i}"
        parts.append(name)
        df = _with_found(df, text, group, shared, name)
    arrays = F.array_sort(F.concat(*parts)) if chunks > 1 else F.col(parts[0])
    return df.withColumn(out, arrays).drop(*[p for p in parts if p != out])


def _with_found(df: DataFrame, text: str, group: str | None, shared, out: str) -> DataFrame:
    at, by, schema = df.columns.index(text), df.columns.index(group) if group else None, StructType([*df.schema.fields, StructField(out, FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _shared(*shared.value)
        for b in batches:
            groups = b.column(by).to_pylist() if by is not None else [None] * b.num_rows
            rows = [hits(found, t.as_py(), None if g is None else str(g)) for t, g in zip(b.column(at), groups, strict=True)]
            told = pa.array([[{"place": p, "term": t, "times": n} for p, t, n in r] for r in rows], _FOUND)
            yield pa.RecordBatch.from_arrays([*b.columns, told], names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def term_names(found: Column, most: int | None = None) -> Column:
    """The terms of :func:`find_terms`, in order, the first ``most``."""
    names = F.transform(found, lambda x: x["term"])
    return F.slice(names, 1, most) if most else names


def term_total(found: Column) -> Column:
    """All occurrences."""
    return F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x["times"])
