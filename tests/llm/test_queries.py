"""The registered queries against their SQL, and the pipeline against a plain version."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from feedloom.llm import qda, queries, simhash, tokens


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(name, spark, tables, duck, same_rows):
    same_rows(queries.QUERIES[name](spark, tables), duck, queries.SQL[name])


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tables):
    """Stage by stage on the same input: kept ids, mixed words, and the ids of the packed windows."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]

    good = stages["quality_classifier"](spark, docs, tables)
    model, feats = qda.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    good_ids = {r["doc_id"] for r in qda.scores(feats, model).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == good_ids and good.columns == docs.columns

    last = {}
    for r in good.collect():
        h = hashlib.sha256((r["text"] or "").encode()).digest()
        last[h] = max(last.get(h, r["doc_id"]), r["doc_id"])
    unique = stages["exact_dedup"](spark, good, tables)
    assert {r["doc_id"] for r in unique.collect()} == set(last.values()) and unique.columns == docs.columns

    rows = unique.collect()
    fps = np.array([simhash.fingerprint(r["text"]) for r in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = np.array([np.bitwise_count(fps ^ f) <= 2 for f in fps])
    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = sorted((find(i), find(j)), key=lambda k: rows[k]["doc_id"])
        root[b] = a
    single = stages["simhash_near_dedup"](spark, unique, tables)
    assert {r["doc_id"] for r in single.collect()} == {rows[find(i)]["doc_id"] for i in range(len(rows))}

    mixed = stages["mixing"](spark, single, tables)
    assert mixed.columns == docs.columns
    total = sum(len((r["text"] or "").encode().split()) for r in single.collect())
    words = sum(len((r["text"] or "").encode().split()) for r in mixed.collect())
    assert abs(words - 1.5 * total) <= docs.select("source").distinct().count()

    packed = stages["packing"](spark, mixed, tables).collect()
    assert sum(p["length"] for p in packed) == sum(len(tokens.encoder()(r["text"])) + 1 for r in mixed.collect())


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
