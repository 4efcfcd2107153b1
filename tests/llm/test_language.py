import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import language

SCHEMA = "doc_id long, text string, lang string"


def plain_counts(texts, order):
    """Followers of each context of up to ``order`` bytes."""
    after = defaultdict(Counter)
    for t in texts:
        data = b"\n" * order + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                after[data[i - k : i]][data[i]] += 1
    return after


def plain_bits(after, text, order):
    """Code length, byte by byte, with escapes and exclusion written out."""
    data, bits = b"\n" * order + text, 0.0
    for i in range(order, len(data)):
        excluded = set()
        for k in range(order, -1, -1):
            left = {s: n for s, n in after.get(data[i - k : i], {}).items() if s not in excluded}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if data[i] in left:
                bits -= math.log2(left[data[i]] / whole)
                break
            bits -= math.log2(len(left) / whole)
            excluded |= set(left)
        else:
            bits -= math.log2(1 / (256 - len(excluded)))
    return bits


@pytest.mark.parametrize("order", [1, 2, 4])
def test_code_lengths_are_those_of_plain_ppm(order):
    rng = random.Random(order)
    draw = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 60))).encode()
    taught = {"x": [draw("abcde ") for _ in range(30)], "y": [draw("abcdé \n") for _ in range(5)]}
    texts = [draw("abcde é\nzü") for _ in range(40)]
    trees = []
    for name in sorted(taught):
        keys, n = np.unique(language.strings(taught[name], order), return_counts=True)
        trees.append(language.tree(keys, n, order))
    got = language.code_lengths(language.Model(sorted(taught), trees), texts)
    want = [[plain_bits(plain_counts(taught[name], order), t, order) for name in sorted(taught)] for t in texts]
    assert np.allclose(got, want)


def test_costs_of_a_context_sum_to_one():
    keys, n = np.unique(language.strings([b"abracadabra", b"banana"], 4), return_counts=True)
    levels = language.tree(keys, n, 4)
    for context in (b"\n\n\n\n", b"abra", b"zzza", b"zzzz"):
        each = language.costs(levels, (int.from_bytes(context, "big") << 8) + np.arange(256))
        assert abs(np.exp2(-each).sum() - 1) < 1e-9


def test_held_out_accuracy(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = language.predict(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97


def test_held_out_rows_languages_and_ids_teach_nothing(spark):
    rows = [(i, "the and of with" if i % 2 else "der die das und", "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    lied = docs.withColumn("lang", F.when(language.held_out(), "xx").otherwise(F.col("lang"))).unionByName(spark.createDataFrame([(None, "zz", "yy"), (90, "zz", None)], SCHEMA))
    a, b = language.train(docs), language.train(lied)
    assert a.names == b.names == ["de", "en"]
    for s, t in zip(a.trees, b.trees, strict=True):
        for x, y in zip(s, t, strict=True):
            assert all(np.array_equal(p, q) for p, q in zip(x, y, strict=True))


def test_defined_cases(spark):
    taught = [(i, "the and of with" if i % 2 else "der die das und", "en" if i % 2 else "de") for i in range(40)]
    rows = [(100, None, "en"), (101, "", None), (102, "123 !?", "en"), (103, "漢字", None), (None, "with the", "de"), (105, "the " * 50_000, None), (106, "der", None), (106, "der", None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"lang_pred": F.lit("no"), "score": F.lit(9), "held_out": F.lit("x")})
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in language.predict(docs, language.train(spark.createDataFrame(taught, SCHEMA))).collect()]
    assert sorted((d or 0, p) for d, _, p, _ in got) == [(0, "en"), (100, "und"), (101, "und"), (102, "und"), (103, "en"), (105, "en"), (106, "de"), (106, "de")]
    assert all(s == 0.0 for _, _, p, s in got if p == "und") and next(h for d, h, *_ in got if d is None) is False


def test_equal_code_lengths_go_to_the_smaller_name(spark):
    docs = spark.createDataFrame([(0, "abc", "b"), (1, "abc", "a")], SCHEMA)
    found = language.predict(docs, language.train(docs.filter(~language.held_out()))).collect()
    names = {r["lang"] for r in docs.filter(~language.held_out()).collect()}
    assert {r["lang_pred"] for r in found} == {min(names)}


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(0, "abc", None)], SCHEMA)
    model = language.train(docs)
    assert [(r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()] == [("und", 0.0)]
    assert language.predict(docs.limit(0), model).collect() == []


def test_sample_is_bounded_and_holds_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 5)
    monkeypatch.setattr(language, "LANGUAGE_BYTES", 40)
    docs = spark.createDataFrame([(i, f"text {i:04d}", "en" if i % 3 else "de") for i in range(300)], SCHEMA)
    few = language.sample(docs, "doc_id", "text", "lang").collect()
    assert Counter(r["lang"] for r in few) == {"en": 4, "de": 4} and all(len(r["text"]) == 9 for r in few)
