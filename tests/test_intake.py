"""Sources that fail whole or in part, and many terms at once."""

import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import terms, text
from feedloom.operators import batches
from feedloom.sources import connectors, intake


def tables(spark, tmp_path):
    return batches.BatchTable(spark, f"{tmp_path}/items", connectors.MATERIAL), batches.BatchTable(spark, f"{tmp_path}/bad", intake.QUARANTINE)


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def test_a_source_with_a_failing_column_is_empty(spark):
    """The cast fails only when the column is read, which counting rows does not do."""
    connectors.register("bad cast", lambda spark, o: spark.range(5).select(F.raise_error(F.lit("no number")).cast("string").alias("url"), *[F.lit("x").alias(c) for c in connectors.COLUMNS[1:-1]], F.col("id").alias("ordinal")))
    got = connectors.read(spark, "bad cast", {})
    assert got.collect() == [] and got.columns == connectors.COLUMNS
    with pytest.raises(KeyError):
        connectors.read(spark, "unheard of", {})


def test_bad_records_are_set_aside(spark, tmp_path):
    items, bad = tables(spark, tmp_path)
    put(tmp_path / "a", "1.json", {"url": "u1", "title": "t"}, "{broken", "[1]", {"title": "no url"}, {"url": {"x": 1}, "title": 5}, "", {"url": " u2 ", "content": None})
    put(tmp_path / "a", "2.json", {"url": "u3"})
    put(tmp_path / "b", "1.json", {"url": "u4"})
    feeds = [intake.Feed("a", f"{tmp_path}/a"), intake.Feed("b", f"{tmp_path}/b"), intake.Feed("gone", f"{tmp_path}/gone")]
    causes = intake.take_in(spark, feeds, items, bad, f"{tmp_path}/cp")
    assert causes["a"] is None and causes["b"] is None and causes["gone"]
    assert sorted((r["url"], r["source"], r["content"]) for r in items.read().collect()) == [("u1", "a", ""), ("u2", "a", ""), ("u3", "a", ""), ("u4", "b", "")]
    listed = bad.read().collect()
    assert {r["line"]: r["reason"] for r in listed} == {"{broken": "not JSON", "[1]": "not an object", '{"title": "no url"}': "no url", '{"url": {"x": 1}, "title": 5}': "a field of another type"}
    assert all(r["file"].endswith("a/1.json") for r in listed) and len(listed) == 4
    put(tmp_path / "a", "3.json", {"url": "u5"})
    intake.take_in(spark, feeds[:2], items, bad, f"{tmp_path}/cp")
    assert items.read().count() == 5 and bad.read().count() == 4


def test_a_killed_intake_writes_nothing_twice(spark, tmp_path, monkeypatch):
    items, bad = tables(spark, tmp_path)
    put(tmp_path / "a", "1.json", {"url": "u1"}, "nonsense")
    write, calls = items.write, []

    def fail_once(rows, batch):
        calls.append(batch)
        if len(calls) == 1:
            raise OSError("killed")
        return write(rows, batch)

    monkeypatch.setattr(items, "write", fail_once)
    feed = [intake.Feed("a", f"{tmp_path}/a")]
    assert "killed" in intake.take_in(spark, feed, items, bad, f"{tmp_path}/cp")["a"]
    assert intake.take_in(spark, feed, items, bad, f"{tmp_path}/cp")["a"] is None
    assert items.read().count() == 1 and bad.read().count() == 1


def test_last_good_version(spark, tmp_path):
    cache = batches.BatchTable(spark, f"{tmp_path}/cache", connectors.MATERIAL)
    read = lambda day: sorted(r["url"] for r in intake.read_or_last(spark, "links", {"path": f"{tmp_path}/{day}", "source": "s"}, cache, day).collect())
    assert read("2026-01-01") == []
    put(tmp_path / "2026-01-02", "l.txt", "one\thttps://a")
    put(tmp_path / "2026-01-04", "l.txt", "two\thttps://b")
    put(tmp_path / "2026-01-05", "l.txt", "# nothing yet")
    assert read("2026-01-02") == read("2026-01-03") == ["https://a"]
    assert read("2026-01-04") == read("2026-01-05") == ["https://b"]


def test_many_terms_equal_the_plain_rule(spark, tables_or_random):
    texts, vocabulary = tables_or_random
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "id long, text string")
    listed = spark.createDataFrame(list(enumerate([*vocabulary, "", None])), "place int, term string")
    got = {r["id"]: [(f["term"], f["times"]) for f in r["found"]] for r in terms.find_terms(docs, "text", listed).collect()}
    for i, t in enumerate(texts):
        low = t.lower()
        assert got[i] == [(w, low.count(w.lower())) for w in vocabulary if w.lower() in low]
    assert got[len(texts)] == got[len(texts) + 1] == []


@pytest.fixture
def tables_or_random():
    rng = random.Random(4)
    words = ["".join(rng.choice("abAB ") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    return ["".join(rng.choice("abAB \n") for _ in range(rng.randint(0, 80))) for _ in range(40)], list(dict.fromkeys(words))


def test_a_hundred_thousand_terms_over_documents(spark, tables, monkeypatch):
    """In two chunks; against contains, for the terms of a sample of texts."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    rng = random.Random(1)
    real = sorted({w for r in docs.orderBy("doc_id").limit(30).collect() for w in r["text"].split()})[:3000]
    listed = real + [f"zq{rng.randrange(10**9)}" for _ in range(100_000 - len(real))]
    frame = spark.createDataFrame(list(enumerate(listed)), "place int, term string")
    monkeypatch.setattr(terms, "CHUNK_TERMS", 60_000)
    got = {r["doc_id"]: r["t"] for r in terms.find_terms(docs, "text", frame).select("doc_id", terms.term_names(F.col("found")).alias("t")).collect()}
    for r in docs.orderBy("doc_id").limit(12).collect():
        low = r["text"].lower()
        assert got[r["doc_id"]] == [w for w in listed if w.lower() in low]


def test_terms_of_a_group(spark):
    items = spark.createDataFrame([("en", "A Cat", "dog"), ("de", "cat", "Hund"), ("fr", "cat", ""), (None, "cat", "")], "topic string, title string, snippet string")
    topics = spark.createDataFrame([("en", ["dog", "cat", "Cat", "bird"]), ("de", ["hund"]), ("xx", ["cat"])], "topic string, terms array<string>")
    assert {r["topic"]: r["matched_terms"] for r in connectors.watched(items, topics).collect()} == {"en": ["dog", "cat", "Cat"], "de": ["hund"]}


def test_tone_is_unchanged_by_binding(spark):
    rows = [("",), (None,), ("a——b — 首先，赋能。可能 也许！\n- x\n1. y",), ("赋能" * 30,), (" ",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.tone(F.col("t"))).collect()]
    assert got[0] == got[1] == got[4] and got[0]["ai_score"] == 0.0 and got[0]["cliche_hits"] == []
    assert got[2]["dash_count"] == 4 and got[2]["bullet_density"] == 0.67
