"""Clusters by similarity join against the plain fold."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import blocks, clusters, relations

WORDS = ["rise", "model", "open", "chip", "cloud", "agent", "launch", "GPT", "new", "data", "in", "a", "🙂x", "发布", "模型", "开源"]


def titles(seed, n):
    """Titles in near copies, of all lengths, some without a key, some repeated after others came between."""
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 5))) for _ in range(n // 6)]
    for i in range(n):
        t = rng.choice(base)
        if rng.random() < 0.5:
            t += " " + rng.choice(WORDS)
        if rng.random() < 0.3:
            t = t.replace(rng.choice("aeio"), rng.choice(["", "u", "x"]))
        if rng.random() < 0.03:
            t = rng.choice(["", "!!", None, "a", "ai"])
        yield (i, t, 0)


def fold(df):
    return {r["ordinal"]: r["cluster"] for r in relations.cluster_titles(df, ["block"]).collect()}


@pytest.mark.parametrize(("seed", "budget", "per_title"), [(1, 20_000_000, 200), (2, 4_000, 1), (3, 0, 0)])
def test_same_clusters_as_the_fold(spark, monkeypatch, seed, budget, per_title):
    """In one part, in several, and title by title."""
    monkeypatch.setattr(clusters, "PAIRS_PER_TITLE", per_title)
    df = spark.createDataFrame(list(titles(seed, 250 if budget else 24)), "ordinal long, title string, block int")
    got = clusters.cluster(df, pair_budget=budget)
    assert got.columns == [*df.columns, "cluster"]
    assert {r["ordinal"]: r["cluster"] for r in got.collect()} == fold(df)


def test_filters_lose_no_pair(spark):
    """Every pair of titles that reaches the threshold, in either direction, passes the filters."""
    keys = sorted({k for _, t, _ in titles(5, 160) for k in [(t or "").replace(" ", "").lower()] if k})
    df = spark.createDataFrame([(i, k, i) for i, k in enumerate(keys)], "at long, key string, last long")
    df = df.withColumns({"grams": clusters.bigrams(F.col("key")), "chars": clusters._characters(F.col("key"))})
    tokens = clusters.stage(clusters._tokens(df, clusters.THRESHOLD, clusters.SCALE), "tokens")
    found = {(r["head"], r["item"]) for r in clusters._pairs(tokens, tokens, clusters.THRESHOLD, clusters.SCALE, both=True).collect()}
    want = {(i, j) for i, a in enumerate(keys) for j, b in enumerate(keys) if i < j and max(relations.similarity(a, b), relations.similarity(b, a)) >= clusters.THRESHOLD}
    assert want and want <= found and len(found) < len(keys) * (len(keys) - 1) / 2


def test_a_repeated_title_goes_to_the_better_head_that_came_between(spark):
    rows = [(0, "abcdefgh xyz"), (1, "abcdefgh"), (2, "qrstuvwabcd"), (3, "abcdefgh"), (4, "abcdefgh xyz")]
    df = spark.createDataFrame([(o, t, 0) for o, t in rows], "ordinal long, title string, block int")
    assert {r["ordinal"]: r["cluster"] for r in clusters.cluster(df).collect()} == fold(df)


def test_many_copies_meet_one_head(spark):
    """A title that is most of the table is one row until the end; its near copies do not meet each other beyond the budget."""
    df = spark.range(3000).select(F.col("id").alias("ordinal"), F.when(F.col("id") % 3 > 0, "the one headline").otherwise(F.concat(F.lit("the one headline, part "), F.col("id") % 40)).alias("title"))
    got = clusters.cluster(df, pair_budget=500)
    assert got.select("cluster").distinct().count() <= 3 and got.count() == 3000


def test_no_titles(spark):
    df = spark.createDataFrame([(0, None), (1, "!")], "ordinal long, title string")
    assert sorted(tuple(r) for r in clusters.cluster(df).select("ordinal", "cluster").collect()) == [(0, 0), (1, 1)]
    assert clusters.cluster(df.limit(0)).collect() == []


def edges(rows, both):
    """What :class:`relations.Head` finds, pair by pair."""
    out = {}
    for at, _, key in rows:
        head = relations.Head(key, at)
        for other, last, k in rows:
            if other != at and (at < other if both else at < last):
                s = head.beats(k, {k[i : i + 2] for i in range(len(k) - 1)}, clusters.THRESHOLD, 0.0)
                if s is not None:
                    out[at, other] = s
    return out


@pytest.mark.parametrize("both", [True, False])
def test_blocks_find_what_heads_find(spark, monkeypatch, both):
    """Over several chunks, with titles of one letter, of over 64 and of over 200 letters, and keys that come again."""
    monkeypatch.setattr(blocks, "CHUNK", 40)
    monkeypatch.setattr(blocks, "AT_ONCE", 100)
    rng = random.Random(7)
    keys = {(t or "").replace(" ", "").lower() for _, t, _ in titles(6, 200)} | {"a", "ab", "\x00", "a\x00"}
    words = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(30)]
    keys |= {"".join(rng.choice(words) for _ in range(n)) for n in (10, 12, 15, 16, 17, 18, 20, 60, 60) for _ in range(3)}
    keys |= {k[:-2] + "e" for k in keys if len(k) > 60}
    keys = sorted(keys - {""})
    rng.shuffle(keys)
    rows = [(i, i + rng.choice([0, 0, 50]), k) for i, k in enumerate(keys)]
    df = clusters.stage(spark.createDataFrame(rows, "at long, last long, key string"), "keys")
    got = blocks.compared(df, df, clusters.THRESHOLD, clusters.SCALE, both).collect()
    want = edges(rows, both)
    assert {(r["head"], r["item"]): r["similarity"] for r in got} == want and len(got) == len(want) > 100


@pytest.mark.parametrize("by_blocks", [True, False])
def test_either_way_gives_the_same_clusters(spark, monkeypatch, by_blocks):
    monkeypatch.setattr(clusters, "tokens_are_common", lambda *_: by_blocks)
    monkeypatch.setattr(clusters, "PAIRS_PER_TITLE", 1)
    df = spark.createDataFrame(list(titles(8, 150)), "ordinal long, title string, block int")
    assert {r["ordinal"]: r["cluster"] for r in clusters.cluster(df, pair_budget=3000).collect()} == fold(df)


def test_titles_of_common_tokens_make_no_pairs_of_rows(spark, monkeypatch):
    """Prose shares its letters: a join on tokens would make each pair many times over."""
    monkeypatch.setattr(clusters, "_pairs", lambda *_: pytest.fail("joined on tokens"))
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoins") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    df = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(9)), 0) for i in range(300)], "ordinal long, title string, block int")
    assert {r["ordinal"]: r["cluster"] for r in clusters.cluster(df).collect()} == fold(df)


def test_rare_tokens_are_joined(spark):
    df = spark.createDataFrame([(i, "".join(chr(0x4E00 + (i * 37 + j * j * 11 + i * i * j) % 20000) for j in range(12)), i) for i in range(300)], "at long, key string, last long")
    assert not clusters.tokens_are_common(df)


def test_first_line(spark):
    from feedloom.functions import text

    texts = [None, "", " \n  \n", "a", "\n\n  a b \n c", "a\n", " \t x\ty \nz", "\r\nq", "é  \n\nz"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(text.first_line(F.col("t"))).collect()]
    assert got == [next((x.strip(" ") for x in (t or "").split("\n") if x.strip(" ")), "") for t in texts]
