from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.operators import items
from feedloom.plans import flow


def test_items(spark):
    raw = spark.createDataFrame([("u", None, "s"), ("", "t", "s"), (None, "t", "s")], "url string, title string, source string")
    assert [tuple(r) for r in items.standardise(raw).collect()] == [("u", "", "s")]
    links = items.page_links(spark.createDataFrame([('<a href="/x"><b>One</b></a><a href="https://o.p/q">Two</a><a href="z"></a>',)], ["html"]), F.lit("https://a.b/c"))
    assert [tuple(r) for r in links.collect()] == [("https://a.b/x", "One"), ("https://o.p/q", "Two")]
    cells = spark.createDataFrame([('{"link":"l","text":"t"}',), ('[{"text":"t"}]',), ("plain",), (None,)], ["c"])
    assert [r["x"] for r in cells.select(items.cell_text(F.col("c")).alias("x")).collect()] == ["l", "t", "plain", ""]
    drafts = spark.createDataFrame([("u", "a" * 400, "b" * 40), ("v", "ok", "")], "url string, short string, long string")
    fitted = {r["url"]: r for r in items.fit_lengths(drafts, {"short": ("x", 380, "X"), "long": ("xiaohongshu", 450, "L")}).collect()}
    assert fitted["u"]["short"] == "a" * 380 + "..." and len(fitted["u"]["fixes"]) == 2 and len(fitted["v"]["fixes"]) == 1
    reviews = spark.createDataFrame([("u", "revise", 1), ("v", "publish", 1)], "url string, action string, fixable int")
    revisions = spark.createDataFrame([("u", "new", ""), ("v", "new", "n"), ("w", "x", "y")], "url string, short string, long string")
    got = {r["url"]: (r["short"], r["long"]) for r in items.revise(drafts, reviews, revisions, {"short": 2, "long": 9}).collect()}
    assert got == {"u": ("ne", "b" * 40), "v": ("ok", "")}
    assert items.merged({"a": 1, "r": {"x": 1}}, {"a": None, "r": {"y": 2}}) == {"a": 1, "r": {"x": 1, "y": 2}}
    calls = []

    def flaky(batch):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return batch

    assert items.invoke(flaky, [{}], pause=lambda s: None) == [{}] and len(calls) == 3
    assert spark.range(1).select(items.tidy_paragraphs(F.lit("a\n\n。\n\n\n\nb")).alias("x")).first()["x"] == "a\n\nb"


def test_long_quality(spark):
    tags = F.array(F.lit("AI"), F.lit("b"), F.lit("c"))
    good = spark.range(1).select(items.long_quality(F.lit("一个合适的标题在这里"), F.lit("适合新手，建议先看价格。" * 12), tags, F.lit(9.0)).alias("q")).first()["q"]
    assert good["score"] == 99 and good["notes"] == "ok"


def test_flow(spark):
    schema = "url string, title string, snippet string, content string, source string, ordinal long, batch string"
    body = "GPT-5 的价格和权限都有变化，开发者可以先看文档。" * 12
    a = [("https://a.b/1?utm_source=x", "OpenAI 发布 GPT-5", "s", body, "aihot-hot", 0, "d"), ("https://a.b/2", "苹果新手机发布会 AI", "s", body, "github-trending", 1, "d"), ("", "no url", "", "", "x", 2, "d")]
    b = [("https://a.b/1", "OpenAI发布GPT-5!", "s", body, "rss", 0, "d"), ("https://c.d/9", "seen before AI", "s", body, "rss", 1, "d"), ("https://c.d/3", "OpenAI发布GPT-5！", "s", body, "rss", 2, "d")]
    out = flow.run([("one", spark.createDataFrame(a, schema)), ("two", spark.createDataFrame(b, schema))], spark.createDataFrame([("https://c.d/9",)], ["key"]))
    assert out.merged.count() == 5
    assert sorted(r["key"] for r in out.fresh.collect()) == ["https://a.b/1", "https://a.b/2", "https://c.d/3"]
    events = out.events.collect()
    assert len(events) == 2 and {r["cluster_size"] for r in events} == {1, 2}
    picked = out.picked.orderBy("pick_rank").collect()
    assert [r["pick_rank"] for r in picked] == [1, 2] and all(r["heat_score"] >= 30 for r in picked)
    assert tuple(out.funnel.first()) == (3, 3, 5) and out.branch() in ("one", "both")
    assert out.clean.filter(F.length("content") > text.CONTENT_MAX).count() == 0


def test_clusters_are_those_of_the_plain_rule(spark):
    """Every head compared in full, without bounds."""
    import random

    from feedloom.operators import relations

    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(1, 30))) for _ in range(12)]
    titles = [t if rng.random() < 0.3 else "".join(c for c in t if rng.random() > 0.15) for t in (rng.choice(base) for _ in range(150))]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(titles)], "ordinal long, title string, batch int")
    keys = {r["ordinal"]: r["k"] for r in df.select("ordinal", relations.title_key(df["title"]).alias("k")).collect()}
    want = {}
    for batch in (0, 1):
        heads = []
        for i in range(batch, 150, 2):
            best, where = 0.0, None
            for head, c in heads if keys[i] else []:
                s = relations.similarity(keys[i], head)
                if s >= 0.72 and s > best:
                    best, where = s, c
            if where is None:
                where = i
                heads += [(keys[i], i)] if keys[i] else []
            want[i] = where
    assert {r["ordinal"]: r["cluster"] for r in relations.cluster_titles(df, ["batch"]).collect()} == want
