"""A run from the command line, its reports, and the readers that it may use."""

import json


from feedloom import __main__ as cli
from feedloom.operators import relations
from feedloom.operators.batches import BatchTable
from feedloom.plans import reports
from feedloom.sources import connectors


def feed(folder, name, items):
    (folder / name).write_text(json.dumps({"items": items}, ensure_ascii=False))
    return str(folder / name)


def test_runs_one_after_the_other(spark, tmp_path, capsys):
    body = "GPT-5 的价格和权限都有变化，开发者可以先看文档。" * 12
    item = lambda n, title: {"url": f"https://a.b/{n}", "title": title, "content": body}
    one = feed(tmp_path, "one.json", [item(1, "OpenAI 发布 GPT-5"), item(2, "苹果 AI 新手机发布会")])
    two = feed(tmp_path, "two.json", [item(1, "OpenAI发布GPT-5!"), item(3, "OpenAI发布GPT-5！"), item(4, "某公司 agent 框架开源")])
    config = [{"type": "feed", "name": "aihot-hot", "path": one}, {"type": "feed", "name": "github-x", "path": two, "cap": 2}, {"type": "feed", "name": "gone", "path": str(tmp_path / "none")}, {"type": "feed", "name": "off", "path": one, "enabled": False}]
    (tmp_path / "sources.json").write_text(json.dumps(config, indent=1))
    args = ["--sources", str(tmp_path / "sources.json"), "--state", f"{tmp_path}/state", "--out", f"{tmp_path}/out"]
    first = cli.run(spark, cli.arguments([*args, "--run", "r1"]))
    assert first == {"collected": 4, "fresh": 3, "hot": 3, "picked": 2, "added": 2}
    assert cli.run(spark, cli.arguments([*args, "--run", "r1"])) == first  # a run of a name is the same run
    again = cli.run(spark, cli.arguments([*args, "--run", "r2"]))
    assert (again["fresh"], again["picked"], again["added"]) == (0, 0, 0)
    cleared = cli.run(spark, cli.arguments([*args, "--run", "r3", "--clear-dedup", "--max-drafts", "1", "--target-platform", "x"]))
    assert (cleared["fresh"], cleared["picked"], cleared["added"]) == (3, 1, 0)
    late = cli.run(spark, cli.arguments([*args, "--run", "r4", "--clear-dedup", "--no-table", "--no-local", "--min-heat-score", "101"]))
    assert (late["hot"], late["picked"], late["added"]) == (0, 0, 0)
    table = BatchTable(spark, f"{tmp_path}/state/table", cli.ROWS)
    assert table.read().count() == 2 and table.read().select("link").distinct().count() == 2


def test_four_reports_of_a_run(spark, tmp_path):
    made = spark.createDataFrame([("d1", "u1", "x" * 200, "ai", "p1", 80.0), ("d2", "u2", None, "ai", None, 70.5), ("d3", "u3", "y", "", "p1", None)], "draft_id string, url string, short_text string, pillar string, title_pattern string, long_score double")
    lost = spark.createDataFrame([("u4", "t", "s", "首次失败: too long; 修复后失败: x", "x_quality_fail", 0), ("u5", "t", None, "too long", "x_quality_fail", 1), ("u6", "t", "s", "", None, 2)], "url string, title string, source string, reason string, reject_kind string, ordinal int")
    told = reports.of_run(made, lost)
    quality = {r["draft_id"]: r for r in told.quality.collect()}
    assert len(quality["d1"]["preview"]) == 120 and quality["d2"]["preview"] == "" and quality["d3"]["source"] is None
    assert told.quality.columns == [*reports.QUALITY, "preview"] and told.growth_items.columns == reports.GROWTH
    assert {(r["part"], r["name"]): (r["n_drafts"], r["avg_score"]) for r in told.growth.collect()} == {("pillar", "ai"): (2, 75.25), ("pillar", "unknown"): (1, 0.0), ("title_pattern", "p1"): (2, None), ("title_pattern", "unknown"): (1, None)}
    assert {(r["part"], r["name"]): r["n_rejects"] for r in told.reject_counts.collect()} == {("kind", "x_quality_fail"): 2, ("kind", "unknown"): 1, ("source", "s"): 2, ("source", "unknown"): 1, ("reason", "too long"): 2}
    assert reports.publish(spark, told, f"{tmp_path}/r", "run-1") and not reports.publish(spark, told, f"{tmp_path}/r", "run-1")
    assert spark.read.json(f"{tmp_path}/r/run-1/rejects").count() == 3
    none = reports.of_run(made.limit(0), lost.limit(0))
    assert none.growth.count() == none.reject_counts.count() == none.quality.count() == 0


def test_curated_and_news_readers(spark, tmp_path):
    path = feed(tmp_path, "c.json", [{"url": "https://o/1", "permalink": "https://p/1", "title": "t", "summary": "s", "category": "paper", "score": 7, "selected": True}, {"title": "no url"}, {"url": "https://o/2", "category": "x"}, {"url": "https://o/3"}])
    items = connectors.json_items(spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw"))
    got = [(r["url"], r["original_url"], r["section_name"], r["score"], r["selected"]) for r in connectors.curated_items(items, "aihot", 3).collect()]
    assert got == [("https://p/1", "https://o/1", "论文研究", 7.0, True), ("https://o/2", "https://o/2", "未分类", None, False)]
    assert connectors.read(spark, "curated", {"path": path, "source": "aihot"}).columns == connectors.COLUMNS
    entry = lambda t, d: f"<item><title>{t}</title><link>https://n/{t}</link><description>{d}</description></item>"
    (tmp_path / "n.xml").write_text(f"<rss><channel>{entry('GPT', 'x' * 400)}{entry('weather', 'sun')}{entry('other', 'a new 大模型')}{entry('LLM', 'z')}</channel></rss>")
    news = connectors.read(spark, "news", {"path": str(tmp_path / "n.xml"), "source": "news", "cap": 2}).collect()
    assert [r["title"] for r in news] == ["GPT", "other"] and len(news[0]["snippet"]) == 300 and len(news[0]["content"]) == 400


def test_related_rows(spark):
    df = spark.createDataFrame([(0, "a", None, 1.0, "x", ""), (1, "b", None, 9.0, "x", ""), (2, "b", None, 1.0, "", ""), (3, "c", None, 1.0, "", ""), (4, "d", "k", 1.0, "", "")], "ordinal long, url string, cluster string, heat_score double, content string, snippet string")
    top = {r["cluster"]: (r["url"], r["cluster_size"], r["n_related"]) for r in relations.representative_rows(df, ["cluster"]).collect()}
    assert top == {None: ("b", 4, 2), "k": ("d", 1, 0)}
    assert sorted((r["ordinal"], r["url"]) for r in relations.related(df, ["cluster"]).collect()) == [(0, "a"), (3, "c")]
    same = {r["cluster"]: r["related_urls"] for r in relations.representatives(df, ["cluster"]).collect()}
    assert same[None] == ["a", "c"]
