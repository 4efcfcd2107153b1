import json
import uuid

from pyspark.sql import functions as F

from feedloom.functions.scoring import BOTH, ONE
from feedloom.plans import generation, scoring_stage

SHORT = "acme 这次更新影响所有开发者\n风险在于权限变化，适合先看文档\n但别急着升级，机会仍在后面，先看清楚成本再决定"
BODY = "普通人可以先看价格和权限，避坑建议：注意隐私风险。" * 7
GOOD_LONG = {"other_title": "新手先看的避坑清单", "other_content": BODY, "other_tags": ["#AI", "避坑", "隐私"], "image_prompt": "封面 3:4 信息图，主体居中，大字标题，配色明亮，字体清晰，氛围轻松" * 2}
def tables_in(spark, path):
    """Writes what several stages read, as a caller does."""
    return lambda df: [df.write.parquet(p := f"{path}/{uuid.uuid4().hex}"), spark.read.parquet(p)][1]


RULES = generation.DraftRules(required=["主体", "配色", "字体"], aspects=["3:4"], styles=["信息图"])


def reply(**parts):
    return json.dumps({"tweet_content": SHORT, **parts}, ensure_ascii=False)


def test_generate(spark, tmp_path):
    first = {
        "short": reply(platform="仅X"), "both": reply(platform="X+小红书", **GOOD_LONG), "lowered": reply(platform=BOTH, **{**GOOD_LONG, "other_title": "短"}),
        "mended": reply(platform=BOTH, **{**GOOD_LONG, "other_content": "太短"}), "worse": json.dumps({"tweet_content": "x", "platform": ONE}),
        "held": reply(platform=ONE), "hopeless": json.dumps({"tweet_content": "y", "platform": ONE}),
    }
    answers = {
        "batch": [(u, 0, d) for u, d in first.items()] + [("short", 1, "{}"), ("stranger", 0, "{}")],
        "single": [("late", 0, "{}"), ("late", 1, reply(platform="only x", unique_id="t1"))],
        "repair": [("lowered", 0, reply(platform=BOTH, **{**GOOD_LONG, "other_tags": "a"})), ("mended", 0, reply(platform=BOTH, **GOOD_LONG)), ("worse", 0, json.dumps({"tweet_content": ""}))],
    }
    asked = {}

    def answer(rows, task):
        asked[task] = {r["url"] for r in rows.select("url").collect()}
        given = spark.createDataFrame(answers[task], "url string, turn int, data string")
        return given.join(rows.select("url"), "url", "left_semi") if task != "batch" else given

    urls = [*first, "late", "silent"]
    rows = [(u, "acme 新版本", "s", "c", "feed", "产品", 70.0, i, BOTH if u == "held" else None) for i, u in enumerate(urls)]
    picked = spark.createDataFrame(rows, "url string, title string, snippet string, content string, source string, category string, heat_score double, ordinal int, routed string").withColumn("routed_reason", F.lit("r"))
    out = generation.generate(picked, answer, tables_in(spark, tmp_path), RULES)
    made = {r["url"]: r for r in out.drafts.collect()}
    lost = {r["url"]: r for r in out.rejects.collect()}
    assert asked["single"] == {"late", "silent"} and asked["repair"] == {"lowered", "mended", "worse", "held", "hopeless"}
    assert set(made) == {"short", "both", "lowered", "mended", "late"} and set(lost) == {"worse", "held", "hopeless", "silent"}
    assert {u: (r["platform"], r["attempt"]) for u, r in made.items()} == {"short": (ONE, 0), "both": (BOTH, 0), "lowered": (ONE, 2), "mended": (BOTH, 1), "late": (ONE, 0)}
    assert made["both"]["tags"] == ["AI", "避坑", "隐私"] and made["both"]["long_score"] >= 80 and made["short"]["long_body"] == ""
    assert "小红书修复失败，已降级仅X: xhs_failed: 小红书标签数 1 不在 3-8" in made["lowered"]["notes"] and made["late"]["draft_id"] == "t1"
    assert made["lowered"]["long_title"] == "" and made["lowered"]["platform_reason"] == "小红书质量未达标，保留 X 草稿待审核"
    assert lost["silent"]["reject_kind"] == "no_llm_output" and lost["hopeless"]["reason"].endswith("; 修复调用无结果")
    assert "修复后失败: tweet_content 空" in lost["worse"]["reason"]
    # a routed platform holds for the downgrade too
    assert "降级仅X失败: xhs_failed: 小红书标题/正文空" in lost["held"]["reason"] and "小红书修复调用无结果" in lost["held"]["reason"]


def test_nothing_picked(spark, tmp_path):
    picked = spark.createDataFrame([], "url string, title string, snippet string, content string, source string, category string, heat_score double, ordinal int, routed string, routed_reason string")
    none = spark.createDataFrame([], "url string, turn int, data string")
    out = generation.generate(picked, lambda rows, task: none, tables_in(spark, tmp_path))
    assert out.drafts.count() == 0 and out.rejects.count() == 0


def test_reviewed(spark):
    made = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "old")], "url string, short_text string")
    reviews = spark.createDataFrame([("a", 50.0, "publish", "", 1, 0), ("a", 60.0, "revise", "s", 2, 1), ("b", 90.0, "publish", "", 3, 0)], "url string, score double, action string, summary string, fixable int, turn int")
    revisions = spark.createDataFrame([("a", "new text"), ("b", "new")], "url string, short_text string")
    got = {r["url"]: (r["short_text"], r["review_score"]) for r in generation.reviewed(made, reviews, revisions, {"short_text": 3}).collect()}
    assert got == {"a": ("new", 60.0), "b": ("old", 90.0), "c": ("old", None)}


def test_scoring_stage(spark):
    rows = spark.createDataFrame(
        [("u1", "GPT", "", "", "feed", "综合资讯", 0), ("u2", "t", "", "", "feed", "综合资讯", 1), ("u3", "t", "", "", "watchlist", "综合资讯", 2), ("u4", None, None, None, None, None, 3)],
        "url string, title string, snippet string, content string, source string, category string, ordinal int",
    ).withColumn("day", F.lit("d"))
    sent = scoring_stage.requests(rows, "day", "ordinal", 3).orderBy("batch").collect()
    assert [[x["url"] for x in json.loads(r["request"])] for r in sent] == [["u1", "u2", "u3"], ["u4"]]
    text = json.dumps([
        {"url": "u1", "heat_score": 10}, {"url": "u1", "heat_score": 72, "ai_relevance": " Core ", "ai_topic_relevant": True, "score_reason": "r", "ai_subtopic": "Model"},
        {"url": "u2", "heat_score": 90, "ai_relevance": "none"}, {"url": "u3", "heat_score": "x", "ai_relevance": "adjacent"}, {"url": "", "heat_score": 1},
    ])
    replies = spark.createDataFrame([(0, text, None), (1, "nothing", None)], "batch int, reply string, error string")
    got = {r["url"]: (r["heat_score"], r["score_reason"], r["ai_relevance"], r["ai_subtopic"]) for r in scoring_stage.scored(rows, replies).collect()}
    assert got == {
        "u1": (72.0, "r | relevance=core/model | heat_ai=T", "core", "model"), "u2": (0.0, scoring_stage.OFF_SUBJECT, "none", "other"),
        "u3": (64.0, "relevance=adjacent/other | heat_ai=F", "adjacent", "other"), "u4": (0.0, scoring_stage.OFF_SUBJECT, "none", "other"),
    }
    failed = spark.createDataFrame([(0, text, None), (1, None, "timeout")], "batch int, reply string, error string")
    got = {r["url"]: (r["heat_score"], r["score_reason"]) for r in scoring_stage.scored(rows, failed).collect()}
    why = "LLM 调用失败，使用规则分: timeout"
    assert got == {"u1": (50.0, why), "u2": (0.0, why), "u3": (64.0, why), "u4": (0.0, why)}
