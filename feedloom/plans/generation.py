"""From picked items to drafts: replies, checks, one repair, fall back to the short text, rejects.

The model is a boundary: a function from the rows asked and a task to replies.
Rows flow by their verdict, so a stage is asked only for what failed before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import drafts, rewrite, scoring, text
from feedloom.operators import items, relations

#: What an unanswered row is rejected for, and the mark of a failed long form.
NO_REPLY, NO_REPLY_KIND, LONG_FAILED = "LLM 未生成素材", "no_llm_output", "xhs_failed: "


@dataclass(frozen=True)
class DraftRules:
    short_pass: float = 75.0
    long_pass: float = 80.0
    #: Angles and pillars with their words, in order, and the pillars' weights and boosts.
    angles: list[tuple[str, list[str]]] = field(default_factory=list)
    pillars: dict[str, list[str]] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    boosts: dict[str, dict[str, float]] = field(default_factory=dict)
    growth: dict[str, list[str]] = field(default_factory=lambda: drafts.GROWTH_TERMS)
    #: Parts of the picture's rubric.
    forbidden: list[str] = field(default_factory=list)
    required: list[str] = field(default_factory=list)
    aspects: list[str] = field(default_factory=list)
    styles: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Generated:
    drafts: DataFrame
    rejects: DataFrame


def _tag_list(raw: Column) -> Column:
    listed = F.transform(F.from_json(raw, "array<string>"), lambda t: F.regexp_replace(F.trim(t), "^#+", ""))
    return F.when(F.coalesce(raw, F.lit("")).startswith("["), F.filter(listed, lambda t: t != "")).otherwise(text.tags(raw))


def parsed(rows: DataFrame) -> DataFrame:
    """The parts of a reply's JSON, ``data``, as columns; a valid ``routed`` platform overrides the reply's."""
    get = lambda k: F.coalesce(F.get_json_object("data", f"$.{k}"), F.lit(""))
    part = drafts.payload(F.col("data"))
    routed = F.when(F.col("routed").isin(scoring.ONE, scoring.BOTH), F.col("routed"))
    long_form = (F.trim(F.coalesce(part["other_title"], F.lit(""))) != "") | (F.trim(F.coalesce(part["other_content"], F.lit(""))) != "")
    changed = routed.isNotNull() & (routed != get("platform"))
    why = F.when(changed, F.concat(get("platform_reason"), F.lit(" | router:"), F.coalesce("routed_reason", F.lit("")))).otherwise(get("platform_reason"))
    return rows.withColumns(
        {
            "platform": scoring.normalise_platform(F.coalesce(routed, get("platform")), long_form),
            "platform_reason": F.regexp_replace(why, r"^[ |]+|[ |]+$", ""),
            "short_text": get("tweet_content"),
            "long_title": F.coalesce(part["other_title"], F.lit("")),
            "long_body": F.coalesce(part["other_content"], F.lit("")),
            "tags": _tag_list(part["other_tags"]),
            "image_prompt": F.trim(F.coalesce(part["image_prompt"], F.lit(""))),
            "draft_id": F.coalesce(F.nullif(get("unique_id"), F.lit("")), items.draft_id(F.col("url"))),
            "given_angle": get("content_angle"),
            "given_hook": get("hook_type"),
        }
    )


def judged(rows: DataFrame, rules: DraftRules) -> DataFrame:
    """Lengths, wording, labels, scores and ``verdict``: ``ok`` or the first reason against the draft."""
    c = F.col
    short_most, long_most = text.PLATFORM_LIMITS["x"][1], text.PLATFORM_LIMITS["xiaohongshu"][1]
    fitted = items.fit_lengths(rows, {"short_text": ("x", short_most, "X"), "long_body": ("xiaohongshu", long_most, "小红书")})
    voice = F.when(c("platform") == scoring.BOTH, "xiaohongshu").otherwise("general")
    said = rewrite.humanise_drafts(fitted, voice)
    material = F.concat_ws(" ", "title", "snippet", "content", "source", "category")
    said = said.withColumn("platform", F.when(drafts.one_platform_only(material, c("source")), scoring.ONE).otherwise(c("platform")))
    both = c("platform") == scoring.BOTH

    of_item = F.concat_ws(" ", material, *([c("score_reason")] if "score_reason" in rows.columns else []))
    labelled = said.withColumns(
        {
            "angle": scoring.normalise_angle(F.when(c("given_angle") != "", c("given_angle")).otherwise(scoring.angle(material, rules.angles, c("source")))),
            "pillar": scoring.pillar(of_item, rules.pillars, rules.weights),
            "short": drafts.short_quality(c("short_text"), c("title"), c("source"), material),
            "short_reason": drafts.check_short(c("short_text"), c("title"), c("source"), material),
        }
    )
    tidy = {k: F.when(keep, v).otherwise(blank) for k, keep, v, blank in [
        ("short_text", F.lit(True), items.tidy_paragraphs(c("short_text")), F.lit("")),
        ("long_title", both, F.trim("long_title"), F.lit("")),
        ("long_body", both, items.tidy_paragraphs(c("long_body")), F.lit("")),
        ("tags", both, c("tags"), F.array().cast("array<string>")),
        ("image_prompt", both, c("image_prompt"), F.lit("")),
    ]}
    tidied = labelled.withColumns(tidy)

    image = drafts.check_image(c("image_prompt"), rules.forbidden, rules.required)
    points = drafts.image_quality(c("image_prompt"), rules.forbidden, rules.required, rules.aspects, rules.styles)
    plain = drafts.check_long(c("long_title"), c("long_body"), F.size("tags"), c("image_prompt"))
    rubric = plain.isin("ok", "小红书正文缺少影响/使用/避坑信息") & ~image["ok"]
    draft_text = F.concat_ws(" ", "long_title", "long_body", "short_text", "image_prompt", F.array_join("tags", " "), of_item)
    growth = scoring.dimensions(draft_text, c("pillar"), rules.growth, rules.boosts)
    hits = lambda k: text.hit_count(draft_text, rules.growth[k]).cast("string")
    scored = tidied.withColumns(
        {
            "long": F.when(both, items.long_quality(c("long_title"), c("long_body"), c("tags"), points)).otherwise(F.struct(F.lit(0.0).alias("score"), F.lit("仅X").alias("notes"))),
            "long_reason": F.when(rubric, F.concat(F.lit("配图提示词未通过 rubric: "), image["reason"])).otherwise(plain),
            "growth": F.when(both, growth).otherwise(F.struct(*[F.lit(0.0).alias(k) for k in ("search", "save", "beginner", "series")])),
            "growth_hits": F.struct(*[hits(k).alias(k) for k in ("search", "save", "beginner", "series", "jargon")]),
            "plan": scoring.note_plan(c("pillar")),
            "hook": F.when(c("given_hook") != "", c("given_hook")).otherwise(drafts.hook_type(c("short_text"), c("angle"))),
        }
    )

    shown = lambda v: F.bround(v, 0).cast("int").cast("string")
    low = lambda label, at, least: F.concat(F.lit(label), shown(c(at)["score"]), F.lit(f" < {least:.0f}: "), c(at)["notes"])
    verdict = (
        F.when(c("short_reason") != "ok", c("short_reason"))
        .when(c("short")["score"] < rules.short_pass, low("X质量分 ", "short", rules.short_pass))
        .when(both & (c("long_reason") != "ok"), F.concat(F.lit(LONG_FAILED), c("long_reason")))
        .when(both & (c("long")["score"] < rules.long_pass), F.concat(F.lit(LONG_FAILED), low("小红书质量分 ", "long", rules.long_pass)))
        .otherwise("ok")
    )
    tone = F.concat_ws(
        "; ",
        F.concat(F.lit("ai_tone="), shown(c("tone")["ai_score"])),
        F.when(F.size(c("tone")["cliche_hits"]) > 0, F.concat(F.lit("hits="), F.array_join(F.slice(c("tone")["cliche_hits"], 1, 3), ","))),
        F.when(F.size("fixes") > 0, F.concat(F.lit("length_fixed="), F.size("fixes").cast("string"))),
    )
    g, h = c("growth"), c("growth_hits")
    lines = {"search": ("搜索词命中 ", h["search"]), "save": ("收藏信号命中 ", h["save"]), "beginner": ("新手信号 ", F.concat(h["beginner"], F.lit("; 黑话 "), h["jargon"])), "series": ("系列化信号命中 ", h["series"])}
    counted = F.concat_ws("; ", *[F.concat(F.lit(f"{k}="), shown(g[k]), F.lit(f"({label}"), n, F.lit(")")) for k, (label, n) in lines.items()])
    summary = F.concat(F.lit("growth="), c("pillar"), F.lit("/"), c("plan")["title_pattern"], F.lit(": "), F.when(both, counted).otherwise("仅X"))
    reason = F.when(c("platform_reason") != "", c("platform_reason")).when(both, "适合小红书").otherwise("硬技术/圈层内容，仅X更合适")
    done = scored.withColumns({"verdict": verdict, "notes": F.concat_ws(" | ", c("short")["notes"], c("long")["notes"], tone, summary), "platform_reason": reason})
    return done.select("*", c("short")["score"].alias("short_score"), c("long")["score"].alias("long_score"), "growth.*", "plan.*").drop("short", "long", "growth", "growth_hits", "plan", "short_reason", "long_reason", "given_angle", "given_hook", "tone", "fixes")


def generate(picked: DataFrame, answer: Callable[[DataFrame, str], DataFrame], keep: Callable[[DataFrame], DataFrame], rules: DraftRules | None = None) -> Generated:
    """Drafts and rejects of the picked items.

    ``picked``: one row per url with ``url, title, snippet, content, source,
    category, heat_score, ordinal`` and, nullable, ``routed, routed_reason``.
    ``answer(rows, task)`` gives ``url, turn, data``: ``batch`` asks for all
    items (the first reply of a url counts), ``single`` for those without one
    (the last counts), ``repair`` for drafts that failed, whose reason is in
    ``verdict``.  A failed long form whose repair fails too, or gets no reply,
    is judged once more as a short text alone; a platform that the router has
    set holds then as well.  ``keep`` writes what several stages read as a
    table and reads it again, so that no reply is asked for twice and no draft
    is judged twice.
    """
    rules, c = rules or DraftRules(), F.col
    given = answer(picked, "batch").filter(F.coalesce("url", F.lit("")) != "")
    first = keep(relations.first_per(given, ["url"], ["turn"]).select("url", "turn", "data"))
    single = answer(relations.unanswered(picked, first, "url"), "single").select("url", "turn", "data")
    replies = first.withColumn("asked", F.lit(0)).unionByName(single.withColumn("asked", F.lit(1)))
    answered = relations.with_replies(picked, replies, "url", ["asked", "turn"])

    built = keep(judged(parsed(answered.filter("data IS NOT NULL")), rules))
    silent = answered.filter("data IS NULL").select(*picked.columns, "data", F.lit(NO_REPLY).alias("reason"), F.lit(NO_REPLY_KIND).alias("reject_kind"))

    failed = built.filter(c("verdict") != "ok").select(*picked.columns, "data", "verdict")
    mended = keep(relations.first_per(answer(failed, "repair"), ["url"], ["turn"]).select("url", c("data").alias("mended")))
    again = failed.join(mended, "url").withColumn("first_data", c("data")).withColumn("data", c("mended")).drop("mended")
    lower = failed.filter(c("verdict").startswith(LONG_FAILED)).withColumn("first_data", c("data"))
    short_only = items.downgrade(parsed(lower), F.lit(True)).withColumn("platform", F.when(c("routed") == scoring.BOTH, scoring.BOTH).otherwise(scoring.ONE))
    tries = parsed(again).withColumn("attempt", F.lit(1)).unionByName(short_only.withColumn("attempt", F.lit(2)))
    tried = keep(judged(tries.withColumnRenamed("verdict", "before"), rules))

    outcome = tried.groupBy("url").agg(F.max(F.when(c("attempt") == 1, c("verdict"))).alias("repaired"), F.max(F.when(c("attempt") == 2, c("verdict"))).alias("lowered"))
    saved = relations.first_per(tried.filter(c("verdict") == "ok"), ["url"], ["attempt"]).join(outcome, "url")
    why = F.when(c("repaired").isNull(), " | 小红书修复无结果，已降级仅X").otherwise(F.concat(F.lit(" | 小红书修复失败，已降级仅X: "), c("repaired")))
    saved = saved.withColumns(
        {
            "notes": F.when(c("attempt") == 2, F.concat("notes", why)).otherwise(c("notes")),
            "platform_reason": F.when(c("attempt") == 2, "小红书质量未达标，保留 X 草稿待审核").otherwise(c("platform_reason")),
        }
    )
    ok = built.filter(c("verdict") == "ok").withColumn("attempt", F.lit(0))
    made = ok.unionByName(saved.drop("before", "first_data", "repaired", "lowered")).drop("verdict", "data").withColumn("status", F.lit("待审核"))

    lost = failed.join(outcome, "url", "left").filter(~((F.coalesce("repaired", F.lit("")) == "ok") | (F.coalesce("lowered", F.lit("")) == "ok")))
    long_form = c("verdict").startswith(LONG_FAILED)
    after = F.when(long_form, F.concat(F.when(c("repaired").isNull(), "; 小红书修复调用无结果").otherwise(F.concat(F.lit("; 小红书修复后失败: "), "repaired")), F.lit("; 降级仅X失败: "), F.coalesce("lowered", F.lit(""))))
    after = after.when(c("repaired").isNull(), "; 修复调用无结果").otherwise(F.concat(F.lit("; 修复后失败: "), "repaired"))
    refused = lost.withColumn("reason", F.concat(F.lit("首次失败: "), "verdict", after))
    refused = refused.select(*picked.columns, "data", "reason", scoring.reject_kind(c("reason")).alias("reject_kind"))
    rejects = silent.unionByName(refused)
    return Generated(made, items.reject_rows(rejects, c("reject_kind"), c("reason"), F.get_json_object("data", "$.tweet_content")))


def reviewed(made: DataFrame, reviews: DataFrame, revisions: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Drafts with the reviewer's ``score, action, summary`` where there is one; those to revise take the revision.

    ``reviews``: ``url, score, action, summary, fixable``; the last reply of a
    url counts by ``turn``.  A draft without a review stays as it is.
    """
    one = relations.last_per(reviews, ["url"], ["turn"])
    told = one.select("url", F.col("score").alias("review_score"), F.col("action").alias("review_action"), F.col("summary").alias("review_summary"))
    return items.revise(made.join(told, "url", "left"), one, revisions, caps)
