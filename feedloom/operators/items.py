"""Row-level stages between source and sink: standard rows, rejects, downgrades, repairs, revisions."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.drafts import _contains_any
from feedloom.functions.scoring import ONE
from feedloom.functions.text import hit_count, truncate, validate_length
from feedloom.operators.relations import numbered

TEXTS = ["title", "snippet", "content", "source"]


def standardise(raw: DataFrame) -> DataFrame:
    """Null texts become empty; rows without a url go."""
    return raw.filter(F.coalesce("url", F.lit("")) != "").withColumns({c: F.coalesce(c, F.lit("")) for c in TEXTS if c in raw.columns})


def needs_enrichment(content: Column, least: int = 200) -> Column:
    return F.length(F.regexp_replace(F.coalesce(content, F.lit("")), r"(?U)^\s+|\s+$", "")) < least


def first_nonempty(*sources: DataFrame) -> DataFrame:
    """The first source with rows, else the last: one small action per source tried."""
    return next((s for s in sources[:-1] if not s.isEmpty()), sources[-1])


def enabled(config: DataFrame, kind: str) -> DataFrame:
    """Entries of a configuration of one kind that are not switched off."""
    return config.filter((F.col("type") == kind) & F.coalesce("enabled", F.lit(True)))


def page_links(pages: DataFrame, base: Column, html: str = "html") -> DataFrame:
    """``url, title`` of a page's links with text, relative ones made absolute against the site's root."""
    rows = pages.select(base.alias("_base"), F.explode(F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*href=["'][^"']+["'][^>]*>.*?</a>"""), F.lit(0))).alias("a"))
    href = F.regexp_extract("a", r"""(?i)href=["']([^"']+)["']""", 1)
    root = F.regexp_extract("_base", r"^(https?://[^/?#]+)", 1)
    url = F.when(href.rlike("^https?://"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(root, F.lit("/"), href))
    title = F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]+>", " "), r"\s+", " "))
    return rows.select(url.alias("url"), title.alias("title")).filter("title <> ''")


def chunked(df: DataFrame, n: int, by: str, order: str) -> DataFrame:
    """Adds ``chunk``: runs of ``n`` rows within ``by``, in the order of a whole number; a group that is most of the table is split."""
    placed = numbered(df, by, order)
    return placed.withColumn("chunk", F.floor(F.col("_rn") / n)).drop("_rn")


def draft_id(url: Column, prefix: str = "tweet") -> Column:
    """The same id for the same url, run after run."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(url, 256), 1, 12))


def profile(cat: Column, source: Column, by_category: dict[str, str], by_source: dict[str, str], fallback: str) -> Column:
    """The category's profile, else that of the first source key that occurs, else the fallback."""
    out = F.when(F.lit(False), fallback)
    for k, v in by_category.items():
        out = out.when(cat == k, v)
    for k, v in by_source.items():
        out = out.when(F.contains(F.lower(F.coalesce(source, F.lit(""))), F.lit(k)), v)
    return out.otherwise(fallback)


def cell_text(cell: Column) -> Column:
    """A rich table cell as text: a link object, a list of them (its first), or the value itself."""
    link = lambda root: F.coalesce(F.nullif(F.get_json_object(cell, f"{root}.link"), F.lit("")), F.get_json_object(cell, f"{root}.text"))
    body = F.trim(cell)
    return F.coalesce(F.when(body.startswith("{"), link("$")).when(body.startswith("["), link("$[0]")).otherwise(cell), F.lit(""))


def tidy_paragraphs(text: Column) -> Column:
    """Paragraphs of marks alone and further blank lines fold into one blank line."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"\n{2,}[。…·•\-*＊═─\s]+\n{2,}", "\n\n")
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


def payload_json(items: DataFrame, columns: list[str], widths: dict[str, int] | None = None) -> DataFrame:
    """Adds ``payload``: the columns as one JSON object for an external scorer, texts cut at their widths; nulls are left out."""
    widths = widths or {}
    part = lambda c: F.substring(F.coalesce(F.col(c), F.lit("")), 1, widths[c]) if c in widths else F.col(c)
    return items.withColumn("payload", F.to_json(F.struct(*[part(c).alias(c) for c in columns])))


def clean_volume(rows: DataFrame, raw: str, cleaned: str, truncated: str) -> DataFrame:
    """Characters before and after cleaning, and how many items were truncated: one row."""
    total = lambda c: F.coalesce(F.sum(F.length(c)), F.lit(0))
    return rows.agg(F.count("*").alias("n_items"), total(raw).alias("chars_before"), total(cleaned).alias("chars_after"), F.count_if(truncated).alias("n_truncated"))


def reject_rows(items: DataFrame, kind: Column, reason: Column, body: Column, width: int = 160) -> DataFrame:
    """Rejected items as events, the draft's first ``width`` characters with them."""
    keep = [c for c in ("url", "title", "source", "category", "heat_score", "ordinal") if c in items.columns]
    return items.select(*keep, kind.alias("reject_kind"), reason.alias("reason"), F.substring(F.coalesce(body, F.lit("")), 1, width).alias("preview"))


def downgrade(drafts: DataFrame, when: Column) -> DataFrame:
    """Where ``when`` holds, the short text stays and the long form's columns are blanked."""
    blank = {"platform": F.lit(ONE), "long_title": F.lit(""), "long_body": F.lit(""), "tags": F.array().cast("array<string>"), "image_prompt": F.lit("")}
    return drafts.withColumns({c: F.when(when, v).otherwise(F.col(c)) for c, v in blank.items() if c in drafts.columns})


def fit_lengths(drafts: DataFrame, fields: dict[str, tuple[str, int, str]], strict: bool = True) -> DataFrame:
    """Over-long fields are cut where ``strict``; ``fixes`` says what was done or is amiss.

    ``fields``: column to platform, most characters and label.
    """
    out, notes = drafts, []
    for c, (platform, most, label) in fields.items():
        check = validate_length(F.col(c), F.lit(platform))
        n, full = F.length(c), F.coalesce(F.col(c), F.lit("")) != ""
        over = full & (n > most) & F.lit(strict)
        cut = truncate(F.col(c), most)
        note = F.when(over, F.concat(F.lit(f"{label} 内容超长 "), n.cast("string"), F.lit(" 字，已截断到 "), F.length(cut).cast("string"), F.lit(" 字")))
        notes.append(note.when(full & ~check["ok"], F.concat(F.lit(f"{label} 内容长度异常: "), check["reason"])))
        out = out.withColumn(f"_{c}", F.when(over, cut).otherwise(F.col(c)))
    out = out.withColumn("fixes", F.array_compact(F.array(*notes)))
    return out.withColumns({c: F.col(f"_{c}") for c in fields}).drop(*[f"_{c}" for c in fields])


# Terms of the long form's quality.
CONSUMER = ["智能眼镜", "耳机", "音箱", "家居", "陪伴", "教育", "学习", "翻译", "视频", "图片", "拍照", "健康", "孩子", "家长", "出差", "生活", "普通人", "新手"]
PRACTICAL = [
    "怎么", "可以", "建议", "注意", "风险", "避免", "判断", "避坑", "用来", "场景",
    "适用", "价格", "权限", "隐私", "上手", "省时", "省钱", "效果", "体验", "选择", "不适合",
]


def long_quality(title: Column, body: Column, tags: Column, image_score: Column) -> Column:
    """Struct ``score, notes``: points for title, search words, readers, use, size and the picture."""
    t, b = F.trim(F.coalesce(title, F.lit(""))), F.trim(F.coalesce(body, F.lit("")))
    both = F.concat(t, b)
    tests = [
        (F.length(t).between(8, 24) & ~_contains_any(t, ["震惊", "绝了", "不看后悔", "宝子", "家人们"]), 25, "标题点击/长度不足"),
        (F.exists(F.slice(tags, 1, 4), lambda x: F.contains(both, x)) | _contains_any(both, ["AI", "工具", "效率", "隐私", "避坑", "办公", "创作", *CONSUMER]), 20, "搜索关键词弱"),
        (_contains_any(b, ["普通人", "打工人", "创作者", "创业者", "学生", "开发者", "适合", *CONSUMER]), 20, "场景/人群弱"),
        (hit_count(b, PRACTICAL) >= 2, 20, "实用/避坑弱"),
        (F.length(b).between(120, 450) & F.size(tags).between(3, 8), 5, "正文或标签长度不佳"),
    ]
    score = sum((F.when(ok, points).otherwise(0) for ok, points, _ in tests), F.lit(0)) + image_score
    notes = F.concat_ws("；", *[F.when(~ok, F.lit(note)) for ok, _, note in tests], F.when(image_score < 7, F.lit("封面提示词弱")))
    return F.struct(F.least(score, F.lit(100)).cast("double").alias("score"), F.when(notes == "", "ok").otherwise(notes).alias("notes"))


def revise(drafts: DataFrame, reviews: DataFrame, revisions: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Fields of drafts judged ``revise`` with something fixable take the revision's text, cut at ``caps``.

    ``reviews``: ``url, action, fixable``; ``revisions``: ``url`` and any of the
    capped columns; an empty or missing field keeps the draft's, a revision of
    another url has no effect.
    """
    wanted = reviews.filter((F.col("action") == "revise") & (F.col("fixable") > 0)).select("url").distinct()
    given = revisions.join(wanted, "url", "left_semi").dropDuplicates(["url"])
    given = given.select("url", *[F.col(c).alias(f"_{c}") for c in caps if c in revisions.columns])
    out = drafts.join(given, "url", "left")
    fields = [c for c in caps if f"_{c}" in out.columns]
    return out.withColumns({c: F.coalesce(F.nullif(F.substring(f"_{c}", 1, caps[c]), F.lit("")), F.col(c)) for c in fields}).drop(*[f"_{c}" for c in fields])


def histogram(df: DataFrame, *columns: str, n: int | None = None) -> DataFrame:
    """Counts of the columns' joined values, most first."""
    out = df.groupBy(F.concat_ws(":", *columns).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    return out.limit(n) if n else out


def invoke(model: Callable[[list[dict]], list[dict]], batch: list[dict], attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> list[dict]:
    """An external model's answer to one batch; two further tries, one and two seconds apart."""
    for i in range(attempts):
        try:
            return model(batch)
        except Exception:
            if i == attempts - 1:
                raise
            pause(float(i + 1))
    return []


def merged(*configs: dict) -> dict:
    """Later settings override earlier ones, one level of nested tables deep; nulls do not override."""

    def two(a: dict, b: dict) -> dict:
        return a | {k: (a[k] | v if isinstance(v, dict) and isinstance(a.get(k), dict) else v) for k, v in b.items() if v is not None}

    return reduce(two, configs, {})


