"""Sources: files and command output as rows of one schema.

A network fetch is a boundary: what it returned lies in files, and the
connectors read those.  ``register`` adds further ones.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.scoring import release_score, signal_score
from feedloom.functions.terms import find_terms, term_names
from feedloom.functions.text import any_hit, squeeze, star_count, strip_html
from feedloom.operators.relations import first_per
from feedloom.operators.staging import stage

MATERIAL = "url string, title string, snippet string, content string, source string, publish_time string, ordinal long"
COLUMNS = [c.split()[0] for c in MATERIAL.split(", ")]

Reader = Callable[[SparkSession, dict], DataFrame]
_READERS: dict[str, Reader] = {}


def register(name: str, reader: Reader) -> None:
    _READERS[name] = reader


def read(spark: SparkSession, name: str, options: dict) -> DataFrame:
    """The source's rows; an empty relation where it cannot be read, with the cause in the log.

    Spark reads late, so the rows are written as a table here: only an action
    over all of their columns shows that a source fails, and what was read once
    is not read again.  A name that nobody registered is an error.  For a
    source of which single records are bad see ``intake``.
    """
    reader = _READERS[name]
    try:
        return stage(reader(spark, options), f"source-{name}")
    except Exception as cause:
        logging.getLogger(__name__).warning("source %s gives no rows: %s", name, cause)
        return spark.createDataFrame([], MATERIAL)


def _first(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c.cast("string")), F.lit("")) for c in cols])


def _field(item: str, *names: str) -> Column:
    return _first(*[F.get_json_object(F.col(item), f"$.{n}") for n in names])


def json_items(raw: DataFrame, text: str = "raw") -> DataFrame:
    """One row per object of a JSON document: an array, or the array under items, results, data or topics."""
    body = F.trim(F.col(text))
    listed = F.when(body.startswith("["), body)
    for key in ("items", "results", "data", "topics"):
        listed = F.coalesce(listed, F.get_json_object(body, f"$.{key}"))
    items = F.from_json(listed, "array<string>", {"mode": "PERMISSIVE"})
    return raw.select(F.posexplode(items).alias("ordinal", "item")).filter(F.trim("item").startswith("{")).withColumn("ordinal", F.col("ordinal").cast("long"))


def feed_items(items: DataFrame, source: str, per_source: int | None = None) -> DataFrame:
    """Items of a JSON feed under their usual names; rows without a url go."""
    rows = items.select(
        _field("item", "permalink", "url", "link").alias("url"),
        F.coalesce(_field("item", "title", "name"), F.lit("")).alias("title"),
        F.substring(F.coalesce(_field("item", "snippet", "description", "summary"), F.lit("")), 1, 500).alias("snippet"),
        F.coalesce(_field("item", "content", "body"), F.lit("")).alias("content"),
        F.lit(source).alias("source"),
        _field("item", "publish_time", "published_at", "date").alias("publish_time"),
        "ordinal",
    ).filter(F.col("url").isNotNull())
    return rows.orderBy("ordinal").limit(per_source) if per_source else rows


# Sections of the curated feed and what they are called.
SECTIONS = {
    "ai-models": "模型发布",
    "ai-products": "产品发布",
    "industry": "行业动态",
    "paper": "论文研究",
    "tip": "技巧与观点",
}
NO_SECTION = "未分类"


def curated_items(items: DataFrame, source: str, cap: int) -> DataFrame:
    """The first ``cap`` items of the curated feed, with ``original_url, section, section_name, score, selected``; rows without a url go."""
    few = items.orderBy("ordinal").limit(cap)
    names = F.create_map(*[F.lit(v) for pair in SECTIONS.items() for v in pair])
    section = F.coalesce(_field("item", "category"), F.lit(""))
    more = {
        "original_url": _field("item", "url"),
        "section": section,
        "section_name": F.coalesce(F.try_element_at(names, section), F.lit(NO_SECTION)),
        "score": _field("item", "score").try_cast("double"),
        "selected": F.coalesce(_field("item", "selected").try_cast("boolean"), F.lit(False)),
    }
    summary = F.coalesce(_field("item", "summary"), F.lit(""))
    own = few.filter(_field("item", "url").isNotNull())
    return own.select(
        _field("item", "permalink", "url").alias("url"),
        F.coalesce(_field("item", "title"), F.lit("")).alias("title"),
        summary.alias("snippet"),
        summary.alias("content"),
        F.lit(source).alias("source"),
        _field("item", "published_at", "publishedAt").alias("publish_time"),
        "ordinal",
        *[c.alias(n) for n, c in more.items()],
    )


# Words that put an entry of the news feed on the subject.
NEWS_SUBJECT = [
    "ai", "大模型", "llm", "gpt", "chatgpt", "claude", "gemini", "智能",
    "machine learning", "deep learning", "神经网络", "transformer",
    "agent", "智能体", "prompt", "微调", "训练", "推理",
    "sora", "midjourney", "stable diffusion", "生成式", "aigc",
    "openai", "anthropic", "google ai", "deepmind", "百度", "阿里",
    "腾讯", "字节", "智谱", "月之暗面", "minimax",
]


def on_subject(entries: DataFrame, cap: int, words: list[str] | None = None, first: int = 20) -> DataFrame:
    """The first ``cap`` of a feed's first entries whose title or snippet holds one of the words; snippets are cut at 300."""
    few = entries.orderBy("ordinal").limit(first)
    near = few.filter(any_hit(F.concat_ws(" ", "title", "snippet"), words or NEWS_SUBJECT))
    return near.withColumns({"content": F.col("snippet"), "snippet": F.substring("snippet", 1, 300)}).orderBy("ordinal").limit(cap)


def social_items(items: DataFrame) -> DataFrame:
    """Items of a social search: platform and engagement under any of their aliases."""
    engagement = F.coalesce(_field("item", "engagement", "score", "points", "likes", "upvotes").try_cast("double"), F.lit(0.0))
    return items.select(
        _field("item", "url", "link", "permalink").alias("url"),
        F.coalesce(_field("item", "title", "name"), F.concat(F.lit("item-"), F.col("ordinal").cast("string"))).alias("title"),
        F.lower(F.coalesce(_field("item", "platform", "source", "network"), F.lit(""))).alias("platform"),
        engagement.alias("engagement"),
        F.substring(F.coalesce(_field("item", "snippet", "description", "summary"), F.lit("")), 1, 500).alias("snippet"),
        "ordinal",
    ).filter(F.col("url").isNotNull())


def per_platform(items: DataFrame, cap: int) -> DataFrame:
    """At most ``cap`` over the number of platforms, one at least, of each platform."""
    n = items.agg(F.greatest(F.lit(1), F.floor(F.lit(cap) / F.greatest(F.lit(1), F.count_distinct("platform")))).alias("_most"))
    return first_per(items, ["platform"], ["ordinal"], cap).crossJoin(F.broadcast(n)).withColumn("_rn", F.row_number().over(_by("platform"))).filter("_rn <= _most").drop("_rn", "_most")


def _by(key: str):
    from pyspark.sql.window import Window

    return Window.partitionBy(key).orderBy("ordinal")


def rss(spark: SparkSession, path: str, source: str) -> DataFrame:
    """RSS 2.0 files: items with a title and a link, markup stripped."""
    schema = "title string, link string, description string, `content:encoded` string, pubDate string, `dc:date` string"
    rows = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path).withColumn("ordinal", F.monotonically_increasing_id())
    content = squeeze(strip_html(F.col("`content:encoded`"), ""))
    snippet = F.coalesce(F.nullif(squeeze(strip_html(F.col("description"), "")), F.lit("")), F.substring(content, 1, 300))
    out = rows.select(
        F.trim("link").alias("url"),
        F.trim("title").alias("title"),
        F.substring(snippet, 1, 500).alias("snippet"),
        F.substring(content, 1, 2000).alias("content"),
        F.lit(source).alias("source"),
        _first(F.col("pubDate"), F.col("`dc:date`")).alias("publish_time"),
        "ordinal",
    )
    return out.filter("url <> '' and title <> ''")


def link_lines(raw: DataFrame, source: str, text: str = "raw") -> DataFrame:
    """``title<tab>url`` or ``title url`` lines; comments and other schemes go."""
    lines = raw.select(F.posexplode(F.split(F.trim(F.col(text)), "\r?\n")).alias("ordinal", "line")).select(F.col("ordinal").cast("long"), F.trim("line").alias("line"))
    parts = F.when(F.contains("line", F.lit("\t")), F.split("line", "\t")).otherwise(F.split("line", " ", 2))
    rows = lines.filter("line <> '' and not startswith(line, '#')").withColumn("p", parts).filter(F.size("p") >= 2)
    rows = rows.select(F.trim(F.col("p")[1]).alias("url"), F.trim(F.col("p")[0]).alias("title"), F.lit("").alias("snippet"), F.lit("").alias("content"), F.lit(source).alias("source"), F.lit(None).cast("string").alias("publish_time"), "ordinal")
    return rows.filter(F.col("url").rlike("^https?://"))


def front_matter(raw: DataFrame, source: str, text: str = "raw") -> DataFrame:
    """Markdown with a header of ``key: value`` lines; without one the text is a row of its own.

    The url falls back to the header's source, the title to the first heading.
    """
    head = F.regexp_extract(text, r"(?s)^---\s*\n(.*?)\n---\s*\n?(.*)$", 1)
    body = F.regexp_extract(text, r"(?s)^---\s*\n(.*?)\n---\s*\n?(.*)$", 2)
    value = lambda k: F.nullif(F.regexp_extract(head, rf"""(?im)^\s*{k}\s*:\s*["']?(.*?)["']?\s*$""", 1), F.lit(""))
    has = F.col(text).rlike(r"(?s)^---\s*\n.*?\n---")
    url = F.when(has, F.coalesce(value("url"), value("source"))).otherwise(F.regexp_extract(text, r"https?://[^\s)\]]+", 0))
    heading = F.nullif(F.regexp_extract(body, r"(?m)^\s*# (.*)$", 1), F.lit(""))
    title = F.when(has, F.coalesce(value("title"), heading, F.lit(""))).otherwise(F.trim(F.regexp_replace(F.substring_index(F.col(text), "\n", 1), "^[# ]+", "")))
    part = lambda n: F.trim(F.substring(F.when(has, body).otherwise(F.col(text)), 1, n))
    rows = raw.withColumn("ordinal", F.monotonically_increasing_id()).select(
        F.coalesce(url, F.lit("")).alias("url"),
        F.substring(title, 1, 200).alias("title"),
        part(500).alias("snippet"),
        part(2000).alias("content"),
        F.lit(source).alias("source"),
        F.when(has, F.coalesce(value("date"), value("publish_time"))).alias("publish_time"),
        "ordinal",
        has.alias("_has"),
    )
    return rows.filter("not _has or url <> ''").drop("_has")


def hot_lists(items: DataFrame, subject: Column, general: list[str], cap: int) -> DataFrame:
    """Entries of hot lists (``list_id, ordinal, ...``): general lists need the subject; each list gives ``max(2, cap/3)``."""
    rows = items.filter(~F.col("list_id").isin(general) | subject)
    return first_per(rows, ["list_id"], ["ordinal"], max(2, cap // 3))


def hot_topics(items: DataFrame, cap: int) -> DataFrame:
    """The first ``2 x cap`` topics, their snippets telling how many sources report, and which five.

    ``items``: ``url, title, ordinal, source_count, source_names``; of equal urls the first counts.
    """
    few = items.orderBy("ordinal").limit(cap * 2).filter(F.coalesce("url", F.lit("")) != "")
    names = F.array_join(F.slice(F.coalesce("source_names", F.array().cast("array<string>")), 1, 5), ", ")
    said = F.concat(F.lit("🔥 "), F.coalesce("source_count", F.lit(0)).cast("string"), F.lit(" 个独立信源在报道"))
    snippet = F.when(names != "", F.concat(said, F.lit("\n来源: "), names)).otherwise(said)
    return first_per(few.withColumns({"snippet": snippet, "content": F.lit(""), "source": F.lit("aihot-hot")}), ["url"], ["ordinal"])


def pushed(repos: DataFrame, now: Column, days: int = 30, most: int = 15, subject: Column | None = None) -> DataFrame:
    """Repositories pushed to in the last ``days`` days, most stars first, 50 at most."""
    rows = repos.filter((F.coalesce("url", F.lit("")) != "") & (F.col("pushed_at") >= F.date_trunc("day", now - F.expr(f"INTERVAL {days} DAYS"))))
    rows = rows if subject is None else rows.filter(subject)
    return rows.orderBy(F.desc("stars"), "url").limit(min(most, 50))


def query_groups(terms: list[str], size: int = 6) -> list[str]:
    """The terms as OR queries of at most ``size`` terms."""
    return [" OR ".join(terms[i : i + size]) for i in range(0, len(terms), size)]


def released(repos: DataFrame, releases: DataFrame) -> DataFrame:
    """Repositories with their latest release, if any, and the score of both.

    ``repos``: ``repo, stars``; ``releases``: ``repo, tag, published``.
    """
    last = releases.groupBy("repo").agg(F.max_by("tag", "published").alias("tag"))
    joined = repos.join(last, "repo", "left")
    return joined.withColumn("signal", release_score(F.col("stars"), F.col("tag").isNotNull()))


def watched(items: DataFrame, topics: DataFrame, most: int = 8) -> DataFrame:
    """Items with the terms of their topic that occur, in the order of the topic's list; those that match none go.

    ``topics``: ``topic, terms``; ``items``: ``topic, title, snippet, ...``.
    One automaton holds the terms of all topics.
    """
    terms = topics.select("topic", F.posexplode("terms").alias("place", "term"))
    rows = items.filter(F.col("topic").isNotNull()).withColumn("_text", F.concat_ws(" ", "title", "snippet"))
    found = find_terms(rows, "_text", terms, "topic", "_found")
    return found.withColumn("matched_terms", term_names(F.col("_found"), most)).filter(F.size("matched_terms") > 0).drop("_text", "_found")


def trending(html: DataFrame, text: str = "html") -> DataFrame:
    """Repositories and stars of a listing page: ``repo, stars``."""
    rows = html.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?s)<article\b.*?</article>"), F.lit(0))).alias("a"))
    return rows.select(F.regexp_extract("a", r"""href="/([\w.-]+/[\w.-]+)["/]""", 1).alias("repo"), star_count(F.regexp_extract("a", r"([\d.,]+\s*[kKmM]?)\s*(?:stars|</a>)", 1)).alias("stars")).filter("repo <> ''")


def community(items: DataFrame) -> DataFrame:
    """Adds ``signal``: 0.6 a point and 1.2 a comment, 100 at most."""
    return items.withColumn("signal", signal_score(F.col("points"), F.col("comments")))


register("feed", lambda spark, o: feed_items(json_items(spark.read.text(o["path"], wholetext=True).withColumnRenamed("value", "raw")), o["source"], o.get("cap")).select(*COLUMNS))
register("rss", lambda spark, o: rss(spark, o["path"], o["source"]).select(*COLUMNS))
register("links", lambda spark, o: link_lines(spark.read.text(o["path"], wholetext=True).withColumnRenamed("value", "raw"), o["source"]).select(*COLUMNS))
register("markdown", lambda spark, o: front_matter(spark.read.text(o["path"], wholetext=True).withColumnRenamed("value", "raw"), o["source"]).select(*COLUMNS))
register("curated", lambda spark, o: curated_items(json_items(spark.read.text(o["path"], wholetext=True).withColumnRenamed("value", "raw")), o["source"], o.get("cap", 20)).select(*COLUMNS))
register("news", lambda spark, o: on_subject(rss(spark, o["path"], o["source"]), o.get("cap", 6), o.get("words")).select(*COLUMNS))
