"""The scoring stage: requests of bounded size to an external scorer, its replies, rules where it fails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import scoring
from feedloom.functions.drafts import reply_array
from feedloom.operators import items, relations
from feedloom.operators.calls import ReplyLog

#: Items in one request, and how much of an item's content it holds.
BATCH, CONTENT = 40, 800
OFF_SUBJECT = "ai_relevance 判定非 AI 主题"


def requests(rows: DataFrame, group: str, order: str, n: int = BATCH) -> DataFrame:
    """One row per request: the group, ``batch, request``, a JSON array of at most ``n`` items of a group by the whole number ``order``."""
    columns = [k for k in ("url", "title", "snippet", "content", "source", "publish_time", "category", "extra") if k in rows.columns]
    placed = relations.numbered(items.payload_json(rows, columns, {"content": CONTENT}), group, order)
    told = placed.select(group, F.floor(F.col("_rn") / n).alias("batch"), F.struct("_rn", "payload").alias("item"))
    together = told.groupBy(group, "batch").agg(F.sort_array(F.collect_list("item")).alias("found"))  # at most n items
    body = F.concat(F.lit("["), F.array_join(F.transform("found", lambda x: x["payload"]), ","), F.lit("]"))
    return together.select(group, "batch", body.alias("request"))


def asked(rows: DataFrame, group: str, order: str, log: ReplyLog, n: int = BATCH, subject: list[str] | None = None) -> DataFrame:
    """:func:`scored` with the replies of the service behind ``log``, asked from the tasks, each request once."""
    told = log.ask(requests(rows, group, order, n))
    return scored(rows, told.select("batch", "reply", "error"), subject)


def _answers(replies: DataFrame) -> DataFrame:
    """The objects of all replies, the last of each url."""
    one = replies.select("batch", F.posexplode(reply_array(F.col("reply"))).alias("turn", "o"))
    get = lambda k: F.get_json_object("o", f"$.{k}")
    found = one.select(
        "batch",
        "turn",
        get("url").alias("url"),
        F.coalesce(get("heat_score").try_cast("double"), F.lit(0.0)).alias("given"),
        (~F.coalesce(get("ai_topic_relevant"), F.lit("false")).isin("false", "0", "", "[]", "{}")).alias("topic"),
        F.coalesce(get("score_reason"), F.lit("")).alias("why"),
        F.lower(F.trim(F.coalesce(get("ai_relevance"), F.lit("none")))).alias("relevance"),
        F.lower(F.trim(F.coalesce(get("ai_subtopic"), F.lit("other")))).alias("subtopic"),
    )
    return relations.last_per(found.filter(F.coalesce("url", F.lit("")) != ""), ["url"], ["batch", "turn"]).drop("batch", "turn")


def scored(rows: DataFrame, replies: DataFrame, subject: list[str] | None = None) -> DataFrame:
    """Adds ``heat_score, score_reason, ai_relevance, ai_subtopic``.

    ``replies``: ``batch, reply, error``, one row per request.  All or nothing:
    where any request failed, and ``error`` says how, every item takes the
    rules' fallback score.  Else an item that no reply names, or that a reply
    calls off the subject, scores 0; the others take the better of the reply's
    and the rules' score.  ``rows`` need ``url, title, snippet, content, source,
    category``; ``hot_list, signal, weight`` are used where present.
    """
    c = F.col
    own = lambda k, default: F.coalesce(c(k), default) if k in rows.columns else default
    none = F.lit(None).cast("string")
    hot_list = c("hot_list") if "hot_list" in rows.columns else none
    rules = scoring.rule_score(c("title"), c("snippet"), c("content"), c("source"), c("category"), hot_list, own("signal", F.lit(0.0)), own("weight", F.lit(1.0)))
    bias = scoring.audience_bias(c("category"), c("source"))
    whole = F.concat_ws(" ", "title", "snippet", "content", "source", "category")
    failure = replies.agg(F.max("error").alias("failure"))  # one row
    joined = rows.join(_answers(replies), "url", "left").crossJoin(F.broadcast(failure)).withColumns({"_rules": rules, "_bias": bias})
    relevance, subtopic = F.coalesce("relevance", F.lit("none")), F.coalesce("subtopic", F.lit("other"))
    near = relevance != "none"
    down = c("failure").isNotNull()
    heat = F.when(down, scoring.fallback_score(whole, c("source"), c("_rules"), c("_bias"), subject)).otherwise(scoring.final_score(F.coalesce("given", F.lit(0.0)), c("_rules"), c("_bias"), near))
    shown = F.regexp_replace(F.concat(F.coalesce("why", F.lit("")), F.lit(" | relevance="), relevance, F.lit("/"), subtopic, F.lit(" | heat_ai="), F.when(c("topic"), "T").otherwise("F")), r"^[ |]+|[ |]+$", "")
    off = F.trim(F.coalesce(F.nullif(c("why"), F.lit("")), F.lit(OFF_SUBJECT)))
    reason = F.when(down, F.concat(F.lit("LLM 调用失败，使用规则分: "), "failure")).when(near, shown).otherwise(off)
    out = {"heat_score": heat, "score_reason": reason, "ai_relevance": F.when(down, "none").otherwise(relevance), "ai_subtopic": F.when(down, "other").otherwise(subtopic)}
    return joined.withColumns(out).drop("given", "topic", "why", "relevance", "subtopic", "failure", "_rules", "_bias")
