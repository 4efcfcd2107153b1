"""The four reports of one run, from its drafts and rejects: each a relation, all published together.

Drafts and rejects are staged once, and every report reads those tables.  The
run counts as reported when its manifest is there; a run that is reported
again under its name changes nothing.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import sinks
from feedloom.operators.batches import Files
from feedloom.operators.relations import top_reasons
from feedloom.operators.staging import stage

#: Columns of the quality report beside the preview, in order; what a run does not have is null.
QUALITY = [
    "draft_id", "url", "title", "source", "category", "heat_score", "score_reason", "discovery_reason", "platform", "platform_reason", "angle", "hook", "short_score", "long_score",
    "pillar", "note_structure", "title_pattern", "search", "save", "beginner", "series", "notes", "long_title",
]
#: Columns of the growth report's items.
GROWTH = ["draft_id", "url", "title", "platform", "pillar", "note_structure", "title_pattern", "search", "save", "beginner", "series", "long_score", "notes"]
PREVIEW = 120


class Reports(NamedTuple):
    drafts: DataFrame
    #: One row a draft: what it was judged by.
    quality: DataFrame
    #: ``part`` (pillar or title pattern), ``name, n_drafts, avg_score``; the mean for pillars alone.
    growth: DataFrame
    growth_items: DataFrame
    rejects: DataFrame
    #: ``part`` (kind, source or reason), ``name, n_rejects, place``: reasons are the ten most frequent.
    reject_counts: DataFrame


def _named(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]


def _or_unknown(df: DataFrame, c: str) -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")) if c in df.columns else F.lit("unknown")


def of_run(made: DataFrame, rejects: DataFrame) -> Reports:
    """``made``: drafts as generation gives them; ``rejects``: ``url, title, source, reason, reject_kind, ordinal``."""
    drafts, lost = stage(made, "drafts"), stage(rejects, "rejects")
    preview = F.substring(F.coalesce("short_text", F.lit("")), 1, PREVIEW).alias("preview")
    score = F.coalesce(F.col("long_score").cast("double"), F.lit(0.0)) if "long_score" in drafts.columns else F.lit(0.0)
    parts = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), _or_unknown(drafts, p).alias("name")) for p in ("pillar", "title_pattern")])).alias("p")
    counted = drafts.select(parts, score.alias("score")).groupBy("p.part", "p.name").agg(F.count("*").alias("n_drafts"), F.bround(F.avg("score"), 2).alias("avg_score"))
    growth = counted.withColumn("avg_score", F.when(F.col("part") == "pillar", F.col("avg_score")))
    sides = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), _or_unknown(lost, c).alias("name")) for p, c in (("kind", "reject_kind"), ("source", "source"))])).alias("p")
    by_side = lost.select(sides).groupBy("p.part", "p.name").agg(F.count("*").alias("n_rejects")).withColumn("place", F.lit(None).cast("long"))
    reasons = top_reasons(lost).select(F.lit("reason").alias("part"), F.col("reason_key").alias("name"), "n_rejects", F.col("first_seen").cast("long").alias("place"))
    return Reports(drafts, drafts.select(*_named(drafts, QUALITY), preview), growth, drafts.select(*_named(drafts, GROWTH)), lost, by_side.unionByName(reasons))


def publish(spark: SparkSession, reports: Reports, path: str, run: str, fmt: str = "json") -> bool:
    """Write all reports of ``run`` under ``path`` and then its manifest, with their counts; False where it is there."""
    files = Files(spark, path)
    manifest = f"{path.rstrip('/')}/_runs/{run}"
    if files.exists(manifest):
        return False
    counts = {}
    for name, rows in reports._asdict().items():
        sinks.write_report(rows, f"{path.rstrip('/')}/{run}/{name}", fmt)
        counts[name] = rows.count() if name in ("drafts", "rejects") else None
    return files.publish(manifest, json.dumps({"drafts": counts["drafts"], "rejects": counts["rejects"]}))
