"""The whole flow from sources to table rows.

The scored items are written once, in one pass over the sources that counts
the funnel as it goes (observed metrics, no scan of their own); what follows
are lazy relations over that table, so a caller materialises what it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.functions import scoring, text
from feedloom.operators import clusters, items, relations
from feedloom.operators.staging import stage


@dataclass(frozen=True)
class Settings:
    per_source: int = 6
    min_heat: float = 30.0
    most: int = 18
    threshold: float = 0.72
    #: Column that bounds a batch of events to cluster in one task; None clusters all items at once, which needs an ``ordinal`` that is unique over all sources.
    block: str | None = "batch"


@dataclass(frozen=True)
class Flow:
    merged: DataFrame
    fresh: DataFrame
    scored: DataFrame
    events: DataFrame
    clean: DataFrame
    picked: DataFrame
    funnel: DataFrame

    def branch(self) -> str:
        """``both`` where most items are shallow, else ``one``; ``both`` without items."""
        share = self.clean.agg(F.avg(F.when(F.col("tech_depth") <= 60, 1.0).otherwise(0.0))).first()[0]
        return "both" if share is None or share > 0.5 else "one"


def run(sources: list[tuple[str, DataFrame]], history: DataFrame, settings: Settings | None = None, keep: Callable[[DataFrame, str], DataFrame] = stage) -> Flow:
    """Union, classify, drop what was seen, score, cluster, clean, filter and pick.

    Sources have ``url, title, snippet, content, source, ordinal`` and the
    block column; ``history`` has ``key``.  ``keep`` writes the scored items
    as a table and gives it back; the funnel is counted by that write.
    """
    s = settings or Settings()
    none = F.lit(None).cast("string")
    capped = [(n, relations.first_per(items.standardise(df), ["source"], ["ordinal"], s.per_source)) for n, df in sources]
    merged = relations.union_sources(capped)
    c = F.col
    merged = merged.withColumn("category", scoring.category(c("source"), c("title"), c("snippet"), none, none, none))
    merged = merged.withColumns({"tech_depth": scoring.tech_depth(c("category")), "key": text.normalise_url(c("url"))})
    collected, passed = Observation(), Observation()
    fresh = relations.new_only(merged.observe(collected, F.count(F.lit(1)).alias("collected")), "key", history, ["collector_rank", "ordinal"])
    rules = scoring.rule_score(c("title"), c("snippet"), c("content"), c("source"), c("category"), none, F.lit(0.0), F.lit(1.0))
    heat = scoring.fallback_score(F.concat_ws(" ", "title", "snippet", "content", "source", "category"), c("source"), rules, scoring.audience_bias(c("category"), c("source")))
    scored = fresh.withColumn("heat_score", heat)
    scored = keep(scored.observe(passed, F.count(F.lit(1)).alias("fresh"), F.count_if(c("heat_score") >= s.min_heat).alias("hot")), "scored")
    counts = passed.get | collected.get
    funnel = scored.sparkSession.createDataFrame([(counts["fresh"], counts["hot"], counts["collected"])], "fresh long, hot long, collected long")
    if s.block is None:
        events = relations.representative_rows(clusters.cluster(scored, threshold=s.threshold), ["cluster"])
    else:
        events = relations.representative_rows(relations.cluster_titles(scored, [s.block], s.threshold), [s.block, "cluster"])
    evidence = text.squeeze(F.concat_ws(" ", "title", "snippet", "content"))
    kept = events.filter(scoring.enough_evidence(evidence, c("source"), c("category"), c("cluster_size")))
    clean = kept.withColumn("content", text.clean_text(text.pick_content(c("content"), c("snippet"))))
    able = clean.filter(c("heat_score") >= s.min_heat).withColumn("bucket", scoring.pick_audience(c("category"), c("source")))
    order = [F.desc("heat_score"), F.desc("cluster_size"), F.desc(F.length("content") + F.length("snippet")), "collector_rank", "ordinal"]
    few = relations.first_per(able, ["bucket"], order, s.most)
    placed = few.withColumn("place", F.row_number().over(Window.orderBy(*order)))  # at most three buckets of ``most`` rows
    picked = relations.quota_pick(placed, "bucket", "place", s.most)
    return Flow(merged, fresh, scored, events, clean, picked, funnel)
