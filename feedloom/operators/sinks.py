"""Sinks: reports, the append-only table with an anti-join, schema evolution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.scoring import BOTH, normalise_status
from feedloom.functions.text import normalise_url
from feedloom.operators.relations import blocked_links, first_per, top_reasons
from feedloom.operators.staging import stage


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One job; the committer makes it all or nothing."""
    df.write.mode("overwrite").format(fmt).save(path)


def table_rows(drafts: DataFrame, existing: DataFrame, now_ms: int, freshness_hours: float | None = None) -> DataFrame:
    """Draft rows that the table lacks, as the table's columns.

    The link is the normalised url; of equal links the first row counts; the
    long form's columns are blank unless both platforms are the target.
    ``existing``: ``link, created``.
    """
    both = F.col("platform") == BOTH
    rows = drafts.withColumn("link", normalise_url(F.col("url"))).filter("link <> ''")
    held = blocked_links(existing, now_ms, freshness_hours).select(normalise_url(F.col("link")).alias("link")).distinct()
    fresh = first_per(rows.join(held, "link", "left_anti"), ["link"], ["ordinal"])
    blank = lambda c: F.when(both, F.coalesce(c, F.lit(""))).otherwise("")
    return fresh.select(
        "link",
        F.col("title"),
        "source",
        "platform",
        normalise_status(F.col("status")).alias("status"),
        F.col("body").alias("short_text"),
        blank(F.col("long_title")).alias("long_title"),
        blank(F.col("long_body")).alias("long_body"),
        blank(F.array_join("tags", ", ")).alias("long_tags"),
        F.lit(now_ms).cast("long").alias("created"),
    )


def guarded(write: Callable[[DataFrame, int], object], ready: bool, remember: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], str]:
    """A ``foreachBatch`` function: nothing is written unless ready; state is saved only after a whole write.

    Both get the batch's number.  With ``BatchTable.write`` (False for a batch
    that is there) and state written under the number (``StateTable.write``),
    a batch that failed between the two, and one that is replayed whole, come
    out once.
    """

    def run(batch: DataFrame, number: int = 0) -> str:
        if not ready:
            return "disabled"
        if batch.isEmpty():
            return "no rows"
        rows = stage(batch, "batch")
        new = write(rows, number)
        remember(rows, number)
        return "replayed" if new is False else "written"

    return run


def evolve(df: DataFrame, wanted: dict[str, str], obsolete: list[str]) -> DataFrame:
    """Columns of ``wanted`` (name to type) are added where absent, obsolete ones dropped; others stay."""
    out = df.drop(*obsolete)
    return out.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in out.columns})


def growth_report(drafts: DataFrame) -> DataFrame:
    """Drafts and mean scores by pillar and title pattern."""
    by = F.coalesce(F.nullif(F.col("pillar"), F.lit("")), F.lit("unknown"))
    return drafts.groupBy(by.alias("pillar"), "title_pattern").agg(F.count("*").alias("n_drafts"), F.bround(F.avg("score"), 2).alias("avg_score"))


def reject_report(rejects: DataFrame) -> dict[str, DataFrame]:
    """Rejects by kind and by source, and the most frequent reasons."""
    name = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c)
    return {"kinds": rejects.groupBy(name("reject_kind")).count(), "sources": rejects.groupBy(name("source")).count(), "reasons": top_reasons(rejects)}
