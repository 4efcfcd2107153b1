"""One run from the command line: sources from a configuration, state, caps and sinks.

    python -m feedloom --sources sources.json --state /shared/state --out /shared/out

``sources.json`` is a list of ``{"type", "name", "path"}`` with, optionally,
``"cap"`` and ``"enabled": false``; types are those that connectors register.
"""

from __future__ import annotations

import argparse
import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.functions import scoring
from feedloom.operators import sinks
from feedloom.operators.batches import BatchTable
from feedloom.plans import flow
from feedloom.sources import connectors
from feedloom.streaming.state import StateTable

SEEN = "key string, seq long"
ROWS = "link string, title string, source string, platform string, status string, short_text string, long_title string, long_body string, long_tags string, created long"
#: Where a run may aim: both forms by the item, the long form, or the short one.
TARGETS = {"mixed": None, "xiaohongshu": scoring.BOTH, "x": scoring.ONE}


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="feedloom", description=__doc__.splitlines()[0])
    p.add_argument("--sources", required=True, help="configuration of the sources, JSON")
    p.add_argument("--state", required=True, help="folder of seen keys and of the table")
    p.add_argument("--out", required=True, help="folder of the run's picked items")
    p.add_argument("--max-per-source", type=int, default=6)
    p.add_argument("--min-heat-score", type=float, default=30.0)
    p.add_argument("--max-drafts", type=int, default=int(os.environ.get("FEEDLOOM_MAX_DRAFTS", "18")))
    p.add_argument("--clear-dedup", action="store_true", help="forget the seen keys first")
    p.add_argument("--no-table", dest="to_table", action="store_false", help="leave the table as it is")
    p.add_argument("--no-local", dest="to_local", action="store_false", help="write no picked items")
    p.add_argument("--freshness-hours", type=float, default=None, help="rows of the table block their links for so long; for ever where absent")
    p.add_argument("--target-platform", choices=sorted(TARGETS), default=os.environ.get("FEEDLOOM_TARGET_PLATFORM", "mixed"))
    p.add_argument("--run", default=None, help="the run's name; a run of that name is not written again")
    return p.parse_args(args)


def sources(spark: SparkSession, path: str) -> list[tuple[str, DataFrame]]:
    """The enabled sources in order; one that fails is empty."""
    listed = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))  # a configuration
    on = [s for s in listed if s.get("enabled", True)]
    return [(s["name"], connectors.read(spark, s["type"], {**s, "source": s["name"]})) for s in on]


def run(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    """The run's funnel; what it picked is written by the sinks that are on, and the keys are remembered after them."""
    name = a.run or time.strftime("%Y%m%d_%H%M%S")
    seen = StateTable(spark, f"{a.state}/seen", SEEN)
    if a.clear_dedup:
        seen.clear()
    settings = flow.Settings(a.max_per_source, a.min_heat_score, a.max_drafts, block=None)
    read = sources(spark, a.sources)
    if not read:
        return {"collected": 0, "fresh": 0, "hot": 0, "picked": 0, "added": 0}
    # one order over all sources, as clustering needs it
    ordered = [(n, df.withColumn("ordinal", F.row_number().over(Window.partitionBy("source").orderBy("ordinal")).cast("long") * len(read) + i)) for i, (n, df) in enumerate(read)]
    history = seen.read(before=name)
    found = flow.run(ordered, history.select("key"), settings)
    picked = flow.stage(found.picked, "picked")
    platform = F.lit(TARGETS[a.target_platform]) if TARGETS[a.target_platform] else F.lit(scoring.BOTH if found.branch() == "both" else scoring.ONE)
    if a.to_local:
        BatchTable(spark, f"{a.out}/picked", picked.schema).write(picked, name)
    added = 0
    if a.to_table:
        table = BatchTable(spark, f"{a.state}/table", ROWS)
        blank = {c: F.lit("") for c in ("status", "long_title", "long_body")}
        drafts = picked.withColumns({**blank, "platform": platform, "body": F.col("content"), "tags": F.array().cast("array<string>"), "ordinal": F.col("pick_rank")})
        rows = flow.stage(sinks.table_rows(drafts, table.read(lambda n: n != name).select("link", F.col("created").cast("string").alias("created")), int(time.time() * 1000), a.freshness_hours), "rows")
        table.write(rows, name)
        added = rows.count()
    start = history.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1
    fresh = found.scored.select("key", (F.row_number().over(Window.orderBy("collector_rank", "ordinal")) + start).alias("seq"))  # at most max-per-source rows a source
    seen.write(flow.relations.remember(history, fresh, "key", "seq", 5000), batch=name)
    counts = found.funnel.first().asDict()
    return counts | {"picked": picked.count(), "added": added}


def main(args: list[str] | None = None) -> int:
    a = arguments(args)
    spark = SparkSession.builder.appName("feedloom").getOrCreate()
    print(json.dumps(run(spark, a)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
