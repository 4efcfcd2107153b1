"""Micro-batch state: seen keys, editorial memory, the review queue.

State is a Parquet table written to a new folder and then named by a pointer,
so a batch that fails leaves the last state as it was.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from feedloom.operators.batches import BatchTable
from feedloom.operators.relations import first_per, new_only, remember
from feedloom.operators.staging import stage


class StateTable:
    """Versions of a table under ``path``; the largest version that was written whole counts."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def _versions(self) -> list[tuple[int, str]]:
        """``(number, batch)`` of the whole versions, oldest first; the batch is empty where none was named."""
        fs, jvm = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs.exists(root):
            return []
        done = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        found = [re.fullmatch(r"v(\d+)(?:-(.+))?", p.getName()) for p in done]
        return sorted((int(m[1]), m[2] or "") for m in found if m)

    def _at(self, version: tuple[int, str]) -> str:
        return f"{self.path}/v{version[0]}" + (f"-{version[1]}" if version[1] else "")

    def read(self, before: str | int | None = None) -> DataFrame:
        """The last version; ``before``: the last one that this batch did not write, so that a replay finds what the first try found."""
        at = [v for v in self._versions() if before is None or v[1] != str(before)]
        return self.spark.read.schema(self.schema).parquet(self._at(at[-1])) if at else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, keep: int = 2, batch: str | int | None = None) -> None:
        """A new version; those of the same batch go, and all but the last ``keep``."""
        at, name = self._versions(), "" if batch is None else str(batch)
        new = ((at[-1][0] + 1) if at else 0, name)
        df.write.mode("overwrite").parquet(self._at(new))
        fs, jvm = self._fs()
        same = [v for v in at if name and v[1] == name]
        others = [v for v in at if v not in same]
        for old in same + others[: max(0, len(others) - keep + 1)]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._at(old)), True)

    def clear(self) -> None:
        self.write(self.spark.createDataFrame([], self.schema))


def admit(batch: DataFrame, state: StateTable, key: str, most: int = 5000, sink: Callable[[DataFrame], object] | None = None, batch_id: str | int | None = None) -> DataFrame:
    """Rows of the batch whose key is new; ``sink`` gets them before their keys are remembered.

    ``batch``: ``key, ordinal, ...``; ``state``: ``key, seq``.  Keys that a try
    of the same ``batch_id`` remembered count as new, so a batch that failed
    anywhere can be run again and gives the same rows.  The history is one
    table of the newest ``most`` keys, in order of arrival; for keys without
    such a limit see ``keyed.admit``, which rewrites nothing.
    """
    history = state.read(before=batch_id)
    fresh = stage(new_only(batch, key, history, ["ordinal"]), "admitted")
    start = history.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1
    kept = remember(history, fresh.select(key, (F.col("ordinal") + start).alias("seq")), key, "seq", most)
    if sink is not None:
        sink(fresh)
    state.write(kept, batch=batch_id)
    return fresh


def admit_stream(stream: DataFrame, state: StateTable, key: str, sink: BatchTable, checkpoint: str, most: int = 5000) -> StreamingQuery:
    """New rows of a stream, each batch written to ``sink`` once; each run takes what has come since the last."""

    def run(batch: DataFrame, number: int) -> None:
        admit(batch, state, key, most, lambda rows: sink.write(rows, number), number)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recent(memory: DataFrame, added: DataFrame, order: str, most: int = 50) -> DataFrame:
    """The newest ``most`` rows of both, first in first out."""
    return memory.unionByName(added).orderBy(F.desc(order)).limit(most)


def recent_titles(memory: DataFrame, order: str, most: int = 20, width: int = 80) -> DataFrame:
    """``body``: one row, the titles of the newest ``most`` rows as a list, oldest of them first; empty without any."""
    few = memory.orderBy(F.desc(order)).limit(most).filter(F.coalesce("title", F.lit("")) != "")
    lines = few.agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.substring("title", 1, width).alias("t")))).alias("x"))  # ``most`` rows
    told = F.array_join(F.transform("x", lambda r: F.concat(F.lit("- "), r["t"])), "\n")
    head, tail = "## 最近已做过的角度（避免重复，2026-07-26 新增）\n\n", "\n\n如果当前素材角度与上面重合度 > 80%，请换一个角度。"
    return lines.select(F.when(F.size("x") == 0, "").otherwise(F.concat(F.lit(head), told, F.lit(tail))).alias("body"))


def purge(table: DataFrame, status: str = "待审核", confirm: bool = False) -> tuple[DataFrame, DataFrame]:
    """What stays, and counts by status; only where confirmed do rows of ``status`` go."""
    name = F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("(空)"))
    counts = table.groupBy(name.alias("status")).agg(F.count("*").alias("n_rows"))
    return (table.filter(~F.col("status").eqNullSafe(F.lit(status))) if confirm else table), counts


def enqueue(queue: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Items not in the queue are added as pending."""
    fresh = first_per(items, [key], ["ordinal"]).join(queue.select(key), key, "left_anti")
    return queue.unionByName(fresh.withColumn("status", F.lit("pending")).select(*queue.columns))


def decide(queue: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Pending rows take the status of their last decision; decided ones keep theirs."""
    last = decisions.groupBy(F.col(key).alias("_k")).agg(F.max_by("status", "seq").alias("_status"))
    joined = queue.join(last, queue[key] == last["_k"], "left")
    status = F.when((F.col("status") == "pending") & F.col("_status").isNotNull(), F.col("_status")).otherwise(F.col("status"))
    return joined.withColumn("status", status).select(*queue.columns)


def age_out(queue: DataFrame, created: Column, now: Column, days: int) -> DataFrame:
    """Pending rows older than ``days`` are rejected; rows without a date stay."""
    old = (F.col("status") == "pending") & (created < now - F.expr(f"INTERVAL {days} DAYS"))
    return queue.withColumn("status", F.when(F.coalesce(old, F.lit(False)), "rejected").otherwise(F.col("status")))


def feedback_stats(log: DataFrame, since: Column | None = None) -> DataFrame:
    """Total, approved, rejected and the approval rate, over all rows or those ``since``."""
    rows = log if since is None else log.filter(since)
    agg = rows.agg(F.count("*").alias("total"), F.count_if(F.col("feedback") == "approved").alias("approved"), F.count_if(F.col("feedback") == "rejected").alias("rejected"))
    rate = F.when(F.col("total") > 0, F.col("approved") / F.col("total")).otherwise(0.0)
    return agg.withColumn("approval_rate", rate).withColumn("retrain", F.col("total") >= 50)
