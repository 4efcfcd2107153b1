"""The review queue as a log of changes: a decision on ten rows of a large queue writes ten rows.

Items and decisions are small batches of changes next to a base that is
bucketed and sorted by key, one file per bucket.  A read reduces the changes
to one row a key and joins the base to them: by broadcast while they are few,
else by the base's own buckets, which are not shuffled.  :meth:`ReviewLog.compact` writes a new base; it changes no row.

Each change is resolved as it is written: an item only where its key is new, a
decision only where its row is pending.  So a key has at most one item and one
decision in the log, and order within it is of no account.  Batches have
names; a name that is there writes nothing again.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedloom.operators.batches import BatchTable
from feedloom.operators.relations import first_per
from feedloom.operators.staging import broadcast_checked, stage

PENDING = "pending"


class ReviewLog:
    """A queue of ``schema``, which names ``key``, at ``path``; rows are read with ``status`` behind them."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "id", buckets: int = 16):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.item = StructType.fromDDL(schema)
        self.row = StructType([*self.item.fields, StructField("status", StringType())])
        change = StructType([StructField("key", self.item[key].dataType), StructField("item", self.item), StructField("decision", StringType())])
        self.changes = BatchTable(spark, f"{self.path}/changes", change)
        self.files = self.changes.files
        self.wanted = buckets

    def _base(self) -> dict | None:
        names = [n for n in self.files.names(f"{self.path}/bases") if not n.startswith(".")]
        return json.loads(self.files.text(f"{self.path}/bases/{names[-1]}")) | {"at": int(names[-1])} if names else None

    def _table(self, base: dict) -> DataFrame:
        """The base as a bucketed table; its number of buckets is what its manifest says."""
        name = "feedloom_queue_" + hashlib.sha256(f"{self.path}/{base['folder']}".encode()).hexdigest()[:24]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.row.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {base['buckets']} BUCKETS LOCATION '{self.path}/{base['folder']}'"
        )
        return self.spark.table(name)

    def _pending_changes(self, base: dict | None) -> DataFrame:
        """One row a key of the changes since the base: ``_key, _item, _decision``."""
        merged = set(base["batches"]) if base else set()
        rows = self.changes.read(lambda n: n not in merged)
        return rows.groupBy(F.col("key").alias("_key")).agg(F.first("item", ignorenulls=True).alias("_item"), F.first("decision", ignorenulls=True).alias("_decision"))

    def read(self) -> DataFrame:
        """Every row with its status."""
        base = self._base()
        found = self._pending_changes(base)
        fresh = [F.col(f"_item.{f.name}").alias(f.name) for f in self.item.fields]
        status = F.coalesce("_decision", F.lit(PENDING)).alias("status")
        if base is None:
            return found.filter("_item is not null").select(*fresh, status)
        old = self._table(base)
        # a key with an item in the changes is not in the base, so the two parts do not meet
        decided = old.join(broadcast_checked(stage(found.filter("_item is null").select("_key", "_decision"), "decisions")), old[self.key] == F.col("_key"), "left")
        rows = decided.select(*[old[f.name] for f in self.item.fields], F.coalesce("_decision", old["status"]).alias("status"))
        return rows.unionByName(found.filter("_item is not null").select(*fresh, status))

    def add(self, items: DataFrame, batch: str | int, order: str = "ordinal") -> bool:
        """Items whose key is not in the queue, the first of each; they are pending."""
        if self.changes.holds(batch):
            return False
        first = first_per(items.filter(F.col(self.key).isNotNull()), [self.key], [order]).select(*[f.name for f in self.item.fields])
        new = first.join(self.read().select(F.col(self.key)), self.key, "left_anti").select(*[f.name for f in self.item.fields])
        return self.changes.write(new.select(F.col(self.key).alias("key"), F.struct(*new.columns).alias("item"), F.lit(None).cast("string").alias("decision")), batch)

    def _decided(self, rows: DataFrame, batch: str | int) -> bool:
        empty = F.lit(None).cast(self.item)
        return self.changes.write(rows.select(F.col("_key").alias("key"), empty.alias("item"), F.col("_status").alias("decision")), batch)

    def decide(self, decisions: DataFrame, batch: str | int) -> bool:
        """Pending rows take their last decision by ``seq``; what else is decided has no effect and is not written."""
        if self.changes.holds(batch):
            return False
        last = stage(decisions.groupBy(F.col(self.key).alias("_key")).agg(F.max_by("status", "seq").alias("_status")).filter("_status is not null"), "last")
        open_ = self.read().filter(F.col("status") == PENDING).select(F.col(self.key).alias("_open"))
        return self._decided(open_.join(broadcast_checked(last), F.col("_open") == F.col("_key")), batch)

    def age_out(self, created: Column, now: Column, days: int, batch: str | int) -> bool:
        """Pending rows older than ``days`` are rejected."""
        if self.changes.holds(batch):
            return False
        old = (F.col("status") == PENDING) & F.coalesce(created < now - F.expr(f"INTERVAL {days} DAYS"), F.lit(False))
        return self._decided(self.read().filter(old).select(F.col(self.key).alias("_key"), F.lit("rejected").alias("_status")), batch)

    def compact(self, buckets: int | None = None) -> None:
        """A new base of all rows; the changes in it stay known by name, their files are no longer read."""
        base, merged = self._base(), self.changes.batches()
        n = buckets or (base["buckets"] if base else self.wanted)
        folder = f"data/base-{uuid.uuid4().hex}"
        manifest = {"folder": folder, "buckets": n, "batches": merged}
        rows = stage(self.read(), "queue")
        name = "feedloom_queue_" + hashlib.sha256(f"{self.path}/{folder}".encode()).hexdigest()[:24]
        rows.repartition(n, self.key).write.bucketBy(n, self.key).sortBy(self.key).format("parquet").option("path", f"{self.path}/{folder}").saveAsTable(name)
        if not self.files.publish(f"{self.path}/bases/{(base['at'] + 1) if base else 0:012d}", json.dumps(manifest)):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.files.remove(f"{self.path}/{folder}")
            raise RuntimeError(f"another writer compacted {self.path}")
