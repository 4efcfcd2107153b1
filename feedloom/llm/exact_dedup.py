"""Exact deduplication against a persistent, bucketed digest index.

The index holds ``(digest binary, keep_id bigint, batch string)`` in *runs*:
Parquet tables bucketed and sorted by digest, one file per bucket, all with the
same number of buckets.  A manifest at the location names the runs and holds
the number of buckets, so whoever opens the index, in this session or another,
reads it as it was written; another number is refused.

A new batch is reduced to one row per digest (map-side combined, so a text
copied a billion times shuffles one row per task), shuffled and sorted once
into the index's buckets, and merged with every run in one stage of sort-merge
joins: the runs need neither shuffle nor sort.  Digests without a partner are
new (the anti-join) and become a run of their own; a run that is no smaller
than half of the one before it is merged with it, so there are few runs, each
over twice the next, and an entry is rewritten a logarithmic number of times.

A batch has a name.  Entries of the same name count as new, and what is there
already is not appended again, so a batch that was lost after its append can
be run again and gives the same rows.

The number of buckets comes from the size expected, ``BUCKET_ROWS`` digests to
a bucket; :meth:`DigestIndex.compact` writes the index anew, with as many
buckets as it needs by then.  One writer at a time: the manifest's next number
is taken once, and a second writer that took the same stops.

Defined cases: a null text counts as the empty text; a null id never wins over
another id; rows that repeat both id and text share one verdict and count in
``group_size``; an empty batch gives no rows; further columns are ignored by
:func:`dedup_batch` and carried by :func:`distinct_documents`, whatever their
names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import keep_rows, lookup, shared_dir, stage, text_or_empty
from feedloom.operators.batches import Files

#: Digests of a bucket (some 60 bytes each, sorted in one task), and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 4_000_000, 16
ENTRY = "digest binary, keep_id bigint, batch string"
#: Reads a bucket's only file in the order in which it was written.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def buckets_for(rows: int) -> int:
    """The power of two that holds ``rows`` digests with room to double."""
    need = max(LEAST_BUCKETS, 2 * rows // BUCKET_ROWS)
    return 1 << (need - 1).bit_length()


@contextmanager
def ordered_buckets(spark: SparkSession) -> Iterator[None]:
    """Within it plans use the order of bucket files; they must run within it as well."""
    before = spark.conf.get(ORDERED, "false")
    spark.conf.set(ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED, before)


class DigestIndex:
    """The index at ``location``, which outlives the session; made where there is none.

    ``buckets`` counts for a new index; for one that is there it is what its
    manifest says, and a different wish is an error.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int | None = None):
        self.spark, self.location = spark, location.rstrip("/")
        self.files = Files(spark, self.location)
        if not self._numbers():
            self._publish({"buckets": buckets or LEAST_BUCKETS, "runs": []}, 0)
        self.buckets = self._manifest()["buckets"]
        if buckets is not None and buckets != self.buckets:
            raise ValueError(f"the index at {self.location} has {self.buckets} buckets, not {buckets}")

    def _numbers(self) -> list[int]:
        return [int(n) for n in self.files.names(f"{self.location}/_index") if not n.startswith(".")]

    def _manifest(self) -> dict:
        at = self._numbers()[-1]
        return json.loads(self.files.text(f"{self.location}/_index/{at:012d}")) | {"at": at}

    def _publish(self, manifest: dict, at: int) -> None:
        if not self.files.publish(f"{self.location}/_index/{at:012d}", json.dumps(manifest)):
            raise RuntimeError(f"another writer changed the index at {self.location}")

    def _table(self, folder: str) -> str:
        return "feedloom_digests_" + hashlib.sha256(f"{self.location}/{folder}".encode()).hexdigest()[:24]

    def runs(self) -> list[DataFrame]:
        """The runs, largest first, each as its bucketed table."""
        found = []
        for run in self._manifest()["runs"]:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._table(run['folder'])} ({ENTRY}) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}/{run['folder']}'"
            )
            found.append(self.spark.table(self._table(run["folder"])))
        return found

    def _plain(self, runs: list[dict]) -> DataFrame:
        """The entries of runs as files without buckets: a plan over bucketed tables may leave out a shuffle that one file per bucket needs."""
        if not runs:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*[f"{self.location}/{r['folder']}" for r in runs])

    def read(self) -> DataFrame:
        """All entries."""
        return self._plain(self._manifest()["runs"])

    def _write(self, rows: DataFrame) -> dict:
        """A run of its own: one file per bucket, sorted by digest."""
        folder = f"run-{uuid.uuid4().hex}"
        dealt = rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
        dealt.write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").option("path", f"{self.location}/{folder}").saveAsTable(self._table(folder))
        return {"folder": folder, "rows": self.spark.table(self._table(folder)).count()}

    def append(self, rows: DataFrame) -> None:
        """Add entries, none of which is there, and merge runs of like size."""
        before = self._manifest()
        new = self._write(rows)
        if new["rows"]:
            self._publish({"buckets": self.buckets, "runs": [*before["runs"], new]}, before["at"] + 1)
        else:
            self._drop([new])
        self._merge()

    def _merge(self) -> None:
        while True:
            now = self._manifest()
            runs = now["runs"]
            if len(runs) < 2 or 2 * runs[-1]["rows"] < runs[-2]["rows"]:
                return
            old = runs[-2:]
            merged = self._write(self._plain(old))
            self._publish({"buckets": self.buckets, "runs": [*runs[:-2], merged]}, now["at"] + 1)
            self._drop(old)

    def _drop(self, runs: list[dict]) -> None:
        """Runs that no manifest names any more, with their files."""
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(run['folder'])}")
            self.files.remove(f"{self.location}/{run['folder']}")

    def compact(self, location: str) -> DigestIndex:
        """The same entries at a new ``location`` as one run, buckets by today's size."""
        fresh = DigestIndex(self.spark, location, buckets_for(sum(r["rows"] for r in self._manifest()["runs"])))
        fresh.append(self.read())
        return fresh

    def close(self) -> None:
        """Take the tables out of the session's catalog; their files stay."""
        for run in self._manifest()["runs"]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(run['folder'])}")


def new_index(spark: SparkSession, rows: int = 0) -> DigestIndex:
    """An empty index in the shared folder, for about ``rows`` digests."""
    return DigestIndex(spark, f"{shared_dir(spark)}/feedloom/index-{uuid.uuid4().hex}", buckets_for(rows))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"))


def met_index(groups: DataFrame, index: DigestIndex) -> DataFrame:
    """``groups`` (one row a digest) with ``_known`` and ``_batch`` of the index's entry, null where it has none.

    One shuffle and one sort, of ``groups``; run it within :func:`ordered_buckets`.
    """
    met = groups.repartition(index.buckets, "digest")
    known, batch = F.lit(None).cast("long"), F.lit(None).cast("string")
    for i, run in enumerate(index.runs()):
        entry = run.select("digest", F.col("keep_id").alias(f"_known{i}"), F.col("batch").alias(f"_batch{i}"))
        met = met.join(entry.hint("merge"), "digest", "left")
        known, batch = F.coalesce(known, f"_known{i}"), F.coalesce(batch, f"_batch{i}")
    return met.select(*groups.columns, known.alias("_known"), batch.alias("_batch"))


def dedup_batch(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """Add a batch to ``index``; return ``doc_id, digest, keep_id, group_size, kept``.

    One row per input row.  Within the batch the largest id of equal texts
    stays; a text that an earlier batch indexed is dropped in favour of the
    indexed id.  ``group_size`` counts the batch's rows of that text.
    ``batch``: the name under which it may be run again; new where absent.
    """
    name = batch or uuid.uuid4().hex
    rows = stage(digests(docs, id_col, text_col), "digests")
    groups = stage(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    fresh = F.col("_batch").isNull() | (F.col("_batch") == name)
    with ordered_buckets(docs.sparkSession):
        decided = stage(
            met_index(groups, index).select(
                "digest", F.when(fresh, F.col("keep_id")).otherwise(F.col("_known")).alias("keep_id"), "group_size", fresh.alias("fresh"), F.col("_batch").isNull().alias("missing")
            ),
            "decided",
        )
    index.append(decided.filter("missing").withColumn("batch", F.lit(name)))
    return lookup(rows, decided.drop("missing"), ["digest"], "inner").select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept")
    )


def dedup_in_batches(batches: list[DataFrame], index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Batches one after the other against one index: the rows of :func:`dedup_batch`, ``group_size`` over all of them."""
    found = None
    for docs in batches:
        rows = dedup_batch(docs, index, id_col, text_col)
        found = rows if found is None else found.unionByName(rows)
    found = stage(found.drop("group_size"), "batches")
    sizes = found.groupBy("digest").agg(F.count("*").alias("group_size"))
    return lookup(found, sizes, ["digest"], "inner")


def distinct_documents(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`dedup_batch` keeps, with all their columns.

    Rows that repeat the kept row's id and text come out once.
    """
    kept = stage(dedup_batch(docs, index, id_col, text_col, batch).filter("kept").select("doc_id", "digest"), "kept")
    repeats = kept.groupBy("digest").count().filter("count > 1").limit(1).count() > 0
    free = next(f"_f{i}" for i in range(len(docs.columns) + 1) if not any(c.lower().startswith(f"_f{i}_") for c in docs.columns))
    own_id, own_digest = f"{free}_id", f"{free}_digest"
    hashed = docs.withColumns({own_id: F.col(id_col), own_digest: F.unhex(F.sha2(text_or_empty(text_col), 256))})
    ids = kept.select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest))
    out = keep_rows(hashed, ids.distinct() if repeats else ids, [own_id, own_digest])
    if repeats:
        out = out.dropDuplicates([own_id, own_digest])
    return out.drop(own_id, own_digest)
