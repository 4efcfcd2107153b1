"""Continuous intake of JSON-line feeds: bad records are set aside, bad sources leave the others alone.

Each source is a file stream of its own.  A line that is no object, lacks an
url, or holds a field of another type goes to a quarantine table with its file
and the reason; the other lines of the file get through.  Both tables take
batches by their number, so a stream that is killed writes nothing twice.
A file as a whole may also be read with a last good version to fall back on.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.batches import BatchTable
from feedloom.operators.staging import stage
from feedloom.sources import connectors

#: Fields of a record; ``ordinal`` is counted here.
RECORD = "url string, title string, snippet string, content string, publish_time string"
QUARANTINE = "source string, file string, line string, reason string"


@dataclass(frozen=True)
class Feed:
    """A source: its name and the folder that its files come to; ``files``: at most so many a batch."""

    name: str
    path: str
    files: int = 1000


def reason(line: Column, record: Column) -> Column:
    """Why a line is no record; null for one that is.  Numbers and truth values pass as text."""
    value = F.try_parse_json(line)
    nested = F.lit(False)
    for field in RECORD.split(", "):
        kind = F.schema_of_variant(F.try_variant_get(value, f"$.{field.split()[0]}", "variant"))
        nested = nested | F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))
    return (
        F.when(value.isNull(), "not JSON")
        .when(~F.trim(line).startswith("{"), "not an object")
        .when(record["_bad"].isNotNull() | nested, "a field of another type")
        .when(F.coalesce(F.trim(record["url"]), F.lit("")) == "", "no url")
    )


def parsed(lines: DataFrame, source: str) -> DataFrame:
    """``lines``: ``value, file``; adds ``record`` and ``reason``."""
    record = F.from_json("value", f"{RECORD}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.filter(F.trim("value") != "").withColumn("record", record)
    return rows.withColumns({"reason": reason(F.col("value"), F.col("record")), "source": F.lit(source)})


def good(rows: DataFrame) -> DataFrame:
    fields = [F.coalesce(F.col(f"record.{c}"), F.lit("")).alias(c) for c in ("title", "snippet", "content")]
    return rows.filter("reason is null").select(F.trim("record.url").alias("url"), *fields, "source", "record.publish_time", F.monotonically_increasing_id().alias("ordinal")).select(*connectors.COLUMNS)


def bad(rows: DataFrame) -> DataFrame:
    return rows.filter("reason is not null").select("source", "file", F.col("value").alias("line"), "reason")


def start(spark: SparkSession, feed: Feed, table: BatchTable, quarantine: BatchTable, checkpoint: str, seconds: float | None = None):
    """The feed's stream; every ``seconds``, or once over what is there.

    Batches are named after the feed, so feeds share both tables.
    """

    def run(lines: DataFrame, number: int) -> None:
        name = f"{feed.name}-{number:012d}"
        if table.holds(name):
            return
        rows = stage(parsed(lines, feed.name), "intake")
        quarantine.write(bad(rows), name)
        table.write(good(rows), name)  # last: this is what marks the batch as done

    lines = spark.readStream.option("maxFilesPerTrigger", feed.files).text(feed.path).select("value", F.col("_metadata.file_path").alias("file"))
    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", f"{checkpoint}/{feed.name}")
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


def take_in(spark: SparkSession, feeds: list[Feed], table: BatchTable, quarantine: BatchTable, checkpoint: str) -> dict[str, str | None]:
    """All that the feeds have, each in its own stream; the cause of each one's failure, or None."""
    running, failed = {}, {}
    for feed in feeds:
        try:
            running[feed.name] = start(spark, feed, table, quarantine, checkpoint)
        except Exception as cause:  # noqa: BLE001 - a feed that cannot start leaves the others alone
            failed[feed.name] = str(cause)
    for name, stream in running.items():
        try:
            stream.awaitTermination()
            failed[name] = None
        except Exception as cause:  # noqa: BLE001
            failed[name] = str(cause)
    for name, cause in failed.items():
        if cause:
            logging.getLogger(__name__).warning("feed %s stopped: %s", name, cause)
    return failed


def read_or_last(spark: SparkSession, name: str, options: dict, cache: BatchTable, version: str) -> DataFrame:
    """A source's rows, kept as ``version``; the newest version before it where the source fails or is empty.

    Versions sort by their names (a date); a version that is there is read again, not fetched.
    """
    if not cache.holds(version):
        rows = connectors.read(spark, name, options)
        if rows.limit(1).count():
            cache.write(rows, version)
    held = [v for v in cache.batches() if v <= version]
    return cache.read(lambda v: v == held[-1]) if held else spark.createDataFrame([], cache.schema)
