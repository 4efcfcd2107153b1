"""Tables in the shared folder that cut lineage, and joins that check sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.lambdas import bound  # noqa: F401 - taken from here as well

#: Rows up to which a measured side may be broadcast (a few MB of keys).
BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given.

    Only a local master may have neither (a test); a temporary folder is set
    there.  On a cluster each executor would write to its own disk, so it stops.
    """
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        got = spark.conf.get("feedloom.local.scratch", None)
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        got = "file://" + tempfile.mkdtemp(prefix="feedloom-")
        spark.conf.set("feedloom.local.scratch", got)
    return got.rstrip("/")


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and read it back.

    This cuts lineage so that a lost executor costs one re-read, makes values
    that depend on evaluation order final, and gives both sides of a later
    join a plain exchange that adaptive execution can split when a key is hot.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/feedloom/{uuid.uuid4().hex}/{label}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the (staged) side has at most ``limit`` rows.

    Beyond the limit the plan keeps its shuffle join.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
