"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next one's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import exact_dedup, mixing, packing, qda, simhash
from feedloom.llm.common import documents, labels, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 9)."""
    return qda.accepted(docs, qda.train_on_labelled(docs, labels(spark, sf_dir)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays (operator 7)."""
    index = exact_dedup.new_index(spark, docs.count())
    kept = exact_dedup.distinct_documents(docs, index)  # the index has been read by now
    index.close()
    return kept


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (operator 2)."""
    return simhash.one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights (operator 3).

    A document comes once per epoch, and once more for what it gives beyond.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix is tokenised and packed into windows (operator 1)."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Model training and token packing have no SQL form; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/feedloom/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
