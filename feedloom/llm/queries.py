"""The registered queries of the operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import alignment, exact_dedup, language, licences, merkle, mixing, packing, pii, qda, quality_rules, secrets, simhash, sql, tokens
from feedloom.llm.common import documents, labels


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.histogram(tokens.length_counts(documents(spark, sf_dir)))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches against one index: the larger half of the ids, which win over the others, then the rest."""
    docs = documents(spark, sf_dir)
    index = exact_dedup.new_index(spark, docs.count())
    half = docs.select(F.percentile_approx("doc_id", 0.5)).first()[0]
    later = F.coalesce(F.col("doc_id") > F.lit(half), F.lit(False))
    found = exact_dedup.dedup_in_batches([docs.filter(later), docs.filter(~later)], index)
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.apply_rules(documents(spark, sf_dir), labels(spark, sf_dir))
    return found.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, feats = qda.train(documents(spark, sf_dir), labels(spark, sf_dir))
    return qda.scores(feats, model)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(documents(spark, sf_dir))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.predict(docs, language.train(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))[0]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_pii": op5_pii,
    "op6_licences": op6_licences,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_secrets": op10_secrets,
    "op11_language_id": op11_language_id,
    "op12_alignment": op12_alignment,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {
    "op3_mixing": r"""
        WITH docs AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   length(coalesce(text, '')) AS n,
                   length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols,
                   md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS hash
            FROM documents
        ), keyed AS (
            SELECT doc_id, source, size,
                   -ln((('0x' || substr(hash, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
                   / (1.0 / (1.0 + 20.0 * symbols::DOUBLE / (1 + n)::DOUBLE)) AS key
            FROM docs
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) AS rank
            FROM docs GROUP BY source
        ), weighted AS (
            SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
                   source_size * 2 AS cap
            FROM sources
        ), level AS (
            SELECT *,
                   (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level,
                   row_number() OVER (ORDER BY cap::DOUBLE / weight, rank) AS place
            FROM weighted
            WINDOW before AS (ORDER BY cap::DOUBLE / weight, rank
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), held AS (
            SELECT level AS held FROM level WHERE level * weight <= cap ORDER BY place LIMIT 1
        ), goals AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, coalesce((SELECT held FROM held) * weight, cap::DOUBLE)) AS target
            FROM weighted
        ), summed AS (
            SELECT k.*, g.source_size, g.target,
                   CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS epochs,
                   coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM keyed k JOIN goals g ON k.source IS NOT DISTINCT FROM g.source
        )
        SELECT doc_id, size, source_size, target,
               (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
        FROM summed
    """,
    "op7_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_merkle": sql.merkle(),
}
