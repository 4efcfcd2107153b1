"""Queries of the operators that keep tables, ask services and compare whole tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.functions import terms as many
from feedloom.functions import text
from feedloom.operators import clusters, relations
from feedloom.operators.batches import BatchTable
from feedloom.operators.calls import ReplyLog
from feedloom.operators.evolution import EvolvingTable
from feedloom.operators.staging import shared_dir, stage
from feedloom.plans import scoring_stage
from feedloom.plans.catalog import TERMS, query, table
from feedloom.sources import connectors, intake
from feedloom.streaming import state
from feedloom.streaming.changelog import ReviewLog


def _place(spark: SparkSession, label: str) -> str:
    """A folder of this run's own, which all tasks reach."""
    return f"{shared_dir(spark)}/feedloom/{uuid.uuid4().hex}/{label}"


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts and the first lines of documents, in one order: ``ordinal, title``."""
    parts = table(spark, sf_dir, "part").select((2 * F.col("p_partkey")).alias("ordinal"), F.concat_ws(" ", "p_name", "p_type").alias("title"))
    docs = table(spark, sf_dir, "documents").select((2 * F.col("doc_id") + 1).alias("ordinal"), F.substring(text.first_line(F.col("text")), 1, 60).alias("title"))
    return parts.unionByName(docs)


@query()
def event_clusters_all(spark, sf_dir):
    """Clusters of all titles of two tables at once, without blocks."""
    return clusters.cluster(titles(spark, sf_dir)).select("ordinal", "cluster")


@query("""WITH t AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-zà-ÿ]+')) AS w FROM benchmark), u AS (SELECT w FROM t WHERE length(w) >= 4)
    SELECT doc_id, count(w) AS n_terms, coalesce(sum((length(l) - length(replace(l, w, ''))) // length(w)), 0)::BIGINT AS n_hits
    FROM (SELECT doc_id, lower(text) AS l FROM documents) LEFT JOIN u ON contains(l, w) GROUP BY doc_id""")
def term_table(spark, sf_dir):
    """All words of the benchmark in all documents."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-zà-ÿ]+")).alias("term")).filter(F.length("term") >= 4).distinct()
    listed = words.withColumn("place", F.row_number().over(Window.orderBy("term")))
    found = many.find_terms(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", listed)
    return found.select("doc_id", F.size("found").cast("long").alias("n_terms"), many.term_total(F.col("found")).alias("n_hits"))


@query("""WITH r AS (SELECT 'documents' AS part, 'documents.parquet' AS file, contains(text, 'the') AS hit FROM documents
      UNION ALL SELECT 'conversations', 'conversations.parquet', contains(text, 'the') FROM conversations),
    c AS (SELECT part, file, count(*) AS n_rows, count(*) FILTER (WHERE hit) AS n_hits FROM r GROUP BY ROLLUP (part, file))
    SELECT part, file, n_rows, n_hits, n_hits / n_rows AS hit_share, CASE WHEN n_hits / n_rows >= 0.7 THEN 'OK' WHEN n_hits / n_rows >= 0.5 THEN 'WARN' ELSE 'LOW' END AS flag FROM c""")
def file_shares(spark, sf_dir):
    parts = [(n, relations.with_file(table(spark, sf_dir, n)).select("file", "text")) for n in ("documents", "conversations")]
    return relations.file_shares(parts, F.contains("text", F.lit("the")))


@query("""SELECT user_id::VARCHAR AS key, event_id AS ordinal, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS rn FROM events) WHERE rn = 1""")
def admitted_batches(spark, sf_dir):
    """Events by type, one batch each, every batch tried twice: each user is admitted once."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("ordinal"), "event_type")
    seen = state.StateTable(spark, _place(spark, "seen"), "key string, seq long")
    out = BatchTable(spark, _place(spark, "admitted"), "key string, ordinal long, event_type string")
    for number, kind in enumerate(sorted(r[0] for r in events.select("event_type").distinct().collect())):
        for _ in range(2):
            state.admit(events.filter(F.col("event_type") == kind), seen, "key", 10_000_000, lambda rows, n=number: out.write(rows, n), number)
    return out.read()


@query("""WITH d AS (SELECT l_orderkey AS k, l_linenumber AS n, l_linenumber * 100000000 + l_partkey * 10 + (l_returnflag = 'A')::INTEGER AS seq, CASE l_returnflag WHEN 'A' THEN 'approved' ELSE 'rejected' END AS s FROM lineitem WHERE l_returnflag <> 'N'),
    a AS (SELECT k, max_by(s, seq) AS s FROM d WHERE n <= 3 GROUP BY k), b AS (SELECT k, max_by(s, seq) AS s FROM d WHERE n > 3 GROUP BY k)
    SELECT o_orderkey AS id, coalesce(a.s, b.s, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 365 DAYS THEN 'rejected' ELSE 'pending' END) AS status
    FROM orders LEFT JOIN a ON a.k = o_orderkey LEFT JOIN b ON b.k = o_orderkey""")
def queue_log(spark, sf_dir):
    """All orders as a queue: two batches of decisions with a compaction between them, then ageing."""
    log = ReviewLog(spark, _place(spark, "queue"), "id long, created timestamp_ntz", "id")
    log.add(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created"), F.col("o_orderkey").alias("ordinal")), "orders")
    status = F.when(F.col("l_returnflag") == "A", "approved").otherwise("rejected")
    # a line's number may come twice in an order: equal numbers have one status
    seq = F.col("l_linenumber").cast("long") * 100_000_000 + F.col("l_partkey") * 10 + (F.col("l_returnflag") == "A").cast("int")
    said = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("id"), status.alias("status"), "l_linenumber", seq.alias("seq"))
    log.decide(said.filter("l_linenumber <= 3"), "first")
    log.compact()
    log.decide(said.filter("l_linenumber > 3"), "second")
    log.age_out(F.col("created"), F.expr("TIMESTAMP_NTZ '1999-01-01 00:00:00'"), 365, "ageing")
    return log.read().select("id", "status")


@query("""SELECT c_custkey::VARCHAR AS id, c_name AS name, c_acctbal AS balance, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey::VARCHAR, s_name, s_acctbal, 'supplier' FROM supplier
    UNION ALL SELECT p_partkey::VARCHAR, p_name, p_size::DOUBLE, 'part' FROM part""")
def evolved_table(spark, sf_dir):
    """Three tables as three generations of one: a column dropped, one added with a default, two widened."""
    kept = EvolvingTable(spark, _place(spark, "evolved"), {"id": "bigint", "name": "string", "balance": "double", "segment": "string"})
    kept.write(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")), "customers")
    kept.evolve(drop=["segment"], add={"kind": "string"}, defaults={"kind": "customer"})
    kept.write(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind")), "suppliers")
    kept.evolve(widen={"id": "string"})
    kept.write(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("balance"), F.lit("part").alias("kind")), "parts")
    return kept.read()


@query("""SELECT CASE role WHEN 'user' THEN 'item' WHEN 'system' THEN 'no url' ELSE 'not JSON' END AS outcome,
        CASE role WHEN 'user' THEN 'conv/' || conv_id || '/' || turn END AS url, md5(CASE role WHEN 'user' THEN text WHEN 'system' THEN 'x' ELSE replace(text, chr(10), ' ') END) AS hash, count(*) AS n
    FROM conversations GROUP BY ALL""")
def intake_records(spark, sf_dir):
    """Conversations as lines of a feed: users' turns are records, the system's lack an url, the others are no JSON at all."""
    c, path = F.col, _place(spark, "feed")
    line = F.when(c("role") == "user", F.to_json(F.struct(F.concat_ws("/", F.lit("conv"), "conv_id", "turn").alias("url"), c("text").alias("title"))))
    line = line.when(c("role") == "system", F.to_json(F.struct(c("text").alias("title")))).otherwise(F.replace("text", F.lit("\n"), F.lit(" ")))
    table(spark, sf_dir, "conversations").select(line.alias("value")).write.text(path)
    taken = BatchTable(spark, _place(spark, "items"), connectors.MATERIAL)
    aside = BatchTable(spark, _place(spark, "quarantine"), intake.QUARANTINE)
    failed = intake.take_in(spark, [intake.Feed("conversations", path)], taken, aside, _place(spark, "checkpoints"))
    if any(failed.values()):
        raise RuntimeError(str(failed))
    good = taken.read().select(F.lit("item").alias("outcome"), "url", F.md5("title").alias("hash"))
    bad = aside.read().select(F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("url"), F.md5(F.when(c("reason") == "no url", "x").otherwise(c("line"))).alias("hash"))
    return good.unionByName(bad).groupBy("outcome", "url", "hash").agg(F.count("*").alias("n"))


def _service(request: str, digest: str) -> str:
    """A stand-in for a scorer: heat by length, on the subject where a term occurs."""
    rows = [{"url": x["url"], "heat_score": len(x["content"]) % 101, "ai_relevance": "core" if any(t in x["content"] for t in TERMS) else "none"} for x in json.loads(request)]
    return "Scores:\n```json\n" + json.dumps(rows) + "\n```"


def _busy(request: str, digest: str) -> str:
    """One that fails for requests with a German term."""
    if "keit" in request:
        raise OSError("busy")
    return _service(request, digest)


def _scored(spark, sf_dir, call) -> DataFrame:
    said = {"title": "acme 新版本", "snippet": "s", "source": "feed", "category": "综合资讯"}
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ordinal"), F.concat(F.lit("https://feed.example/"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("content"), "lang")
    log = ReplyLog(spark, _place(spark, "replies"), call, attempts=2, wait=0.0)
    found = scoring_stage.asked(stage(rows.withColumns({k: F.lit(v) for k, v in said.items()}), "asked"), "lang", "ordinal", log, subject=TERMS)
    return found.select("ordinal", "heat_score", "ai_relevance", F.substring("score_reason", 1, 40).alias("reason"))


_RULE = "CASE WHEN contains(lower(text), 'cve') OR contains(lower(text), 'breaking change') THEN 8.0 ELSE 0.0 END"


@query(f"""WITH s AS (SELECT doc_id AS ordinal, substr(text, 1, 800) AS c, {_RULE} AS rule FROM documents),
    n AS (SELECT *, contains(c, 'thon') OR contains(c, 'eau') OR contains(c, 'keit') OR contains(c, 'ción') AS near FROM s)
    SELECT ordinal, CASE WHEN near THEN greatest((length(c) % 101)::DOUBLE, rule)::DOUBLE ELSE 0.0::DOUBLE END AS heat_score, CASE WHEN near THEN 'core' ELSE 'none' END AS ai_relevance,
        CASE WHEN near THEN 'relevance=core/other | heat_ai=F' ELSE 'ai_relevance 判定非 AI 主题' END AS reason FROM n""")
def scoring_asked(spark, sf_dir):
    """All documents scored by a service that the tasks call, each request of at most 40 items once."""
    return _scored(spark, sf_dir, _service)


@query(f"""SELECT doc_id AS ordinal, CASE WHEN regexp_matches(lower(text), 'thon|eau|keit|ción') THEN greatest(50.0, {_RULE}) ELSE 0.0 END::DOUBLE AS heat_score, 'none' AS ai_relevance,
        substr('LLM 调用失败，使用规则分: OSError: busy', 1, 40) AS reason FROM documents""")
def scoring_failed(spark, sf_dir):
    """Some requests fail to the end, so every item takes the rules' score."""
    return _scored(spark, sf_dir, _busy)
