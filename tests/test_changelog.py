"""The queue as a log of changes against the rules over whole tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.streaming import state
from feedloom.streaming.changelog import ReviewLog

SCHEMA = "id string, title string, created timestamp"
NOW = datetime(2026, 1, 10)


def items(spark, ids, seed=0):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, f"t{n}", NOW - timedelta(days=rng.randrange(20)), n) for n, i in enumerate(ids)], SCHEMA + ", ordinal long")


def decisions(spark, *of):
    return spark.createDataFrame([(i, s, n) for n, (i, s) in enumerate(of)], "id string, status string, seq long")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_log_equals_the_rules_over_whole_tables(spark, tmp_path):
    """Items, decisions, ageing and compaction in turn, each batch replayed."""
    log = ReviewLog(spark, f"{tmp_path}/q", SCHEMA, buckets=4)
    queue = spark.createDataFrame([], SCHEMA + ", status string")
    rng = random.Random(2)
    for n in range(6):
        new = items(spark, [f"k{rng.randrange(40)}" for _ in range(12)], n)
        queue = state.stage(state.enqueue(queue, new, "id"), "queue")
        assert log.add(new, f"add-{n}") and not log.add(new, f"add-{n}")
        some = decisions(spark, *[(f"k{rng.randrange(45)}", rng.choice(["approved", "rejected"])) for _ in range(8)])
        queue = state.stage(state.decide(queue, some, "id"), "queue")
        assert log.decide(some, f"decide-{n}") and not log.decide(some, f"decide-{n}")
        if n == 3:
            queue = state.stage(state.age_out(queue, F.col("created"), F.lit(NOW), 7), "queue")
            assert log.age_out(F.col("created"), F.lit(NOW), 7, "age-3")
        before = rows(log.read())
        assert before == rows(queue)
        if n in (1, 4):
            log.compact()
            assert rows(log.read()) == before
    again = ReviewLog(spark, f"{tmp_path}/q", SCHEMA, buckets=32)  # another wish counts for an own new queue alone
    assert rows(again.read()) == rows(queue)
    log.compact(8)
    assert rows(again.read()) == rows(queue)


def test_ten_decisions_write_ten_rows(spark, tmp_path):
    log = ReviewLog(spark, f"{tmp_path}/q", SCHEMA)
    log.add(items(spark, [f"k{i}" for i in range(2000)]), 0)
    log.compact()
    log.decide(decisions(spark, *[(f"k{i}", "approved") for i in range(10)], ("unheard of", "approved")), 1)
    assert log.changes.read(lambda n: n.endswith("1")).count() == 10
    assert log.read().filter("status = 'approved'").count() == 10 and log.read().count() == 2000
    log.decide(decisions(spark, ("k0", "rejected"), ("k10", "rejected")), 2)
    assert log.changes.read(lambda n: n.endswith("2")).count() == 1


def test_the_base_is_not_shuffled(spark, tmp_path):
    log = ReviewLog(spark, f"{tmp_path}/q", SCHEMA, buckets=4)
    log.add(items(spark, [f"k{i}" for i in range(100)]), 0)
    log.compact()
    log.decide(decisions(spark, ("k1", "approved")), 1)
    plan = log.read()._jdf.queryExecution().executedPlan().toString()
    base = [x for x in plan.splitlines() if "feedloom_queue_" in x]
    assert len(base) == 1 and "Exchange" not in plan[: plan.index(base[0])].split("BroadcastExchange")[0]


def test_a_batch_that_fails_is_not_there(spark, tmp_path):
    log = ReviewLog(spark, f"{tmp_path}/q", SCHEMA)
    bad = items(spark, ["a"]).withColumn("title", F.raise_error(F.lit("down")).cast("string"))
    with pytest.raises(Exception, match="down"):
        log.add(bad, 0)
    assert log.read().count() == 0 and log.add(items(spark, ["a"]), 0) and log.read().count() == 1
