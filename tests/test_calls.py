"""External calls from tasks: a counting stub sees each request once, whatever fails."""

import json
import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.functions.scoring import ONE
from feedloom.operators import calls
from feedloom.plans import generation, scoring_stage


def counting(path, answer, fails=None, stop_after=None):
    """A service that notes each call in a file; ``fails``: requests and how often they fail; ``stop_after``: the task dies then."""

    def call(request, digest):
        with open(path, "a") as f:
            f.write(digest + "\n")
        with open(path) as f:
            seen = Counter(f.read().split())
        if stop_after and os.path.exists(f"{path}.armed") and sum(seen.values()) > stop_after:
            os._exit(1)  # the worker is gone in the middle of its task
        if fails and seen[digest] <= fails.get(request, 0):
            raise OSError("busy")
        return answer(request)

    return call


def seen(path):
    with open(path) as f:
        return Counter(f.read().split())


def requests(spark, *texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "request string, n int")


def test_each_request_once_over_runs(spark, tmp_path):
    path = f"{tmp_path}/calls"
    log = calls.ReplyLog(spark, f"{tmp_path}/log", counting(path, str.upper), parallel=3)
    got = {(r["request"], r["n"]): (r["reply"], r["error"]) for r in log.ask(requests(spark, "a", "b", "a", None)).collect()}
    assert got == {("a", 0): ("A", None), ("b", 1): ("B", None), ("a", 2): ("A", None), (None, 3): (None, None)}
    assert {r["reply"] for r in log.ask(requests(spark, "b", "c")).collect()} == {"B", "C"}
    assert sorted(seen(path).values()) == [1, 1, 1]


def test_retries_and_failures(spark, tmp_path):
    path = f"{tmp_path}/calls"
    log = calls.ReplyLog(spark, f"{tmp_path}/log", counting(path, str.upper, {"twice": 2, "always": 99}), wait=0.01)
    got = {r["request"]: (r["reply"], r["error"]) for r in log.ask(requests(spark, "twice", "always", "once")).collect()}
    assert got == {"twice": ("TWICE", None), "always": (None, "OSError: busy"), "once": ("ONCE", None)}
    assert sorted(seen(path).values()) == [1, 3, 3]
    log.ask(requests(spark, "twice", "always", "once")).collect()
    assert sorted(seen(path).values()) == [1, 3, 6]


def test_a_task_that_dies_asks_for_the_rest_alone(spark, tmp_path):
    path = f"{tmp_path}/calls"
    texts = [f"request {i}" for i in range(20)]
    log = calls.ReplyLog(spark, f"{tmp_path}/log", counting(path, str.upper, stop_after=11), parallel=1)
    open(f"{path}.armed", "w").close()
    with pytest.raises(Exception):
        log.ask(requests(spark, *texts))
    assert sum(seen(path).values()) == 12
    os.remove(f"{path}.armed")
    assert sorted(r["reply"] for r in log.ask(requests(spark, *texts)).collect()) == sorted(t.upper() for t in texts)
    # the one that was under way when the worker died is the only one asked again
    assert len(seen(path)) == 20 and sorted(seen(path).values())[-2:] == [1, 2]


def test_a_task_holds_few_requests_at_a_time(spark, tmp_path, monkeypatch):
    """However many requests a task has, and the session's batches are as they were afterwards."""
    key, held, put = "spark.sql.execution.arrow.maxRecordsPerBatch", [], calls.stage
    before = spark.conf.get(key)

    def sizes(df, label):
        if label == "replies":
            rows = df.select("digest").mapInPandas(lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n long")
            held.extend(r["n"] for r in rows.collect())
        return put(df, label)

    monkeypatch.setattr(calls, "stage", sizes)
    log = calls.ReplyLog(spark, f"{tmp_path}/log", lambda request, digest: request.upper(), parallel=1)
    got = log.ask(spark.range(300).selectExpr("concat('request ', id) AS request")).collect()
    assert len(got) == 300 and all(r["reply"] == r["request"].upper() for r in got)
    assert sum(held) == 300 and max(held) <= 64
    assert spark.conf.get(key) == before


def test_pauses_double():
    waits = []

    def down(request, digest):
        raise OSError("down")

    assert calls.with_retries(down, "r", "d", 4, 0.5, waits.append) == (None, "OSError: down") and waits == [0.5, 1.0, 2.0]


def test_scoring_stage_asks_from_the_tasks(spark, tmp_path):
    path = f"{tmp_path}/calls"
    rows = spark.createDataFrame([(f"u{i}", "GPT", "", "", "feed", "综合资讯", i) for i in range(7)], "url string, title string, snippet string, content string, source string, category string, ordinal int").withColumn("day", F.lit("d"))
    answer = lambda request: json.dumps([{"url": x["url"], "heat_score": 71, "ai_relevance": "core"} for x in json.loads(request)])
    log = calls.ReplyLog(spark, f"{tmp_path}/log", counting(path, answer))
    for _ in range(2):
        assert {r["heat_score"] for r in scoring_stage.asked(rows, "day", "ordinal", log, 3).collect()} == {71.0}
    assert len(seen(path)) == 3 and set(seen(path).values()) == {1}
    # all or nothing: one request that fails puts every item on the rules
    broken = calls.ReplyLog(spark, f"{tmp_path}/other", counting(f"{tmp_path}/more", lambda r: 1 / 0 if "u6" in r else answer(r)), attempts=1)
    assert {r["score_reason"] for r in scoring_stage.asked(rows, "day", "ordinal", broken, 3).collect()} == {"LLM 调用失败，使用规则分: ZeroDivisionError: division by zero"}


def test_generation_asks_from_the_tasks(spark, tmp_path):
    path = f"{tmp_path}/calls"
    short = "acme 这次更新影响所有开发者\n风险在于权限变化，适合先看文档\n但别急着升级，机会仍在后面，先看清楚成本再决定"

    def service(request):
        asked = json.loads(request)
        some = [x for x in asked["items"] if asked["task"] != "batch" or x["url"] != "late"]
        return "Here you are:\n" + json.dumps([{"url": x["url"], "tweet_content": "x" if x["url"] == "bad" and asked["task"] == "batch" else short, "platform": ONE} for x in some], ensure_ascii=False)

    urls = ["a", "b", "late", "bad"]
    schema = "url string, title string, snippet string, content string, source string, category string, heat_score double, ordinal int, routed string, routed_reason string"
    picked = spark.createDataFrame([(u, "acme 新版本", "s", "c", "feed", "产品", 70.0, i, None, "r") for i, u in enumerate(urls)], schema)
    answer = calls.answerer(calls.ReplyLog(spark, f"{tmp_path}/log", counting(path, service)), ["url", "title", "content"], {"content": 100})
    keep = lambda df: calls.stage(df, "kept")
    for _ in range(2):
        out = generation.generate(picked, answer, keep, generation.DraftRules())
        assert {r["url"]: r["attempt"] for r in out.drafts.collect()} == {"a": 0, "b": 0, "late": 0, "bad": 1} and out.rejects.count() == 0
    assert len(seen(path)) == 3 and set(seen(path).values()) == {1}
