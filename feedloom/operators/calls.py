"""Calls of an external service from the tasks, each asked once.

A request is a text, its digest is its name.  Requests that were answered
before are joined from the reply log; the others are dealt over tasks, which
call the service with retries and back-off.  A reply is written under its
digest in the shared folder the moment it comes, before the task goes on, so a
task that runs again reads what it has and asks only for the rest.  A run that
is through moves its replies into the log, one table, and the loose ones go.

A request that fails to the end has ``error`` and no reply; it is not logged,
so the next run asks for it again.  Between a service's answer and the few
milliseconds until it is written nothing can be known; pass the digest on as
an idempotency key where the service takes one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.drafts import reply_array
from feedloom.operators import items, relations
from feedloom.operators.batches import BatchTable
from feedloom.operators.staging import stage

#: Takes a request and its digest; gives the reply or raises.
Call = Callable[[str, str], str]
SETTLED = "digest string, reply string"
#: Requests that a task's Python holds at a time; a request may be tens of kilobytes, and a call takes longer than a hand-over.
AT_ONCE = 64


class Loose:
    """Replies by digest in a folder that all tasks reach."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.fs, self.folder = fs.FileSystem.from_uri(folder)

    def get(self, digest: str) -> str | None:
        try:
            with self.fs.open_input_stream(f"{self.folder}/{digest[:2]}/{digest}") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def put(self, digest: str, reply: str) -> None:
        """Whole or not at all."""
        self.fs.create_dir(f"{self.folder}/{digest[:2]}")
        draft = f"{self.folder}/{digest[:2]}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(reply).encode())
        self.fs.move(draft, f"{self.folder}/{digest[:2]}/{digest}")


def with_retries(call: Call, request: str, digest: str, attempts: int, wait: float, pause: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """``reply, error``: further tries after ``wait``, twice it, four times it and so on."""
    for i in range(attempts):
        try:
            return call(request, digest), None
        except Exception as cause:  # noqa: BLE001 - any failure of the service counts
            error = f"{type(cause).__name__}: {cause}"
            if i < attempts - 1:
                pause(wait * 2**i)
    return None, error


@contextmanager
def _batches_of(spark: SparkSession, n: int) -> Iterator[None]:
    """What runs in here hands Python at most ``n`` rows at a time, however many a task has."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(n, int(before)) if int(before) > 0 else n)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class ReplyLog:
    """The replies of one service at ``path``, which all tasks reach; ``call`` travels with the tasks."""

    def __init__(self, spark: SparkSession, path: str, call: Call, attempts: int = 3, wait: float = 1.0, parallel: int = 8):
        self.path = path.rstrip("/") if "://" in path else "file://" + path.rstrip("/")
        self.settled = BatchTable(spark, f"{self.path}/settled", SETTLED)
        self.call, self.attempts, self.wait, self.parallel = call, attempts, wait, parallel

    def ask(self, requests: DataFrame) -> DataFrame:
        """``requests`` (a column ``request``) with ``reply, error``; equal requests share a reply."""
        rows = stage(requests.withColumn("_digest", F.sha2("request", 256)), "requests")
        known = self.settled.read()
        todo = rows.filter("request is not null").groupBy(F.col("_digest").alias("digest")).agg(F.first("request").alias("request")).join(known, "digest", "left_anti")
        call, attempts, wait, folder = self.call, self.attempts, self.wait, f"{self.path}/loose"

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            loose = Loose(folder)
            for b in batches:
                told = []
                for digest, request in zip(b["digest"], b["request"], strict=True):
                    reply, error = loose.get(digest), None
                    if reply is None:
                        reply, error = with_retries(call, request, digest, attempts, wait)
                        if reply is not None:
                            loose.put(digest, reply)
                    told.append((digest, reply, error))
                yield pd.DataFrame(told, columns=["digest", "reply", "error"]).astype(object)

        with _batches_of(rows.sparkSession, AT_ONCE):
            new = stage(todo.repartition(self.parallel).mapInPandas(run, "digest string, reply string, error string"), "replies")
        got = new.filter("reply is not null").select("digest", "reply")
        if got.limit(1).count():
            self.settled.write(got, uuid.uuid4().hex)
        self.settled.files.remove(folder)
        replies = known.withColumn("error", F.lit(None).cast("string")).unionByName(new).withColumnRenamed("digest", "_digest")
        return rows.join(replies, "_digest", "left").drop("_digest")


def answerer(log: ReplyLog, columns: list[str], limits: dict[str, int], sizes: dict[str, int] | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """The ``answer`` of ``generation.generate``: ``url, turn, data`` of the items' replies.

    A request is ``{"task", "items"}`` with at most ``sizes[task]`` items, one
    where the task is not named, by the whole number ``ordinal``.
    """
    sizes = sizes or {"batch": 8}

    def answer(rows: DataFrame, task: str) -> DataFrame:
        asked = stage(items.payload_json(rows, [c for c in [*columns, "verdict"] if c in rows.columns], limits).withColumn("_all", F.lit(0)), "asked")
        n = sizes.get(task, 1)
        placed = relations.numbered(asked, "_all", "ordinal")
        together = placed.groupBy(F.floor(F.col("_rn") / n).alias("turn")).agg(F.sort_array(F.collect_list(F.struct("_rn", "payload"))).alias("found"))  # at most n items
        body = F.concat(F.lit(f'{{"task": "{task}", "items": ['), F.array_join(F.transform("found", lambda x: x["payload"]), ","), F.lit("]}"))
        told = log.ask(together.select("turn", body.alias("request")))
        each = told.filter("reply is not null").select("turn", F.posexplode(reply_array(F.col("reply"))).alias("at", "data"))
        turn = (F.col("turn") * 1000 + F.col("at")).cast("int")
        return each.select(F.get_json_object("data", "$.url").alias("url"), turn.alias("turn"), "data")

    return answer
