"""Tables of batches that are written again, state under a batch's number, streams that are killed."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators import batches, sinks
from feedloom.streaming import keyed, state

SCHEMA = "url string, ordinal long"


def rows(spark, *urls):
    return spark.createDataFrame([(u, i) for i, u in enumerate(urls)], SCHEMA)


def urls(df):
    return sorted(r["url"] for r in df.collect())


def test_a_batch_is_written_once(spark, tmp_path):
    table = batches.BatchTable(spark, f"{tmp_path}/t", SCHEMA)
    assert table.read().count() == 0
    assert table.write(rows(spark, "a", "b"), 0) and table.write(rows(spark, "c"), 1)
    assert not table.write(rows(spark, "a", "b"), 0) and urls(table.read()) == ["a", "b", "c"]
    assert urls(table.read(lambda n: n.endswith("1"))) == ["c"]


def test_a_half_written_batch_is_invisible(spark, tmp_path):
    table = batches.BatchTable(spark, f"{tmp_path}/t", SCHEMA)
    table.write(rows(spark, "a"), "x")
    rows(spark, "lost").write.parquet(f"{tmp_path}/t/data/y-half")
    bad = rows(spark, "b").withColumn("url", F.raise_error(F.lit("down")).cast("string"))
    with pytest.raises(Exception, match="down"):
        table.write(bad, "y")
    assert urls(table.read()) == ["a"] and table.batches() == ["x"]
    assert table.write(rows(spark, "b"), "y") and urls(table.read()) == ["a", "b"]


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    one, two = (batches.BatchTable(spark, f"{tmp_path}/t", SCHEMA) for _ in range(2))
    monkeypatch.setattr(two, "holds", lambda batch: False)  # it looked before the other published
    assert one.write(rows(spark, "a"), 7) and not two.write(rows(spark, "a"), 7)
    assert urls(one.read()) == ["a"] and len(one.files.names(f"{tmp_path}/t/data")) == 1


def test_compaction_changes_no_row_and_forgets_no_name(spark, tmp_path):
    table = batches.BatchTable(spark, f"{tmp_path}/t", SCHEMA)
    for i, u in enumerate("abc"):
        table.write(rows(spark, u), i)
    table.compact(1)
    table.write(rows(spark, "d"), 3)
    assert urls(table.read()) == ["a", "b", "c", "d"] and not table.write(rows(spark, "a"), 0)
    table.compact()
    assert urls(table.read()) == ["a", "b", "c", "d"] and len(table.files.names(f"{tmp_path}/t/data")) == 1


def test_admission_that_fails_anywhere_gives_each_key_once(spark, tmp_path):
    """Killed before the sink, after the sink and after the state, each batch is run again under its number."""
    seen = state.StateTable(spark, f"{tmp_path}/seen", "url string, seq long")
    out = batches.BatchTable(spark, f"{tmp_path}/out", SCHEMA)

    def fail(_):
        raise OSError("killed")

    feed = [("a", "b", "a", ""), ("b", "c", "d"), ("d", "e", "a")]
    for number, batch in enumerate(feed):
        with pytest.raises(OSError):
            state.admit(rows(spark, *batch), seen, "url", 3, fail, number)
        with pytest.raises(OSError):
            state.admit(rows(spark, *batch), seen, "url", 3, lambda r, n=number: (out.write(r, n), fail(r)), number)
        for _ in range(3):
            state.admit(rows(spark, *batch), seen, "url", 3, lambda r, n=number: out.write(r, n), number)
    # of three keys a goes out of the history, so it comes again
    assert urls(out.read()) == ["a", "a", "b", "c", "d", "e"]
    assert urls(seen.read()) == ["a", "d", "e"] and len(seen._versions()) == 2


def test_guarded_sink_replayed(spark, tmp_path):
    table = batches.BatchTable(spark, f"{tmp_path}/t", SCHEMA)
    log, broken = [], [True]

    def remember(batch, number):
        if broken:
            broken.pop()
            raise OSError("down")
        log.append(number)

    run = sinks.guarded(table.write, True, remember)
    with pytest.raises(OSError):
        run(rows(spark, "a"), 0)
    assert run(rows(spark, "a"), 0) == "replayed" and run(rows(spark, "b"), 1) == "written"
    assert log == [0, 1] and urls(table.read()) == ["a", "b"]


LOG = "key string, ordinal long, at timestamp"


def feed(spark, path, *of):
    spark.createDataFrame([(k, o, datetime(2026, 1, *at)) for k, o, at in of], LOG).coalesce(1).write.mode("append").parquet(path)


def read(spark, path):
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(path)


def run(df, at, out=None, each=None):
    writer = df.writeStream.option("checkpointLocation", f"{at}/cp").trigger(availableNow=True)
    (writer.foreachBatch(each) if each else writer.format("parquet").option("path", out)).start().awaitTermination()


@pytest.fixture
def store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    keyed.use_store(spark)
    yield
    spark.conf.set(name, before)


def test_keys_in_the_state_store_survive_kills(spark, tmp_path, store):
    """The sink fails before and after its commit in two different batches; the stream is started anew each time."""
    source, table, kills = f"{tmp_path}/in", batches.BatchTable(spark, f"{tmp_path}/out", LOG), {("before", 0), ("after", 1)}
    feed(spark, source, ("a", 1, (1, 0)), ("a", 0, (1, 1)), ("b", 2, (1, 1)), (None, 3, (1, 1)), ("", 4, (1, 1)))
    feed(spark, source, ("a", 5, (1, 5)), ("c", 6, (1, 6)), ("b", 7, (2, 1)))

    write = batches.each_batch(table)

    def each(batch, number):
        for when in ("before", "after"):
            if when == "after":
                write(batch, number)
            if (when, number) in kills:
                kills.discard((when, number))
                raise OSError("killed")

    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            run(keyed.admit(read(spark, source), "key"), tmp_path, each=each)
    run(keyed.admit(read(spark, source), "key"), tmp_path, each=each)
    feed(spark, source, ("c", 8, (3, 1)), ("d", 9, (3, 1)))
    run(keyed.admit(read(spark, source), "key"), tmp_path, each=each)
    assert not kills
    assert sorted((r["key"], r["ordinal"]) for r in table.read().collect()) == [("a", 0), ("b", 2), ("c", 6), ("d", 9)]


def test_keys_are_admitted_again_after_their_hours(spark, tmp_path, store):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    stream = lambda: keyed.admit(read(spark, source).withWatermark("at", "0 seconds"), "key", at="at", hours=24)
    feed(spark, source, ("a", 0, (1, 0)), ("a", 1, (1, 5)), ("b", 2, (1, 1)))
    feed(spark, source, ("b", 3, (2, 1)), ("a", 4, (2, 0, 0, 1)))
    run(stream(), tmp_path, out)
    feed(spark, source, ("a", 5, (6, 0)), ("z", 6, (9, 0)))
    run(stream(), tmp_path, out)
    assert sorted(r["ordinal"] for r in spark.read.parquet(out).collect()) == [0, 2, 4, 5, 6]
    with pytest.raises(ValueError, match="event time"):
        keyed.admit(read(spark, source), "key", hours=1)


def test_ageing_by_timers_equals_the_batch_rule(spark, tmp_path, store):
    """Rows turn to rejected as the watermark passes, without a row of their own."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def stream():
        log = read(spark, source).filter("key <> ''").select("key", F.when(F.col("ordinal") >= 100, F.when(F.col("ordinal") % 2 == 0, "approved").otherwise("rejected")).alias("decision"), "at", F.col("ordinal").alias("seq"))
        return keyed.age(log.withWatermark("at", "0 seconds"), days=3)

    feed(spark, source, ("a", 0, (1, 0)), ("b", 1, (1, 1)), ("c", 2, (1, 2)))
    feed(spark, source, ("b", 100, (2, 0)), ("b", 101, (2, 1)), ("x", 102, (2, 1)), ("d", 3, (3, 0)))
    run(stream(), tmp_path, out)
    now = {r["key"]: r["status"] for r in spark.read.parquet(out).groupBy("key").agg(F.max_by("status", F.struct("at", F.col("status") != "pending")).alias("status")).collect()}
    assert now == {"a": "pending", "b": "rejected", "c": "pending", "d": "pending"}
    feed(spark, source, ("e", 4, (5, 0)))
    feed(spark, source, ("a", 102, (5, 1)))
    run(stream(), tmp_path, out)
    changes = spark.read.parquet(out)
    got = {r["key"]: r["status"] for r in changes.groupBy("key").agg(F.max_by("status", F.struct("at", F.col("status") != "pending")).alias("status")).collect()}
    queue = spark.createDataFrame([(k, "pending", datetime(2026, 1, *at)) for k, at in (("a", (1, 0)), ("b", (1, 1)), ("c", (1, 2)), ("d", (3, 0)), ("e", (5, 0)))], "key string, status string, created timestamp")
    decided = state.decide(queue, spark.createDataFrame([("b", "approved", 100), ("b", "rejected", 101)], "key string, status string, seq long"), "key")
    aged = state.age_out(decided, F.col("created"), F.lit(datetime(2026, 1, 5, 1)), 3)
    assert got == {r["key"]: r["status"] for r in aged.collect()}
    assert changes.filter("key = 'a'").count() == 2
