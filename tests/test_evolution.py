"""Tables whose columns change, shares by file, metrics of streams."""

import pytest
from pyspark.sql import functions as F

from feedloom.operators import relations
from feedloom.operators.evolution import EvolvingTable
from feedloom.streaming import metrics


def test_three_generations_read_as_one(spark, tmp_path):
    table = EvolvingTable(spark, f"{tmp_path}/t", {"id": "int", "old": "string", "score": "int"})
    assert table.write(spark.createDataFrame([(1, "x", 5)], "id int, old string, score int"), 0)
    assert table.evolve(add={"status": "string"}, widen={"score": "long"}, defaults={"status": "new"}) and not table.evolve(add={"status": "string"}, drop=["gone"])
    table.write(spark.createDataFrame([(2, "y", 2**40, "ok")], "id int, old string, score long, status string"), 1)
    assert table.evolve(drop=["old"], widen={"score": "double", "id": "string"}, add={"tags": "array<string>"})
    table.write(spark.createDataFrame([("3", 0.5)], "id string, score double"), 2)
    want = [("1", 5.0, "new", None), ("2", float(2**40), "ok", None), ("3", 0.5, "new", None)]
    again = EvolvingTable(spark, f"{tmp_path}/t")
    assert list(again.columns.items()) == [("id", "string"), ("score", "double"), ("status", "string"), ("tags", "array<string>")]
    assert sorted(tuple(r) for r in again.read().collect()) == want and again.read().columns == list(again.columns)
    assert not again.write(spark.createDataFrame([("9", 9.0)], "id string, score double"), 0), "a batch of an older generation is known"


def test_a_column_added_again_is_another_one(spark, tmp_path):
    table = EvolvingTable(spark, f"{tmp_path}/t", {"id": "int", "note": "string"})
    table.write(spark.createDataFrame([(1, "secret")], "id int, note string"), 0)
    table.evolve(drop=["note"])
    table.evolve(add={"note": "int"}, defaults={"note": 7})
    assert [tuple(r) for r in table.read().collect()] == [(1, 7)]


def test_what_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="name its columns"):
        EvolvingTable(spark, f"{tmp_path}/none")
    table = EvolvingTable(spark, f"{tmp_path}/t", {"id": "bigint"})
    with pytest.raises(ValueError, match="does not hold"):
        table.evolve(widen={"id": "int"})
    with pytest.raises(ValueError, match="no extra"):
        table.write(spark.range(1).withColumn("extra", F.lit(1)), 0)
    assert table.read().count() == 0


def test_a_read_prunes_columns_of_every_generation(spark, tmp_path):
    table = EvolvingTable(spark, f"{tmp_path}/t", {"id": "int", "body": "string"})
    table.write(spark.createDataFrame([(1, "x")], "id int, body string"), 0)
    table.evolve(add={"n": "int"})
    table.write(spark.createDataFrame([(2, "x", 1)], "id int, body string, n int"), 1)
    plan = table.read().select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<id:int>") == 2


def test_shares_by_file(spark, tmp_path):
    for name, n in (("a", 6), ("b", 4)):
        for i in range(2):
            spark.range(n * i, n * i + n).selectExpr("id", "id % 2 = 0 AS hit").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    parts = [(x, relations.with_file(spark.read.parquet(f"{tmp_path}/{x}"))) for x in "ab"]
    got = relations.file_shares(parts, F.col("hit")).collect()
    assert len(got) == 4 + 2 + 1
    assert {(r["part"], r["n_rows"], r["n_hits"]) for r in got if r["file"] is None} == {("a", 12, 6), ("b", 8, 4), (None, 20, 10)}
    assert all(r["flag"] == "WARN" and r["file"].endswith(".parquet") for r in got if r["file"])
    spark.range(0).selectExpr("id", "id = 0 AS hit").write.parquet(f"{tmp_path}/c")
    assert relations.file_shares([("c", relations.with_file(spark.read.schema("id long, hit boolean").parquet(f"{tmp_path}/c")))], F.col("hit")).count() <= 1


def test_a_table_of_part_files_is_one_file(spark, tmp_path):
    """As one file, as a folder of several, and as one with partitions."""
    rows = spark.range(12).selectExpr("id", "id % 3 AS day")
    rows.repartition(4).write.parquet(f"{tmp_path}/in.v2/many.parquet")
    rows.write.partitionBy("day").parquet(f"{tmp_path}/in.v2/days.parquet")
    for name in ("many", "days"):
        read = relations.with_file(spark.read.parquet(f"{tmp_path}/in.v2/{name}.parquet"))
        assert [tuple(r) for r in read.groupBy("file").count().collect()] == [(f"{name}.parquet", 12)]
    rows.coalesce(1).write.parquet(f"{tmp_path}/in.v2/plain")
    assert relations.with_file(spark.read.parquet(f"{tmp_path}/in.v2/plain")).filter("file like 'part-%.parquet'").count() == 12


def test_file_shares_of_tables_in_part_files(spark, tables, duck, same_rows, tmp_path):
    from feedloom.plans import catalog, table_queries  # noqa: F401 - registers its queries

    for name in ("documents", "conversations"):
        spark.read.parquet(f"{tables}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    same_rows(catalog.QUERIES["file_shares"](spark, str(tmp_path)), duck, catalog.SQL["file_shares"])


def test_stream_metrics(spark, tmp_path):
    found = metrics.listen(spark)
    try:
        for i in range(2):
            spark.range(5 * i, 5 * i + 5).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        counted = metrics.observed(rows, "taken", n_rows=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
        counted.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        for _ in range(50):
            if found.total("taken", "n_rows") == 10:
                break
            import time

            time.sleep(0.2)
        assert found.total("taken", "n_rows") == 10 and found.total("taken", "even") == 5
    finally:
        spark.streams.removeListener(found)
