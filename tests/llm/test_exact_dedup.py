import random

import pytest

from feedloom.llm import exact_dedup

ROWS = "doc_id long, text string, lang string, digest int, kept string"


def test_edges(spark):
    rows = [(1, "a", "en", 0, "x"), (5, "a", "en", 0, "x"), (2, None, None, None, None), (3, "", "en", 1, "y"), (None, "a", "en", 0, "z"), (7, "b" * 200_000, "en", 0, ""), (8, "b", "de", 2, "")]
    docs = spark.createDataFrame(rows, ROWS)
    index = exact_dedup.new_index(spark)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.dedup_batch(docs, index).collect()}
    assert got == {1: (5, 3, False), 5: (5, 3, True), None: (5, 3, False), 2: (3, 2, False), 3: (3, 2, True), 7: (7, 1, True), 8: (8, 1, True)}


def test_index_persists_between_batches(spark):
    index = exact_dedup.new_index(spark)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert all(r["kept"] for r in exact_dedup.dedup_batch(first, index).collect())
    index.close()
    again = exact_dedup.DigestIndex(spark, index.location)  # as a later session opens it
    second = spark.createDataFrame([(9, "b"), (10, "c"), (11, "c")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.dedup_batch(second, again).collect()}
    assert got == {9: (2, False), 10: (11, False), 11: (11, True)}
    assert sorted(r["keep_id"] for r in index.read().collect()) == [1, 2, 11]


def test_documents_keep_columns_and_repeated_rows_come_once(spark):
    docs = spark.createDataFrame([(1, "a", "en", 0, "x"), (4, "a", "fr", 0, "q"), (4, "a", "fr", 0, "q"), (6, "b", None, None, None)], ROWS)
    got = exact_dedup.distinct_documents(docs, exact_dedup.new_index(spark))
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(4, "a", "fr", 0, "q"), (6, "b", None, None, None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], ROWS)
    assert exact_dedup.dedup_batch(docs, exact_dedup.new_index(spark)).count() == 0
    assert exact_dedup.distinct_documents(docs, exact_dedup.new_index(spark)).count() == 0


def test_a_batch_runs_again_with_the_same_rows(spark):
    """As after a driver lost between the append and the caller's write."""
    index = exact_dedup.new_index(spark)
    exact_dedup.dedup_batch(spark.createDataFrame([(1, "a")], "doc_id long, text string"), index, batch="one").collect()
    second = spark.createDataFrame([(5, "a"), (6, "b"), (7, "b"), (None, "c")], "doc_id long, text string")
    runs = [sorted(map(tuple, exact_dedup.dedup_batch(second, index, batch="two").collect()), key=str) for _ in range(2)]
    assert runs[0] == runs[1] and sum(r[4] for r in runs[0]) == 2
    assert index.read().count() == 3
    assert not any(r["kept"] for r in exact_dedup.dedup_batch(second, index, batch="three").collect())
    kept = [sorted(map(tuple, exact_dedup.distinct_documents(second, index, batch="two").collect()), key=str) for _ in range(2)]
    assert kept[0] == kept[1] == [(7, "b"), (None, "c")]


def test_compaction_keeps_entries_and_sizes_buckets(spark):
    index = exact_dedup.new_index(spark)
    for i in range(3):
        exact_dedup.dedup_batch(spark.createDataFrame([(i, f"t{i}"), (9, "same")], "doc_id long, text string"), index).collect()
    small = index.compact(index.location + "-2")
    assert sorted(map(tuple, small.read().collect())) == sorted(map(tuple, index.read().collect()))
    index.close()
    assert not exact_dedup.dedup_batch(spark.createDataFrame([(4, "t1")], "doc_id long, text string"), small).collect()[0]["kept"]
    assert [exact_dedup.buckets_for(n) for n in (0, 40_000_000, 10**10)] == [16, 32, 8192]


def test_columns_with_the_operators_own_names_stay(spark):
    docs = spark.createDataFrame([(1, "a", 5, "x", 7), (2, "a", 6, "y", 8)], "doc_id long, text string, _f_id int, _f0_digest string, fresh int")
    got = exact_dedup.distinct_documents(docs, exact_dedup.new_index(spark))
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(2, "a", 6, "y", 8)]


def test_reopened_index_knows_its_buckets(spark):
    """Opened by its location alone, after the tables have left the catalog, and in another session."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    index = exact_dedup.DigestIndex(spark, exact_dedup.new_index(spark).location + "-64", 64)
    assert exact_dedup.dedup_batch(docs, index).filter("kept").count() == 2000
    index.close()
    for session in (spark, spark.newSession()):
        again = exact_dedup.DigestIndex(session, index.location)
        assert again.buckets == 64
        same = session.range(2000).selectExpr("id + 5000 AS doc_id", "concat('text ', id) AS text")
        assert exact_dedup.dedup_batch(same, again).filter("kept").count() == 0
        again.close()
    with pytest.raises(ValueError, match="64 buckets, not 16"):
        exact_dedup.DigestIndex(spark, index.location, 16)


def test_runs_are_merged_and_joined_in_their_order(spark):
    """No run is sorted or shuffled for the merge join; runs stay few; every entry is found once."""
    index, seen = exact_dedup.new_index(spark), 0
    for n in (40, 10, 3, 1, 200):
        docs = spark.range(seen, seen + n).selectExpr("id AS doc_id", "concat('t', id) AS text")
        assert exact_dedup.dedup_batch(docs, index).filter("kept").count() == n
        seen += n
    assert index.read().count() == seen and len(index.runs()) == 1
    for n in (20, 2):
        exact_dedup.dedup_batch(spark.range(seen, seen + n).selectExpr("id AS doc_id", "concat('t', id) AS text"), index).count()
        seen += n
    assert len(index.runs()) == 3
    groups = exact_dedup.stage(spark.range(10).selectExpr("unhex(sha2(concat('t', id), 256)) AS digest"), "probe")
    with exact_dedup.ordered_buckets(spark):
        met = exact_dedup.met_index(groups, index)
        plan = met._jdf.queryExecution().sparkPlan().toString() + met._jdf.queryExecution().executedPlan().toString()
        assert met.filter("_batch IS NOT NULL").count() == 10
        final = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin") >= 3
    above = [line for line in final.splitlines() if "Exchange" in line or " Sort " in line]
    assert len([x for x in above if "Exchange" in x]) == 1 and len([x for x in above if " Sort " in x]) == 1, final


def test_batches_one_after_the_other_equal_plain_python(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abcdefgh") * rng.randint(0, 3)) for i in range(120)]
    batches = [rows[60:], rows[:30], rows[30:60]]
    index = exact_dedup.new_index(spark)
    frames = [spark.createDataFrame(b, "doc_id long, text string") for b in batches]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.dedup_in_batches(frames, index).collect()}
    keep = {}
    for b in batches:
        own = {}
        for i, t in b:
            own[t] = max(own.get(t, i), i)
        keep = own | keep
    texts = [t for _, t in rows]
    assert got == {i: (keep[t], texts.count(t), keep[t] == i) for i, t in rows}
