import hashlib
import math

from pyspark.sql import functions as F

from feedloom.llm import mixing

ROWS = "doc_id long, text string, source string, size int, rest string"


def plain_targets(sizes):
    """Share, cap, and share the excess anew until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            break
        left = budget - sum(2 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    return {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in order}


def plain_mix(rows):
    docs = []
    for i, t, s in rows:
        t = t or ""
        name = f"null:{hashlib.md5(t.encode()).hexdigest()}" if i is None else i
        h = hashlib.md5(f"mix-1:{name}".encode()).hexdigest()
        u = (int(h[:13], 16) + 0.5) / 2**52
        w = 1.0 / (1.0 + 20.0 * sum(c in "#*$%&|<>" for c in t) / (1 + len(t)))
        docs.append((i, s, len(t.split()), -math.log(u) / w))
    sizes = {}
    for _, s, n, _ in docs:
        sizes[s] = sizes.get(s, 0) + n
    goal, out = plain_targets(sizes), []
    for s in sizes:
        epochs = int(goal[s] // sizes[s]) if sizes[s] else 0
        rest = int(goal[s]) - epochs * sizes[s]
        for i, _, n, _ in sorted((d for d in docs if d[1] == s), key=lambda d: (d[3], d[0] is not None, d[0] or 0, d[2])):
            extra = max(0, min(n, rest))
            rest -= n
            out.append((i, n, sizes[s], round(goal[s], 6), epochs * n + extra))
    return sorted(out, key=str)


def rows_of(n=400):
    names = ["b", "a", "Z", "é", "", None, "tiny", "none"]
    rows = []
    for i in range(n):
        s = "b" if i % 3 == 0 else names[i % 6]
        rows.append((i, " ".join(f"w{j}" + "#" * (i % 4) for j in range(i * 7 % 60)), s))
    return [*rows, (9001, "just two", "tiny"), (9002, None, "none"), (9003, " \n", "none"), (None, "null id here", "a"), (9004, "x " * 50_000, "Z")]


def test_against_brute_force(spark):
    rows = rows_of()
    docs = spark.createDataFrame([(*r, 1, None) for r in rows], ROWS)
    got = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.mix_sizes(docs).collect()]
    assert sorted(got, key=str) == plain_mix(rows)


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    docs = spark.createDataFrame([(*r, 1, None) for r in rows_of()], ROWS)
    mixed = mixing.mix_sizes(docs)
    first = {tuple(r) for r in mixed.select("doc_id", "taken").collect()}
    assert first == {tuple(r) for r in mixing.mix_sizes(docs.repartition(3)).select("doc_id", "taken").collect()}
    for r in mixed.groupBy("source").agg({"taken": "sum", "target": "max", "size": "sum"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 1
    assert mixed.filter("taken > 2 * size").count() == 0


def test_heavier_documents_come_first(spark):
    """Ranks under the keys follow the weights: of two equal documents the one with three times the weight leads three times in four."""
    pairs = spark.range(4000).selectExpr("id as a", "id + 100000 as b", "'' as t")
    keyed = pairs.select(mixing.key("a", F.lit(3.0), text_col="t").alias("x"), mixing.key("b", F.lit(1.0), text_col="t").alias("y"))
    share = keyed.filter("x < y").count() / 4000
    assert abs(share - 0.75) < 0.03


def test_documents_are_repeated_and_the_last_is_cut(spark):
    rows = rows_of(60)
    docs = spark.createDataFrame([(*r, 1, None) for r in rows], ROWS)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len((r["text"] or "").split())
    taken = {i: t for i, _, _, _, t in plain_mix(rows) if t}
    assert {i: n for i, n in words.items() if n} == taken
    whole = {i: t for i, t, _ in rows}
    assert all(whole[r["doc_id"]].startswith(r["text"]) for r in out.collect() if r["text"])


def test_empty_table_and_one_source(spark):
    empty = spark.createDataFrame([], ROWS)
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    one = spark.createDataFrame([(1, "a b c d", "s", 0, "")], ROWS)
    assert [r["taken"] for r in mixing.mix_sizes(one).collect()] == [6]


def test_repeated_rows_and_equal_keys(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 0, "")] * 4 + [(2, "d", "s", 0, "")], ROWS)
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == 5 and sum(r["taken"] for r in got) == 19


def test_rows_without_id_draw_keys_of_their_own(spark):
    rows = [(None, f"text {i}", "a", 2, None) for i in range(200)] + [(None, None, "a", 2, None)]
    got = mixing.sized(spark.createDataFrame(rows, ROWS))
    assert got.select("key").distinct().count() == 201


def test_weights_of_any_scale_spread_over_the_buckets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'one two three' AS text", "'a' AS source")
    ends = []
    for w in (1e-6, 0.01, 1.0, 1e6):
        rows = mixing.sized(docs, weight=F.lit(w))
        one, two = mixing._buckets(F.col("key"))
        assert rows.groupBy(one, two).count().agg(F.max("count")).first()[0] <= 5
        mixed = mixing.mix(rows, mixing.plan(rows))
        ends.append(sorted(r.doc_id for r in mixed.filter("extra > 0").collect()))
        assert mixed.agg(F.sum("taken")).first()[0] == 90_000
    assert ends[0] == ends[1] == ends[2] == ends[3]
