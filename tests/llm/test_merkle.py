import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_proof(nodes, at):
    """Siblings on each level as (before, after), and the root."""
    proof = []
    while len(nodes) > 1:
        first = at - at % 8
        run = nodes[first : first + 8]
        proof.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at //= 8
    return proof, nodes[0]


def plain(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    low = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    leaves = {}
    for lang in order:
        hashed = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), r) for r in langs[lang]) if len({r["doc_id"] for r in langs[lang]}) == len(langs[lang]) else sorted((((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), r) for r in langs[lang]), key=lambda x: x[0])
        leaves[lang] = [(key[2], r) for key, r in hashed]
    subroots = [plain_proof([x for x, _ in leaves[lang]], 0)[1] for lang in order]
    out = []
    for k, lang in enumerate(order):
        up, root = plain_proof(subroots, k)
        nodes = [x for x, _ in leaves[lang]]
        for i, (own, r) in enumerate(leaves[lang]):
            proof = plain_proof(nodes, i)[0] + up
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(low.get(c, c) for c in text)
            node = leaf(r, text)
            for before, after in proof:
                node = h(before, node, after)
            out.append((r["doc_id"], own, subroots[k], root, h(*[b + a for b, a in proof]), node, node == root))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def check(spark, rows):
    got = [tuple(r[c] for c in COLUMNS) for r in merkle.check(spark.createDataFrame(rows, SCHEMA)).collect()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(got, key=key) == sorted(plain([dict(zip(names, r, strict=True)) for r in rows]), key=key)
    return got


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513, 1500])
def test_heights(spark, n):
    """Run ends, subtree ends and what lies past them; a small language beside the large one."""
    check(spark, [(i, f"Text {i}", "en", "s", i) for i in range(n)] + [(n + 1, "Eins", "de", None, 4)] * (n % 2))


def test_defined_cases(spark):
    rows = [(3, "ABC", None, None, None), (None, "AB", "en", "s", 2), (None, "AC", "en", "s", 2), (5, None, "en", "ü", -7), (0, "", "fr", "", 0), (0, "x", "fr", "", 0)]
    rows += [(7, "Same", "de", "s", 4)] * 3 + [(i, "Ä " * i, "é", "s", i) for i in range(20)] + [(90, "Long " * 40_000, "zz", "s", 200_000)]
    got = check(spark, rows)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_single_document_and_no_rows(spark):
    (row,) = check(spark, [(1, "x", "en", "s", 1)])
    assert row[1] == row[2] == row[3] and row[4] == h("")
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.check(empty).collect() == []
    assert merkle.build(empty.select("lang", "doc_id", F.lit("").alias("node"))).root.collect() == []


def test_columns_that_a_leaf_does_not_name(spark):
    docs = spark.createDataFrame([(i, "T", "en", "s", 1) for i in range(12)], SCHEMA)
    more = docs.withColumns({c: F.lit(1) for c in ("node", "later", "place", "size", "block", "root", "proof", "_at")})
    assert sorted(merkle.check(docs).collect()) == sorted(merkle.check(more).collect())


def test_only_checkpointed_levels_are_stored(spark):
    leaves = spark.range(5000).select(F.lit("en").alias("lang"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    m = merkle.build(leaves)
    assert [s.selectExpr("sum(size(nodes))").first()[0] for s in m.langs.stored] == [5000, 10]
    assert max(r[0] for r in m.langs.stored[0].selectExpr("size(nodes)").collect()) == merkle.SUBTREE
    some = merkle.proofs(m).filter("doc_id in (0, 511, 512, 4999)").withColumn("folded", merkle.fold(F.col("node"), F.col("proof"))).collect()
    assert len(some) == 4 and all(r["folded"] == r["root"] for r in some)
    # a sibling that is changed shows as well
    bad = merkle.proofs(m).filter("doc_id = 7").withColumn("p", F.transform("proof", lambda s: F.struct(F.concat(s["before"], F.lit("0")).alias("before"), s["after"].alias("after"))))
    assert bad.select((merkle.fold(F.col("node"), F.col("p")) == F.col("root")).alias("ok")).first()["ok"] is False


def test_order_of_rows_and_partitions_does_not_matter(spark):
    docs = spark.createDataFrame([(i, f"T{i}", "en" if i % 3 else "de", "s", 1) for i in range(700)], SCHEMA)
    assert sorted(merkle.check(docs.orderBy(F.desc("doc_id")).coalesce(1)).collect()) == sorted(merkle.check(docs.repartition(7)).collect())
