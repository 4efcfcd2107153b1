import random

import numpy as np
import pytest
import xxhash

from feedloom.llm import components, simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """{fingerprint: smallest linked fingerprint} by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprints():
    for t in [None, "", " \n\t", "One", "one two", "A b C d", "É é\x1fx y z w", "word " * 70_000, "x y z " * 3 + "q"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_same_hash_as_spark(spark):
    got = spark.sql("select xxhash64('a b c') h").first()["h"]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_anchors_cover_every_link():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    row, anchor, home = simhash.replicas(x)
    assert home.sum() == len(x)
    at = {int(r): int(a) for r, a, h in zip(row, anchor, home, strict=True) if h}
    for i in range(len(x)):
        for _ in range(4):
            a, b = (int(v) for v in rng.integers(0, 64, 2))
            y = x[i] ^ np.uint64(1 << a) ^ (np.uint64(0) if a == b else np.uint64(1 << b))
            assert at[i] in set(simhash.replicas(np.array([y]))[1].tolist())


@pytest.mark.parametrize("homes", [1, 128])
def test_links_give_the_same_components_as_all_pairs(spark, homes):
    rng = random.Random(3)
    fps = {0, 2**64 - 1}
    for _ in range(12):  # chains and dense clusters
        f = rng.getrandbits(64)
        for _ in range(25):
            fps.add(f)
            f ^= sum({1 << rng.randrange(64) for _ in range(rng.choice([1, 2, 2, 3]))})
    center = rng.getrandbits(64)
    fps |= {center ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["node"]: r["root"] for r in components.connected_components(simhash.links(df, homes)).collect()}
    want = plain_components(signed)
    assert {f: got.get(f, f) for f in signed} == want


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(4, base, "x"), (9, base, None), (2, base.replace("word7 ", "word8 "), "x"), (30, None, None), (31, " ", "x"), (40, "quite other words here", "x"), (None, base, "x"), (40, "quite other words here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    fp = {t: simhash.fingerprint(t) for _, t, _ in rows}
    roots = plain_components(fp.values())
    low = {}
    for i, t, _ in rows:
        low[roots[fp[t]]] = min(low.get(roots[fp[t]], 10**9), i if i is not None else 10**9)
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in got), key=str) == sorted(((i is None, i, low[roots[fp[t]]]) for i, t, _ in rows), key=str)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(low.values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    lonely = spark.createDataFrame([(None, "a b c", "x")], docs.schema)
    assert [r["component_id"] for r in simhash.near_duplicates(lonely).collect()] == [None]


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
