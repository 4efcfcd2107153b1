"""Rules, the classifier and the licence scan."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedloom.llm import licences, qda, quality_rules


def plain_repeats(words, k=5):
    seen = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return len({j for i in range(len(words) - k + 1) if seen[tuple(words[i : i + k])] > 1 for j in range(i, i + k)})


def test_repeated_words():
    rng = random.Random(2)
    for size in (2, 3, 30, 6000):
        for _ in range(20):
            words = [str(rng.randrange(size)).encode() for _ in range(rng.randrange(0, 90))]
            words += words[3:14] if rng.random() < 0.5 else []
            assert quality_rules.repeated_words(words) == plain_repeats(words)
    long = [str(rng.randrange(20_000)).encode() for _ in range(50_000)]
    assert quality_rules.repeated_words(long + long[70:90]) == plain_repeats(long + long[70:90])


def test_counts():
    text = "a|b #é\n\na|b #é\n \na  \x0b c"
    counts, _ = quality_rules.measures(text)
    assert counts == [6, 12, 4, 1, 0]
    assert quality_rules.measures(None)[0] == [0, 0, 0, 0, 0]


def test_binomial_tail():
    from math import comb

    for n, p, k in ((20, 0.3, 2), (200, 0.05, 4), (50, 0.1, 0)):
        assert quality_rules.at_most(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def plain_cutoffs(rows, half, strata):
    """Paths and walks by loops over the rows: ``(id, stratum, good, {rule: value})``."""
    rules, grid, out = quality_rules.RULES, quality_rules.GRID, {}
    for stratum in strata:
        mine = [r for r in rows if r[1] == stratum]
        one, two = ([r for r in mine if half[r[0]] == h] for h in (0, 1))
        good, bad = [r for r in one if r[2]], [r for r in one if not r[2]]

        def lowest(rule, most):
            able = [c for c in grid[rule] if sum(r[3][rule] > c for r in good) <= most * len(good)]
            return min(able) if able else None

        def looser(rule, k):
            c = lowest(rule, 0.0)
            at = len(grid[rule]) if c is None else grid[rule].index(c) + k
            return grid[rule][at] if at < len(grid[rule]) else None

        gain = {r: sum(x[3][r] > looser(r, 2) for x in bad) if looser(r, 2) is not None else 0 for r in rules}
        order = sorted((r for r in rules if gain[r]), key=lambda r: (-gain[r], rules.index(r)))
        path = [{r: looser(r, 2) for r in order[: k + 1]} for k in range(len(order))]
        path += [{r: looser(r, k) for r in order} for k in (1, 0)] + [{r: lowest(r, e) for r in order} for e in quality_rules.LADDER]
        tested, chosen = [r for r in two if r[2]], {}
        for cuts in path if order else []:
            wrong = sum(any(c is not None and r[3][k] > c for k, c in cuts.items()) for r in tested)
            if quality_rules.at_most(wrong, len(tested), quality_rules.RISK) > quality_rules.DOUBT / len(strata):
                break
            chosen = cuts
        out[stratum] = [chosen.get(r) for r in rules]
    return out


def test_cutoffs_equal_plain_ones_and_hold_on_new_documents(spark):
    rng = random.Random(8)
    rules = quality_rules.RULES
    low = lambda r: {"long_words": rng.gauss(7, 0.3), "short_words": -rng.gauss(5, 0.2), "capital_share": abs(rng.gauss(0.03, 0.01))}.get(r, abs(rng.gauss(0, 0.004)))
    rows = []
    for i in range(6000):
        stratum, good = ("big", None, "small")[0 if i % 10 < 7 else 1 if i % 10 < 9 else 2 if i < 300 else 0], i % 3 > 0
        value = {r: low(r) for r in rules}
        if not good:
            value |= {"symbol_share": rng.uniform(0, 0.4), "adjacent_share": rng.uniform(0, 0.2)}
        rows.append((i, stratum, good, value))
    schema = "doc_id long, stratum string, good boolean, " + ", ".join(f"{r} double" for r in rules)
    df = spark.createDataFrame([(i, s, g, *v.values()) for i, s, g, v in rows], schema)
    half = {r[0]: r[1] for r in df.select("doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2))).collect()}
    got = {r["stratum"]: r["cutoffs"] for r in quality_rules.cutoffs(df).collect()}
    assert got == plain_cutoffs(rows, half, ["big", None, "small"])
    assert got["small"] == [None] * len(rules) and got["big"][0] is not None and got[None][0] is not None
    fresh = [{r: low(r) for r in rules} for _ in range(4000)]
    for s in ("big", None):
        assert sum(any(c is not None and v[r] > c for r, c in zip(rules, got[s], strict=True)) for v in fresh) <= quality_rules.RISK * len(fresh)


def test_rules_reject_and_leave_held_out_good_documents(spark):
    """At a size whose labels decide: rules reject, and good documents whose labels were not used stay."""
    from pathlib import Path

    where = Path("/root/testdata/sf0.01")
    if not where.exists():
        pytest.skip("no test tables")
    docs, marks = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.withColumn("lang", F.lit("all"))  # 399 labels suffice for one stratum only
    used = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) > 0
    rows = quality_rules.measured(docs)
    limits = quality_rules.cutoffs(quality_rules.marked_rows(rows, marks.filter(used)))
    got = quality_rules.verdicts(rows, limits)
    assert got.filter("not base_failed and not kept").count() > 0
    held = got.join(marks.filter(~used & (F.col("quality") == 1)), "doc_id").select(F.size("failed_rules").alias("n")).collect()
    assert sum(r["n"] > 0 for r in held) <= max(2, 2 * quality_rules.RISK * len(held))


def test_rules_on_documents(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "one two three four five six seven eight nine ten", "en"), (4, "a b c d e " * 9, "en"), (None, "x " * 100_000, "de"), (3, "one two three four five six seven eight nine ten", "en")]
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, lang string, n_words int, kept string")
    marks = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted(((r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in quality_rules.apply_rules(docs, marks).collect()), key=str)
    assert got == sorted([(1, 0, True, False), (2, 0, True, False), (3, 10, False, True), (3, 10, False, True), (4, 45, True, False), (None, 100_000, True, False)], key=str)
    assert quality_rules.apply_rules(docs.limit(0), marks).count() == 0
    assert quality_rules.apply_rules(docs, marks.limit(0)).filter("kept").count() == 2


def test_classifier_on_held_out_rows(spark, tables):
    docs, marks = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    model, feats = qda.train(docs, marks)
    got = {r["doc_id"]: r for r in qda.scores(feats, model).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in marks.collect() if got[r["doc_id"]]["held_out"]]
    assert sum(p == q for p, q in held) / len(held) > 0.9
    kept = qda.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}


def test_scores_are_those_of_a_plain_discriminant(spark, tables):
    """Log densities by determinants and inverse matrices, the calibration aside."""
    import numpy as np

    docs, marks = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    model, feats = qda.train(docs, marks)
    rows = {r["doc_id"]: [r[c] for c in qda.STATISTICS] for r in feats.collect()}
    quality = {r["doc_id"]: r["quality"] for r in marks.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    x = [np.array([rows[i] for i, q in quality.items() if q == k]) for k in (0, 1)]
    cov = [np.cov(a, rowvar=False, bias=True) for a in x]
    pooled = sum(len(a) * c for a, c in zip(x, cov, strict=True)) / sum(map(len, x))
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    shrunk = [(1 - qda.TO_IDENTITY) * ((1 - qda.TO_POOLED) * c + qda.TO_POOLED * pooled) / np.outer(scale, scale) + qda.TO_IDENTITY * np.eye(len(scale)) for c in cov]

    def density(v, k):
        d = (v - x[k].mean(axis=0)) / scale
        return -0.5 * (d @ np.linalg.inv(shrunk[k]) @ d + np.linalg.slogdet(shrunk[k])[1])

    for r in qda.scores(feats, model).collect():
        v = np.array(rows[r["doc_id"]])
        margin = np.arcsinh(density(v, 1) - density(v, 0))
        assert abs(1 / (1 + np.exp(-(model.slope * margin + model.offset))) - r["score"]) < 1e-6


def test_training_on_labelled_rows_alone_gives_the_same_model(spark, tables):
    import numpy as np

    docs, marks = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    one, two = qda.train(docs, marks)[0], qda.train_on_labelled(docs, marks)
    assert np.allclose(one.means, two.means) and np.allclose(one.roots, two.roots) and abs(one.slope - two.slope) < 1e-6


def test_labels_of_held_out_rows_are_not_learnt(spark, tables):
    docs, marks = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    flipped = marks.withColumn("quality", F.when(qda.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, qda.scores(f, m).collect())) for m, f in (qda.train(docs, marks), qda.train(docs, flipped)))
    assert one == two


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "w " * 100_000, "c"), (2, "w", "d")], "doc_id long, text string, score string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model, feats = qda.train(docs, marks)
    assert [r["score"] for r in qda.scores(feats, model).collect()] == [0.5] * 4
    assert qda.accepted(docs, model).columns == docs.columns and qda.accepted(docs, model).count() == 4
    model, feats = qda.train(docs.limit(0), marks)
    assert qda.scores(feats, model).count() == 0


@pytest.fixture(scope="module")
def licence_model(spark, tables):
    corpus = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    return corpus, licences.train(corpus)


def plain_scan(text, model):
    """Independent version: paragraphs, ranges, scores, agreement, and the best row per paragraph and family."""
    import math
    import re

    found = []
    for no, para in enumerate(re.split(r"\n(?:[ \t\x0b\x0c\r]*\n)+", text or "")):
        lines = [re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", x.lower()) for x in para.split("\n")]
        words, ranges, at = [w for x in lines for w in x], [], 0
        for x in lines:
            if 0 < len(x) <= licences.WINDOW:
                ranges.append((at, len(x)))
            at += len(x)
        n = len(words)
        if n > licences.WINDOW or sum(bool(x) for x in lines) > 1:
            ranges += [(a, min(licences.WINDOW, n - a)) for a in range(0, max(n - licences.STEP, 0) + 1, licences.STEP)]
        rows = []
        for a, k in set(ranges):
            part = words[a : a + k]
            codes = HASHED(tuple(part))
            sums = [b + sum(round(w[c], 4) for c in codes) for w, b in zip(model.weights, model.intercepts, strict=True)]
            top = max(sums)
            p = [math.exp(x - top) for x in sums]
            p = [x / sum(p) for x in p]
            if p[-1] > 0.5:
                continue
            best = max(range(len(p) - 1), key=lambda i: p[i])
            grams = {f"{x} {y}" for x, y in zip(part, part[1:])}
            parts = [set(licences._grams(q)) for t in licences.TEMPLATES.get(licences.CLASSES[best], []) for q in licences.pieces(t)]
            share = max([len(grams & t) / len(t) for t in parts], default=0.0)
            sure = best < len(licences.FAMILIES) and p[best] >= model.believed and share >= licences.CONFIRM
            rows.append((best if sure else licences.CLASSES.index("unknown"), a, a + k))
        sure = [r for r in rows if licences.CLASSES[r[0]] != "unknown"]
        rows = sure + [r for r in rows if r not in sure and not any(x[1] < r[2] and x[2] > r[1] for x in sure)]
        found += [(no, licences.CLASSES[r]) for r in {x[0] for x in rows}]
    return sorted(found)


def HASHED(part):
    return HASHES[part]


HASHES: dict = {}


def test_licence_scan_equals_a_plain_one(spark, licence_model):
    corpus, model = licence_model
    mit = licences.TEMPLATES["MIT"][2]
    wrapped = "\n".join(" ".join(mit.split()[i : i + 9]) for i in range(0, len(mit.split()), 9))
    prose = [r["text"] for r in corpus.orderBy("doc_id").limit(40).collect() if r["text"] and len(r["text"]) < 6000]
    rows = [(i, f"{t}\n\n{wrapped}\n\n{licences.LEFT_OUT[i % len(licences.LEFT_OUT)]}\n{t[:200]}") for i, t in enumerate(prose)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    every = licences.units(F.col("text"), lambda no, w, c, ranges: F.transform(ranges, lambda s: F.struct(F.slice(w, s["at"] + 1, s["n"]).alias("w"), licences._cut(c, s).alias("c"))))
    for r in docs.select(F.explode(F.flatten(every)).alias("x")).select("x.w", "x.c").collect():
        HASHES[tuple(r["w"])] = r["c"]
    got = {}
    for r in licences.scan(docs, model).collect():
        got.setdefault(r["doc_id"], []).append((r["paragraph"], r["family"]))
    for i, text in rows:
        assert sorted(got.get(i, [])) == plain_scan(text, model)
    assert sum(f == "MIT" for x in got.values() for _, f in x) >= len(rows)


def test_licences(spark, licence_model):
    corpus, model = licence_model
    assert 0.5 < model.believed < 1
    lines = {i: (f, t) for i, (f, t) in enumerate((f, t) for f, ts in licences.TEMPLATES.items() for t in ts)}
    rows = [(i, f"Some prose before.\n\n{t}\n\nand after", "x") for i, (_, t) in lines.items()]
    wrap = lambda t, k: "\n".join(" ".join(t.split()[i : i + k]) for i in range(0, len(t.split()), k))
    rows += [(1000 + i, f"Some prose before.\n{wrap(t, 11)}\nand after", "x") for i, (_, t) in lines.items()]
    rows += [(2000 + i, f"and then it said {t} which was the end of it, as ever. " * 3, "x") for i, (_, t) in lines.items()]
    rows += [(100, None, "x"), (101, "", "x"), (None, "Released under the MIT License.", "x"), (102, "nothing of that kind\n" * 3000, "x"), (103, "word " * 100_000, "x"), (104, "Released under the MIT License.\n" * 3000, "x")]
    rows += [(105, "Released under the MIT License.", "x")] * 2 + [(106 + i, t, "x") for i, t in enumerate(licences.LEFT_OUT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = {}
    for r in licences.scan(docs, model).collect():
        got.setdefault(r["doc_id"], []).append(r["family"])
    right = sum(f in got.get(base + i, []) for base in (0, 1000, 2000) for i, (f, _) in lines.items())
    assert right >= 0.9 * 3 * len(lines)
    assert got[None] == ["MIT"] and got[104] == ["MIT"] and got[105] == ["MIT", "MIT"]
    assert not {100, 101, 102, 103} & set(got)
    assert sum(set(got.get(106 + i, [])) == {"unknown"} for i in range(len(licences.LEFT_OUT))) >= 0.6 * len(licences.LEFT_OUT)
    plain = corpus.filter("not lower(text) rlike 'licen|rights reserved|copyright|public domain'")
    assert licences.scan(plain, model).filter("family <> 'unknown'").count() == 0
    assert licences.scan(plain, model).count() <= 0.05 * plain.count()
    assert licences.scan(docs.limit(0), model).count() == 0


def test_the_bound_drops_no_notice(spark, licence_model):
    corpus, model = licence_model
    each = licences.units(F.col("text"), lambda no, w, c, ranges: F.transform(ranges, lambda s: licences._cut(c, s)))
    rows = corpus.select(F.explode(F.flatten(each)).alias("codes")).withColumn("p", licences._best(F.col("codes"), model.weights, model.intercepts))
    assert rows.filter((F.col("p.best") < len(licences.CLASSES) - 1) & ~licences.may_be_notice(F.col("codes"), model)).count() == 0
    assert rows.filter(~licences.may_be_notice(F.col("codes"), model)).count() > 0


def test_a_group_of_copies_has_one_vote(spark):
    """Copies, in any number, leave the votes and so the cutoffs as they were."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(120)) + "!" * (i % 7) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    more = [(1000 + i, texts[i % 5], "en") for i in range(80)]
    copied = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    marks = copied.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    alone = quality_rules.votes(quality_rules.marked_rows(quality_rules.measured(docs), marks))
    together = quality_rules.votes(quality_rules.marked_rows(quality_rules.measured(copied), marks))
    assert together.count() == alone.count() <= 60
    assert sorted(r["doc_id"] for r in together.collect()) == sorted(r["doc_id"] for r in alone.collect())
