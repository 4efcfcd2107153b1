"""Licence scan: a trained classifier of paragraphs, confirmed against templates.

A paragraph is a run of non-blank lines; its lines are joined, so a notice may
be wrapped anywhere.  What is classified are its lines of up to ``WINDOW``
words and, where it has more than one line or more words, its runs of
``WINDOW`` words, one every ``STEP`` words: a notice inside a long paragraph,
or one that goes over lines, lies whole in a run, and none is diluted by more
than ``WINDOW`` words of prose.  All are scored.

Word uni- and bigrams are hashed into ``DIM`` features.  A multinomial logistic
regression is trained here on notices (with words dropped, cut, and amid prose
of the corpus), on notices of other licences and legal sentences (the unknown
class), and on prose.  The probability from which a family is believed is set
on samples held out, notices of licences that training never saw among them.
A family is confirmed only where enough of the bigrams of one of its templates
are there.

The largest margin of any licence class over prose, summed over a text's hash
codes, bounds the margin of the best class, so where that bound is below 0 the
class is prose, and only the others are scored in full.

Training is bounded: the templates, ``COPIES`` variants of each, and ``UNITS``
lines or runs of each of ``SAMPLE`` documents.  Scoring covers every text.
"""

from __future__ import annotations

import functools
import json
import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import bound, running, sample_documents, stage
from feedloom.llm.spans import apart

DIM, COPIES, SAMPLE, UNITS = 4096, 24, 300, 40
#: Words of a run, and from one run's start to the next: a piece of a template fits whole in some run.
WINDOW, STEP = 64, 32
#: Share of a template's bigrams that must be there.
CONFIRM = 0.7
#: Share of held-out samples believed that must be right.
RIGHT = 0.99
PROSE, UNKNOWN = "prose", "unknown"

# Notices and grants of public licences, and short notices in customary words.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD": [
        "Distributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "AGPL": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "proprietary": ["All rights reserved.", "Copyright by the author. All rights reserved.", "This document is confidential and may not be reproduced without written permission of the owner."],
}

# Grants of other public licences, and legal sentences in customary words: the unknown class.
OTHERS: list[str] = [
    "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License which accompanies this distribution.",
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE.",
    "Licensed under the European Union Public Licence.",
    "This font software is licensed under the SIL Open Font License.",
    "You may use this material only under the licence agreement that came with it.",
    "Use of this software is governed by the terms of the end user agreement.",
    "This content may be shared for non-profit use with credit to its source.",
    "You may not copy, sell or distribute this work without a licence from its owner.",
    "The publisher grants the reader a non-exclusive right to use this publication.",
    "Reproduction in whole or in part is prohibited without the consent of the copyright holder.",
    "This licence applies to every copy of the software and to works based on it.",
    "Patent rights are granted to each recipient under the terms of this agreement.",
    "The licensee shall keep all notices of copyright and of this license intact.",
    "By using this material you agree to the terms and conditions of the provider.",
    "This database is made available under the Open Database License.",
]
# Likewise, but only for the threshold and for figures; training never sees them.
LEFT_OUT: list[str] = [
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software.",
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary.",
    "The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package.",
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 3.0 License.",
    "Use of this material requires a signed agreement with the publisher.",
    "This notice may not be removed or altered from any source distribution.",
    "The terms of this license apply to every copy of the documentation.",
    "You may redistribute and adapt this text so long as the original creator is credited.",
    "No part of this publication may be reproduced without prior permission of the publisher.",
]
FAMILIES = tuple(TEMPLATES)
CLASSES = (*FAMILIES, UNKNOWN, PROSE)
#: A longer template is cut, from its start, into pieces of so many words.
PIECE = 24

_WORD = r"[\p{L}\p{N}]++(?:[.-][\p{L}\p{N}]++)*+"
_BLANK = r"\n(?:[\x20\x09\x0B-\x0D]*+\n)++"


def words_of(c: Column) -> Column:
    """Lower-case words of letters, digits, and dots and hyphens inside a word."""
    return F.regexp_extract_all(F.lower(c), F.lit(_WORD), F.lit(0))


def pieces(text: str) -> list[list[str]]:
    """The words of a template, in pieces of ``PIECE``; a short rest joins the last."""
    words = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())
    if len(words) <= STEP:
        return [words]
    cut = [words[i : i + PIECE] for i in range(0, len(words), PIECE)]
    return [*cut[:-2], cut[-2] + cut[-1]] if len(cut[-2] + cut[-1]) <= STEP else cut


def _grams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def bigrams_of(w: Column) -> Column:
    """Distinct word bigrams."""
    rest = F.greatest(F.size(w) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(w, 1, rest), F.slice(w, 2, rest), lambda a, b: F.concat_ws(" ", a, b)))


def _coded(w: Column) -> Column:
    """``struct<one, two>``: the hash codes, below ``DIM``, of each word and of each word with the next."""
    code = lambda *g: F.pmod(F.xxhash64(*g), F.lit(DIM)).cast("int")
    rest = F.greatest(F.size(w) - 1, F.lit(0))
    return F.struct(F.transform(w, lambda x: code(x)).alias("one"), F.zip_with(F.slice(w, 1, rest), F.slice(w, 2, rest), lambda x, y: code(x, y)).alias("two"))


def codes_of(w: Column) -> Column:
    """The distinct hash codes of the uni- and bigrams."""
    return bound(_coded(w), lambda c: F.array_distinct(F.concat(c["one"], c["two"])))


@dataclass(frozen=True)
class Model:
    """Per class ``DIM`` weights and an intercept; the believed probability."""

    weights: list[list[float]]
    intercepts: list[float]
    believed: float


def _ranges(lines: Column, n: Column) -> Column:
    """``struct<at, n>`` (words from 0) of what is classified in a paragraph of ``n`` words whose lines have so many."""
    span = lambda a, b: F.struct(a.cast("int").alias("at"), b.cast("int").alias("n"))
    ends = running(lines, F.lit(0), lambda a, b: a + b)
    own = F.filter(F.zip_with(lines, ends, lambda k, end: span(end - k, k)), lambda s: s["n"].between(1, WINDOW))
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n - STEP, F.lit(0)), F.lit(STEP)), lambda a: span(a, F.least(F.lit(WINDOW), n - a)))
    single = (n <= WINDOW) & (F.size(F.filter(lines, lambda k: k > 0)) <= 1)
    return F.when(single, own).otherwise(F.concat(own, runs))


def units(text: Column, judge) -> Column:
    """Array of arrays, one per paragraph: ``judge(paragraph, words, codes, ranges)`` is an array of what is found there."""

    def of(no: Column, w: Column, lines: Column) -> Column:
        ranges = bound(lines, lambda k: _ranges(k, F.size(w)))
        return bound(_coded(w), lambda c: judge(no, w, c, ranges))

    def paragraph(p: Column, no: Column) -> Column:
        lines = F.transform(F.split(p, "\n", -1), words_of)
        return bound(lines, lambda ls: bound(F.flatten(ls), lambda w: of(no, w, F.transform(ls, lambda x: F.size(x)))))

    return F.transform(F.split(F.coalesce(text, F.lit("")), _BLANK, -1), paragraph)


def _cut(codes: Column, s: Column) -> Column:
    """The distinct codes of the range ``s``."""
    return F.array_distinct(F.concat(F.slice(codes["one"], s["at"] + 1, s["n"]), F.slice(codes["two"], s["at"] + 1, s["n"] - 1)))


def prose_of(docs: DataFrame) -> DataFrame:
    """``key, words``: lines and runs of the sample, but for those that share two bigrams with a template."""
    known = F.array(*[F.lit(g) for g in sorted({g for t in [*sum(TEMPLATES.values(), []), *OTHERS] for p in pieces(t) for g in _grams(p)})])
    each = units(F.col("text"), lambda no, w, c, ranges: F.transform(ranges, lambda s: F.slice(w, s["at"] + 1, s["n"])))
    few = F.slice(F.sort_array(F.transform(F.array_distinct(F.flatten(each)), lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))), 1, UNITS)
    rows = sample_documents(docs, SAMPLE).select(F.explode(few).alias("x")).select(F.col("x.h").cast("string").alias("key"), F.col("x.w").alias("words"))
    return rows.filter(F.size(F.array_intersect(bigrams_of(F.col("words")), known)) < 2)


def notices(spark: SparkSession) -> DataFrame:
    """``label, key, w, left_out`` of each piece of each template."""
    rows = [(CLASSES.index(f), f, t, False) for f, ts in TEMPLATES.items() for t in ts]
    rows += [(CLASSES.index(UNKNOWN), UNKNOWN, t, x) for ts, x in ((OTHERS, False), (LEFT_OUT, True)) for t in ts]
    cut = [(label, f"{f}:{i}:{j}", p, x) for i, (label, f, t, x) in enumerate(rows) for j, p in enumerate(pieces(t))]
    return spark.createDataFrame(cut, "label int, key string, w array<string>, left_out boolean").coalesce(1)


def training_samples(docs: DataFrame) -> DataFrame:
    """``label, words, fold, left_out`` of notices with noise and amid prose, of unknown licences, and of prose."""
    spark = docs.sparkSession
    prose = stage(prose_of(docs).coalesce(4), "prose")
    n = max(1, prose.count())
    numbered = prose.select((F.row_number().over(Window.orderBy("key")) - 1).alias("_no"), F.col("words").alias("around"))  # a bounded sample
    copies = spark.range(COPIES).withColumnRenamed("id", "copy").coalesce(1)
    # a stated number of templates and copies
    noisy = notices(spark).join(F.broadcast(copies)).withColumn("key", F.concat_ws(":", "key", "copy"))
    h = lambda m, *x: F.pmod(F.xxhash64(F.col("key"), *x), F.lit(m)).cast("int")
    kept = F.filter("w", lambda x, i: (F.col("copy") == 0) | (h(100, x, i) >= F.col("copy") % 4 * 5))
    part = F.when((F.col("copy") % 5 == 4) & (F.size("w") > 16), F.slice("w", h(8, F.lit("at")) + 1, h(6, F.lit("n")) + 8)).when(F.size(kept) > 2, kept).otherwise(F.col("w"))
    rows = noisy.select("label", "key", "copy", "left_out", part.alias("w"), h(n, F.lit("prose")).alias("_at"), h(24, F.lit("a")).alias("a"), h(24, F.lit("b")).alias("b"))
    rows = rows.join(numbered, rows["_at"] == numbered["_no"], "left")
    around = F.coalesce("around", F.array().cast("array<string>"))
    amid = F.slice(F.concat(F.slice(around, F.lit(1), F.col("a")), F.col("w"), F.slice(around, F.col("a") + 1, F.col("b"))), 1, WINDOW)
    words = F.when(F.col("copy") % 2 == 0, F.col("w")).otherwise(amid)
    fold = lambda k: F.pmod(F.xxhash64(k), F.lit(4))
    found = rows.select("label", words.alias("words"), F.when(F.col("left_out"), 3).otherwise(fold(F.col("key"))).alias("fold"), "left_out")
    return found.unionByName(prose.select(F.lit(CLASSES.index(PROSE)).alias("label"), "words", fold(F.col("key")).alias("fold"), F.lit(False).alias("left_out")))


def _best(codes: Column, model_weights: list[list[float]], intercepts: list[float]) -> Column:
    """``struct<probability, best>``: the likeliest class of a set of hash codes, prose only if likelier than all others together.

    Lambda variables hold what is used more than once, so that it is computed once.
    """
    table = F.from_json(F.lit(json.dumps([[round(v, 4) for v in col] for col in zip(*model_weights, strict=True)])), "array<array<double>>")
    start = F.array(*[F.lit(float(x)) for x in intercepts])

    def top(sums: Column) -> Column:
        inverse = F.transform(sums, lambda x: F.aggregate(sums, F.lit(0.0), lambda a, y: a + F.exp(y - x)))
        prose = F.element_at(inverse, len(CLASSES)) < 2
        among = F.when(prose, inverse).otherwise(F.slice(inverse, 1, len(CLASSES) - 1))
        return bound(among, lambda q: F.struct((F.lit(1.0) / F.array_min(q)).alias("probability"), (F.array_position(q, F.array_min(q)) - 1).cast("int").alias("best")))

    return F.aggregate(F.transform(codes, lambda c: F.get(table, c)), start, lambda a, row: F.zip_with(a, row, lambda x, y: x + y), lambda a: bound(a, top))


def may_be_notice(codes: Column, model: Model) -> Column:
    """False only where prose is likelier than all other classes together.

    A class's margin over prose is at most the sum of the largest margins in its
    group of classes, code by code; that no group's sum reaches ``-ln(classes)``
    shows it.  First all classes are one group, then four.
    """
    rows = [[round(v, 4) for v in col] for col in zip(*model.weights, strict=True)]
    prose = CLASSES.index(PROSE)

    def reached(group: range) -> Column:
        margins = F.from_json(F.lit(json.dumps([round(max(r[c] for c in group) - r[prose], 4) for r in rows])), "array<double>")
        start = max(model.intercepts[c] for c in group) - model.intercepts[prose] + math.log(prose) + 1e-6
        return F.aggregate(codes, F.lit(start), lambda a, c: a + F.get(margins, c)) >= 0

    few = [range(prose - 1, prose), range(4), range(4, 7), range(7, prose - 1)]
    return reached(range(prose)) & functools.reduce(lambda a, b: a | b, [reached(g) for g in few])


def agreement(words: Column, label: Column) -> Column:
    """The largest share of a piece's bigrams, of the family's templates, that ``words`` hold; 0 for other classes."""
    table = [[_grams(p) for t in TEMPLATES.get(f, []) for p in pieces(t)] for f in CLASSES]
    known = F.from_json(F.lit(json.dumps(table)), "array<array<array<string>>>")
    share = lambda g: F.aggregate(F.get(known, label), F.lit(0.0), lambda a, t: F.greatest(a, F.size(F.array_intersect(g, t)) / F.size(t)))
    return bound(bigrams_of(words), share)


def verdict(words: Column, p: Column, believed: float) -> Column:
    """``struct<label, probability, agreement>`` of a range whose best class is not prose."""
    sure = lambda a: (p["best"] < len(FAMILIES)) & (p["probability"] >= believed) & (a >= CONFIRM)
    return bound(agreement(words, p["best"]), lambda a: F.struct(F.when(sure(a), p["best"]).otherwise(CLASSES.index(UNKNOWN)).alias("label"), p["probability"].alias("probability"), a.alias("agreement")))


def fit(samples: DataFrame) -> tuple[list[list[float]], list[float]]:
    """Weights and intercepts from rows ``label, codes``."""
    named = samples.select("label", F.transform("codes", lambda c: c.cast("string")).alias("names"))
    sparse = CountVectorizerModel.from_vocabulary([str(i) for i in range(DIM)], inputCol="names", outputCol="features")
    fitted = LogisticRegression(maxIter=40, regParam=0.0005, family="multinomial", standardization=False).fit(sparse.transform(named).select("label", "features"))
    return fitted.coefficientMatrix.toArray().tolist(), list(fitted.interceptVector.toArray())


def train(docs: DataFrame, samples: DataFrame | None = None) -> Model:
    """The model; ``samples``: what :func:`training_samples` gives, made from ``docs`` where absent."""
    samples = training_samples(docs) if samples is None else samples
    samples = stage(samples.withColumn("codes", codes_of(F.col("words"))).coalesce(4), "samples")
    weights, intercepts = fit(samples.filter("fold < 3"))
    held = samples.filter("fold = 3").select("label", "words", _best(F.col("codes"), weights, intercepts).alias("p")).filter(F.col("p.best") < len(FAMILIES))
    held = held.filter(agreement(F.col("words"), F.col("p.best")) >= CONFIRM).select(F.round("p.probability", 2).alias("top"), (F.col("p.best") == F.col("label")).alias("right"))
    curve = sorted(((r["top"], r["n"], r["ok"]) for r in held.groupBy("top").agg(F.count("*").alias("n"), F.count_if("right").alias("ok")).collect()), reverse=True)  # 101 rows
    believed, n, ok = 1.0, 0, 0
    for top, more, right in curve:
        n, ok = n + more, ok + right
        if ok >= RIGHT * n:
            believed = top
    return Model(weights, intercepts, believed)


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, paragraph, family, probability, agreement, first_word, n_words, body``: the notices of each paragraph.

    One row per paragraph and family: the line or run of words that agrees
    best (then the likeliest, the shortest, the first), with its place among
    the paragraph's words and its words.  ``family`` is one of ``FAMILIES``, or
    ``unknown`` where some stretch is a notice but overlaps none of a family
    that is believed and confirmed.

    Defined cases: null and empty texts have no notice; a null id keeps its
    rows; repeated rows repeat theirs; equal notices in one paragraph count
    once; an empty table gives no rows; other columns are not read.
    """
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))) if model is None else model
    unknown = CLASSES.index(UNKNOWN)

    def judge(no: Column, w: Column, codes: Column, ranges: Column) -> Column:
        def hit(s: Column) -> Column:
            best = lambda c: F.when(may_be_notice(c, model), _best(c, model.weights, model.intercepts))
            return F.struct(s.alias("s"), bound(_cut(codes, s), best).alias("p"))

        def told(h: Column) -> Column:
            body = lambda v: F.struct(
                no.alias("paragraph"), v["label"].alias("label"), (-v["agreement"]).alias("a"), (-v["probability"]).alias("q"), h["s"]["n"].alias("n"),
                h["s"]["at"].alias("start"), (h["s"]["at"] + h["s"]["n"]).alias("end"), F.array_join(F.slice(w, h["s"]["at"] + 1, h["s"]["n"]), " ").alias("body"),
            )
            return bound(verdict(F.slice(w, h["s"]["at"] + 1, h["s"]["n"]), h["p"], model.believed), body)

        def one_each(rows: Column) -> Column:
            named = lambda k: F.filter(rows, lambda r: (r["label"] == unknown) == k)
            both = bound(F.struct(named(False).alias("sure"), named(True).alias("rest")), lambda x: F.concat(x["sure"], apart(x["rest"], x["sure"])))
            return bound(F.sort_array(both), lambda r: F.filter(r, lambda x, i: (i == 0) | (F.get(r, i - 1)["label"] != x["label"])))

        hits = F.filter(F.transform(ranges, hit), lambda h: h["p"].isNotNull() & (h["p"]["best"] != CLASSES.index(PROSE)))
        return bound(F.transform(hits, told), one_each)

    # one generator, so that no filter or projection computes the scores again
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.flatten(units(F.col(text_col), judge))).alias("x"))
    names = F.array(*[F.lit(c) for c in CLASSES])
    return rows.select("doc_id", "x.paragraph", F.get(names, F.col("x.label")).alias("family"), (-F.col("x.q")).alias("probability"), (-F.col("x.a")).alias("agreement"), F.col("x.start").alias("first_word"), F.col("x.n").alias("n_words"), "x.body")
