import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SCHEMA = "doc_id long, text string"


def byte_of():
    """The bytes that the byte-level vocabulary's characters stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


BYTES = byte_of()


def tokens(text):
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    spelled_a = [bytes(BYTES[c] for c in A.id_to_token(i)) for i in a]
    spelled_b = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [B.id_to_piece(i)]]
    return list(zip(a, spelled_a, strict=True)), list(zip(b, spelled_b, strict=True))


def plain(texts):
    """Every figure by trying all pairs of tokens of each text."""
    rows, counts = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a, b = tokens(text or "")
        if not text or b"".join(s for _, s in a) != whole or b"".join(s for _, s in b) != whole:
            rows.append(None)
            continue
        spans = [[], []]
        for side, of in enumerate((a, b)):
            at = 0
            for i, s in of:
                spans[side].append((at, at + len(s), i))
                at += len(s)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, before = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[2]) for x in of if before < x[1] <= end) for of in spans))
            before = end
        counts.update(links)
        rows.append((len(a), len(b), links, ";".join(groups)))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    for row in rows:
        if row is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            n_a, n_b, links, groups = row
            yield (n_a, n_b, groups.count(";") + 1, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest())


def check(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, **options)[0].collect()}
    assert got == dict(enumerate(plain(texts)))
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=30), st.data())
def test_groups_and_links_are_those_of_all_pairs(a, data):
    total, b = sum(a), []
    while sum(b) < total:
        b.append(data.draw(st.integers(1, total - sum(b))))
    at = alignment.coalesce_intervals(np.array(a), np.array(b))
    ends = [np.cumsum(x).tolist() for x in (a, b)]
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in ends]
    assert sorted(zip(at.link_a.tolist(), at.link_b.tolist(), strict=True)) == [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
    common = sorted(set(ends[0]) & set(ends[1]))
    for e, group in zip(ends, (at.group_a, at.group_b), strict=True):
        assert group.tolist() == [next(i for i, c in enumerate(common) if c >= x) for x in e]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_chunks_of_any_texts(texts):
    found = alignment.align_chunk(texts, alignment.sides())
    want = list(plain(texts))
    assert [(f[0], f[1], f[2], f[3], f[4]) for f in found] == [(w[0], w[1], w[2], w[3], w[6]) for w in want]
    assert all(sum(f[6]) == f[3] for f in found)


def test_defined_cases(spark):
    texts = [None, "", "a", " lead", "a▁b", "tab\tand\n\nlines ", "x<|endoftext|>y </s>", "ß ñ 漢字 🙂", "the the the", "the the the", "\x00", "word " * 3000]
    got = check(spark, texts)
    assert got[0] == got[1] == got[4] == (0, 0, 0, 0, 0, 0, "") and got[8] == got[9] and got[6][0] > 0


def test_repeated_and_missing_ids_clashing_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "one two", 5, "x"), (1, "one two", 6, "y"), (None, "one", 7, "z")], "doc_id long, text string, row long, pairs string")
    rows = alignment.align(docs)[0].collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"]) for r in rows) == [(0, 1, 3), (1, 2, 5), (1, 2, 5)]
    assert alignment.align(docs.limit(0))[0].collect() == []


def test_tables_both_ways_of_the_join(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").orderBy("doc_id").limit(60).collect()
    texts = [r["text"] for r in rows if len(r["text"]) < 3000]
    assert check(spark, texts) == check(spark, texts, pair_rows=0)


def test_long_texts_are_cut_into_chunks_by_whole_documents():
    rows = [(i, "x" * n) for i, n in enumerate([5, 5, 50, 1])]
    assert [[r[0] for r in c] for c in alignment.chunks(iter(rows), 10)] == [[0, 1], [2], [3]]
