import base64

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import packing, tokens

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_tokenizers_library(text):
    assert tokens.encoder()(text).tolist() == EXACT.encode(text, add_special_tokens=False).ids


def test_ids_of_special_strings_and_data(tables, spark):
    texts = ["a<|endoftext|>b", "", "it's  we'll\n\n x", "ß ñ 12,5%"] + [r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    for t in texts:
        assert tokens.encoder()(t).tolist() == EXACT.encode(t, add_special_tokens=False).ids
    assert len(tokens.encoder()(None)) == 0


def layout_is_sound(pieces, lengths, size):
    """Pieces cover each document once and fill each sequence without gaps."""
    at = {}
    for p in sorted(pieces, key=lambda p: (p["doc"], p["start"])):
        assert p["start"] == at.get(p["doc"], 0) and p["n"] > 0
        at[p["doc"]] = p["start"] + p["n"]
    assert at == {d: n for d, n in lengths.items() if n}
    fill = {}
    for p in sorted(pieces, key=lambda p: (p["seq"], p["offset"])):
        assert p["offset"] == fill.get(p["seq"], 0)
        fill[p["seq"]] = p["offset"] + p["n"]
    assert all(f <= size for f in fill.values())
    return sum(0 if f & (f - 1) == 0 else size - f for f in fill.values())


def layout(packer):
    pieces = []
    for seq, w in enumerate(packer.closed):
        offset = 0
        for doc, start, ids, _ in w:
            assert ids.tolist() == list(range(start, start + len(ids)))
            pieces.append({"doc": doc, "start": start, "n": len(ids), "seq": seq, "offset": offset})
            offset += len(ids)
    return pieces


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=120))
def test_packer_places_every_id_once(lengths):
    packer = packing.Packer(16)
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(n, dtype="<u4"))
    packer.finish()
    assert layout_is_sound(layout(packer), dict(enumerate(lengths)), 16) == 0
    assert packer.placed == sum(lengths) and packer.moved <= sum(lengths)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_placements_are_those_of_a_plain_sum_of_squares_packer(lengths):
    """Window by window: levels of all windows after each document, by trying every level."""
    size, packer, levels = 16, packing.Packer(16), []
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(n, dtype="<u4"))
        s = n % size
        if s:
            best = None
            for level in [0, *sorted(set(levels))]:
                if level + s <= size:
                    after = levels.copy()
                    if level:
                        after.remove(level)
                    if level + s < size:
                        after.append(level + s)
                    cost = sum(after.count(x) ** 2 for x in set(after))
                    if best is None or cost <= best[0]:  # ties go to the fullest level
                        best = (cost, after)
            levels = best[1]
        assert sorted(levels) == sorted(lv for lv in range(size) for _ in packer.open[lv])
        assert [len(x) for x in packer.open] == packer.count.tolist()


def test_finish_leaves_the_fullest_windows_as_the_rule_built_them():
    packer, rng = packing.Packer(64), np.random.default_rng(1)
    for i in range(4000):
        packer.add(i, np.arange(rng.integers(1, 90), dtype="<u4"))
    packer.finish()
    assert packer.moved < 0.02 * packer.placed


def test_documents(spark):
    rows = [(1, "hello world " * 3000), (2, None), (3, ""), (None, "some words"), (3, "again"), (4, "x")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int").coalesce(1)
    got = packing.pack(docs).collect()
    whole = {}
    for p in got:
        assert len(p["ids"]) == 4 * p["length"] and p["padded_length"] >= p["offset"] + p["length"]
        whole.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], bytes(p["ids"])))
    for i, t in rows:
        want = [*tokens.encoder()(t).tolist(), 1]
        parts = sorted(whole[(i, len(want))])
        assert np.frombuffer(b"".join(x for _, x in parts), "<u4").tolist() == want
    assert packing.pack(docs.limit(0)).count() == 0
    # runs that end early lose nothing either
    assert sum(p["length"] for p in packing.pack(docs, run_ids=50).collect()) == sum(p["length"] for p in got)


def test_histogram_answers(spark):
    texts = [None, "", "a", "a b c", "a b c", "word " * 3000, "x y"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    lengths = sorted(len(tokens.encoder()(t)) for t in texts)
    hist = tokens.histogram(tokens.length_counts(docs))
    rows = {r["length"]: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_at_least"] == sum(x >= n for x in lengths) and r["docs_up_to"] == sum(x <= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
    got = {r["context"]: (r["tokens"], r["truncated_docs"]) for r in tokens.totals(hist, [2, 512, 10**6]).collect()}
    assert got == {c: (sum(min(x, c) for x in lengths), sum(x > c for x in lengths)) for c in (2, 512, 10**6)}
    got = {r["quantile"]: r["length"] for r in tokens.quantiles(hist, [0.5, 1.0]).collect()}
    assert got == {0.5: lengths[3], 1.0: lengths[-1]}
    assert tokens.histogram(tokens.length_counts(docs.limit(0))).count() == 0


def test_ranks_are_those_of_the_vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        assert len({base64.b64decode(x.split()[0]) for x in f}) == 50256
