"""Spelling variants, ranked lexical search and packing against plain versions."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricmart.llm import lexsearch, pack, queries, spelling

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(JSON)


def plain(rows):
    return [(r[0], r[1]) for r in rows]


def ranked(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# ---- 11: spelling variants

def variants(frame):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame).collect()]


def test_variants_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert ranked(variants(docs)) == ranked(brute.spelling(docs.select("doc_id", "text").collect()))


def test_variants_of_awkward_rows(spark, docs, awkward, no_docs):
    more = [(7, "Straße straße strasse strassse Strasse " * 5 + "ÀÉÎ Àéî×÷ naïve naive náive " * 4), (7, "x" * 3000 + " " + "x" * 3001 + " "), (8, "x" * 3000 + " " + "x" * 3001), (9, "x" * 3000 + " " + "x" * 3001)]
    frame = docs.select("doc_id", "text", "key", "n").unionByName(spark.createDataFrame(more * 2, "doc_id long, text string"), allowMissingColumns=True)
    assert ranked(variants(frame)) == ranked(brute.spelling(plain(awkward) + more * 2))
    assert spelling.variants(no_docs).count() == 0


def test_variants_of_cells_in_pieces(spark, monkeypatch):
    """Small cells, pieces and shares: words meet as they do in one piece."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abeé") for _ in range(rng.randrange(5, 9))) for _ in range(700)]
    rows = [(i, " ".join(rng.choices(words, weights=[1 + 40 * (j < 30) for j in range(700)], k=400))) for i in range(60)]
    frame, want = spark.createDataFrame(rows, "doc_id long, text string"), ranked(brute.spelling(rows))
    for cell, visitors in ((60, 60), (9, 20)):
        monkeypatch.setattr(spelling, "CELL", cell)
        monkeypatch.setattr(spelling, "VISITORS", visitors)
        assert ranked(variants(frame)) == want


def test_chains_of_forms(spark):
    """A form of a form of a form: the root is the last."""
    chain = ["abcdefgh"[:5] + "z" * i for i in range(6)]
    rows = [(0, None)] + [(i * 1000 + j, w) for i, w in enumerate(chain) for j in range(3 ** (i + 1))]
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {w: (f, r) for w, f, r, *_ in brute.spelling(rows)}
    assert got == want and max(len(r) - len(w) for w, (_, r) in want.items()) >= 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcé", min_size=5, max_size=7), min_size=1, max_size=60, unique=True))
def test_tree_finds_all_near_words(words):
    for la in range(5, 8):
        for lb in (la, la + 1):
            a, b = ([w for w in words if len(w) == n] for n in (la, lb))
            if a and b:
                q, p = spelling.near_pairs(a, b)
                got = sorted(zip(q.tolist(), p.tolist(), strict=True))
                def near(x, y):
                    return sum(c != d for c, d in zip(x, y, strict=True)) == 1 if la == lb else any(y[:i] + y[i + 1:] == x for i in range(lb))
                assert got == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if near(x, y)]


# ---- 12: ranked lexical search

def found(docs, items, **k):
    return [(r.item_id, r.rank, r.doc_id, r.score) for r in lexsearch.search(docs, items, **k).collect()]


def test_search_of_the_table(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert ranked(found(docs, items)) == ranked(brute.lexical(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect()))


def test_search_of_awkward_rows(spark, docs, awkward, no_docs, monkeypatch):
    texts = [(1, "w1x w2x one two changed Mail"), (2, "ONE"), (2, "two, w7x"), (3, None), (4, "?!"), (None, "w3x w4x"), (5, "é😀 w9x"), (6, "nothing_like_it"), (7, awkward[6][1])]
    items = spark.createDataFrame(texts, "item_id long, text string").withColumn("term", F.lit(1)).withColumn("rank", F.lit(2))
    want = ranked(brute.lexical(plain(awkward), texts))
    assert ranked(found(docs, items)) == want
    monkeypatch.setattr(lexsearch, "BLOCK_TERMS", 30)  # items in several blocks
    monkeypatch.setattr(lexsearch, "CHUNK", 7)
    monkeypatch.setattr(lexsearch, "LEAF", 2)
    assert ranked(found(docs, items)) == want
    assert found(no_docs, items) == [] and found(docs, items.limit(0)) == []


def test_ball_trees_prune_and_stay_exact():
    """On grouped rows a search leaves most rows unscored, and finds the same as scoring all."""
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(40, 6, replace=False)) + 40 * (i // 200) for i in range(2000)]
    cols, lengths = np.concatenate(rows), np.full(2000, 6)
    values = rng.integers(1, 1_000_000, len(cols))
    tree, scored = lexsearch.BallTree(cols.copy(), values.copy(), lengths.copy()), 0
    for g in range(10):
        terms = np.sort(rng.choice(40, 5, replace=False)) + 40 * g
        weight = rng.integers(1, 9000, 5)
        best = lexsearch.Best(10)
        best.names = list(range(2000))
        scored += tree.search(terms, weight, best)
        dense = np.zeros(400, dtype=np.int64)
        dense[terms] = weight
        scores = (dense[cols] * values).reshape(2000, 6).sum(axis=1)
        want = sorted((-int(s), i) for i, s in enumerate(scores) if s > 0)[:10]
        assert sorted((-s, -d) for s, _, d in best.rows) == want
    assert scored < 10 * 2000 / 3


# ---- 13: packing

def check(frame, rows, **k):
    got = pack.pack(frame, JSON, with_ids=True, **k).collect()
    want = brute.packed(rows, LIBRARY, got, **{a: b for a, b in k.items() if a == "window"})
    # the pieces of one document follow each other in the stream
    stream = sorted(got, key=lambda p: (p.sequence_id, p.offset))
    have: dict = {}
    i = 0
    while i < len(stream):
        first, ids = stream[i], []
        assert first.start == 0
        while len(ids) < first.doc_tokens:
            p = stream[i]
            assert (p.doc_id, p.doc_tokens, p.start, p.length) == (first.doc_id, first.doc_tokens, len(ids), len(p.ids))
            raw = np.array(p.ids, dtype="<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(raw)
            ids += p.ids
            i += 1
        key = first.doc_id, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        have[key] = have.get(key, 0) + 1
    assert have == want


def test_packing(spark, docs, awkward, no_docs, monkeypatch):
    given_docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(given_docs.repartition(5), plain(given_docs.select("doc_id", "text").collect()))
    special = [(1, "a<|endoftext|>b <|endoftext|> c"), (1, "<|endoftext|>"), (2, "՘x \U0001d6a6 mixed ‘quotes’ naïve 中文 한국어")]
    frame = docs.unionByName(spark.createDataFrame(special, "doc_id long, text string"), allowMissingColumns=True)
    check(frame, plain(awkward) + special)
    monkeypatch.setattr(pack, "BLOCK", 2)  # several blocks of partitions
    check(frame.repartition(7), plain(awkward) + special, window=100)
    assert pack.pack(no_docs, JSON).count() == 0


TOKENIZER = open(JSON, encoding="utf-8").read()
RANKS = pack.ranks(TOKENIZER)
CODER = pack.Coder(TOKENIZER, RANKS)


def test_fast_merging_is_shown_to_agree():
    assert RANKS is not None and len(RANKS) == 50256
    raw = lambda *pairs: [tuple(x.encode() for x in p) for p in pairs]
    assert pack.agrees(raw("ab", ("ab", "c")))
    # here "bc" is merged first, so the bytes of "abc" never meet as "ab", "c"
    assert not pack.agrees(raw("bc", "ab", ("ab", "c")))
    assert not pack.agrees(raw("ab", "bc", ("ab", "c"), ("a", "bc")))
    slow = pack.Coder(TOKENIZER, None)
    assert slow.encode("The quick <|endoftext|> ½ \u1c89") == CODER.encode("The quick <|endoftext|> ½ \u1c89")


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aab \n\t'stre\x85\xa0\x1c1½ ")), max_size=120))
def test_ids_are_the_library_s(text):
    assert np.frombuffer(CODER.encode(text), CODER.kind).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_queries_are_registered():
    assert {"op11_spelling", "op12_lexical_search", "op13_packing"} <= set(queries.QUERIES)
    assert "op12_lexical_search" in queries.SQL
