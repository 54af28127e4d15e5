"""Each operator against a plain version, on awkward rows and on the smallest table."""

import base64
import hashlib
import math
import tracemalloc
import unicodedata
from collections import Counter

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricmart.llm import ann, bpe, decontam, jaccard, langid, pii, quality, secrets, shard, suffix_dedup
from metricmart.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def both(spark, docs, awkward):
    """(frame, plain rows) for the awkward documents and the given table."""
    given_docs = table(spark, "documents")
    return ((docs, [(r[0], r[1]) for r in awkward]), (given_docs, [(r.doc_id, r.text) for r in given_docs.collect()]))


def ranked(rows):
    return sorted(rows, key=repr)


# ---- 1: byte-level BPE

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_bpe_matches_the_library(spark, docs, awkward):
    for frame, plain in both(spark, docs, awkward):
        want = []
        for d, t in plain:
            ids = REFERENCE.encode_ordinary(t or "")
            want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert ranked(tuple(r) for r in bpe.round_trip(frame, tokenizer()).collect()) == ranked(want)


CODEC = tokenizer()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"], max_codepoint=0x2FFF), st.sampled_from("aab \n\t'stre\x85\xa0 ")), max_size=200))
def test_bpe_of_any_text(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_bpe_of_long_words():
    for text in ("a" * 20_000, "ab" * 9_000, "thethe" * 3_000, "".join(np.random.default_rng(1).choice(list("abcdefg"), 20_000))):
        assert CODEC.encode(text) == REFERENCE.encode_ordinary(text)


def test_bpe_columns_and_words(spark, docs):
    rows = bpe.decode(bpe.encode(docs, CODEC), CODEC)
    assert rows.where("decoded <> cast(coalesce(text, '') AS binary)").count() == 0
    words = ["the", " quick", "brôwn", "ababababab", "", "xyzzyqj", "aaaaaaaaa"]
    got = bpe.encode_words(spark.createDataFrame([(w,) for w in words * 2], "word string"), RANKS).collect()
    assert {r.word: list(r.ids) for r in got} == {w: list(CODEC.fold(w.encode())) if w else [] for w in words}


def test_bpe_of_nothing(no_docs):
    assert bpe.round_trip(no_docs, CODEC).count() == 0


# ---- 2: nearest neighbours

def plain_neighbours(rows, k=20):
    rows = [(i, np.array(v, dtype=float)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v))]
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-float(sum(a * b for a, b in zip(v, w))), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_neighbours_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plain_neighbours([(r.vec_id, r.embedding) for r in vectors.collect()])
    got = {}
    for r in ann.neighbours(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and q not in [i for i, _ in near]


def test_neighbours_of_awkward_rows(spark):
    rng = np.random.default_rng(2)
    one = [float(x) for x in rng.normal(size=6)]
    rows = [(0, one), (20, one), (20, one), (40, None), (60, []), (80, [0.0] * 6), (100, [1.0, None]), (120, [float("nan")] * 6), (140, [float("inf"), 1.0]),
            (None, one), (160, [1.0, 2.0]), *[(i, one) for i in range(1, 60) if i % 20], *[(i, [float(x) for x in rng.normal(size=6)]) for i in range(200, 240)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("v", F.lit(2))
    padded = [(i, v + [0.0] * (6 - len(v)) if v else v) for i, v in rows]
    want = plain_neighbours(padded)
    got = {}
    for r in ann.neighbours(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert ann.neighbours(frame.limit(0)).count() == 0
    assert ann.neighbours(frame.where("vec_id = 40")).count() == 0


def test_neighbours_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 400)
    monkeypatch.setattr(ann, "MOST_BLOCK", 400)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 12))
    rows = [(5 * i, [float(x) for x in centres[i % 8] + 0.3 * rng.normal(size=12)]) for i in range(1800)]  # 5 blocks, 2 of queries
    assert ann.block_size(1800, 12) == 400
    want = plain_neighbours(rows)
    got = {}
    for r in ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    assert set(got) == set(want) and all(len(near) == 20 and near == sorted(near, key=lambda x: (-x[1], x[0])) for near in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.97


def test_neighbours_cost_less_a_vector_in_larger_tables():
    """Entries walked and vectors reranked for a query grow slower than the table, at the same recall."""
    rng = np.random.default_rng(5)
    basis = rng.normal(size=(8, 64))

    def cost(n):
        vectors = rng.normal(size=(n, 8)) @ basis
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        first, queries = np.arange(n), vectors[:40]
        block = ann.Block(vectors, 1.0, vectors[-ann.pivot_count(n, 64):])
        order = ann.nearest_pivots(queries, 1.0, block.pivots, query=True)
        share = np.quantile(np.concatenate([x for _, _, x in block.needed(queries, 21, first)]), ann.AIM)
        found = [set(near.tolist()) for near, _ in block.search(queries, 21, first, share)]
        true = [set(np.argsort(-(vectors @ q), kind="stable")[:21].tolist()) for q in queries]
        assert np.mean([len(a & b) / 21 for a, b in zip(found, true, strict=True)]) >= 0.99
        walked = np.mean([sum(block.ends[p + 1] - block.ends[p] for p in o) for o in order.tolist()])
        return walked + max(ann.LEAST, share * n)

    small, large = cost(4_000), cost(64_000)
    assert large < 16 ** 0.75 * small


@pytest.mark.parametrize("scale", [1.0, 1e150, 1e-150, 1e200, 1e-200])
def test_neighbours_single_precision_loses_none(scale):
    """What is put aside in single precision isn't among the best, ties and products that differ by less than its error included."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3000, 20))
    vectors[500:900] = vectors[0] + 1e-9 * rng.normal(size=(400, 20))
    vectors[900:1000] = vectors[1]
    vectors *= scale
    with np.errstate(all="ignore"):
        block = ann.Block(vectors, float(np.sqrt((vectors ** 2).sum(axis=1).max())), vectors[-128:])
        every, first = np.arange(3000), rng.permutation(3000)
        for q in (vectors[0], vectors[1], vectors[2], *rng.normal(size=(5, 20))):
            score = vectors @ q
            kept = block.likely(every, q, 21)
            assert block.best(kept, score[kept], 21, first)[0].tolist() == block.best(every, score, 21, first)[0].tolist()
            if scale == 1.0:
                assert len(kept) < 600


# ---- 3: Jaccard join

def test_jaccard_links(spark, docs, awkward):
    plain = [(r[0], r[1]) for r in awkward]
    got = jaccard.link(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    keyed = [(d, t) for d, t in plain if d is not None]
    want = brute.jaccard(keyed) + [(None, len(brute.shingles(t)), None) for d, t in plain if d is None]
    assert ranked(tuple(r) for r in got.collect()) == ranked(want)
    given_docs = table(spark, "documents")
    assert ranked(tuple(r) for r in jaccard.link(given_docs).collect()) == ranked(brute.jaccard([(r.doc_id, r.text) for r in given_docs.collect()]))


def test_jaccard_chains_and_thresholds(spark):
    """Families at and just below the threshold, whose first member links to few of the others."""
    rows, i = [], 0
    for family in range(6):
        base = [f"f{family}t{k}" for k in range(104)]
        for cut in range(0, 60, 3):
            rows.append((i, " ".join(base[cut:] + [f"f{family}c{cut}n{k}" for k in range(cut // 4)])))
            i += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ranked(tuple(r) for r in jaccard.link(frame).collect()) == ranked(brute.jaccard(rows))


def test_jaccard_keeps_one_of_each(spark, docs, awkward, no_docs):
    kept = Counter((r.doc_id, r.text) for r in jaccard.first_of_each(docs).collect())
    rows = [(r[0], r[1]) for r in awkward]
    at = brute.jaccard([(i, t) for i, (_, t) in enumerate(rows)])  # each row its own node
    groups, want = {}, Counter()
    for (i, n, c) in at:
        groups.setdefault((c, n == 0 and i), []).append(rows[i])
    for members in groups.values():
        want[min(members, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))] += 1
    assert kept == want
    twice = spark.createDataFrame([(1, "a clean text of some six words"), (1, "and quite another one that has nothing in common"), (None, "no id but the same words here"),
                                   (None, "no id but the same words here"), (2, "no id but the same words here"), (3, "x"), (3, "x"), (4, None), (4, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in jaccard.first_of_each(twice).collect())
    assert got == Counter([(1, "a clean text of some six words"), (1, "and quite another one that has nothing in common"), (2, "no id but the same words here"), (3, "x"), (4, None), (4, None)])
    assert jaccard.link(no_docs).count() == 0 and jaccard.first_of_each(no_docs).count() == 0


def test_rtree_join_loses_no_pair():
    rng = np.random.default_rng(4)
    sizes = rng.integers(20, 200, 300)
    counts = np.stack([np.bincount(rng.integers(0, jaccard.GROUPS, n), minlength=jaccard.GROUPS) for n in sizes])
    counts[150:] = counts[:150]
    sizes[150:] = sizes[:150]
    tree, part = jaccard.Tree(counts, sizes), jaccard.Tree(counts[:40], sizes[:40])
    for a, b, n in ((tree, tree, 300), (tree, part, 40), (part, tree, 300)):
        found = {(int(x), int(y)) for xs, ys in a.join(b) for x, y in zip(xs, ys)}
        m = len(a.order)
        want = {(x, y) for x in range(m) for y in range(n) if 100 * min(sizes[x], sizes[y]) >= 80 * max(sizes[x], sizes[y])
                and jaccard.possible(np.minimum(counts[x], counts[y]).sum(), sizes[x] + sizes[y])}
        assert found == want


def test_pairs_of_a_large_group_are_found_in_bounded_memory():
    """One slab of near copies, all of which may link: neither the tree's nodes nor the pairs found are held at once."""
    rng = np.random.default_rng(11)
    n, size = 1500, 200
    counts = np.stack([np.bincount(rng.integers(0, jaccard.GROUPS, 4), minlength=jaccard.GROUPS) for _ in range(n)]) + 2
    pdf = pd.DataFrame({"slab": 1, "i": 0, "j": 0, "piece": 0, "sid": np.arange(n), "c": np.arange(n), "n": size,
                        "counts": [jaccard.packed(c.astype(np.uint8)) for c in counts]})
    held = seen = 0
    tracemalloc.start()
    try:
        got = jaccard._slab_pairs(pdf)
        for frame in [got] if isinstance(got, pd.DataFrame) else got:
            held, seen = max(held, len(frame)), seen + len(frame)
            assert (frame["a"] < frame["b"]).all()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen >= n * (n - 1) // 2
    assert held <= jaccard.HELD + jaccard.STEP and peak < 60e6, (held, peak)


def test_large_slabs_pair_only_points_beside_the_largest_component(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SLAB", 4)
    points = [(1, s, 7) for s in range(200)] + [(1, 200, 8)] + [(2, s, 5) for s in range(6)] + [(3, s, s % 5) for s in range(23)]
    slim = spark.createDataFrame([(s, 1, b"") for s in range(201)], "sid long, n long, counts binary")
    rows = jaccard.tasks(spark.createDataFrame(points, "slab long, sid long, c long"), slim).collect()
    met, component = set(), {(slab, s): c for slab, s, c in points}
    by = {}
    for r in rows:
        by.setdefault((r.slab, r.i, r.j), []).append(r)
    for (slab, i, j), group in by.items():
        met |= {(slab, x.sid, y.sid) for x in group for y in group if {x.piece, y.piece} == {i, j} and x.sid < y.sid}
    want = {(slab, x, y) for slab, x in component for other, y in component if slab == other and x < y and component[slab, x] != component[slab, y]}
    assert want <= met
    assert sum(r.slab == 1 for r in rows) <= 2 * 201 and not any(r.slab == 2 for r in rows)


# ---- 4: personal data

def test_pii_base_spans(spark, docs, awkward):
    for frame, plain in both(spark, docs, awkward):
        got = pii.report(frame).collect()
        assert ranked((r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in got) == ranked((d, *brute.pii(t)) for d, t in plain)


def test_pii_accepts_by_threshold(spark):
    """Trees that say yes to everything: additions never overlap what stays."""
    frame = spark.createDataFrame([(1, "write to jo (at) site (dot) org, card 4111 1111 1111 1112, a@b.cd", "x"), (2, None, "y")], "doc_id long, text string, base string")
    model = pii.Model([(0, 0.0, 0.0, 1.0)], [1.0], dict.fromkeys(pii.KINDS, 0.5))
    got = {r.doc_id: r for r in pii.annotate(frame, model).collect()}
    assert [(s["kind"], s["match"]) for s in got[1].base] == [("email", "a@b.cd")]
    assert [(s["kind"], s["match"]) for s in got[1].added] == [("email", "jo (at) site (dot) org"), ("card", "4111 1111 1111 1112")]
    assert [r.text for r in pii.redact(frame, model).orderBy("doc_id").collect()] == ["write to [EMAIL], card [CARD], [EMAIL]", None]


def test_pii_learns_and_redacts(spark, no_docs):
    given_docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(given_docs)
    assert model.trees
    left = pii.redact(given_docs, model).select(pii.base_spans(F.col("text")).alias("s")).where("size(s) > 0").count()
    assert left == 0
    assert pii.report(no_docs).count() == 0


def test_pii_adds_loose_forms_and_leaves_other_numbers(spark):
    def luhn(body):
        total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(body)))
        return body + str(-total % 10)

    loose, other, rows = {}, {}, []
    for i in range(600):
        card = luhn(f"4{i * 7919 % 10**14:014d}")
        wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
        dotted = lambda c: ".".join(c[k:k + 4] for k in range(0, 16, 4))
        loose[i] = {("email", f"jo{i} (at) site{i % 9} (dot) org"), ("card", dotted(card)), ("phone", f"({200 + i}) 010-{1000 + i}")}
        other[i] = [f"10.{i % 90}.{300 + i}.4", f"{7000000000 + i * 9973}", dotted(wrong), f"2024-{i % 12 + 1:02d}-{i % 28 + 1:02d}"]
        mail, number, phone = (next(m for k, m in loose[i] if k == kind) for kind in ("email", "card", "phone"))
        rows.append((i, f"Write to {mail} today. The card {number} was used, so call {phone} soon. This is version {other[i][0]} of the text; "
                        f"invoice {other[i][1]} is open. The long code {other[i][2]} came in on the day {other[i][3]} and a@b{i}.cd wrote."))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.annotate(frame, pii.fit(frame)).collect():
        assert {(s["kind"], s["match"]) for s in r.added} == loose[r.doc_id]
        assert not any(x in s["match"] for s in r.base for x in other[r.doc_id])


def test_pii_learns_from_all_documents(spark):
    """A form that one document in five hundred bears has support enough over all of them, in which copies count once."""
    filler = spark.range(60_000).select("id", F.concat(F.lit("plain words of text "), F.col("id").cast("string"), F.lit("x")).alias("text"))
    loose = spark.range(120).select("id", F.concat(F.lit("so call ("), (F.col("id") + 200).cast("string"), F.lit(") 010-1234 soon")).alias("text"))
    copies = spark.range(500).select("id", F.lit("so write to jo (at) site (dot) org soon").alias("text"))
    assert set(pii.fit(filler.union(loose).union(copies)).thresholds) == {"phone"}


# ---- 5: repeats

def test_repeats(spark, awkward):
    rows = [(r[0], r[1]) for r in awkward]
    keyed = list(dict((d, t) for d, t in rows if d is not None).items())
    frame = spark.createDataFrame(keyed, "doc_id long, text string").withColumn("c", F.lit(1)).repartition(4)
    got = suffix_dedup.report(frame)
    assert ranked(tuple(r) for r in got.collect()) == ranked(brute.repeats(keyed))
    given_docs = table(spark, "documents")
    assert ranked(tuple(r) for r in suffix_dedup.report(given_docs).collect()) == ranked(brute.repeats([(r.doc_id, r.text) for r in given_docs.collect()]))


def test_repeats_of_awkward_rows(spark, docs, awkward, no_docs):
    got = suffix_dedup.report(docs).collect()
    assert len(got) == len(awkward)
    for r in got:
        assert 0 <= r.n_removed <= r.n_bytes and (r.n_spans > 0) == (r.n_removed > 0)
    assert sum(r.n_removed < r.n_bytes for r in got if r.n_bytes == len(awkward[6][1])) <= 3  # of the copies of one text only the first stays
    assert suffix_dedup.report(no_docs).count() == 0


def test_repeats_of_low_entropy(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, "".join(rng.choice(list("ab"), p=[0.97, 0.03], size=int(rng.integers(90, 700))))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = ranked(brute.repeats(rows))
    assert ranked(tuple(r) for r in suffix_dedup.report(frame).collect()) == want
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 1)  # every anchor goes the way of the frequent ones
    monkeypatch.setattr(suffix_dedup, "CELLS", 1 << 16)
    assert ranked(tuple(r) for r in suffix_dedup.report(frame).collect()) == want


def test_repeats_of_frequent_anchors_in_no_frequent_cell(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, "".join(rng.choice(list("ab"), p=[0.97, 0.03], size=int(rng.integers(90, 700))))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 2)
    monkeypatch.setattr(suffix_dedup, "CELLS", 1)  # no cell is above the mean then
    assert ranked(tuple(r) for r in suffix_dedup.report(frame).collect()) == ranked(brute.repeats(rows))


def test_log_index():
    index, seen = suffix_dedup.LogIndex(), set()
    rng = np.random.default_rng(1)
    for _ in range(200):
        keys = rng.integers(0, 5000, int(rng.integers(0, 60))).astype(np.uint64)
        want = []
        for k in keys.tolist():
            want.append(k in seen)
            seen.add(k)
        assert index.scan(keys).tolist() == want
    assert len(index.levels) <= 13 and sum(map(len, index.levels)) == len(seen)


# ---- 6: decontamination

def plain_contaminated(docs, items):
    out = {}
    for d, t in docs:
        w = decontam.words_of(t)
        for i, text in items:
            size = min(len(decontam.words_of(text)), len(w))
            width = min(5, len(decontam.words_of(text)))
            if not size or size < width:
                continue
            iw = decontam.words_of(text)
            b = Counter(tuple(iw[k:k + width]) for k in range(len(iw) - width + 1))
            for s in range(len(w) - size + 1):
                a = Counter(tuple(w[s + k:s + k + width]) for k in range(size - width + 1))
                inter, union = sum((a & b).values()), sum((a | b).values())
                if 100 * inter >= 80 * union and inter / union > out.get((d, i), (0,))[0]:
                    out[d, i] = (inter / union, s)
    return out


def test_decontamination(spark, awkward, no_docs):
    items = [(1, awkward[11][1]), (2, awkward[11][1]), (3, None), (4, ""), (5, "one two"), (6, "nothing like it in any of these documents at all"), (7, awkward[6][1])]
    rows = [(r[0], r[1]) for r in awkward if r[0] not in (None, 42, 45)]
    rng = np.random.default_rng(5)
    passage = awkward[11][1].split()
    for i in range(40):  # passages with words changed, around the threshold
        p = list(passage)
        for at in rng.integers(0, len(p), int(rng.integers(0, 4))):
            p[at] = f"new{i}"
        rows.append((1000 + i, " ".join(["before"] * int(rng.integers(0, 5)) + p + ["after"] * int(rng.integers(0, 5)))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontam.contaminated(frame, bench).collect()}
    assert got == plain_contaminated(rows, items)
    kept = decontam.clean(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in got}
    assert decontam.contaminated(frame, bench.limit(0)).count() == 0
    assert decontam.contaminated(no_docs, bench).count() == 0


def test_block_files_find_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(6)
    items = [(i, 1, *np.unique(rng.integers(0, 1 << 63, 30).astype(np.uint64), return_counts=True)) for i in range(50)]
    group = decontam.Group(items)
    bits = np.unpackbits(group.prints, axis=1)
    prints = []
    for i in range(2000):  # 50 to 79 bits off some item, at random or as unevenly as can be
        off = int(rng.integers(50, 80))
        flip = rng.permutation(256)[:off] if i % 2 else (np.arange(off) + int(rng.integers(0, 256))) % 256
        p = bits[i % 50].copy()
        p[flip] ^= 1
        prints.append(np.packbits(p))
    prints = np.array(prints)
    away = (np.unpackbits(prints, axis=1)[:, None] != bits[None]).sum(axis=2)
    assert list(group.within(prints)) == [tuple(x) for x in np.argwhere(away <= decontam.RADIUS).tolist()]


def test_decontamination_in_chunks(spark, monkeypatch):
    text = "a passage of the benchmark that some document holds from its first word to its last"
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, text) for i in range(20)] + [(3, text)], "item_id long, text string")
    monkeypatch.setattr(decontam, "CHUNK_ITEMS", 3)
    assert len([c for c in decontam._chunks(bench) if c]) > 2
    assert sorted(r.item_id for r in decontam.contaminated(docs, bench).collect()) == sorted([*range(20), 3])
    assert [r.doc_id for r in decontam.clean(docs, bench).collect()] == [2]


def test_decontamination_of_the_table(spark):
    d, b = table(spark, "documents"), table(spark, "benchmark")
    want = plain_contaminated([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()])
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontam.contaminated(d, b).collect()} == want


# ---- 7: sharding

def test_sharding(spark, docs, awkward, no_docs):
    import zlib

    for frame, plain in both(spark, docs, awkward):
        got = shard.shard(frame).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in plain)
        largest, total = max(r.size for r in got), sum(r.size for r in got)
        by = {}
        for r in got:
            assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
            by.setdefault(r.shard, []).append(r)
        for rows in by.values():
            assert sorted(r.slot for r in rows) == list(range(len(rows)))
            assert abs(sum(r.size for r in rows) - total / 40) <= largest
    assert shard.shard(no_docs).count() == 0


def test_sharding_of_one_text(spark):
    frame = spark.range(4000).selectExpr("id AS doc_id", "'the same text for all of them' AS text")
    sizes = Counter(r.shard for r in shard.shard(frame).collect())
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1


# ---- 8: secrets

def test_secrets_base_spans(spark, docs, awkward):
    for frame, plain in both(spark, docs, awkward):
        got = secrets.report(frame).collect()
        assert ranked((r.doc_id, [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in got) == ranked((d, *brute.secrets(t)) for d, t in plain)


def test_secrets_added_and_empty(spark, no_docs):
    frame = spark.createDataFrame([(1, "x -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890a ghp_" + "Z9" * 18)], "doc_id long, text string")
    spans = [s.split(":") for s in secrets.report(frame).first().spans.split(",")]
    assert [s[0] for s in spans] == ["private_key", "chat_token", "code_host"]
    assert secrets.report(no_docs).count() == 0


@pytest.mark.parametrize("pattern, text", [("abc+d?ef", "abccef"), ("(foo|ba[rz])qux", "bazqux"), ("x?yz[01]w", "yz1w"), ("(ab){2}cd", "ababcd"), ("[a-z]+", "q"), ("ab([0-9]+)cd", "ab1cd"), ("ab[0-9]?cd", "ab1cd"), ("ab[0-9]?cd", "abcd"), ("x(ab|c[0-9]d)yz", "xc7dyz"),
                                           ("(abc[0-9]*def)+ghi", "abc1defghi"), ("ab(c(d[0-9]e)f)gh", "abcd5efgh"), (secrets.ASSIGN, "api_key=12345678")])
def test_trigram_queries_hold_for_matches(pattern, text):
    grams = {text[i:i + 3] for i in range(len(text) - 2)}
    assert any(q <= grams for q in secrets.trigram_query(pattern))


# ---- 9: language

def test_language(spark, docs, awkward, no_docs):
    given_docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_report(given_docs).join(given_docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang_pred = lang").count() / got.count() >= 0.97
    rows = langid.language_report(docs).collect()
    assert len(rows) == len(awkward)
    texts = {r[0]: r[1] for r in awkward}
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(unicodedata.category(c)[0] == "L" for c in texts[r.doc_id] or ""))
    assert langid.language_report(no_docs).count() == 0
    unlabelled = langid.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_number_signs_are_no_letters(spark):
    texts = ["² ³ ¹", "½ ¼ ⅔", "① ② ⑳ ⒈", "Ⅷ ⅳ ↂ", "१२३ ٣٤ ๕", "٪ ‰ № 7", "ª", "ʰ", "中文", "Ⅷ the"]
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)] + [(100 + i, "the cat and the dog", "en") for i in range(30)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_report(rows).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(6)) and all(got[i][0] == "en" for i in range(6, 10))


def test_no_word_is_cut_and_rare_languages_come_in_whole(spark, monkeypatch):
    """A small sample: the rare language keeps all its rows, and every word of the sample is in the model."""
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 40)
    monkeypatch.setattr(langid, "LEAST_ROWS", 10)
    rows = [(i, f"common{i} word", "en") for i in range(400)] + [(1000 + i, f"zzyx{i} жук", "ru") for i in range(10)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    words = set(model.words.terms.to_pylist())
    assert {"zzyx", "жук"} <= words and model.langs == ["en", "ru"] and model.predict(["жук", "word"])[0] == ["ru", "en"]


def test_language_is_learned_from_every_document(spark, monkeypatch):
    """No sample: each word stands in one document only. A model that holds few words as they are counts the others too."""
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 40)
    monkeypatch.setattr(langid, "LEAST_ROWS", 10)
    coded = lambda i, zero: "".join(chr(ord(zero) + int(c)) for c in f"{i:03}")
    words = {lang: [coded(i, zero) for i in range(400)] for lang, zero in (("en", "a"), ("fr", "k"))}
    rows = spark.createDataFrame([(400 * k + i, f"{w} word word", lang) for k, lang in enumerate(words) for i, w in enumerate(words[lang])], "doc_id long, text string, lang string")
    model = langid.fit(rows)
    assert set(model.words.terms.to_pylist()) == {"word", *words["en"], *words["fr"]} and model.words.tail is None
    assert model.words.total.tolist() == [[1200, 1200]]
    monkeypatch.setattr(langid, "HEAD", 10)
    small = langid.fit(rows)
    assert small.words.terms.to_pylist() == ["word"] and len(small.grams.terms) <= 10
    for i, lang in enumerate(small.langs):
        known, scores = small.words.look_up(pa.array(words[lang]))
        plain = model.words.look_up(pa.array(words[lang]))[1]
        assert known.all() and np.abs(scores - plain).max() < 0.02, lang
        assert small.predict(words[lang])[0] == [lang] * 400
    assert not small.words.look_up(pa.array(["unseen", "forms"]))[0].any()


@pytest.mark.parametrize(("base", "count", "head", "whole"), [(10, 20_000, 0, [False, False]), (10, 20_000, 400, [False, False]), (10, 700, 4500, [True, False]), (2, 20_000, 400, [False, True])])
def test_no_count_is_estimated_beyond_the_head(spark, monkeypatch, base, count, head, whole):
    """Terms that workers don't hold count as they are, however rare among however many: words met once, n-grams of unseen words."""
    coded = lambda i, zero: "".join(chr(ord(zero) + i // base ** k % base) for k in range({10: 5, 2: 15}[base]))
    firsts = {10: "afk", 2: "abc"}[base]  # languages share letters
    words = {lang: [coded(7 * i, zero) for i in range(count)] for lang, zero in zip(("en", "fr", "xx"), firsts, strict=True)}
    rows = [(lang, " ".join(own[i:i + 50]) + f" the {lang}") for lang, own in words.items() for i in range(0, count, 50)]
    rows += [("en", "both both le le"), ("fr", "both le le le"), ("fr", None), ("en", "")]
    monkeypatch.setattr(langid, "HEAD", head)
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    plain = brute.Language([r for r in rows if r[1]])
    texts = [t for _, t in rows[::60]] + [w for own in words.values() for w in own[::count // 40]]
    texts += [f"{coded(i, z)}x{coded(3 * i, z)} unseen é {coded(i, z)}" for i in range(0, 700, 30) for z in firsts]
    texts += ["both", "le both", "zzz 中文 zzz zzz", "中", "x", "", None, "12 ½", " ".join(t or "" for _, t in rows)] + [rows[0][1]] * 3
    docs = spark.createDataFrame([(t, i % 3 or None) for i, t in enumerate(texts)], "text string, row int").repartition(3)
    got = langid.identify(docs, model).collect()
    assert Counter((r.text, r.row) for r in got) == Counter((t, i % 3 or None) for i, t in enumerate(texts))
    for r in got:
        pred, score = plain.predict(r.text)
        assert r.lang_pred == pred and abs(r.score - score) < 1e-5, (r, pred, score)
    some = texts[::9]
    for t, pred, score in zip(some, *model.predict(some), strict=True):
        assert pred == plain.predict(t)[0] and abs(score - plain.predict(t)[1]) < 1e-5, t
    assert [model.words.whole, model.grams.whole] == whole and len(model.words.terms) <= head and len(model.grams.terms) <= head


def test_language_scores_row_by_row(spark):
    """The batch scorer against a plain one, word by word, from the same counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL")
    rows = [(r.lang, r.text) for r in docs.collect()]
    model = langid.fit(docs)
    plain = brute.Language(rows)
    texts = [t for _, t in rows[:60]] + ["unseenwordforms qqq", "zzz", "x", "Été naïve", "", None, "12 ½"]
    pred, score = model.predict(texts)
    for t, a, s in zip(texts, pred, score, strict=True):
        b, want = plain.predict(t)
        assert a == b and abs(s - want) < 1e-4, (t, a, b, s, want)


# ---- 10: quality

def test_quality(spark, docs, awkward, no_docs):
    given_docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_report(given_docs, labels).join(labels, "doc_id").where("held_out")
    assert got.where("predicted = quality").count() / got.count() >= 0.95
    few = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(awkward)] + [(3, None), (None, 1), (6, 7)], "doc_id long, quality int")
    rows = quality.quality_report(docs, few).collect()
    assert len(rows) == len(awkward) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {r.score for r in quality.quality_report(docs, few.limit(0)).collect()} == {0.5}
    assert quality.quality_report(no_docs, few).count() == 0


def test_quality_scores_row_by_row(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    model = quality.Additive(x, (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float))
    assert model.pairs

    def place(j, value):
        return sum(1 for cut in model.cuts[j] if cut <= value)

    def plain(row):
        total = model.intercept + sum(float(t[place(j, row[j])]) for j, t in enumerate(model.tables))
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            a, b = (place(f, row[f]) * quality.PAIR_BINS // len(model.tables[f]) for f in (i, j))
            total += float(t[a * quality.PAIR_BINS + b])
        return 1 / (1 + math.exp(-total))

    others = rng.normal(size=(100, len(quality.FEATURES))) * 3
    assert np.allclose(model.score(others), [plain(r) for r in others], rtol=0, atol=1e-12)


def test_quality_of_a_document_with_very_many_labels(spark):
    docs = spark.createDataFrame([(i, "good words here. " * 5 if i % 2 else "@@@ 000 @@@") for i in range(40)] + [(1, "good words here. " * 5)] * 3, "doc_id long, text string")
    rows = quality.featurise(docs)
    labels = [(i, i % 2) for i in range(40)]
    hot = spark.createDataFrame(labels + [(1, 1)] * 2000 + [(1, 0)] * 10, "doc_id long, quality int")
    model = quality.fit(rows, hot)
    x = np.array([r.x for r in rows.where("doc_id IN (1, 2)").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()])
    good, bad = model.score(x)
    assert good > 0.95 and bad < 0.5
    once, again = (quality.fit(rows, spark.createDataFrame(some, "doc_id long, quality int")) for some in (labels, labels[::-1]))
    assert np.array_equal(once.score(x), again.score(x))
    assert once.intercept == 0.0  # a document that is there several times counts once
