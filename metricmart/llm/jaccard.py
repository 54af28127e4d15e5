"""N-gram Jaccard join by count-vector R-trees.

A document's set is its distinct 5-word shingles, hashed to 64 bits. Two documents link when
100 * intersection >= 80 * union. Documents with equal sets are one point.

* Points: the shingles of a set are hashed into groups and counted. The overlap of two sets is at
  most the sum over groups of the smaller count (with a node of the tree: of the node's largest).
  Larger sets have more groups; nodes are kept for the ``GROUPS`` that these fold into.
* Slabs: sets that overlap in at least 80 % of the larger one have a common shingle among the
  n - ceil(0.8 n) + 1 first of either in any fixed order of all shingles. The order puts those
  from rarely used hash groups first (``RARITY_GROUPS`` counters over all documents), so that what
  very many documents share comes last. Each such shingle is the key of a slab of the space, and
  the points with that key lie in it. Slabs of equal membership are one.
* Within a slab, points are first paired with the slab's most central point and verified. What that leaves
  unconnected goes through the slab's R-tree, joined with itself from the root down: pairs of nodes
  survive only if their bound and their sizes allow a link. (A slab of up to ``PAIRWISE`` points is
  one node, whose pairs are bounded directly.) Surviving pairs of points that aren't
  connected yet are verified on the texts. Slabs of more than ``SLAB`` points are joined piece by
  piece, so no task holds more than two pieces.

Only links that could still join two components are verified; no other can change the result. Links
are exact but for 64-bit hash collisions. Neither points, links nor components come to the driver.

Defined results: null, empty and blank texts have no shingles and link with nothing (their component
is their own id); a text of fewer than five words has one shingle; rows with one id are one node;
a row without an id has component null; an empty table gives an empty result; other columns are
ignored by ``link`` and kept by ``first_of_each``, which goes by texts alone.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import SIMILARITY, components, map_rows, on_executors, shingle_hashes, sized, stored, word_hashes, words_of

PART, WHOLE = SIMILARITY
GROUPS = 128  # of the smallest sets, and of the trees
RARITY_BITS = 16
RARITY_GROUPS = 1 << RARITY_BITS
SLAB = 4096
PAIRWISE = 16  # points of a slab up to which it is a leaf, whose pairs are bounded directly
CHUNK = 1 << 14  # points that a task looks at together
FAN = 16  # children of a node
STEP = 1 << 10  # pairs of nodes that a task compares at a time
HELD = 1 << 18  # pairs of points that a task holds before it hands them on
_ID, _DIGEST = "__id", "__digest"


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes of a whole text."""
    return np.unique(shingle_hashes(word_hashes(words_of(text))))


def set_id(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def count_vector(h: np.ndarray) -> np.ndarray:
    """Shingles per group, a byte each (255: that many or more). The number of groups is a power of
    two of at least half the set's size, so a group holds two shingles on average in any set."""
    groups = max(GROUPS, 1 << int(len(h) // 2).bit_length())
    return np.minimum(np.bincount((h % np.uint64(groups)).astype(np.int64), minlength=groups), 255).astype(np.uint8)


def packed(counts: np.ndarray) -> bytes:
    """A count vector for the shuffle: most counts are small, so it packs to a third."""
    return zlib.compress(counts.tobytes(), 1)


def unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), dtype=np.uint8)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The vector for fewer groups: theirs are unions of the finer ones."""
    return counts.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def overlap_bound(a: bytes, b: bytes) -> int:
    """An upper bound on the overlap of two sets (by packed counts), at the finest grouping that both have."""
    a, b = unpacked(a), unpacked(b)
    if len(a) > len(b):
        a, b = b, a
    if b.max() == 255:  # cut off: says nothing
        return 1 << 60
    return int(np.minimum(a, b).sum(dtype=np.int64) if len(a) == len(b) else np.minimum(a, folded(b, len(a))).sum())


def rarity(docs: DataFrame) -> np.ndarray:
    """How often each of a fixed number of hash groups occurs in the sets of all documents."""
    def count(batches):
        total = np.zeros(RARITY_GROUPS, dtype=np.int64)
        for pdf in batches:
            sets = [shingle_set(t) for t in pdf["text"]]
            if sets:
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=RARITY_GROUPS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"g": at, "n": total[at]})

    out = np.zeros(RARITY_GROUPS, dtype=np.int64)
    for r in docs.select("text").mapInPandas(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        out[r.g] = r.n
    return out


def points(docs: DataFrame) -> DataFrame:
    """A row per document: set id and size, group counts, and the keys of the slabs it lies in."""
    spark = docs.sparkSession
    on_executors(spark)
    shared = spark.sparkContext.broadcast(rarity(docs))

    def run(texts):
        often = shared.value
        rows = []
        for text in texts:
            h = shingle_set(text)
            n = len(h)
            first = n - -(-PART * n // WHOLE) + 1 if n else 0
            order = np.lexsort((h, often[(h >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]))[:first]
            counts = count_vector(h)
            rows.append((set_id(h), n, hashlib.md5((text or "").encode("utf-8", "surrogatepass")).hexdigest(), packed(counts), h[order].view(np.int64)))
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5

    fields = StructType().add("sid", "long").add("n", "long").add("digest", "string").add("counts", "binary").add("keys", ArrayType(LongType()))
    return map_rows(docs, ["doc_id"], ["text"], fields, run)


def possible(overlap, sizes):
    """Whether an overlap of at most this much could link sets of these sizes together."""
    return (PART + WHOLE) * overlap >= PART * sizes


class Tree:
    """An R-tree over count vectors, packed in order of size; level 0 holds the points."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        # points of like size and like counts lie together
        order = np.lexsort((counts.argmax(axis=1), sizes)) if len(sizes) else np.zeros(0, dtype=np.int64)
        self.order = order
        self.levels = [(counts[order], sizes[order], sizes[order])]
        while len(self.levels[-1][1]) > 1:
            top, low, high = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append((np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def join(self, other: Tree):
        """Pairs of places (in the order given) of points whose bound and sizes allow a link."""
        depth = max(len(self.levels), len(other.levels))
        if not len(self.order) or not len(other.order):
            return
        stack = [(depth - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
        while stack:
            level, x, y = stack.pop()
            if len(x) > STEP:  # the rest waits until all below the first is done, so that a level waits with one block's children at most
                stack.append((level, x[STEP:], y[STEP:]))
                x, y = x[:STEP], y[:STEP]
            ta, la, ha = self.levels[min(level, len(self.levels) - 1)]
            tb, lb, hb = other.levels[min(level, len(other.levels) - 1)]
            fits = (WHOLE * ha[x] >= PART * lb[y]) & (WHOLE * hb[y] >= PART * la[x])
            x, y = x[fits], y[fits]
            fits = possible(np.minimum(ta[x], tb[y]).sum(axis=1), la[x] + lb[y])
            x, y = x[fits], y[fits]
            if not len(x):
                continue
            if not level:
                yield self.order[x], other.order[y]
                continue
            ca, cb = self._children(level, x), other._children(level, y)
            ia = np.repeat(ca, FAN, axis=1).ravel()
            ib = np.tile(cb, (1, FAN)).ravel()
            keep = (ia >= 0) & (ib >= 0)  # a child has one parent, so no pair comes twice
            stack.append((level - 1, ia[keep], ib[keep]))

    def _children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Places of the children one level down (-1: none); a lower tree waits at its root."""
        if level >= len(self.levels):
            out = np.full((len(nodes), FAN), -1, dtype=np.int64)
            out[:, 0] = nodes
            return out
        out = nodes[:, None] * FAN + np.arange(FAN)
        out[out >= len(self.levels[level - 1][1])] = -1
        return out


def _vectors(column) -> np.ndarray:
    """Count vectors folded to ``GROUPS``, as rows (a cut-off one passes every bound)."""
    out = np.empty((len(column), GROUPS), dtype=np.int64)
    for i, c in enumerate(column):
        v = unpacked(c)
        out[i] = folded(v, GROUPS) if v.max() < 255 else 1 << 40
    return out


def bounded(pairs: DataFrame, slim: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` of set ids that sizes and group counts allow to link."""
    left = slim.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    right = slim.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    wide = pairs.join(left, "a").join(right, "b").where((WHOLE * F.least("na", "nb")) >= PART * F.greatest("na", "nb"))

    def run(batches):
        for pdf in batches:
            bound = np.fromiter(map(overlap_bound, pdf["ca"], pdf["cb"]), dtype=np.int64, count=len(pdf))
            yield pdf.loc[possible(bound, (pdf["na"] + pdf["nb"]).to_numpy()), ["a", "b"]]

    return wide.mapInPandas(run, "a long, b long")


def verified(pairs: DataFrame, slim: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """The pairs that do link, by the sets of their texts; only texts of these pairs are moved."""
    pairs = stored(pairs, name + "-pairs")
    ids = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    wanted = stored(ids.join(slim.select("sid", "digest"), "sid"), name + "-wanted")
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(text.alias("text"), F.md5(text.cast("binary")).alias("digest"))
    texts = stored(texts.join(sized(wanted), "digest").select("sid", "text").dropDuplicates(["sid"]), name + "-texts")
    wide = pairs.join(texts.select(F.col("sid").alias("b"), F.col("text").alias("tb")), "b")
    wide = wide.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")

    def run(batches):
        last = last_set = None
        for pdf in batches:
            keep = []
            for a, ta, tb in zip(pdf["a"], pdf["ta"], pdf["tb"], strict=True):
                if a != last:  # the join leaves equal a side by side
                    last, last_set = a, shingle_set(ta)
                other = shingle_set(tb)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(WHOLE * both >= PART * (len(last_set) + len(other) - both))
            yield pdf.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return wide.mapInPandas(run, "a long, b long")


def _pairs_in_groups(size: np.ndarray, begin: np.ndarray):
    """Places of all pairs within each of the groups, a block of groups of equal size at a time."""
    for k in np.unique(size):
        x, y = np.triu_indices(k, 1)
        first = begin[size == k]
        step = max(1, (1 << 18) // max(len(x), 1))
        for at in range(0, len(first), step):
            f = first[at:at + step, None]
            yield (f + x).ravel(), (f + y).ravel()


def _slab_pairs(pdf: pd.DataFrame):
    """Pairs of whole slabs (or pieces of them) that may link and aren't connected, in frames of about ``HELD`` at most, once each in a frame."""
    sid, c, n = pdf["sid"].to_numpy(), pdf["c"].to_numpy(), pdf["n"].to_numpy()
    counts, fine = _vectors(pdf["counts"]), pdf["counts"].to_numpy()
    group = pdf[["slab", "i", "j"]].to_numpy()
    begin = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)]))
    size = np.diff(np.concatenate([begin, [len(pdf)]]))
    found, held = [], 0

    def keep(x, y, bound_too):
        nonlocal held
        fits = (c[x] != c[y]) & (sid[x] != sid[y]) & (WHOLE * np.minimum(n[x], n[y]) >= PART * np.maximum(n[x], n[y]))
        x, y = x[fits], y[fits]
        if bound_too and len(x):
            fits = possible(np.minimum(counts[x], counts[y]).sum(axis=1), n[x] + n[y])
            x, y = x[fits], y[fits]
        if len(x):
            swap = sid[x] > sid[y]
            found.append(np.stack([np.where(swap, y, x), np.where(swap, x, y)]))
            held += len(x)

    def frame():
        nonlocal held
        x, y = np.concatenate(found, axis=1)
        found.clear()
        held = 0
        _, once = np.unique(np.stack([sid[x], sid[y]]), axis=1, return_index=True)
        x, y = x[once], y[once]
        bound = np.fromiter(map(overlap_bound, fine[x], fine[y]), dtype=np.int64, count=len(x))
        fits = possible(bound, n[x] + n[y])
        return pd.DataFrame({"a": sid[x[fits]], "b": sid[y[fits]]})

    small = (size <= PAIRWISE) & (group[begin, 1] == group[begin, 2])
    for x, y in _pairs_in_groups(size[small], begin[small]):
        keep(x, y, True)
        if held >= HELD:
            yield frame()
    piece = pdf["piece"].to_numpy()
    for b, k in zip(begin[~small], size[~small], strict=True):
        own = np.arange(b, b + k)
        left, right = (own[piece[own] == p] for p in group[b, 1:])
        tree = Tree(counts[left], n[left])
        other = tree if group[b, 1] == group[b, 2] else Tree(counts[right], n[right])
        for x, y in tree.join(other):
            if other is tree:  # which gives each pair both ways
                x, y = x[x < y], y[x < y]
            keep(left[x], right[y], False)
            if held >= HELD:
                yield frame()
    if held:
        yield frame()


def _whole_slabs(batches):
    """Arrow batches, sorted by slab, regrouped so that no slab is cut."""
    rest = None
    for pdf in batches:
        rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if len(rest) >= CHUNK:
            last = rest[["slab", "i", "j"]].iloc[-1]
            open_ = ((rest["slab"] == last["slab"]) & (rest["i"] == last["i"]) & (rest["j"] == last["j"])).to_numpy()
            if not open_.all():
                yield rest[~open_].reset_index(drop=True)
                rest = rest[open_].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def tasks(slabs: DataFrame, slim: DataFrame) -> DataFrame:
    """The points of slabs with several components (``c``), in each task (``slab, i, j``) that they are needed in.

    A large slab is cut into pieces. The points of its largest component have pieces of their own, which meet the
    pieces of all other points but not each other, so one loose member costs each point one row only."""
    sizes = slabs.groupBy("slab", "c").agg(F.count("*").alias("k")).groupBy("slab").agg(
        F.sum("k").alias("size"), F.max(F.struct("k", "c")).alias("main"), F.count("*").alias("components")).where("components > 1")
    large = F.col("size") > SLAB
    sizes = sizes.select("slab", F.col("main.c").alias("main"),
                         F.when(large, F.ceil((F.col("size") - F.col("main.k")) / SLAB)).otherwise(1).cast("int").alias("rest"),
                         F.when(large, F.ceil(F.col("main.k") / SLAB)).otherwise(0).cast("int").alias("own"))
    rows = slabs.join(sizes, "slab").join(slim.select("sid", "n", "counts"), "sid")
    in_main = (F.col("own") > 0) & (F.col("c") == F.col("main"))
    spread = lambda n: F.pmod(F.xxhash64("sid"), n).cast("int")
    rows = rows.withColumn("piece", F.when(in_main, F.col("rest") + spread(F.greatest("own", F.lit(1)))).otherwise(spread(F.col("rest"))))
    rows = rows.withColumn("last", F.when(in_main, F.col("rest")).otherwise(F.col("rest") + F.col("own")) - 1)
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))).select(
        "slab", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"), "piece", "sid", "c", "n", "counts")


def unconnected(slabs: DataFrame, slim: DataFrame) -> DataFrame:
    """Pairs of points in one slab that may link and whose components (``c``) differ, by R-tree."""
    dealt = tasks(slabs, slim).repartition("slab", "i", "j").sortWithinPartitions("slab", "i", "j", "sid")
    return dealt.mapInPandas(lambda batches: (pairs for pdf in _whole_slabs(batches) for pairs in _slab_pairs(pdf)), "a long, b long").distinct()


def linked_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(points, links)``: a row per document (see ``points``), and links ``a, b`` of set ids that join all that belongs together."""
    all_points = stored(points(docs), "points")
    sets = all_points.where("n > 0").groupBy("sid").agg(
        F.min(F.struct("doc_id", "digest")).alias("rep"), F.count("*").alias("copies"))
    copied = stored(sets.where("copies > 1").select("sid", F.col("rep.doc_id").alias("rep_id"), F.col("rep.digest").alias("rep_digest")), "copied")
    once = all_points.where("n > 0").join(sized(copied), "sid", "left").where(
        "rep_digest IS NULL OR (doc_id <=> rep_id AND digest = rep_digest)")
    slim = once.select("sid", "n", "counts", "digest").dropDuplicates(["sid"])
    by_key = Window.partitionBy("key")
    shared = once.select("sid", F.explode("keys").alias("key")).select(
        "sid", F.count("*").over(by_key).alias("size"), F.min("sid").over(by_key).alias("low"), F.bit_xor(F.xxhash64("sid")).over(by_key).alias("member"))
    members = stored(shared.where("size > 1").groupBy(F.xxhash64("size", "low", "member").alias("slab"), "sid").agg(
        F.count("*").alias("keys"), F.first("size").alias("size")), "members")
    # a slab is led by the point that shares the most keys with the most others: of a family, the
    # one that its copies were made from, which links to more of them than they do to each other
    central = members.groupBy("sid").agg(F.sum(F.col("keys") * (F.col("size") - 1)).alias("central"))
    leads = members.join(central, "sid").groupBy("slab").agg(F.max(F.struct("central", "sid")).alias("lead")).select("slab", F.col("lead.sid").alias("lead"))
    slabs = stored(members.select("slab", "sid").join(leads, "slab"), "slabs")
    involved = stored(slabs.select("sid").distinct(), "involved")
    slim = stored(slim.join(sized(involved), "sid", "left_semi"), "needed")
    stars = slabs.where("lead <> sid").select(F.col("lead").alias("a"), F.col("sid").alias("b")).distinct()
    links = stored(verified(bounded(stars, slim), slim, docs, "star"), "links")
    known = components(links, "stars")
    labelled = slabs.join(known.withColumnRenamed("id", "sid"), "sid", "left").select("slab", "sid", F.coalesce("component", "sid").alias("c"))
    more = stored(verified(unconnected(stored(labelled, "labelled"), slim), slim, docs, "tree"), "more")
    return all_points, links.union(more)


def link(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    all_points, links = linked_sets(docs)
    rows = all_points.select("doc_id", "sid", "n")
    # from sets to documents: a document is next to the smallest id of its set
    rep = stored(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("rep")), "reps")
    ids = rep.select(F.col("sid").alias("a"), F.col("rep").alias("ra")), rep.select(F.col("sid").alias("b"), F.col("rep").alias("rb"))
    edges = links.join(ids[0], "a").join(ids[1], "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    own = rows.where("n > 0 AND doc_id IS NOT NULL").join(rep, "sid").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(edges.union(own), "documents")
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(final.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of linked texts: the one with the smallest id (no id: after all
    others), then the smallest digest of its text. Here texts decide alone: rows that share an id but not a
    text stay apart, and rows without an id are compared like others. Of wholly equal rows (id and text) one stays;
    texts without words are linked with nothing and all stay.
    """
    all_points, links = linked_sets(docs)
    known = components(links, "sets")
    rows = all_points.where("n > 0").select("doc_id", "sid", "digest").join(known.withColumnRenamed("id", "sid"), "sid", "left")
    rows = stored(rows.select("doc_id", "digest", F.coalesce("component", "sid").alias("c")), "grouped")
    first = rows.groupBy("c").agg(F.count("*").alias("size"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first")).where("size > 1")
    marked = rows.join(first, "c").withColumn("is_first", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest")))
    marked = stored(marked.groupBy("doc_id", "digest").agg(F.max("is_first").alias("is_first"), F.count("*").alias("copies")), "marked")
    keyed = docs.withColumns({_ID: F.col("doc_id"), _DIGEST: F.md5(F.coalesce("text", F.lit("")).cast("binary"))})
    key = lambda other: keyed[_ID].eqNullSafe(other["doc_id"]) & (keyed[_DIGEST] == other["digest"])
    rest = sized(marked.where("NOT is_first").select("doc_id", "digest"))
    again = marked.where("is_first AND copies > 1").select("doc_id", "digest")
    kept = keyed.join(rest, key(rest), "left_anti")
    if again.limit(1).count():
        again = sized(again)
        keyed, one = kept, kept
        once = kept.join(again, key(again), "left_semi").dropDuplicates([_ID, _DIGEST])
        kept = one.join(again, key(again), "left_anti").unionByName(once)
    return kept.select(*docs.columns)
