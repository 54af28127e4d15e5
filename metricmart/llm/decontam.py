"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A window is as many words of a document as benchmark items of a size have (the whole document, if that
is shorter). Windows without any shingle of these items have similarity 0 and aren't built. The
others get a ``BITS``-bit SimHash of their shingles, weighted by count. The fingerprint is cut into
``BLOCKS`` blocks. Of two fingerprints within ``RADIUS`` bits, some block differs by at most ``NEAR`` bits; more than
that, fewer than ``AGREEING`` such blocks would leave over ``RADIUS`` bits to the others. So for each block and value a
file lists the items (of the size) within ``NEAR`` bits of it, and the items that a window meets in ``AGREEING`` of its
blocks' files are all within the radius, and a few more (one in seventy of unlike items), which the distance
rules out. Survivors are decided by the exact weighted similarity: the sum of the smaller shingle counts over the
sum of the larger ones, 0.8 or more. The radius is about five standard deviations above the
distance that two texts at 0.8 are expected to have.

Words and shingles are those of the near-duplicate operators (A-Z lower-cased, five words; an item or
document of fewer words is one shingle). The benchmark's shingles go to the executors in chunks of
at most ``CHUNK_WORDS`` words of items and ``CHUNK_ITEMS`` items, one pass over the documents per chunk.

Defined results: null or empty items and texts match nothing; equal items each match; an item that
matches at several places is given with its best similarity, then its first window; repeated
documents each give their rows; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import SHINGLE, SIMILARITY, map_rows, mix, shingle_hashes, word_hashes, words_of

BITS = 256
BLOCKS = 32  # of 8 bits
RADIUS = 66
NEAR = RADIUS // BLOCKS
AGREEING = BLOCKS - RADIUS // (NEAR + 1)
CHUNK_WORDS = 2_000_000
CHUNK_ITEMS = 50_000  # a kilobyte of block files each
RUN = 4096  # windows that are looked at together
PART, WHOLE = SIMILARITY
BITS_SET = np.array([bin(v).count("1") for v in range(256)], dtype=np.uint8)


def simhash_votes(hashes: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 votes for each hash."""
    if not len(hashes):
        return np.zeros((0, BITS), dtype=np.int32)
    parts = [mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1)) for i in range(BITS // 64)]
    bits = np.unpackbits(np.stack(parts, axis=1).view(np.uint8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(votes: np.ndarray) -> np.ndarray:
    """Blocks (bytes) of the signs of summed votes."""
    return np.packbits(votes > 0, axis=1)


class Group:
    """The items of one size and their multi-index."""

    def __init__(self, items: list[tuple]):
        self.items = items  # (id, rows of it, hashes, counts)
        self.prints = np.concatenate([fingerprints(simhash_votes(np.repeat(i[2], i[3])).sum(axis=0)[None, :]) for i in items])
        values = np.arange(256, dtype=np.uint8)[:, None]
        # block and value -> a bit for each item that is within NEAR bits of the value there
        self.files = np.stack([np.packbits(BITS_SET[values ^ self.prints[None, :, b]] <= NEAR, axis=1) for b in range(BLOCKS)])

    def within(self, prints: np.ndarray):
        """All pairs of places (fingerprint, item) at most ``RADIUS`` bits apart, in order, found by the block files."""
        n = len(self.items)
        step = max(1, (1 << 20) // n)
        for low in range(0, len(prints), step):
            part = prints[low:low + step]
            blocks = np.zeros((len(part), n), dtype=np.uint8)
            for b in range(BLOCKS):
                blocks += np.unpackbits(self.files[b][part[:, b]], axis=1, count=n)
            p, k = np.nonzero(blocks >= AGREEING)
            fine = BITS_SET[part[p] ^ self.prints[k]].sum(axis=1) <= RADIUS
            yield from zip((low + p[fine]).tolist(), k[fine].tolist(), strict=True)


class Index:
    """Items by size, and the sizes that a shingle occurs in."""

    def __init__(self, items: list[tuple[int, str, int]]):
        by_size: dict[int, list[tuple]] = {}
        for item_id, text, rows in items:
            h = shingle_hashes(word_hashes(words := words_of(text)))
            if words:
                by_size.setdefault(len(words), []).append((item_id, rows, *np.unique(h, return_counts=True)))
        self.groups = {size: Group(found) for size, found in sorted(by_size.items())}
        self.shingles = {}  # width -> hashes and sizes of the items they occur in, in order
        for width in sorted({min(SHINGLE, size) for size in self.groups}):
            pairs = [(np.unique(np.concatenate([i[2] for i in g.items])), size) for size, g in self.groups.items() if min(SHINGLE, size) == width]
            hashes = np.concatenate([h for h, _ in pairs])
            sizes = np.repeat([size for _, size in pairs], [len(h) for h, _ in pairs])
            order = np.argsort(hashes, kind="stable")
            self.shingles[width] = hashes[order], sizes[order]

    def matches(self, text: str | None):
        """(item id, similarity, first word, words) of the best window of each matching item."""
        words = words_of(text)
        if not words:
            return
        wh = word_hashes(words)
        for width, (hashes, sizes) in self.shingles.items():
            h = shingle_hashes(wh, width)
            low, high = np.searchsorted(hashes, h, side="left"), np.searchsorted(hashes, h, side="right")
            many = high - low
            places = np.repeat(np.arange(len(h)), many)
            found = sizes[np.arange(len(places)) + np.repeat(low - (np.cumsum(many) - many), many)]
            for size in np.unique(found):
                group = self.groups[int(size)]
                span = min(int(size), len(words)) - width + 1  # shingles in a window
                if span < 1 or WHOLE * span < PART * (int(size) - width + 1):
                    continue
                for k, (similarity, start) in sorted(self._best(group, h, places[found == size], span).items()):
                    for _ in range(group.items[k][1]):
                        yield group.items[k][0], similarity, start, span + width - 1

    @staticmethod
    def _best(group: Group, h: np.ndarray, places: np.ndarray, span: int) -> dict[int, tuple[float, int]]:
        """Item -> similarity and start of its best window, of those that hold a shingle at one of ``places``."""
        top = len(h) - span
        mark = np.zeros(top + 2, dtype=np.int64)
        np.add.at(mark, np.maximum(0, places - span + 1), 1)
        np.add.at(mark, np.minimum(places, top) + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        best: dict[int, tuple[float, int]] = {}
        # runs of neighbouring windows share running sums
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for first, last in ((int(r[0]), int(r[-1])) for r in np.split(run, range(RUN, len(run), RUN))):
                part = h[first:last + span]
                sums = np.concatenate([np.zeros((1, BITS), dtype=np.int32), np.cumsum(simhash_votes(part), axis=0, dtype=np.int32)])
                for i, k in group.within(fingerprints(sums[span:] - sums[:len(sums) - span])):
                    _, _, values, counts = group.items[k]
                    got, n = np.unique(part[i:i + span], return_counts=True)
                    _, a, b = np.intersect1d(got, values, assume_unique=True, return_indices=True)
                    both = int(np.minimum(n[a], counts[b]).sum())
                    union = int(n.sum() + counts.sum()) - both
                    if both * WHOLE >= PART * union and (k not in best or both / union > best[k][0]):
                        best[k] = both / union, first + i
        return best


def _chunks(benchmark: DataFrame):
    """Items (id, text, rows of it) to the driver in chunks of bounded size (at least one item each)."""
    rows = benchmark.where(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.count("*").alias("rows"))
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("words"), F.count("*").alias("items")).first()
    n = max(-(-(total.words or 0) // CHUNK_WORDS), -(-total.items // CHUNK_ITEMS))
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r.item_id, r.text, r.rows) for r in part.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item that occurs in it."""
    spark = docs.sparkSession
    fields = StructType().add("item_id", "long").add("similarity", "double").add("start_word", "long").add("window_words", "long")
    out = None
    for items in _chunks(benchmark):
        shared = spark.sparkContext.broadcast(Index(items))

        def find(texts, shared=shared):
            rows = [(i, *m) for i, t in enumerate(texts) for m in shared.value.matches(t)]
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5

        part = map_rows(docs, ["doc_id"], ["text"], fields, find)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.select("doc_id").limit(0).select("doc_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    for items in _chunks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(Index(items))

        def free(texts, shared=shared):
            return [[i for i, t in enumerate(texts) if next(shared.value.matches(t), None) is None]]

        docs = map_rows(docs, docs.columns, ["text"], StructType(), free)
    return docs
