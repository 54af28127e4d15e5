"""Byte-level BPE: encoding and decoding by a file of ranks.

A text is cut by the vocabulary's pattern; each piece ("word") is encoded on its own by ranked
merges over its bytes, lowest rank first, leftmost of equals; decoding concatenates the ids' bytes.

Two forms of the same fold:

* ``encode_words``: column expressions only. Higher-order functions fold the merges over the byte
  pieces of distinct words, with the rank map as a literal.
* ``encode`` / ``decode`` / ``round_trip``: the fold runs in Arrow batches, on the distinct words of a batch that a
  Python worker hasn't met, all at once: a step merges one pair of each word (``fold_many``). ``CACHE`` to twice as
  many words are remembered; the rank map is broadcast (its size is that of the vocabulary file). The README has
  the figures that decided for this form.

No text is shuffled or cut; a word of any length takes n log n steps.

Defined results: null and empty texts have no ids and decode to nothing; repeated rows each give
a row; an empty table gives an empty result; a null among the ids of ``decode`` is skipped, an
unknown id raises; ``encode`` passes other columns through unless they bear the names it adds.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .common import Splitter, map_rows

CACHE = 200_000
SHORT = 48  # bytes of a word up to which each step looks at all pairs
STEP = 250  # texts encoded together
TOGETHER = 50_000  # words folded together
NONE = 1 << 40  # the rank of neighbours that don't join
LITERAL_BUCKETS = 1 << 16
IDS = ArrayType(IntegerType())
#: Unicode's White_Space characters, written out as libraries differ on what \s holds.
WHITE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def explicit(pattern: str) -> str:
    """The splitting pattern with its white space classes written out."""
    return (pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


class Codec:
    """Encodes and decodes texts; remembers the words it has met lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, explicit(pattern)
        # every pair of tokens that joins to a token: (left << 32 | right) in order, and what it joins to
        joins = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pairs, self.joined = (np.array(c, dtype=np.int64) for c in zip(*joins, strict=True)) if joins else (np.zeros(1, dtype=np.int64) - 1, np.zeros(1, dtype=np.int64))
        self.start()

    def start(self) -> None:
        size = max(self.ranks.values()) + 1
        self.pieces, self.shown = [None] * size, [str(i) for i in range(size)]
        for token, rank in self.ranks.items():
            self.pieces[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.find = Splitter(self.pattern)
        self.words: dict[str, bytes] = {}  # to ids as 32-bit numbers
        self.before: dict[str, bytes] = {}

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("ranks", "pattern", "pairs", "joined")}

    def __setstate__(self, state) -> None:
        self.__dict__ |= state
        self.start()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What neighbours join to (``NONE``: nothing)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.joined[at], NONE)

    def fold_many(self, words: list[bytes]) -> list[bytes]:
        """Ranked merges over the bytes of all words (none empty): each step merges in every word the leftmost of its
        neighbours of lowest rank; words without any are done."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words])
        ids = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.arange(len(words))  # those not done, by their parts' starts
        start = np.cumsum(sizes) - sizes
        last = np.zeros(len(ids), dtype=bool)
        last[start + sizes - 1] = True
        rank = np.full(len(ids), NONE)
        inner = np.flatnonzero(~last)
        rank[inner] = self._rank(ids[inner], ids[inner + 1])
        while len(word):
            best = np.minimum.reduceat(rank, start)
            sizes = np.diff(start, append=len(ids))
            done = best == NONE
            if done.any():
                raw, ends = ids.astype("<i4").tobytes(), start + sizes
                for w, a, b in zip(word[done].tolist(), start[done].tolist(), ends[done].tolist(), strict=True):
                    out[w] = raw[4 * a:4 * b]
                stays = np.repeat(~done, sizes)
                ids, last, rank = ids[stays], last[stays], rank[stays]
                word, best, sizes = word[~done], best[~done], sizes[~done]
                start = np.cumsum(sizes) - sizes
                if not len(word):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            own = np.searchsorted(start, hit, side="right") - 1
            at = hit[np.flatnonzero(np.diff(own, prepend=-1))]  # the leftmost of each word
            ids[at] = best
            last[at] = last[at + 1]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, last, rank = ids[keep], last[keep], rank[keep]
            at -= np.arange(len(at))
            sizes = sizes - 1
            start = np.cumsum(sizes) - sizes
            rank[at] = NONE
            right = at[~last[at]]
            rank[right] = self._rank(ids[right], ids[right + 1])
            left = at[at > start] - 1
            rank[left] = self._rank(ids[left], ids[left + 1])
        return out

    def fold(self, word: bytes) -> tuple[int, ...]:
        """Ranked merges over the bytes of one word."""
        if len(word) > SHORT:
            return self._fold_long(word)
        return tuple(np.frombuffer(self.fold_many([word])[0], dtype="<i4").tolist()) if word else ()

    def _fold_long(self, word: bytes) -> tuple[int, ...]:
        """The same by a heap of pairs over a linked list of parts, in n log n steps."""
        ranks, n = self.ranks, len(word)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n

        def offer(i):
            j = after[i]
            if j < n and (r := ranks.get(word[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        while heap:
            _, i, j, e = heapq.heappop(heap)
            if not alive[i] or after[i] != j or j >= n or end[j] != e or not alive[j]:
                continue
            end[i], after[i], alive[j] = end[j], after[j], False
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i:end[i]]])
            i = after[i]
        return tuple(out)

    def _learn(self, words: set[str]) -> None:
        """Remember all these words; those that aren't remembered yet are folded."""
        new = words - self.words.keys()
        if len(self.words) + len(new) > CACHE:
            self.before, self.words, new = self.words, {}, words
        known = new & self.before.keys()
        self.words.update((w, self.before[w]) for w in known)
        new = list(new - known)
        for i in range(0, len(new), TOGETHER):
            part = [(w, w.encode("utf-8", "surrogatepass")) for w in new[i:i + TOGETHER]]
            short = [p for p in part if len(p[1]) <= SHORT]
            if short:
                self.words.update(zip([w for w, _ in short], self.fold_many([raw for _, raw in short]), strict=True))
            if len(short) < len(part):
                self.words.update((w, np.array(self._fold_long(raw), dtype="<i4").tobytes()) for w, raw in part if len(raw) > SHORT)

    def encode_many(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text."""
        out = []
        for a in range(0, len(texts), STEP):
            split = [self.find(t) if t else [] for t in texts[a:a + STEP]]
            self._learn(set().union(*split))
            out += [np.frombuffer(b"".join(map(self.words.__getitem__, ws)), dtype="<i4").tolist() for ws in split]
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def encode(docs: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the whole text's token ids."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)
    keep = [c for c in docs.columns if c != "ids"]
    return map_rows(docs, keep, [text], StructType().add("ids", IDS), lambda texts: [shared.value.encode_many(texts)])


def decode(rows: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the bytes that the ids stand for."""
    shared = rows.sparkSession.sparkContext.broadcast(codec)
    keep = [c for c in rows.columns if c != "decoded"]
    return map_rows(rows, keep, [ids], StructType().add("decoded", "binary"),
                    lambda lists: [[shared.value.decode(i for i in v or () if i is not None) for v in lists]])


def round_trip(docs: DataFrame, codec: Codec, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Each text encoded whole and its ids decoded, as counts and digests (and the ids)."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)
    fields = StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(texts):
        codec, out = shared.value, ([], [], [], [])
        for a in range(0, len(texts), STEP):
            for ids in codec.encode_many(texts[a:a + STEP]):
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(" ".join(map(codec.shown.__getitem__, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if with_ids:
                    out[3].append(np.array(ids, dtype=np.int32))
        return list(out[:3 + with_ids])

    return map_rows(docs, list(keep), ["text"], fields.add("ids", IDS) if with_ids else fields, run)


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as one literal: maps from hex tokens to ranks, bucketed by crc32."""
    buckets: list[dict[str, int]] = [{} for _ in range(LITERAL_BUCKETS)]
    for token, rank in ranks.items():
        key = token.hex().upper()
        buckets[zlib.crc32(key.encode()) % LITERAL_BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def encode_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """Distinct words with ``ids``: higher-order functions alone, as many steps as a word has bytes."""
    literal = rank_literal(ranks)
    look = lambda key: F.element_at(F.get(literal, (F.crc32(key.cast("binary")) % LITERAL_BUCKETS).cast("int")), key)
    inner = lambda s: F.split(F.substring(s, F.lit(2), F.length(s) - 2), "><")
    wrap = lambda *x: F.concat(F.lit("<"), *x, F.lit(">"))

    def step(state, _):
        # all occurrences of the lowest-ranked pair merge at once, from the left
        pieces = inner(state)
        k = F.size(pieces) - 1
        pairs = F.zip_with(F.slice(pieces, 1, k), F.slice(pieces, 2, k), lambda a, b: F.struct(
            look(F.concat(a, b)).alias("rank"), wrap(a, F.lit("><"), b).alias("old"), wrap(a, b).alias("new")))
        best = F.array(F.array_min(F.filter(pairs, lambda p: p["rank"].isNotNull())))
        return F.get(F.transform(best, lambda p: F.coalesce(F.replace(state, p["old"], p["new"]), state)), F.lit(0))

    code = F.hex(F.encode(F.col(word), "UTF-8"))
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), (F.length(code) / 2).cast("int"))),
                         F.regexp_replace(code, "(..)", "<$1>"), step)
    ids = F.when(F.length(code) > 0, F.transform(inner(folded), look)).otherwise(F.array().cast("array<int>"))
    return words.select(word).distinct().withColumn("ids", ids)
