"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are binned at quantiles. Shallow trees on one feature at a time are boosted
in turn (cyclic, small steps), which adds up to one lookup table per feature; then the feature
pairs with the largest residual gain get a table of their own in the same way. A score is the
sigmoid of the intercept plus one entry per table, added for a whole batch at once.

Fit on a bounded sample of labelled documents (``SAMPLE_ROWS`` ids in expectation, by a hash of the id; each comes
to the driver as one row of features with its numbers of labels 0 and 1). Every text is featurised and
scored whole.

Defined results: null and empty texts have all-zero features and are scored like any other; with
no labelled rows every score is 0.5; labels other than 0 and 1, and those without an id, are ignored; a
document labelled more than once counts with each label; of documents that share an id the smallest features are
learnt from; ties and repeated rows each give a row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from .common import held_out, map_rows, stored

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 80
PAIRS = 6
RATE = 0.15
LEAVES = 4  # of a tree on one feature
FEATURES = ("log_bytes", "log_words", "word_length", "digits", "upper", "marks", "symbols", "spaces", "line_breaks",
            "distinct_words", "top_word", "repeated_lines", "line_length", "sentence_ends", "beyond_ascii", "short_words",
            "upper_words", "longest_word")

DIGITS = b"0123456789"
UPPER = bytes(range(65, 91))
MARKS = b".,;:'\"()-"
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in MARKS)
BEYOND = bytes(range(128, 256))
ENDS = re.compile(rb"[.!?](?=\s|$)")


def features(text: str | None) -> list[float]:
    """One value per entry of ``FEATURES``; all zero for null, empty and blank texts."""
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, k = len(b), len(words)
    share = lambda chars: (n - len(b.translate(None, chars))) / n
    lines = [x for x in b.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=k)
    return [math.log1p(n), math.log1p(k), float(lengths.mean()), share(DIGITS), share(UPPER), share(MARKS), share(SYMBOLS),
            share(b" \t\r\x0b\x0c"), b.count(b"\n") / n, len(seen) / k, max(seen.values()) / k, 1 - len(set(lines)) / len(lines),
            math.log1p(n / len(lines)), len(ENDS.findall(b)) / k, share(BEYOND), float((lengths <= 3).mean()),
            sum(1 for w in seen if w.isupper()) / len(seen), math.log1p(float(lengths.max()))]


class Additive:
    """Intercept, cut points, one table per feature and per chosen pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None):
        weight = np.ones(len(y)) if weight is None else weight
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(len(FEATURES))]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        rate = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.intercept = math.log(rate / (1 - rate))
        if not len(y) or y.min() == y.max():
            return
        bins = self.bins(x)
        score = np.full(len(y), self.intercept)
        for _ in range(ROUNDS):
            for j in range(len(FEATURES)):
                step = self._tree(bins[:, j], len(self.tables[j]), y, score, weight)
                self.tables[j] += step
                score += step[bins[:, j]]
        coarse = [self._coarse(bins[:, j], j) for j in range(len(FEATURES))]
        p = 1 / (1 + np.exp(-score))
        gains = []
        for i, j in combinations(range(len(FEATURES)), 2):
            cell = coarse[i] * PAIR_BINS + coarse[j]
            g = np.bincount(cell, weight * (y - p), PAIR_BINS ** 2)
            h = np.bincount(cell, weight * p * (1 - p), PAIR_BINS ** 2) + 1.0
            gains.append((-(g * g / h).sum(), i, j))
        self.pairs = [(i, j) for _, i, j in sorted(gains)[:PAIRS]]
        self.pair_tables = [np.zeros(PAIR_BINS ** 2) for _ in self.pairs]
        for _ in range(ROUNDS // 2):
            for k, (i, j) in enumerate(self.pairs):
                cell = coarse[i] * PAIR_BINS + coarse[j]
                p = 1 / (1 + np.exp(-score))
                g = np.bincount(cell, weight * (y - p), PAIR_BINS ** 2)
                h = np.bincount(cell, weight * p * (1 - p), PAIR_BINS ** 2)
                step = RATE * g / (h + 5.0)
                self.pair_tables[k] += step
                score += step[cell]

    @staticmethod
    def _tree(bin_of: np.ndarray, size: int, y: np.ndarray, score: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """One tree of at most ``LEAVES`` leaves on one binned feature, as a step for its table."""
        p = 1 / (1 + np.exp(-score))
        g = np.concatenate([[0.0], np.cumsum(np.bincount(bin_of, weight * (y - p), size))])
        h = np.concatenate([[0.0], np.cumsum(np.bincount(bin_of, weight * p * (1 - p), size))])
        leaf = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
        leaves = [(0, size)]
        while len(leaves) < LEAVES:
            best = max(((leaf(a, m) + leaf(m, b) - leaf(a, b), a, m, b) for a, b in leaves for m in range(a + 1, b)), default=None)
            if best is None or best[0] <= 1e-9:
                break
            _, a, m, b = best
            leaves.remove((a, b))
            leaves += [(a, m), (m, b)]
        out = np.zeros(size)
        for a, b in leaves:
            out[a:b] = RATE * (g[b] - g[a]) / (h[b] - h[a] + 1.0)
        return out

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def _coarse(self, bin_of: np.ndarray, j: int) -> np.ndarray:
        return bin_of * PAIR_BINS // len(self.tables[j])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            total += t[bins[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[self._coarse(bins[:, i], i) * PAIR_BINS + self._coarse(bins[:, j], j)]
        return 1 / (1 + np.exp(-total))


def featurise(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the features of each whole text."""
    fields = StructType().add("x", ArrayType(DoubleType()))
    return map_rows(docs, ["doc_id"], ["text"], fields, lambda texts: [[features(t) for t in texts]])


def fit(rows: DataFrame, labels: DataFrame, name: str = "quality") -> Additive:
    """``rows``: doc_id and x; ``labels``: doc_id and the 0/1 column ``name``. Bounded sample."""
    lab = labels.where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull())
    lab = stored(lab.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col(name).cast("long")).alias("ones")), "labels")
    share = min(1.0, SAMPLE_ROWS / max(lab.count(), 1))
    lab = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < math.ceil(share * (1 << 30)))
    one = rows.join(lab, "doc_id").groupBy("doc_id", "n", "ones").agg(F.min("x").alias("x"))
    got = [(r.doc_id, y, tuple(r.x), w) for r in one.collect() for y, w in ((0, r.n - r.ones), (1, r.ones)) if w]
    got.sort()
    x = np.array([g[2] for g in got], dtype=np.float64).reshape(len(got), len(FEATURES))
    return Additive(x, *(np.array([g[i] for g in got], dtype=np.float64) for i in (1, 3)))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels whose crc32 modulo 3 is not 1; score every document."""
    rows = stored(featurise(docs), "features")
    model = fit(rows, labels.where(~held_out("doc_id", 3, 1)))

    def score(x):
        return [model.score(np.array(x, dtype=np.float64).reshape(len(x), len(FEATURES)))]

    scored = map_rows(rows, ["doc_id"], ["x"], StructType().add("score", "double"), score)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
