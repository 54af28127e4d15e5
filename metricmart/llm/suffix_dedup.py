"""Removal of long repeats with a logarithmic family of suffix indexes.

A byte goes if it is covered by a string of ``SIZE`` bytes that also starts earlier: in a document of
smaller id, or further left in the same one. Strings are judged on the input; overlaps count.

A suffix is known by the 64-bit hash of its first ``SIZE`` bytes, and an index over some suffixes
(``LogIndex``) is a family of arrays in that order. Two suffixes match for ``SIZE`` bytes exactly if
they are neighbours with equal keys there, which is all that the removal asks. Each new batch,
in order of documents, gets an array of its own, is merge-scanned against all existing levels, and
then joins the family: levels of like size merge, so a suffix is moved log(n) times.

Every window of ``SIZE`` bytes would be too much to shuffle. Windows are taken together in runs:

* The anchor of a window is the ``GRAM`` bytes in it with the smallest hash. Equal windows have equal
  anchors at equal places. The neighbouring windows with one anchor are a run; the run's
  content is the bytes of its windows.
* A run whose content occurred earlier goes wholly. An anchor that occurs with one content only
  needs nothing more. These are found by one shuffle of (anchor, content) hashes.
* The first runs of each content whose anchor has several contents (where repeats begin and end, or
  differ) are compared window by window, by a second pass over just their bytes.

Equal texts are dealt with beforehand: all but the first go wholly, if ``SIZE`` bytes or longer. Each
Arrow batch passes on one row per content. An anchor that is still frequent after that is split by
content in the first pass and by window in the second. Partitions follow the number of runs.

Defined results: null and empty texts have no bytes; texts shorter than ``SIZE`` keep all; rows with
one id count as documents in the order of a hash of their texts, equal rows in any order; rows
without an id come last; an empty table gives an empty result; other columns are ignored.
Exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_rows, mix, on_executors, sized, stored

SIZE = 100
GRAM = 32
REACH = SIZE - GRAM + 1  # anchor places in a window
PIECE = (1 << 20) - SIZE  # windows of a long text that are hashed together
MASK = (1 << 20) - 1
CELLS = 1 << 16
FREQUENT = 1_000_000  # runs of a cell above the mean that make it frequent
SALTS = 256
ROWS = 2_000_000  # runs in a partition, about
BATCH = 1 << 16  # suffixes of a new batch, at least
LAST = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_N = 1 << 20
_POWER = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(_N, _BASE, dtype=np.uint64))])
_INVERSE = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(_N, pow(_BASE, -1, 1 << 64), dtype=np.uint64))])
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def prefix_sums(data: bytes) -> np.ndarray:
    """Sums from which ``hashes`` gets the hash of any substring."""
    values = _BYTE[np.frombuffer(data, dtype=np.uint8)]
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _INVERSE[:len(values)], out=out[1:])
    return out


def hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings, the same wherever they lie."""
    return mix((sums[end] - sums[start]) * _POWER[start])


def runs(data: bytes):
    """(anchor hash, content hash, first window, windows) of each run, as arrays, for one text."""
    out = []
    for at in range(0, max(len(data) - SIZE + 1, 0), PIECE):
        part = data[at:at + PIECE + SIZE - 1]
        sums = prefix_sums(part)
        n = len(part) - GRAM + 1
        gram = mix((sums[GRAM:] - sums[:-GRAM]) * _POWER[:n])
        low = (gram & ~np.uint64(MASK)) | np.arange(n, dtype=np.uint64)  # of equal hashes, the leftmost
        width = 1
        while width * 2 <= REACH:
            low, width = np.minimum(low[:-width], low[width:]), width * 2
        if width < REACH:
            low = np.minimum(low[:len(low) - REACH + width], low[REACH - width:])
        anchor = (low & np.uint64(MASK)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.concatenate([first, [len(anchor)]]))
        out.append((gram[anchor[first]], hashes(sums, first, first + count - 1 + SIZE), first + at, count))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64)]


class LogIndex:
    """Levels of sorted suffix keys; adding a batch merges levels of like size."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted keys some level holds: a merge scan of the batch with each level."""
        out = np.zeros(len(keys), dtype=bool)
        for level in self.levels:
            at = np.searchsorted(level, keys)
            out |= level[np.minimum(at, len(level) - 1)] == keys
        return out

    def add(self, keys: np.ndarray) -> None:
        while self.levels and len(self.levels[-1]) <= 2 * len(keys):
            keys = np.sort(np.concatenate([self.levels.pop(), keys]), kind="stable")
        if len(keys):
            self.levels.append(keys)

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key of a batch, in its order, came earlier (in it or before); adds the batch."""
        values, first, back = np.unique(keys, return_index=True, return_inverse=True)
        known = self.known(values)
        self.add(values[~known])
        return known[back] | (first[back] != np.arange(len(keys)))


def _gathered(batches, rows: int = BATCH):
    """Arrow batches joined until they have enough rows."""
    have, n = [], 0
    for pdf in batches:
        have.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(have, ignore_index=True)
            have, n = [], 0
    if n:
        yield pd.concat(have, ignore_index=True)


RUN = "earlier boolean, g long, c long, ord long, tie long, pos long"


def _run_rows(batches):
    """A row for the first run of each content in a batch, and rows for those that came after it."""
    for pdf in batches:
        parts = [(g, c, i, first * 128 + count) for i, t in enumerate(pdf["text"]) for g, c, first, count in [runs(t.encode("utf-8", "surrogatepass"))]]
        if not parts:
            continue
        g, c, pos = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
        doc = np.repeat([p[2] for p in parts], [len(p[0]) for p in parts]).astype(np.int64)
        ordinal, tie = pdf["ord"].to_numpy()[doc], pdf["tie"].to_numpy()[doc]
        by = np.lexsort((pos, tie, ordinal, c))
        again = np.zeros(len(c), dtype=bool)
        again[by[1:]] = c[by[1:]] == c[by[:-1]]
        yield pd.DataFrame({"earlier": again, "g": g.view(np.int64), "c": c.view(np.int64), "ord": ordinal, "tie": tie, "pos": pos})


def _cells(batches):
    total = np.zeros(CELLS, dtype=np.int64)
    for pdf in _run_rows(batches):
        total += np.bincount((pdf.loc[~pdf["earlier"], "g"].to_numpy().view(np.uint64) >> np.uint64(48)).astype(np.int64), minlength=CELLS)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"cell": at, "n": total[at]})


FOUND = "open boolean, g long, size long, ord long, tie long, pos long"


def _first_pass(batches):
    """Runs in order of documents: those whose content came earlier, and at the end the first runs
    (``open``) of anchors with several contents."""
    index, kept = LogIndex(), []
    for pdf in _gathered(batches):
        earlier = pdf["earlier"].to_numpy() | False
        fresh = np.flatnonzero(~earlier)
        earlier[fresh] = index.scan(pdf["c"].to_numpy()[fresh])
        gone = pdf[earlier]
        yield pd.DataFrame({"open": False, "g": 0, "size": 0, "ord": gone["ord"], "tie": gone["tie"], "pos": gone["pos"]})
        kept.append(pdf.loc[~earlier, ["g", "ord", "tie", "pos", "frequent"]])
    if kept:
        rest = pd.concat(kept, ignore_index=True)
        _, back, size = np.unique(rest["g"].to_numpy(), return_inverse=True, return_counts=True)
        size = np.where(rest["frequent"].to_numpy(), FREQUENT, size[back])
        out = rest[size > 1]
        yield pd.DataFrame({"open": True, "g": out["g"], "size": size[size > 1], "ord": out["ord"], "tie": out["tie"], "pos": out["pos"]})


CONTENT = "g long, size long, ord long, tie long, first long, content binary"
WINDOW = "h long, ord long, tie long, first long"
GONE = "ord long, tie long, pos long"


def _contents(batches):
    for pdf in batches:
        rows = []
        for ordinal, tie, text, opens in zip(pdf["ord"], pdf["tie"], pdf["text"], pdf["opens"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for x in opens:
                first, count = divmod(int(x["pos"]), 128)
                rows.append((x["g"], x["size"], ordinal, tie, first, data[first:first + count - 1 + SIZE]))
        yield pd.DataFrame(rows, columns=["g", "size", "ord", "tie", "first", "content"])


def _windows(pdf: pd.DataFrame):
    """(hash, row, place of the window in its run) of all windows, in order."""
    data = b"".join(pdf["content"])
    length = np.fromiter(map(len, pdf["content"]), dtype=np.int64, count=len(pdf))
    count = length - SIZE + 1
    begin = np.cumsum(length) - length
    row = np.repeat(np.arange(len(pdf)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    # contents are hashed one after another; each starts its powers anew
    offset = np.arange(len(data)) - np.repeat(begin, length)
    np.cumsum(_BYTE[np.frombuffer(data, dtype=np.uint8)] * _INVERSE[offset], out=sums[1:])
    start = begin[row] + place
    return mix((sums[start + SIZE] - sums[start]) * _POWER[place]), row, place


def _second_pass(batches):
    """Windows of open runs in order of documents, against an index of all before: repeats as runs."""
    index = LogIndex()
    for pdf in _gathered(batches, BATCH // 32):
        h, row, place = _windows(pdf)
        seen = index.scan(h)
        edge = np.concatenate([[True], (row[1:] != row[:-1]) | (seen[1:] != seen[:-1])]) if len(h) else np.zeros(0, dtype=bool)
        first = np.flatnonzero(edge)
        count = np.diff(np.concatenate([first, [len(h)]]))
        first, count = first[seen[first]], count[seen[first]]
        at = row[first]
        yield pd.DataFrame({"ord": pdf["ord"].to_numpy()[at], "tie": pdf["tie"].to_numpy()[at], "pos": (pdf["first"].to_numpy()[at] + place[first]) * 128 + count})


def _spread(batches):
    for pdf in _gathered(batches, BATCH // 32):
        h, row, place = _windows(pdf)
        yield pd.DataFrame({"h": h.view(np.int64), "ord": pdf["ord"].to_numpy()[row], "tie": pdf["tie"].to_numpy()[row], "first": pdf["first"].to_numpy()[row] + place})


def _second_pass_spread(batches):
    index = LogIndex()
    for pdf in _gathered(batches):
        gone = pdf[index.scan(pdf["h"].to_numpy())]
        yield pd.DataFrame({"ord": gone["ord"], "tie": gone["tie"], "pos": gone["first"] * 128 + 1})


def cut(data: bytes, places) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what stays) for packed places of repeated windows."""
    p = np.asarray(places, dtype=np.int64)
    first, count = p >> 7, p & 127
    change = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + count - 1 + SIZE, -1)
    gone = np.cumsum(change)[:-1] > 0
    begins = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
    return int(gone.sum()), begins, np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()


def _cuts(texts, places):
    rows = [(len(data), *cut(data, p)) for data, p in ((t.encode("utf-8", "surrogatepass"), p) for t, p in zip(texts, places, strict=True))]
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 4


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, and ``kept``, the bytes that stay."""
    spark = docs.sparkSession
    on_executors(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    all_rows = docs.select("doc_id", text.alias("text"), F.md5(text.cast("binary")).alias("digest"))
    slim = stored(all_rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "slim")
    # of equal texts, the row with the smallest id comes first; the others go wholly
    several = stored(slim.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep"), "several")
    repeated = stored(slim.groupBy("digest", "doc_id").count().where("count > 1").select("digest", "doc_id"), "repeated")
    any_repeated = repeated.limit(1).count() > 0

    def firsts(rows: DataFrame) -> DataFrame:
        got = rows.join(sized(several.withColumn("copied", F.lit(True))), "digest", "left").where("copied IS NULL OR doc_id <=> rep").drop("copied", "rep")
        if any_repeated:  # equal rows: one of each
            again = repeated.select("digest", F.col("doc_id").alias("_id"))
            same = (got.digest == again.digest) & got.doc_id.eqNullSafe(again["_id"])
            one = got.join(sized(again), same, "left_semi").dropDuplicates(["digest", "doc_id"])
            got = got.join(sized(again), same, "left_anti").unionByName(one)
        return got

    order = F.coalesce("doc_id", F.lit(LAST))
    shared_ids = stored(firsts(slim).groupBy(order.alias("ord")).count().where("count > 1").select("ord", F.lit(True).alias("shares")), "shared")
    unique = firsts(all_rows).withColumn("ord", order).join(sized(shared_ids), "ord", "left").select(
        "doc_id", "ord", F.when(F.col("shares"), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")).alias("tie"), "text")
    long_enough = unique.where(F.octet_length("text") >= SIZE).select("ord", "tie", "text")

    counted = long_enough.mapInPandas(_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in counted)
    frequent = [r.cell for r in counted if r.n > total / CELLS + FREQUENT]
    partitions = max(least, -(-total // ROWS))
    cell = F.shiftrightunsigned("g", 48)
    is_frequent = cell.isin(frequent) if frequent else F.lit(False)
    rows = long_enough.mapInPandas(_run_rows, RUN).withColumn("frequent", is_frequent)
    rows = rows.withColumn("salt", F.when(F.col("frequent"), F.pmod("c", F.lit(SALTS))).otherwise(F.lit(0)))
    found = stored(rows.repartition(partitions, "g", "salt").sortWithinPartitions("ord", "tie", "pos").drop("salt").mapInPandas(_first_pass, FOUND), "runs")

    opens = found.where("open").groupBy("ord", "tie").agg(F.collect_list(F.struct("g", "size", "pos")).alias("opens"))
    opens = stored(opens, "open")
    some = long_enough.join(sized(opens.select("ord", "tie")), ["ord", "tie"], "left_semi").join(opens, ["ord", "tie"])
    contents = stored(some.mapInPandas(_contents, CONTENT), "contents")
    usual = contents.where(F.col("size") < FREQUENT).repartition(partitions, "g").sortWithinPartitions("ord", "tie", "first").mapInPandas(_second_pass, GONE)
    gone = found.where("NOT open").select("ord", "tie", "pos").union(usual)
    many = contents.where(F.col("size") >= FREQUENT)  # also of anchors with that many contents in a cell that is not frequent
    if many.limit(1).count():
        spread = many.mapInPandas(_spread, WINDOW)
        gone = gone.union(spread.repartition(partitions, "h").sortWithinPartitions("ord", "tie", "first").mapInPandas(_second_pass_spread, GONE))
    places = stored(gone.groupBy("ord", "tie").agg(F.collect_list("pos").alias("places")), "places")

    out = "doc_id", "n_bytes", "n_removed", "n_spans", "kept"
    ids = sized(places.select("ord", "tie"))
    fields = StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    shortened = map_rows(unique.join(ids, ["ord", "tie"], "left_semi").join(places, ["ord", "tie"]), ["doc_id"], ["text", "places"], fields, _cuts)
    zero = F.lit(0).cast("long")
    whole = unique.join(ids, ["ord", "tie"], "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    # every row beyond the first of its text
    copies = slim.join(sized(several), "digest").withColumn("k", F.when(F.col("doc_id").eqNullSafe(F.col("rep")), F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("n_bytes"))).otherwise(2)).where("k > 1")
    gone_copies = copies.select(
        "doc_id", "n_bytes", F.when(F.col("n_bytes") >= SIZE, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
        F.when(F.col("n_bytes") >= SIZE, 1).otherwise(0).cast("long").alias("n_spans"), "digest")
    short = all_rows.where(F.octet_length("text") < SIZE).select("digest", F.col("text").cast("binary").alias("kept")).dropDuplicates(["digest"])
    gone_copies = gone_copies.where(F.col("n_bytes") >= SIZE).select(*out[:4], F.lit(b"").alias("kept")).union(
        gone_copies.where(F.col("n_bytes") < SIZE).join(short, "digest").select(*out))
    return whole.union(shortened).union(gone_copies)


def report(docs: DataFrame) -> DataFrame:
    got = remove_repeats(docs)
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
