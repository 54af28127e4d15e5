"""Packing by concatenate and cut: documents follow each other in one stream of ids, cut every ``WINDOW``.

* First pass: every whole text is encoded once, where Spark read it. A task writes each document's ids, its number
  of ids and the sum of those before it in the task (``at``), into the shared folder.
* The totals per partition are summed up in two levels (within blocks of ``BLOCK`` partitions, then over
  the blocks), which gives each partition's global offset. No task sees more than a block.
* Second pass: a document's place in the stream is its partition's offset plus ``at``. It is cut where the
  stream crosses a window's end; a document across such a boundary has a piece on either side.

Only the last window can be short, so padding is less than one window for the whole table. The order is
that of the table's partitions, then rows. It is written down by the first pass, so a lost executor, a repeated task or
another split of the second pass changes nothing.

``Coder`` gives what the tokenizers library gives for the whole text with the given file: the library splits a text at its
special tokens, then into the matches of a pattern, and merges the bytes of each match by the file's list of
pairs. The tiktoken library does the same merges several times as fast. It is used where ``agrees`` has shown that it must
give the same, but for texts with a special token or with a character that the two libraries' regular
expressions might class differently. Those go through the tokenizers library.

Defined results: null and empty texts have no ids but the end mark, so one piece of length 1; repeated rows
are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import map_rows, on_executors, sized, stored

WINDOW = 2048
END = 1  # the id after every document
BLOCK = 1024  # partitions whose totals one task sums up

#: the split of byte-level tokenizers (fixed value)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters outside the ranges whose letters, digits and spaces are the same in all Unicode versions in use
UNSETTLED = re.compile("[^\x00-\u0557\u2000-\u206f\u3000-\u9fff\uac00-\ud7a3\U0001f300-\U0001f9ff]")


def byte_letters() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: printable Latin-1 for itself, the
    others as the characters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def agrees(merges: list[tuple[bytes, bytes]]) -> bool:
    """Whether merging by the rank of the joined bytes gives the same as merging by this list of pairs.

    Both take the lowest rank first and the leftmost of equals. They can only part where two neighbours x and y, that
    aren't listed as a pair, join to a token t. No merge has crossed the ends of x and y by then, so the merges inside were those of t's
    bytes alone, in the same order: x, y is the one state of two parts that these go through. If t's own
    bytes merge to t by the list, that state is t's listed pair, and nothing can part. So it is enough that each token has one pair, and that its
    bytes merge to it.
    """
    rank = {pair: i for i, pair in enumerate(merges)}

    def merged(token: bytes) -> int:
        parts = [bytes([b]) for b in token]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return len(parts)

    return len({a + b for a, b in merges}) == len(merges) and all(merged(a + b) == 1 for a, b in merges)


def ranks(tokenizer: str) -> dict[bytes, int] | None:
    """Ranks of the tokens that tiktoken can merge by; None where that might differ."""
    spec = json.loads(tokenizer)
    byte = {c: b for b, c in enumerate(byte_letters())}
    raw = lambda token: bytes(byte[c] for c in token)
    merges = [tuple(map(raw, p if isinstance(p, list) else p.split(" "))) for p in spec["model"]["merges"]]
    ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in byte for c in t)}
    in_order = [ids[a + b] for a, b in merges]
    if in_order != sorted(in_order) or any(bytes([b]) not in ids for b in range(256)) or max(ids[bytes([b])] for b in range(256)) > in_order[0]:
        return None
    return ids if agrees(merges) else None


class Coder:
    """Whole texts to the bytes of their ids, as the tokenizers library gives them."""

    def __init__(self, tokenizer: str, ranks: dict[bytes, int] | None):
        import tiktoken
        import tokenizers

        self.library = tokenizers.Tokenizer.from_str(tokenizer)
        self.fast = ranks and tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        specials = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast and not self.special.search(text) and (text.isascii() or not UNSETTLED.search(text)):
            ids = self.fast(text)
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.kind).tobytes()


def encoded(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, part, at, n, ids: each document's ids (as bytes) and its place in its partition."""
    on_executors(docs.sparkSession)
    with open(path, encoding="utf-8") as f:  # (executors needn't have the file)
        tokenizer = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, ranks(tokenizer)))
    schema = StructType([docs.schema["doc_id"]]).add("part", "integer").add("at", "long").add("n", "long").add("ids", "binary")

    def run(batches):
        coder, part, at = Coder(*shared.value), TaskContext.get().partitionId(), 0
        last = np.array([end], dtype=coder.kind).tobytes()
        for batch in batches:
            ids = [coder.encode(t) + last for t in batch.column(1).to_pylist()]
            n = np.array([len(x) // coder.kind.itemsize for x in ids], dtype=np.int64)
            places = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(places), pa.array(n), pa.array(ids, pa.binary())],
                                             names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def offsets(table: DataFrame) -> DataFrame:
    """part, base: the ids in all partitions before each one."""
    totals = stored(table.groupBy("part").agg(F.sum("n").alias("n")).withColumn("block", F.floor(F.col("part") / BLOCK)), "totals")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.join(blocks, "block").select("part", (F.col("base") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("base"))


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and its ids)."""
    table = stored(encoded(docs, path, end), "ids")
    placed = table.join(sized(stored(offsets(table), "offsets")), "part").select("doc_id", (F.col("base") + F.col("at")).alias("place"), F.col("n").alias("doc_tokens"), "ids")

    def cut(places, sizes, ids):
        rows = []
        for i, (place, n, raw) in enumerate(zip(places, sizes, ids, strict=True)):
            own = np.frombuffer(raw, dtype=f"<u{len(raw) // n}").astype("<u4")
            a = 0
            while a < n:
                offset = (place + a) % window
                b = min(n, a + window - offset)
                rows.append((i, a, b - a, zlib.crc32(own[a:b].tobytes()), (place + a) // window, offset, *([own[a:b].tolist()] if with_ids else [])))
                a = b
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * (6 + with_ids)

    fields = StructType()
    for name in ("start", "length", "ids_crc32", "sequence_id", "offset"):
        fields = fields.add(name, "long")
    if with_ids:
        fields = fields.add("ids", ArrayType(LongType()))
    return map_rows(placed, ["doc_id", "doc_tokens"], ["place", "doc_tokens", "ids"], fields, cut)
