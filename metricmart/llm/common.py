"""What the operators share: reading a table, shared scratch tables, word hashing, components."""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import checkpoint_dir, ship_package

SHINGLE = 5  # words in a shingle
SIMILARITY = (80, 100)  # near duplicates: 100 * intersection >= 80 * union


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one given table, and only those."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage; the files survive lost executors and are read by all of them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, most: int = 300_000) -> DataFrame:
    """A stored table of a few short columns, hinted for broadcast if it has at most ``most`` rows;
    beyond that it is joined by a shuffle like any other."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


BATCH_ROWS = 1_000  # texts that a task holds at a time, in Arrow and in Python


def on_executors(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, and, where the session has Spark's
    default for short rows, bound the Arrow batches that rows with whole texts go in."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def held_out(doc_id, mod: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest`` modulo ``mod`` (a null id: never)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


def map_rows(df: DataFrame, keep: list[str], inputs: list[str], fields: StructType, fn) -> DataFrame:
    """``df``'s columns ``keep`` as they are (Arrow passes them through, nulls and all) with new ``fields``.

    ``fn`` gets a list of values per input column and returns a list per field, for a batch at a time;
    or, with a leading list of row numbers, rows in their place (fewer, or several of one).
    """
    on_executors(df.sparkSession)
    types = [f.type for f in to_arrow_schema(fields)]
    names = keep + fields.names

    def run(batches):
        for batch in batches:
            got = fn(*[batch.column(i).to_pylist() for i in inputs])
            held = [batch.column(k) for k in keep]
            if len(got) > len(types):
                at, *got = got
                held = [c.take(pa.array(at, type=pa.int64())) for c in held]
            yield pa.RecordBatch.from_arrays(held + [pa.array(g, type=t) for g, t in zip(got, types, strict=True)], names=names)

    schema = StructType(list(df.select(*keep).schema) + list(fields))
    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(run, schema)


class WordHash(dict):
    """Word bytes to a 64-bit hash, remembered up to ``most`` words per Python worker."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


WORD_HASH = WordHash()
MULTIPLIERS = np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=8).digest(), "little") | 1
                        for i in range(SHINGLE)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a fixed bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (bytes.split cuts at exactly those six characters)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASH.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(h: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words; fewer words: the whole sequence as one."""
    n = len(h)
    if not n:
        return h
    w = min(width, n)
    out = np.full(n - w + 1, w, dtype=np.uint64)
    for i in range(w):
        out = out + h[i:n - w + 1 + i] * MULTIPLIERS[i]
    return mix(out)


PLAIN = 0x250  # characters below it (Basic Latin to Latin Extended-B) are split by Python's own regular expressions


class Splitter:
    """All matches of a tokenizer's splitting pattern, in turn; each character of a text lies in one.

    Texts of characters below ``PLAIN`` are split by ``re``, with the classes of letters, numbers and white space written
    out for those characters. That gives the same matches as ``regex`` does, in a third of the time.
    """

    def __init__(self, pattern: str):
        self.slow = regex.compile(pattern)
        classes = {r"\p{L}": r"\p{L}", r"\p{N}": r"\p{N}", r"\s": r"[\t-\r \x85\xa0]"}
        plain = pattern.replace(r"\S", r"[^\s]")
        for name, meaning in classes.items():
            plain = plain.replace(name, "\x00" + name + "\x00")
        out, inside = [], False
        for part in re.split(r"(\x00.*?\x00|\\.|[\[\]])", plain):
            if part in ("[", "]"):
                inside = part == "["
            elif part.startswith("\x00"):
                part = self._ranges(classes[part.strip("\x00")])
                part = part if inside else f"[{part}]"
            out.append(part)
        self.fast = re.compile("".join(out))
        self.other = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")

    @staticmethod
    def _ranges(meaning: str) -> str:
        """The characters below ``PLAIN`` of a class, as ranges."""
        at = [c for c in range(PLAIN) if regex.fullmatch(meaning, chr(c))]
        runs = [[at[0], at[0]]]
        for c in at[1:]:
            if c == runs[-1][1] + 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)

    def __call__(self, text: str) -> list[str]:
        return (self.slow if not text.isascii() and self.other.search(text) else self.fast).findall(text)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected edges ``a, b``: rows ``id, component`` (smallest id).

    Alternates large-star and small-star rounds: each node's edges move to its smallest
    neighbour, so path lengths shrink geometrically. Rounds are cut by tables in the shared
    folder; no node or edge comes to the driver, only the count that tells the end.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: neighbours above u go to the smallest node in u's neighbourhood
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its neighbours below go to the smallest of them
        low2 = big.groupBy("a").agg(F.min("b").alias("m"))
        e = big.join(low2, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        e = stored(e, name)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            return e.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
        before = now
