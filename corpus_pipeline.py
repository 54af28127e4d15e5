"""The corpus pipeline: five stages, each on all the documents that its predecessor kept.

Language ID drops what it can't place; of near duplicates one document stays; documents that hold a
benchmark item go; personal data is replaced by its kind; what is left is encoded by byte-level
BPE, decoded again and compared. The last stage gives a row per document with its ids.

A stage gets any table with the columns of ``documents`` (others are dropped) and gives those columns
back. Null, empty and letterless texts go in the first stage. Empty tables pass through.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metricmart.llm import bpe, decontam, jaccard, langid, pii  # noqa: E402
from metricmart.llm.common import stored, table  # noqa: E402
from metricmart.llm.queries import tokenizer  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those for which no language stands out.

    With no labelled document at all there is nothing to tell languages by, and whatever has a letter stays.
    """
    slim = docs.select(*COLUMNS)
    model = langid.fit(slim)
    if not model.langs:
        return slim.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(slim, model)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= langid.ACCEPT)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links (by 80 % of five-word shingles) join together."""
    return jaccard.first_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of ``benchmark``."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    slim = docs.select(*COLUMNS)
    return pii.redact(slim, pii.fit(slim)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding them gave the text's bytes back."""
    got = bpe.round_trip(docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)),
                         tokenizer(), keep=("doc_id", "text_sha256"), with_ids=True)
    return got.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", (F.col("text_sha256") == F.col("decoded_sha256")).alias("intact"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", redact),
    ("byte-level BPE", tokenize),
]
#: SQL expresses neither the trained models nor the merges; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
