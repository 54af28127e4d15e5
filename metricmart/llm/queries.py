"""The queries of the dealt operators: thin calls that read the given tables whole."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, decontam, jaccard, langid, lexsearch, pack, pii, quality, secrets, shard, spelling, suffix_dedup
from .common import table


def tokenizer() -> bpe.Codec:
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer())


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  table(spark, sf_dir, "labels", "doc_id", "quality"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexsearch.search(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_neighbours": op2_neighbours,
    "op3_jaccard": op3_jaccard,
    "op4_pii": op4_pii,
    "op5_repeats": op5_repeats,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_secrets": op8_secrets,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_lexical_search": op12_lexical_search,
    "op13_packing": op13_packing,
}

SQL: dict[str, str] = {
    "op12_lexical_search": r"""
        WITH bags AS (
            SELECT doc_id, list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
            FROM documents),
        corpus AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM bags WHERE len(terms) > 0),
        tallies AS (
            SELECT doc_id, length, term, count(*) AS tf
            FROM (SELECT doc_id, len(terms) AS length, unnest(terms) AS term FROM bags) GROUP BY ALL),
        wanted AS (
            SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM benchmark),
        weighed AS (
            SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM tallies, corpus GROUP BY term),
        scored AS (
            SELECT item_id, doc_id,
                CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * length * docs) // total)))) AS BIGINT) AS score
            FROM wanted JOIN weighed USING (term) JOIN tallies USING (term), corpus GROUP BY item_id, doc_id)
        SELECT * FROM (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0)
        WHERE rank <= 10""",
}
