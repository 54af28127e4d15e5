"""The pipeline's stages on awkward rows and on the smallest table, against plain versions."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def through(spark, docs):
    kept = [docs]
    for _, stage in P.STAGES:
        kept.append(stage(spark, kept[-1], SF).cache())
    return kept


def test_stages_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, placed, single, clean, private, tokens = through(spark, docs)
    assert all(x.columns == list(P.COLUMNS) for x in (placed, single, clean, private))
    assert placed.count() == docs.count()  # every document there is in a known language
    rows = [(r.doc_id, r.text) for r in placed.collect()]
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute.jaccard(rows)}
    assert clean.count() <= single.count()
    assert private.where(F.col("n_chars") != F.char_length("text")).count() == 0
    for r in private.collect():
        assert sum(brute.pii(r.text)[0]) == 0
    assert tokens.count() == clean.count() and tokens.where("NOT intact").count() == 0


def test_stages_of_awkward_rows(spark, docs, no_docs):
    *_, private, tokens = through(spark, docs)
    assert tokens.where("intact").count() == private.count() > 0
    assert through(spark, no_docs)[-1].count() == 0


def test_run(spark):
    assert P.run(spark, SF).count() > 0
    assert P.ORACLE_SQL is None
