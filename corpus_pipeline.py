"""A corpus pipeline of four stages: toxic documents go, one document of each group of near copies stays,
sources are mixed to target weights, and what is left is encoded.

Each stage works on all rows that the one before it kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from malgeul.llm import byte_bpe, jaccard, mixture, queries, toxicity
from malgeul.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of grade 0 by a model of the labels of the rows that there are."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("grade") == 0).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least doc_id of each group of linked rows."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    return mixture.apply_mix(docs, mixture.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    return byte_bpe.round_trip(docs, queries.byte_codec(), keep=("source",))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("mixture", mix_sources), ("byte_bpe", encode)]

#: A fitted model and hashed draws decide what stays: no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
