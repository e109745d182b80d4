"""Corpus pipeline: each stage gets what its predecessor kept.

``STAGES`` lists (name, function(spark, docs, sf_dir)); ``run`` applies them
to ``documents``, writing each result to the shared folder and reading it
again. All but the last return the columns of documents. A stage takes nulls,
empty texts, repeated rows and empty tables as its operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recaudo.llm import exact_dedup, mixing, near_dedup, quality, sentencepieces
from recaudo.llm.common import read_table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. It learns from
    the rows of ``labels`` outside the held-out fold."""
    model = quality.quality_model(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to equal shares of all sources, in a global random
    order. The mixture is as large as its input."""
    return mixing.mix(docs, seed=mixing.SEED).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip."""
    return sentencepieces.encode(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: Learned and iterative stages have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
