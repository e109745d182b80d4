"""Operators and stages give the same with further columns of any name."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recaudo.llm import (chat, exact_dedup, html_text, mixing, near_dedup, period_runs, pii, quality, secret_scan, sentencepieces, token_alignment, toxicity,
                         vp_search)
from recaudo.llm.common import read_table
from recaudo.llm.folds import fold_is, labelled_sample

SF = "/root/testdata/sf0.001"
NAMES = ("label copy id __id text_sha256 score rank row row_id value start end path base terms region component a b n sha place suspect hash neg count first parts cdf "
         "mix_rate mix_key shingles labels set_key known telling conv vec dim block shard __host host winners key chunk docs pair runs collapsed best keep_id group_size __keep "
         "line entity gram letters window_no seq head body said tokens is_system turns").split()


def clashing(df):
    return df.select("*", *[F.lit(7).alias(c) for c in NAMES if c not in df.columns])


def toxic(docs, labels):
    model = toxicity.fit(labelled_sample(docs, labels, "toxic", ~fold_is(5, 0), 200))
    return toxicity.score(docs, model).select("doc_id", "score")


OPERATORS = {
    "near_dedup": ("documents", lambda d, _: near_dedup.near_duplicates(d)),
    "near_drop": ("documents", lambda d, _: near_dedup.drop_near_duplicates(d).select("doc_id", "text")),
    "vectors": ("embeddings", lambda d, _: vp_search.nearest_neighbours(d, d.filter("vec_id % 50 = 0"), k=3)),
    "exact": ("documents", lambda d, _: exact_dedup.exact_duplicates(d)),
    "exact_drop": ("documents", lambda d, _: exact_dedup.drop_exact_duplicates(d).select("doc_id", "text")),
    "secrets": ("documents", lambda d, _: secret_scan.scan_secrets(d).select("doc_id", "start", "end", "value")),
    "toxicity": ("documents", toxic),
    "quality": ("documents", lambda d, s: quality.quality_scores(d, s)),
    "pii": ("documents", lambda d, _: pii.pii_digest(pii.find_pii(d))),
    "sentencepiece": ("documents", lambda d, _: sentencepieces.encode(d)),
    "mixing": ("documents", lambda d, _: mixing.mix(d).select("doc_id", "text", "source")),
    "chat": ("conversations", lambda d, _: chat.chat_windows(d)),
    "html": ("pages", lambda d, _: html_text.extract_text(d)),
    "alignment": ("documents", lambda d, _: token_alignment.align_tokenizers(d)),
    "runs": ("documents", lambda d, _: period_runs.periodic_runs(d)),
}


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_with_clashing_columns(spark, name):
    table, run = OPERATORS[name]
    rows, labels = read_table(spark, SF, table), read_table(spark, SF, "labels")
    assert collected(run(clashing(rows), clashing(labels))) == collected(run(rows, labels))


def test_stages_with_clashing_columns(spark):
    plain = read_table(spark, SF, "documents")
    wide = clashing(plain).withColumn("copy", F.col("doc_id") * 10)
    for name, stage in corpus_pipeline.STAGES:
        plain, before, wide = stage(spark, plain, SF), wide.columns, stage(spark, wide, SF)
        if name != "sentencepiece":
            assert wide.columns == before
            assert wide.filter("copy <> doc_id * 10").count() == 0
        assert collected(wide.select(*plain.columns)) == collected(plain)
