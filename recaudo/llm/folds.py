"""Labelled training rows for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bucket_of, text_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, in_training: Column, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, label (0 or 1), text of at most ``max_rows`` labelled rows that
    ``in_training`` allows: those whose id has the smallest hash. Rows without
    an id or a label of 0 or 1 take no part; a repeated id counts once (its
    largest label). The chosen labels, bounded by ``max_rows``, are broadcast
    to the documents, which don't shuffle."""
    chosen = (labels.filter(in_training & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # only the two columns that are asked for, so others may have any name
    rows = docs.select(F.col(id_col).alias("row_id"), text_of(text_col).alias("text"))
    return (rows.join(F.broadcast(chosen), F.col("row_id") == F.col("doc_id"))
            .select("doc_id", "label", "text"))


def fold_is(buckets: int, held_out: int, id_col: str = "doc_id") -> Column:
    """True for the ids whose labels are held out: crc32(id as text) mod ``buckets`` = ``held_out``."""
    return bucket_of(id_col, buckets) == held_out
