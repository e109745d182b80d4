"""Exact dedup by two-pass Bloom filtering.

Pass 1 hashes every normalised text to ``hashes`` slots of a filter of
counters that saturate at two and keeps the slots that were hit twice, as a
bitmap. Two equal texts hit the same slots, so every repeated text has all
its slots in the bitmap. Pass 2 probes the bitmap: rows with a slot outside
it are unique and pass straight through without a shuffle; only the others
are grouped by the whole SHA-256 of the text, which removes false alarms.

The bitmap has ``slots_per_row`` bits a row, at most ``max_slots`` bits
(2**30 bits = 128 MB, the proven bound of what is broadcast). Beyond it the
false-alarm rate rises and more rows shuffle; the result stays exact.

Null text counts as empty, and empty texts equal each other. Two rows are
equal when their texts are identical without white space; the row with the
most code points, then the smallest id, stays. Rows that repeat a doc_id and
a text are copies of one document: each of them names that id as its keeper.
A null id sorts after all others. :func:`drop_exact_duplicates` keeps one row
a group, also of rows that repeat an id (a file loaded twice). Other columns,
whatever their names, are not read by :func:`exact_duplicates` and pass
through :func:`drop_exact_duplicates` unchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, read_table, text_of, whole_row, written
from .registry import register

CHUNK_BITS = 32768      # bits of one bitmap_construct_agg result


def normalised(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def _slots(sha: str, hashes: int, slots: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(sha), F.lit(i)), F.lit(slots)) for i in range(hashes)]


def repeated_slots(hashed: DataFrame, sha: str, hashes: int, slots: int) -> np.ndarray:
    """Pass 1: bitmap of the slots that were hit at least twice."""
    hit = (hashed.select(F.explode(F.array_distinct(F.array(*_slots(sha, hashes, slots)))).alias("slot"))
           .groupBy("slot").agg(F.count("*").alias("hits")).filter("hits > 1")
           .select((F.col("slot") + 1).alias("slot")))
    chunks = (hit.groupBy(F.bitmap_bucket_number("slot").alias("chunk"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")))
    bitmap = np.zeros(slots // 8, dtype=np.uint8)
    for row in chunks.toLocalIterator():          # bounded by max_slots / 8 bytes
        start = (row.chunk - 1) * (CHUNK_BITS // 8)
        bitmap[start:start + CHUNK_BITS // 8] = np.frombuffer(row.bits, dtype=np.uint8)
    return bitmap


def maybe_repeated(hashed: DataFrame, sha: str, slots_per_row: int = 8, hashes: int = 4,
                   max_slots: int = 1 << 30):
    """Both passes' column: true for every row whose text may be repeated."""
    rows = max(1, hashed.count())
    slots = CHUNK_BITS
    while slots < min(rows * slots_per_row, max_slots):
        slots *= 2
    shared = hashed.sparkSession.sparkContext.broadcast(repeated_slots(hashed, sha, hashes, slots))

    @F.pandas_udf("boolean")
    def probe(*columns: pd.Series) -> pd.Series:
        bits, found = shared.value, True
        for c in columns:
            at = c.to_numpy(dtype=np.int64)
            found = found & ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        return pd.Series(found)

    return probe(*_slots(sha, hashes, slots))


def _keepers(suspects: DataFrame) -> DataFrame:
    """text_sha256, keep_id, group_size of every text that has copies."""
    best = F.min(F.struct((-F.col("n_code")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")))
    groups = (suspects.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size")).filter("group_size > 1")
              .select("text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size"))
    # a table of its own: the join with the suspects then has two plain exchanges, whose hot groups AQE splits
    return written(groups, "exact-keepers")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bloom) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    hashed = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.sha2(normalised(text_of(text_col)).cast("binary"), 256).alias("text_sha256"),
        F.length(text_of(text_col)).alias("n_code")), "exact-hashes")
    flagged = hashed.withColumn("suspect", maybe_repeated(hashed, "text_sha256", **bloom))
    straight = flagged.filter(~F.col("suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    suspects = flagged.filter("suspect")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    shuffled = suspects.join(_keepers(suspects), "text_sha256", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
    return straight.unionByName(shuffled)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bloom) -> DataFrame:
    """One row of each group of equal texts, with all its columns: of the
    longest original texts the smallest id, of rows that repeat an id the one
    whose columns hash least. Texts are read and hashed once, and written with
    their hashes; rows that the filter finds unique never shuffle."""
    rows = written(docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"),
                               F.sha2(normalised(text_of(text_col)).cast("binary"), 256).alias("sha"),
                               (-F.length(text_of(text_col))).alias("neg"), F.monotonically_increasing_id().alias("place")), "exact-rows")
    flagged = rows.withColumn("suspect", maybe_repeated(rows.select("sha"), "sha", **bloom))
    suspects = flagged.filter("suspect")
    best = F.min(F.struct("neg", F.col("id").isNull().alias("no_id"), "id", "hash", "place"))
    keepers = written(suspects.select("sha", "neg", "id", F.xxhash64(F.to_json("row")).alias("hash"), "place").groupBy("sha").agg(best.alias("best"))
                      .select(F.col("sha").alias("of_sha"), F.col("best.place").alias("keep_place")), "exact-keepers")
    stay = suspects.join(keepers, (F.col("sha") == F.col("of_sha")) & (F.col("place") == F.col("keep_place")), "left_semi")
    return flagged.filter(~F.col("suspect")).select("row.*").unionByName(stay.select("row.*"))


ORACLE = r"""
WITH h AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS n_code
  FROM documents),
k AS (
  SELECT text_sha256, first(doc_id ORDER BY n_code DESC, doc_id) AS keep_id, count(*) AS group_size
  FROM h GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM h JOIN k USING (text_sha256)
"""


@register("op3_exact_dedup", ORACLE)
def op3_exact_dedup(spark, sf_dir):
    return exact_duplicates(read_table(spark, sf_dir, "documents"))
