"""Joins on keys of which a few hold a large part of all rows.

The hot keys come from a mergeable sketch of the key column
(``approx_top_k``: one partial aggregate of bounded size a task), as a table
inside the plan: building the plan runs no job, and the plan is the same for
any data. The sketch counts every row; with ``tracked`` counters its error is
below ``n / (0.75 * tracked)``, so it names every key with a share of at least
``share`` as long as ``tracked`` is well above ``1 / share``. A key that it
names beyond need costs a few more rows of the other side, never a wrong one.

In the join a hot key's rows are dealt over ``salts`` keys by a hash of
``spread``, and the other side has its row of a hot key once a salt; all
other keys have salt 0 on both sides. At most ``1 / share`` keys are hot, so
the table of hot keys is small by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_bounded


def hot_keys(df: DataFrame, key: str, share: float = 0.01, tracked: int = 10_000) -> DataFrame:
    """(``key``): keys that hold at least ``share`` of the rows of ``df``
    whose key is not NULL; at most ``1 / share`` of them."""
    if not 0 < share <= 1 or tracked * share < 4:
        raise ValueError("tracked must be at least 4 / share for the sketch to see all hot keys")
    most = min(int(1 / share), tracked)
    k = F.col(key)
    top = df.where(k.isNotNull()).select(k.alias("_k")).agg(
        F.expr(f"approx_top_k(_k, {most}, {tracked})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    return (top.select("_n", F.explode("_top").alias("_t"))
            .where(F.col("_t")["count"] >= F.col("_n") * F.lit(share)).select(F.col("_t")["item"].alias(key)))


def hot_left_join(left: DataFrame, right: DataFrame, key: str, spread: str, share: float = 0.01, salts: int = 64,
                  tracked: int = 10_000) -> DataFrame:
    """Left join on ``key`` with the hot keys of ``left`` dealt over
    ``salts``. ``right`` may have any number of rows a key; ``spread`` is a
    near-unique column of ``left``. NULL keys match nothing and are dealt by
    ``spread`` as well."""
    hot = hot_keys(left, key, share, tracked).select(F.col(key).alias("_hot"))
    marks = broadcast_bounded(hot, int(1 / share), "keys that hold at least this share of the rows")
    salt = F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int")
    dealt = left.join(marks, left[key] == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), salt).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread_out = right.where(F.col(key).isNotNull()).join(marks, right[key] == F.col("_hot"), "left") \
        .withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(spread_out, [key, "_salt"], "left").drop("_salt")
