"""First row per key, deterministic keyed distinct and top-N slots.

* ``first_row_per_key``: ``min(struct(order..., cols...))`` per key - a
  partial aggregate, so a hot key costs one row per map task; ties are broken
  by the remaining columns, never arbitrarily (D5).
* ``top_n_slots``: distinct (key, value) -> ``row_number() <= n`` per key ->
  pivot to ``n`` slot columns. Spark plans the rank filter as a partial
  WindowGroupLimit *before* the shuffle, so each map task ships at most ``n``
  rows per key; values beyond the first ``n`` get no slot (the report layout
  has fixed slots, as in the reference).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      cols: Sequence[str]) -> DataFrame:
    """For each key the row with the smallest ``order`` tuple (then smallest
    ``cols``), a NULL after every value; returns keys + order + cols."""
    rest = [c for c in cols if c not in order and c not in keys]
    out = [*order, *rest]
    s = F.struct(*[x for i, c in enumerate(out) for x in (F.col(f"`{c}`").isNull().alias(f"_n{i}"), F.col(f"`{c}`").alias(f"_v{i}"))])
    agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(s).alias("_first"))
    return agg.select(*[F.col(f"`{k}`") for k in keys], *[F.col("_first")[f"_v{i}"].alias(c) for i, c in enumerate(out)])


def keyed_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the survivor chosen by ``order`` (deterministic
    replacement of ``dropDuplicates(keys)``): the row that
    :func:`first_row_per_key` picks, by a rank that leaves wide rows as they
    are (Spark keeps one row a key and task before the shuffle)."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def ranked_values(df: DataFrame, keys: Sequence[str], value: str, n: int,
                  order: Sequence[Column] | None = None) -> DataFrame:
    """Distinct (keys, value) with ``slot`` = rank of the value inside the
    key (ascending unless ``order`` is given), only ranks <= n."""
    d = df.select(*keys, value).where(F.col(value).isNotNull()).dropDuplicates([*keys, value])
    w = Window.partitionBy(*keys).orderBy(*(order or [F.col(value).asc()]))
    return d.withColumn("slot", F.row_number().over(w)).where(F.col("slot") <= n)


def top_n_slots(df: DataFrame, keys: Sequence[str], value: str, n: int,
                prefix: str, order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key with slot columns ``{prefix}1`` .. ``{prefix}{n}``
    holding the first ``n`` distinct values in order (NULL when fewer)."""
    r = ranked_values(df, keys, value, n, order)
    return r.groupBy(*keys).agg(
        *[F.max(F.when(F.col("slot") == i, F.col(value))).alias(f"{prefix}{i}")
          for i in range(1, n + 1)])


def slot_columns(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, n + 1)]
