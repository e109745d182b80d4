"""Join helpers: bounded / checked broadcast and null-key spreading.

Rules the library follows:

* A side is broadcast only when its size is bounded by construction
  (``broadcast_bounded``: e.g. one row per calendar month, a fixed lookup
  table) or after an explicit bounded count (``broadcast_if_small``); beyond
  the bound the join stays a shuffle join and AQE decides at runtime.
* Right sides are reduced to one row per key before a left join (no fan-out).
* Consolidation chains are left joins from the base: rows that would vanish
  under the base filters are never built, and same-key joins reuse one hash
  partitioning instead of re-shuffling after every ``coalesce(k, k)`` key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_bounded(df: DataFrame, max_rows: int, reason: str) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction.

    ``max_rows`` and ``reason`` document the bound (e.g. "one row per
    calendar month"); nothing is counted at runtime.
    """
    if max_rows > 10_000_000:
        raise ValueError(f"bound too large to broadcast: {reason}")
    return F.broadcast(df)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast after a bounded check (``limit(max_rows + 1).count()``, stops
    early); a larger side is returned unchanged and joined by shuffle (AQE may
    still switch strategies from runtime statistics)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def spread_null_key(key: Column, spread: Column) -> Column:
    """Join key that never matches when ``key`` is NULL and spreads such rows
    over all partitions (instead of one hot NULL partition):
    NULL -> '\\u0000' + spread value. ``spread`` should be a near-unique
    column of the row (e.g. the account)."""
    return F.when(key.isNull(), F.concat(F.lit("\u0000"), spread.cast("string"))) \
        .otherwise(key.cast("string"))
