"""Touch counts per channel merged into one row per account.

Each channel table has (cuenta_real, cuenta_sin_punto, marca, cantidad).
``merge_touches`` is the full outer join of the channels on the 3-column key
written as a tag-union + ONE aggregate (one shuffle instead of one per join,
and duplicate keys inside a channel are summed instead of fanning out).
``merge_touches_outer_chain`` is the literal chain of full outer joins, kept
as the equivalence reference. Both then keep portfolio brands only (F3,
before the per-account dedup: D6) and keep one row per account with an
explicit order (most touches, then brand, then account text: D5).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .topn import keyed_distinct

KEYS = ["cuenta_real", "cuenta_sin_punto", "marca"]


def channel_col(ch: str) -> str:
    return f"toques_{ch.lower()}"


def _prep(df: DataFrame) -> DataFrame:
    return df.select(F.col("cuenta_real"), F.col("cuenta_sin_punto"),
                     F.lower(F.col("marca")).alias("marca"),
                     F.col("cantidad").try_cast("bigint").alias("cantidad"))


def merge_touches(channels: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for ch, df in channels.items():
        p = _prep(df)
        sel = [F.col(k) for k in KEYS]
        for other in channels:
            sel.append((F.col("cantidad") if other == ch else F.lit(None).cast("bigint"))
                       .alias(channel_col(other)))
        parts.append(p.select(*sel))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.groupBy(*KEYS).agg(*[F.coalesce(F.sum(channel_col(ch)), F.lit(0)).alias(channel_col(ch))
                                 for ch in channels])
    return _finish(agg, list(channels))


def merge_touches_outer_chain(channels: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for ch, df in channels.items():
        p = _prep(df).groupBy(*KEYS).agg(F.sum("cantidad").alias(channel_col(ch)))
        out = p if out is None else out.join(p, KEYS, "full_outer")
    out = out.select(*KEYS, *[F.coalesce(F.col(channel_col(ch)), F.lit(0)).alias(channel_col(ch))
                              for ch in channels])
    return _finish(out, list(channels))


def _finish(df: DataFrame, channels: list[str]) -> DataFrame:
    kept = df.where(F.col("marca").isin(*fixed.PORTFOLIO_BRANDS))
    total = sum((F.col(channel_col(ch)) for ch in channels), F.lit(0))
    ranked = kept.withColumn("_neg_total", -total)
    one = keyed_distinct(ranked, ["cuenta_sin_punto"], ["_neg_total", "marca", "cuenta_real"])
    return one.drop("_neg_total")
