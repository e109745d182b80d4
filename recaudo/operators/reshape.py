"""Reshaping: union by name with constants and exact-duplicate removal,
unpivot, month sequences for backfills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(parts: Sequence[DataFrame], constants: Mapping[str, object] | None = None,
                  distinct: bool = True) -> DataFrame:
    """Union of tables with drifting column sets (missing columns -> NULL),
    constant columns added, exact duplicate rows removed (one shuffle)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if constants:
        out = out.withColumns({k: F.lit(v) for k, v in constants.items()})
    return out.dropDuplicates() if distinct else out


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            name: str = "medida", value: str = "valor") -> DataFrame:
    """Wide -> long (one output row per id row and value column); no shuffle."""
    return df.unpivot(list(ids), list(values), name, value)


def month_sequence(df: DataFrame, date_col: str, name: str = "mes") -> DataFrame:
    """Every calendar month from the first to the last month present
    (empty months included): a 1-row min/max aggregate exploded into months,
    so no join is needed to build the calendar."""
    d = F.trunc(F.to_date(F.col(date_col)), "month")
    bounds = df.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias(name))


def monthly_backfill(df: DataFrame, date_col: str, aggs: Mapping[str, object],
                     fill: Mapping[str, object] | None = None, name: str = "mes",
                     where=None) -> DataFrame:
    """Aggregates per month over the whole month range of ``df``; ``where``
    restricts the rows that are aggregated (not the month range), so months
    without such rows appear with ``fill`` values. The month table is bounded
    by the calendar (at most 12 rows per year), so it is broadcast."""
    d = F.trunc(F.to_date(F.col(date_col)), "month")
    rows = df if where is None else df.where(where)
    per = rows.groupBy(d.alias(name)).agg(*[c.alias(n) for n, c in aggs.items()])
    months = F.broadcast(month_sequence(df, date_col, name))
    out = months.join(per, name, "left")
    if fill:
        out = out.fillna(dict(fill))
    return out
