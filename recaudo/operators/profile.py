"""Data-quality profile of the sources: what the reports' previews showed,
as one partial aggregate a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, fixed
from . import geo


def source_profile(df: DataFrame, name: str, key: str, date: str | None = None, unmapped: Column | None = None) -> DataFrame:
    """tabla, filas, fechas_distintas, claves_nulas, sin_mapear."""
    return df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas"),
                  (F.count_distinct(F.to_date(date)) if date is not None else F.lit(None).cast("bigint")).alias("fechas_distintas"),
                  F.count_if(F.col(key).isNull()).alias("claves_nulas"),
                  F.count_if(F.lit(False) if unmapped is None else unmapped).alias("sin_mapear"))


def unparsable_dates(df: DataFrame, column: str) -> DataFrame:
    """The d/M/yyyy texts that are no date, with their rows: valor, filas."""
    c = F.col(f"`{column}`")
    return (df.where(c.isNotNull() & (F.trim(c) != "") & dates.parse_dmy(c).isNull())
            .groupBy(c.alias("valor")).agg(F.count(F.lit(1)).alias("filas")))


def unidentified_cities(df: DataFrame, city: str, patterns: geo.PatternDictionary) -> DataFrame:
    """The city texts that resolve to no department, with their rows: valor, filas."""
    counted = df.groupBy(F.col(f"`{city}`").alias("valor")).agg(F.count(F.lit(1)).alias("filas"))
    found = geo.resolve_departments(counted, "valor", patterns, out_city="_city_out")
    return found.where(F.col("departamento") == fixed.CITY_UNRESOLVED).select("valor", "filas")
