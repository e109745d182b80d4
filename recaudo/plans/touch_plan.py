"""Touch table: four channel exports (SMS, EMAIL, BOT, IVR; each with
Cuenta_Real, Cuenta_Sin_Punto, Marca, Cantidad) -> one row per account with
the touches per channel, portfolio brands only."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import touches
from ..sources.delimited import read_by_header

CHANNEL_COLUMNS = ["Cuenta_Real", "Cuenta_Sin_Punto", "Marca", "Cantidad"]


def read_channels(spark: SparkSession, folder: str, pattern: str = "Consolidado {ch}.csv",
                  sep: str = ",") -> dict[str, DataFrame]:
    return {ch: read_by_header(spark, os.path.join(folder, pattern.format(ch=ch)), CHANNEL_COLUMNS, sep=sep)
            for ch in fixed.TOUCH_CHANNELS}


def touch_table(channels: dict[str, DataFrame], month: int, year: int) -> DataFrame:
    prepared = {ch: df.select(F.col("Cuenta_Real").alias("cuenta_real"),
                              F.col("Cuenta_Sin_Punto").alias("cuenta_sin_punto"),
                              F.col("Marca").alias("marca"), F.col("Cantidad").alias("cantidad"))
                for ch, df in channels.items()}
    t = touches.merge_touches(prepared)
    return t.select(
        F.col("cuenta_real").alias("Cuenta_Real"), F.col("cuenta_sin_punto").alias("Cuenta_Sin_Punto"),
        F.col("marca"),
        *[F.col(touches.channel_col(ch)).alias(f"Toques por {ch}") for ch in channels],
        F.lit(month).alias("MES DE ASIGNACION"), F.lit(year).alias("PERIODO DE ASIGNACION"))
