"""Export-folder merge: CSV files with ',' or ';' and drifting columns ->
one table (missing columns NULL), both account spellings with the trailing
'-', month constants, exact duplicates removed."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.delimited import FolderScan, read_drifting_folder


def merge_export_folder(spark: SparkSession, folder: str | list[str], month: int, year: int,
                        encoding: str = "UTF-8", skip_unreadable: bool = False) -> FolderScan:
    scan = read_drifting_folder(spark, folder, encoding=encoding, skip_unreadable=skip_unreadable)
    if scan.df is None:
        return scan
    df = scan.df
    for c in ("Cuenta_Real", "Cuenta_Sin_Punto"):
        if c in df.columns:
            df = df.withColumn(c, F.concat(F.col(c), F.lit("-")))
    df = df.withColumns({"MES DE ASIGNACION": F.lit(month), "PERIODO DE ASIGNACION": F.lit(year)})
    scan.df = df.dropDuplicates()
    return scan
