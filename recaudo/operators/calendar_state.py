"""The assignment calendar kept up file by file.

The folded days of a month (mask, first day, last day, earliest row) are a
state that merges: masks by ``bit_or``, first days and earliest rows by
``min``, last days by ``max``. All four give the same whatever the order, and
adding the same days twice changes nothing, so files may come late, out of
order, or again after a failure.

The state is a Parquet folder by month. A new file is folded first, on its
own; only the months it holds are read, merged in one aggregate (a row a key
and month on either side) and written to a staging folder, whose months then
take the places of the old ones. All other months keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import committed
from ..sources.files import hadoop_fs
from . import calendar

MONTH = "month"


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, month) from rows of any number of states."""
    aggs = [F.bit_or("day_mask").alias("day_mask"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")]
    if "first_row" in states.columns:
        aggs.append(F.min("first_row").alias("first_row"))
    return states.groupBy(*keys, MONTH).agg(*aggs)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn(MONTH, F.col(MONTH).cast("date"))


def _months(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith(f"{MONTH}=")) if fs.exists(p) else []


def add_days(df: DataFrame, path: str, keys: Sequence[str], date_col: str, attrs: Sequence[str] = ()) -> list[str]:
    """Adds the days of ``df`` to the state in ``path``. Returns the month
    folders that were replaced (none for a file without dated rows)."""
    spark = df.sparkSession
    new, staged = committed.beside(spark, path, "new"), committed.beside(spark, path, "staging")
    try:
        calendar.day_mask_agg(df, keys, date_col, attrs).write.partitionBy(MONTH).parquet(new)
        touched = _months(spark, new)
        if not touched:
            return []
        for m in touched:
            committed.recover(spark, f"{path}/{m}")
        states = read_state(spark, new)
        old = [f"{path}/{m}" for m in _months(spark, path) if m in set(touched)]
        if old:
            states = states.unionByName(spark.read.option("basePath", path).schema(states.schema).parquet(*old))
        merge_states(states, keys).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(staged)
        return committed.swap_partitions(spark, staged, path)
    finally:
        committed.delete(spark, new)
        committed.delete(spark, staged)


def calendar_from(state: DataFrame, keys: Sequence[str], attrs: Sequence[str] = (), labels: str | None = "array", day_prefix: str = "dia_") -> DataFrame:
    """The calendar of everything added so far; a month's last day is the last one added."""
    last_days = state.groupBy(MONTH).agg(F.max("last_day").alias("month_last_day"))
    return calendar.calendar_of(state, last_days, keys, attrs, labels, day_prefix)
