"""Readers for the parquet tables the query catalog runs on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_HANDLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; column pruning and filters reach the parquet scan because
    every query selects / filters declaratively on top of this. The handle
    (a plan, not data) is kept per session so that the footer/schema is read
    once per path."""
    if name not in TABLES:
        raise KeyError(name)
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, path)
    df = _HANDLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _HANDLES[key] = df
    return df
