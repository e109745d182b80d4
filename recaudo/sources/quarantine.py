"""Broken rows of delimited files, kept with their file and line.

A row is broken if it has more or fewer values than its file's header. Good
rows come from one CSV scan a header group; broken ones from the same files
read as lines, so that file, line number and raw text are known. Rows are
lines here, as in the scan: a quoted value holds no line end.

A large file is read in several splits, and a task knows a line's place in
its split only. One aggregate counts the lines of every split; their running
sum (a row a split) gives the lines before it, and only broken rows join it.
No job a file, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import delimited

BAD = "file string, line bigint, record string"


@dataclass
class Sorted:
    """``good``: the rows by column name, all as text; ``bad``: file, line
    (from 1, the header's) and record of each broken row; ``skipped``: files without a header."""
    good: DataFrame
    bad: DataFrame
    skipped: list[str]


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return spark.read.text(list(files)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def broken_rows(spark: SparkSession, files: Sequence[str], columns: Sequence[str], sep: str, charset: str = "UTF-8") -> DataFrame:
    """file, line, record of the rows that don't have a value for each of ``columns``."""
    lines = _lines(spark, files)
    splits = lines.groupBy("file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "block", "first", before.alias("before"))
    schema = ", ".join(f"c{k} string" for k in range(len(columns))) + f", {delimited.CORRUPT} string"
    text = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    parsed = lines.withColumn("record", text).where(F.trim("record") != "").withColumn(
        "row", F.from_csv("record", schema, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": delimited.CORRUPT}))
    bad = parsed.where(F.col(f"row.{delimited.CORRUPT}").isNotNull()).select("file", "block", "place", "record")
    return bad.join(splits, ["file", "block"]).select("file", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line"), "record")


def read_sorted(spark: SparkSession, files: Sequence[str], sep: str | None = None, encoding: str = "UTF-8") -> Sorted:
    """All files by column name, good rows and broken rows apart. ``sep`` None: comma or semicolon, whichever a header has."""
    groups, skipped = delimited.header_groups(spark, files, sep, encoding)
    if not groups:
        raise ValueError(f"no header in {list(files)}")
    good: DataFrame | None = None
    bad = spark.createDataFrame([], BAD)
    for (used, columns, charset), part in groups.items():
        # without pruning, so that every value of a row is looked at whatever is selected later
        rows = (spark.read.schema(delimited.string_schema(list(columns))).option("header", True).option("sep", used).option("encoding", charset)
                .option("mode", "DROPMALFORMED").option("columnPruning", False).csv(part))
        good = rows if good is None else good.unionByName(rows, allowMissingColumns=True)
        bad = bad.unionByName(broken_rows(spark, part, columns, used, charset))
    return Sorted(good, bad, skipped)


def write_quarantine(bad: DataFrame, path: str, sep: str = ";") -> bool:
    """Writes the broken rows for those who send the files. False if there is none (nothing is written)."""
    return delimited.write_delimited(bad, path, sep=sep, order_by=["file", "line"])
