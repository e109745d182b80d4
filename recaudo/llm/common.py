"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from recaudo.session import scratch_path

#: The white space of every contract here: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of the session and read
    it again: the lineage is cut, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_with(df: DataFrame, name: str, **totals: Column) -> tuple[DataFrame, dict]:
    """:func:`written`, with aggregates of the rows that were taken while they were written."""
    seen = Observation()
    out = written(df.observe(seen, *[c.alias(k) for k, c in totals.items()]), name)
    return out, seen.get


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def bucket_of(doc_id: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (the fold of a label)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct: beside it other columns may have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with underscores behind it where a column has it already (names differ by more than case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name
