"""Tables bucketed and sorted by a join key.

Tables with the same number of buckets on the same columns join bucket by
bucket: Spark reads bucket k of each in one task, and the joins need no
exchange. Writing costs one shuffle a table, once; every join chain over
them afterwards costs none. Rows are dealt out by the key before the write,
so a bucket is one sorted file.

A key of very many rows stays in one bucket, as in any hash join; sides that
join here have one row a key, and the base one row an account and month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Writes ``df`` as table ``name`` in ``path`` (a shared folder) and
    returns it read back. The table is new: an earlier one of that name is replaced."""
    spark = df.sparkSession
    quoted = [f"`{k}`" for k in keys]
    (df.repartition(buckets, *quoted).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return spark.table(name)
