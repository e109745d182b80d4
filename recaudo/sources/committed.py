"""Sinks that leave the earlier output alone until the new one is whole.

* ``staged_write``: two phases. The rows go to a staging folder beside the
  target and are counted while they are written; only a finished folder with
  rows is swapped in. An empty result, a failed job or a killed driver leaves
  the target as it was. The swap is two renames in one folder (the old one
  aside, the new one in); if the driver dies between them, ``recover`` (run
  by the next write) puts the old one back.
* ``rewrite_partitions``: single partitions (months) anew, by Spark's dynamic
  partition overwrite: the files of all other partitions stay, and so do
  those of a partition that got no row. For each partition written, a manifest
  says what it was made from, so ``stale_partitions`` names those whose
  sources have changed since.

All file work goes through the Hadoop file system of the path. One writer at
a time is expected for a target.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from .files import hadoop_fs

MANIFEST = "_manifest"


# ------------------------------------------------------------ whole folders

def beside(spark: SparkSession, path: str, kind: str) -> str:
    """A new hidden name in the folder of ``path``."""
    _, p = hadoop_fs(spark, path)
    return f"{p.getParent()}/.{p.getName()}.{kind}-{uuid.uuid4().hex[:12]}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = hadoop_fs(spark, source)
    if not fs.rename(p, hadoop_fs(spark, target)[1]):
        raise OSError(f"can't rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return fs.exists(p)


def recover(spark: SparkSession, path: str) -> bool:
    """Puts an earlier output back that a swap had set aside when the driver
    died before the new one was in place. True if there was one."""
    fs, p = hadoop_fs(spark, path)
    if fs.exists(p) or not fs.exists(p.getParent()):
        return False
    aside = [s for s in fs.listStatus(p.getParent()) if s.getPath().getName().startswith(f".{p.getName()}.previous-")]
    if not aside:
        return False
    newest = max(aside, key=lambda s: s.getModificationTime())
    _rename(spark, newest.getPath().toString(), path)
    return True


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """``staged`` takes the place of ``path``."""
    previous = None
    if exists(spark, path):
        previous = beside(spark, path, "previous")
        _rename(spark, path, previous)
    try:
        _rename(spark, staged, path)
    except Exception:
        if previous is not None:
            _rename(spark, previous, path)
        raise
    if previous is not None:
        delete(spark, previous)


def swap_partitions(spark: SparkSession, staged: str, path: str) -> list[str]:
    """Every partition folder (``column=value``) of ``staged`` takes the place
    of the one in ``path``, one after the other; the others stay. Returns their names."""
    fs, p = hadoop_fs(spark, staged)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName())
    fs.mkdirs(hadoop_fs(spark, path)[1])
    for name in names:
        recover(spark, f"{path.rstrip('/')}/{name}")
        swap_in(spark, f"{staged}/{name}", f"{path.rstrip('/')}/{name}")
    return names


def staged_write(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None], arrange: Callable[[DataFrame], DataFrame] = lambda df: df,
                 keep_empty: bool = False) -> int:
    """Writes ``df`` to a staging folder by ``write(writer, folder)`` and swaps
    it in. Returns the rows written; with none the target stays as it was,
    unless ``keep_empty``. ``arrange`` deals the rows out before the write."""
    spark = df.sparkSession
    recover(spark, path)
    staged = beside(spark, path, "staging")
    seen = Observation()
    try:
        # counted last: below an exchange that turns out empty, Spark would drop the count with it
        write(arrange(df).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error"), staged)
        rows = seen.get["rows"]
        if rows or keep_empty:
            swap_in(spark, staged, path)
    finally:
        delete(spark, staged)           # after a swap there is nothing left to delete
    return rows


def staged_append(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None]) -> int:
    """Appends the files of ``df`` to a folder when all are written. Returns
    the rows; an empty result adds no file."""
    spark = df.sparkSession
    staged = beside(spark, path, "staging")
    seen = Observation()
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error"), staged)
        rows = seen.get["rows"]
        if rows:
            fs, p = hadoop_fs(spark, path)
            fs.mkdirs(p)
            for s in fs.listStatus(hadoop_fs(spark, staged)[1]):
                name = s.getPath().getName()
                if not name.startswith((".", "_")):             # Spark's part names are unique
                    _rename(spark, s.getPath().toString(), f"{path.rstrip('/')}/{name}")
    finally:
        delete(spark, staged)
    return rows


# ------------------------------------------------------------ single partitions

def source_state(spark: SparkSession, files: Sequence[str]) -> list[dict]:
    """What a partition is made from: path, length and time of change of each file."""
    out = []
    for f in sorted(files):
        fs, p = hadoop_fs(spark, f)
        s = fs.getFileStatus(p)
        out.append({"path": s.getPath().toString(), "length": s.getLen(), "changed": s.getModificationTime()})
    return out


def _manifest_path(path: str, value: str) -> str:
    return f"{path.rstrip('/')}/{MANIFEST}/{value}.json"


def read_manifest(spark: SparkSession, path: str, value: str) -> dict | None:
    fs, p = hadoop_fs(spark, _manifest_path(path, value))
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return json.loads(reader.readLine())
    finally:
        reader.close()


def write_manifest(spark: SparkSession, path: str, value: str, rows: int, sources: list[dict]) -> None:
    target = _manifest_path(path, value)
    fs, p = hadoop_fs(spark, target)
    temporary = hadoop_fs(spark, f"{target}.{uuid.uuid4().hex[:8]}.tmp")[1]
    out = fs.create(temporary, True)
    out.write(json.dumps({"rows": rows, "sources": sources}).encode())
    out.close()
    fs.delete(p, False)
    if not fs.rename(temporary, p):
        raise OSError(f"can't write {target}")


def stale_partitions(spark: SparkSession, path: str, sources: Mapping[str, Sequence[str]]) -> list[str]:
    """The values whose files (``sources``: value -> files) aren't those that
    the partition was last made from."""
    def fresh(value: str, files: Sequence[str]) -> bool:
        known = read_manifest(spark, path, value)
        return known is not None and known["sources"] == source_state(spark, files)
    return [v for v, files in sources.items() if not fresh(v, files)]


def rewrite_partitions(df: DataFrame, path: str, column: str, sources: Mapping[str, Sequence[str]], sep: str = ";") -> dict[str, int]:
    """Writes the partitions named in ``sources`` (value -> the files it is
    made from) anew as delimited text and leaves all others alone. Rows of
    other values are not written. Returns the rows of each value; one without
    rows keeps its earlier files and manifest. The sources are looked at
    before the job, so a file that changes meanwhile is stale again."""
    spark = df.sparkSession
    made_from = {v: source_state(spark, files) for v, files in sources.items()}
    seen = Observation()
    counts = [F.count_if(F.col(f"`{column}`") == v).alias(f"n{k}") for k, v in enumerate(made_from)]
    if not made_from:
        return {}
    out = df.where(F.col(f"`{column}`").isin(*made_from)).hint("rebalance", F.col(f"`{column}`")).observe(seen, *counts)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).option("sep", sep).partitionBy(column).csv(path))
    rows = {v: seen.get[f"n{k}"] for k, v in enumerate(made_from)}
    for v, n in rows.items():
        if n:
            write_manifest(spark, path, v, n, made_from[v])
    return rows
