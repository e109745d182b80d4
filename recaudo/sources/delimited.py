"""Delimited-text sources and sinks.

* ``read_by_header``: files whose columns may be reordered, added or missing
  from one file to the next. The header line of every file is read (metadata,
  in parallel, through the Hadoop file system so any cluster store works);
  files with the same separator and header share ONE distributed CSV scan;
  the scans are unioned by name (missing columns -> NULL). ``columns`` are
  selected by name, and a name that no file has is an error. With
  ``encoding="detect"`` the charset is found a file (:func:`charsets`) and is
  part of what makes files share a scan.
* ``read_drifting_folder``: the same for a folder of ``,`` and ``;`` files. A
  file whose header has neither is reported as skipped; a comma in the header
  wins over a semicolon. ``skip_unreadable`` reads every file once beforehand
  and reports those that can't be read to their end; without it they fail the
  read.
* ``read_delimited``: one plain CSV scan: all files have one header, or an
  explicit schema in the order of the file's columns (what this library's own
  sink writes). A file that can't be read raises.
* ``write_delimited``: header, separator, overwrite/append, optional
  ``partitionBy`` (e.g. year/month) with the rows rebalanced by it, so that a
  partition gets few files and a large one several writers. The plan runs
  once: the rows are counted while they are written. An overwrite is staged
  and swapped in when it is whole (:mod:`.committed`), so an empty or failed
  run leaves the earlier output as it was; ``append_log`` adds its files when
  all are written.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .committed import staged_append, staged_write
from .files import hadoop_fs

#: Header lines (metadata) that are read at a time.
HEADER_THREADS = 16


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


CORRUPT = "_corrupt_record"


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
                   sep: str = ";", header: bool = True, encoding: str | None = None,
                   infer: bool = False, suffix: str | None = ".csv",
                   keep_corrupt: bool = False) -> DataFrame:
    """``keep_corrupt``: rows that do not fit the schema keep their raw text
    in ``_corrupt_record`` (count them with :func:`corrupt_rows`) instead of
    becoming NULLs."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if keep_corrupt and schema is not None:
        st = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
        if CORRUPT not in st.fieldNames():
            schema = StructType(st.fields + [StructField(CORRUPT, StringType(), True)])
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if encoding:
        r = r.option("encoding", encoding)
    if suffix and isinstance(path, str):
        r = r.option("pathGlobFilter", f"*{suffix}")
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def corrupt_rows(df: DataFrame) -> DataFrame:
    """The rows that did not parse (requires ``keep_corrupt=True``); select
    data columns together with ``_corrupt_record`` (Spark rejects queries
    that read only the corrupt-record column of a raw file)."""
    return df.where(F.col(CORRUPT).isNotNull())


# ------------------------------------------------------------ file sniffing

def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Data files of a folder with the suffix (also compressed: ``.csv.gz``)."""
    fs, p = hadoop_fs(spark, folder)
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        base = name.rsplit(".", 1)[0] if name.endswith((".gz", ".bz2", ".zst", ".deflate")) else name
        if st.isFile() and base.endswith(suffix) and not name.startswith((".", "_")):
            out.append(st.getPath().toString())
    return sorted(out)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the data files of a folder."""
    fs, p = hadoop_fs(spark, path)
    return list_files(spark, path) if fs.getFileStatus(p).isDirectory() else [path]


def header_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """First line of a file, whole; compressed files (.gz, .bz2, ... by extension) are read through their Hadoop codec, as the
    CSV reader does."""
    jvm = spark.sparkContext._jvm
    fs, p = hadoop_fs(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    raw = fs.open(p)
    stream = codec.createInputStream(raw) if codec is not None else raw
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding), 65536)
        return (reader.readLine() or "").lstrip("\ufeff")
    finally:
        stream.close()


def detect_separator(header: str) -> str | None:
    """Comma wins, else semicolon, else None (file is skipped)."""
    if "," in header:
        return ","
    if ";" in header:
        return ";"
    return None


def header_columns(line: str, sep: str) -> tuple[str, ...]:
    return tuple(c.strip() for c in next(csv.reader([line], delimiter=sep), []))


def unreadable_files(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """The files that can't be read to their end (e.g. half-written archives).
    Each file is read once, a few jobs at a time; nothing is collected."""
    def broken(path: str) -> bool:
        try:
            spark.read.text(path).write.format("noop").mode("overwrite").save()
            return False
        except Exception:  # noqa: BLE001 - any failure to read is what is asked for; the file is reported
            return True
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        return [f for f, bad in zip(files, pool.map(broken, files)) if bad]


#: ``encoding`` that stands for UTF-8 or Latin-1, whichever a file is.
DETECT = "detect"
CHARSETS = ("UTF-8", "ISO-8859-1")


def charsets(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """File -> UTF-8 where all its bytes are valid UTF-8, else Latin-1. The
    text source hands lines over as the bytes they are, and no character of
    more than one byte holds a line end, so lines tell for the file. One job
    for all files; a row a file comes back."""
    if not files:
        return {}
    seen = (spark.read.text(list(files)).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("utf8"))
            .groupBy("file").agg(F.min("utf8").alias("utf8")).collect())
    other = {unquote(r.file) for r in seen if not r.utf8}
    return {f: CHARSETS[1] if hadoop_uri(spark, f) in other else CHARSETS[0] for f in files}


def hadoop_uri(spark: SparkSession, path: str) -> str:
    """The path as Spark's file metadata has it, decoded (``file:///a b``)."""
    fs, p = hadoop_fs(spark, path)
    return unquote(spark._jvm.org.apache.spark.paths.SparkPath.fromPath(fs.makeQualified(p)).urlEncoded())


@dataclass
class FolderScan:
    df: DataFrame | None
    groups: list[tuple[str, list[str], list[str]]] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    unreadable: list[str] = field(default_factory=list)


def header_groups(spark: SparkSession, files: Sequence[str], sep: str | None = None, encoding: str = "UTF-8"
                  ) -> tuple[dict[tuple[str, tuple[str, ...], str], list[str]], list[str]]:
    """(separator, columns, charset) -> files that share them; the files without a header or separator."""
    found = charsets(spark, files) if encoding == DETECT else dict.fromkeys(files, encoding)
    groups: dict[tuple[str, tuple[str, ...], str], list[str]] = {}
    skipped = []
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        heads = list(pool.map(lambda f: header_line(spark, f, found[f]), files))
    for f, head in zip(files, heads):
        used = sep or detect_separator(head)
        if used is None or not head:
            skipped.append(f)
            continue
        groups.setdefault((used, header_columns(head, used), found[f]), []).append(f)
    return groups, skipped


def _grouped(spark: SparkSession, files: Sequence[str], sep: str | None, encoding: str, file_column: str | None) -> FolderScan:
    """One scan for each (separator, header, charset), unioned by name."""
    groups, skipped = header_groups(spark, files, sep, encoding)
    df = None
    for (used, cols, charset), fl in groups.items():
        part = read_delimited(spark, fl, string_schema(list(cols)), sep=used, encoding=charset, suffix=None)
        if file_column:
            part = part.withColumn(file_column, F.col("_metadata.file_path"))
        df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    return FolderScan(df, [(used, list(cols), fl) for (used, cols, _), fl in groups.items()], skipped)


def read_by_header(spark: SparkSession, files: str | Sequence[str], columns: Sequence[str] | None = None, sep: str | None = ";",
                   encoding: str = "UTF-8", file_column: str | None = None) -> DataFrame:
    """All columns as text, by name. ``files``: a file, a folder or a list of
    files; ``columns``: the ones to select; ``file_column``: adds the path of
    each row's file; ``sep`` None: comma or semicolon, whichever each header has."""
    if isinstance(files, str):
        files = data_files(spark, files)
    scan = _grouped(spark, list(files), sep, encoding, file_column)
    if scan.df is None:
        raise ValueError(f"no header in {list(files)}")
    if columns is None:
        return scan.df
    have = set(scan.df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise ValueError(f"columns {missing} are in none of {list(files)}; there are {sorted(have)}")
    return scan.df.select(*[F.col(f"`{c}`") for c in columns], *([file_column] if file_column else []))


def read_drifting_folder(spark: SparkSession, folder: str | list[str], suffix: str = ".csv",
                         encoding: str = "UTF-8", skip_unreadable: bool = False) -> FolderScan:
    files = folder if isinstance(folder, list) else list_files(spark, folder, suffix)
    bad = unreadable_files(spark, files) if skip_unreadable else []
    scan = _grouped(spark, [f for f in files if f not in set(bad)], None, encoding, None)
    scan.unreadable = bad
    return scan


# ------------------------------------------------------------ sinks

def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite",
                    partition_by: list[str] | None = None, files_per_partition: int | None = None,
                    max_records_per_file: int | None = None, skip_empty: bool = True,
                    order_by: Sequence[Column | str] = (), encoding: str | None = None) -> bool:
    """Write with header and separator. Returns False for an empty result,
    which leaves an earlier output in place (and writes nothing where there
    was none) when ``skip_empty``.

    With ``partition_by`` the rows are rebalanced by those columns: a small
    output partition (e.g. a month) is one file, a large one is split over
    several writers by its size. ``files_per_partition`` asks for at most n
    files each instead, dealt by a deterministic salt.
    ``max_records_per_file`` bounds file size independently.
    ``order_by`` writes a table that is sorted when its files are read in the
    order of their names: rows are dealt out by ranges of the order, equal
    ones by their hash (so a frequent value spreads), and sorted in each file.
    ``mode="append"`` adds to partitions in place, by Spark's own commit."""
    quoted = [F.col(f"`{c}`") for c in partition_by or []]

    if order_by and (partition_by or files_per_partition):
        raise ValueError("order_by is the layout of a whole table; it can't go with partitions")

    def arrange(out: DataFrame) -> DataFrame:
        if order_by:
            order = [*order_by, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
            return out.repartitionByRange(*order).sortWithinPartitions(*order)
        if files_per_partition and partition_by:
            salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_partition))
            return out.repartition(*quoted, salt)
        if files_per_partition:
            return out.repartition(files_per_partition)
        return out.hint("rebalance", *quoted) if partition_by else out

    def write(w, folder: str) -> None:
        w = w.option("header", True).option("sep", sep)
        if encoding:
            w = w.option("encoding", encoding)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.csv(folder)

    if mode == "overwrite":
        return staged_write(df, path, write, arrange, keep_empty=not skip_empty) > 0
    seen = Observation()
    write(arrange(df).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode), path)
    return seen.get["rows"] > 0


def append_log(df: DataFrame, path: str, sep: str = ";") -> bool:
    """Append-only log sink (every file carries its header). False if there was nothing to add."""
    return staged_append(df, path, lambda w, folder: w.option("header", True).option("sep", sep).csv(folder)) > 0
