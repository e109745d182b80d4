"""Catalog entries for delimited sources/sinks and the contact-log stream.

Each run writes into a fresh sub-folder of the session's shared checkpoint
folder (``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import committed, delimited, quarantine, typed
from ..sources.tables import table
from .folder_merge import merge_export_folder
from .registry import register

_CUST_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal decimal(12,2), c_mktsegment string"


@register("csv_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
       CAST(c_nationkey AS VARCHAR) AS nacion
FROM customer""")
def csv_roundtrip(spark, sf):
    base = scratch_path(spark, "csv-roundtrip")
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        "c_mktsegment", F.col("c_nationkey").cast("string").alias("nacion"))
    # ';' CSV, one folder per nation (partitionBy), no success markers
    delimited.write_delimited(c, base, sep=";", partition_by=["nacion"])
    back = delimited.read_delimited(spark, base, _CUST_SCHEMA + ", nacion string", sep=";",
                                    suffix=None)
    return back.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "nacion")


@register("csv_drift_merge", """
SELECT DISTINCT Cuenta_Real || '-' AS Cuenta_Real, Cuenta_Sin_Punto || '-' AS Cuenta_Sin_Punto,
       nombre, saldo, proveedor, nacion, 6 AS mes_de_asignacion, 2024 AS periodo_de_asignacion
FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS Cuenta_Real, CAST(c_custkey AS VARCHAR) AS Cuenta_Sin_Punto,
         c_name AS nombre, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS saldo FROM customer
  UNION ALL BY NAME
  SELECT CAST(c_custkey AS VARCHAR) AS Cuenta_Real, CAST(c_custkey AS VARCHAR) AS Cuenta_Sin_Punto,
         c_name AS nombre, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS saldo FROM customer
  WHERE c_mktsegment = 'BUILDING'
  UNION ALL BY NAME
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS Cuenta_Real, 'S' || CAST(s_suppkey AS VARCHAR) AS Cuenta_Sin_Punto,
         s_name AS proveedor, CAST(s_nationkey AS VARCHAR) AS nacion FROM supplier)""")
def csv_drift_merge(spark, sf):
    base = scratch_path(spark, "csv-drift")
    c = table(spark, sf, "customer")
    s = table(spark, sf, "supplier")
    cust = c.select(F.col("c_custkey").cast("string").alias("Cuenta_Real"),
                    F.col("c_custkey").cast("string").alias("Cuenta_Sin_Punto"),
                    F.col("c_name").alias("nombre"),
                    F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("saldo"))
    sup = s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Cuenta_Real"),
                   F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Cuenta_Sin_Punto"),
                   F.col("s_name").alias("proveedor"), F.col("s_nationkey").cast("string").alias("nacion"))
    # a folder written by different exports: ',' and ';' files, two column
    # sets, exact duplicates across files, and a file without any separator
    delimited.write_delimited(cust, os.path.join(base, "a"), sep=",")
    delimited.write_delimited(cust.where(F.col("nombre").isNotNull()).join(
        c.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").cast("string").alias("Cuenta_Real")),
        "Cuenta_Real", "left_semi"), os.path.join(base, "b"), sep=";")
    delimited.write_delimited(sup, os.path.join(base, "c"), sep=";")
    delimited.write_delimited(s.select(F.col("s_name").alias("solo")), os.path.join(base, "d"), sep="|")
    files = [f for x in "abcd" for f in delimited.list_files(spark, os.path.join(base, x))]
    merged = merge_export_folder(spark, files, 6, 2024).df
    return merged.withColumnsRenamed({"MES DE ASIGNACION": "mes_de_asignacion", "PERIODO DE ASIGNACION": "periodo_de_asignacion"})


# ------------------------------------------------------------ months that drift
# two months of orders as monthly files: the second has its columns in
# another order and one more; every other source is a one-line list.

@register("csv_month_drift", """
SELECT mes, CAST(o_orderkey AS VARCHAR) AS "CUENTA_NEXT", o_orderpriority AS "Marca", o_orderstatus AS "Ciudad",
       CASE WHEN mes = '2025-02' THEN CAST(o_custkey AS VARCHAR) END AS "Extra"
FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN '2025-01' ELSE '2025-02' END AS mes FROM orders)""")
def csv_month_drift(spark, sf):
    from . import monthly
    base = scratch_path(spark, "csv-months")
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("CUENTA_NEXT"), F.col("o_orderpriority").alias("Marca"),
        F.col("o_orderstatus").alias("Ciudad"), F.col("o_custkey").cast("string").alias("Extra"), (F.col("o_orderkey") % 2).alias("odd"))
    layout = {k: v.replace(".csv", "") for k, v in monthly.DEFAULT_LAYOUT.items()}
    months = [(2025, 1), (2025, 2)]
    at = lambda name, month: os.path.join(base, layout[name].format(year=2025, month=month))
    delimited.write_delimited(o.where("odd = 0").select("CUENTA_NEXT", "Marca", "Ciudad"), at("base", "01"))
    delimited.write_delimited(o.where("odd = 1").select("Ciudad", "Extra", "CUENTA_NEXT", "Marca"), at("base", "02"))
    base_only = monthly.read_source(spark, base, "base", months, layout)
    return base_only.select("mes", "CUENTA_NEXT", "Marca", "Ciudad", "Extra")


# ------------------------------------------------------------ single files, sinks

@register("csv_by_name", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""")
def csv_by_name(spark, sf):
    base = scratch_path(spark, "csv-by-name")
    c = table(spark, sf, "customer").select("c_mktsegment", F.lit("x").alias("otro"), "c_name", F.col("c_custkey").cast("string").alias("c_custkey"))
    delimited.write_delimited(c, base, sep=",")
    return delimited.read_by_header(spark, base, ["c_custkey", "c_name", "c_mktsegment"], sep=",")


@register("csv_inferred", """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_acctbal AS DOUBLE) AS s_acctbal FROM supplier""")
def csv_inferred(spark, sf):
    base = scratch_path(spark, "csv-inferred")
    delimited.write_delimited(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), base)
    return delimited.read_delimited(spark, base, infer=True)


# three exports of the orders whose columns change type from file to file:
# whole numbers, amounts, an amount that is a word; keys beyond 32 bits in one
# file; days; and a column that only one file has
@register("csv_inferred_drift", """
SELECT CAST(CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey + 10000000000 ELSE o_orderkey END AS BIGINT) AS cuenta,
       CAST(CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS DECIMAL(18,2)) AS valor,
       CASE WHEN o_orderkey % 3 = 2 THEN 'n/d' ELSE CAST(o_custkey AS VARCHAR) END AS cliente,
       CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS dia,
       CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_custkey AS INTEGER) END AS extra,
       lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS codigo
FROM orders""")
def csv_inferred_drift(spark, sf):
    base = scratch_path(spark, "csv-typed")
    key, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    o = table(spark, sf, "orders")
    code = F.lpad(text("o_custkey"), 9, "0").alias("codigo")
    day, amount = F.to_date("o_orderdate").cast("string").alias("dia"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("valor")
    files = [
        (o.where(key % 3 == 0).select(text("o_orderkey").alias("cuenta"), F.floor("o_totalprice").cast("string").alias("valor"), text("o_custkey").alias("cliente"), day, code), ";"),
        (o.where(key % 3 == 1).select(amount, (key + 10_000_000_000).cast("string").alias("cuenta"), code, text("o_custkey").alias("cliente")), ","),
        (o.where(key % 3 == 2).select(text("o_orderkey").alias("cuenta"), F.lit("n/d").alias("cliente"), amount, day, text("o_custkey").alias("extra"), code), ";"),
    ]
    for k, (df, sep) in enumerate(files):
        delimited.write_delimited(df, os.path.join(base, str(k)), sep=sep)
    paths = [f for k in range(3) for f in delimited.list_files(spark, os.path.join(base, str(k)))]
    return typed.read_typed(spark, paths, sep=None).select("cuenta", "valor", "cliente", "dia", "extra", "codigo")


# the log grows by appended batches; an empty result leaves nothing behind
@register("csv_append_log", """
SELECT o_orderstatus AS estado, count(*) AS n, false AS vacio_escrito FROM orders GROUP BY 1""")
def csv_append_log(spark, sf):
    base = scratch_path(spark, "csv-log")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("cuenta"), F.col("o_orderstatus").alias("estado"))
    for odd in (0, 1):
        delimited.append_log(o.where(F.col("cuenta").cast("bigint") % 2 == odd), os.path.join(base, "log"))
    wrote_empty = delimited.write_delimited(o.where(F.lit(False)), os.path.join(base, "empty"))
    log = delimited.read_by_header(spark, os.path.join(base, "log"), ["estado"])
    return log.groupBy("estado").agg(F.count(F.lit(1)).alias("n"), F.lit(wrote_empty).alias("vacio_escrito"))


# written twice, the second time from a filter that finds nothing: the first
# output is read back, and no staging folder is left beside it
@register("csv_committed_rewrite", """
SELECT o_orderstatus AS estado, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total,
       true AS primera, false AS segunda, true AS sin_restos
FROM orders GROUP BY 1""")
def csv_committed_rewrite(spark, sf):
    base = scratch_path(spark, "csv-committed")
    out = os.path.join(base, "reporte")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("cuenta"), F.col("o_orderstatus").alias("estado"),
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("valor"))
    first = delimited.write_delimited(o, out, partition_by=["estado"])
    second = delimited.write_delimited(o.where("valor < 0"), out, partition_by=["estado"])
    fs, folder = delimited.hadoop_fs(spark, base)
    clean = [s.getPath().getName() for s in fs.listStatus(folder)] == ["reporte"]
    back = delimited.read_delimited(spark, out, "cuenta string, valor decimal(18,2), estado string", suffix=None)
    return back.groupBy("estado").agg(F.count(F.lit(1)).alias("n"), F.sum("valor").alias("total"), F.lit(first).alias("primera"),
                                      F.lit(second).alias("segunda"), F.lit(clean).alias("sin_restos"))


# three months of orders; the file of one is then corrected. A re-run finds
# that month stale by its manifest and rewrites its folder alone
@register("csv_month_rerun", """
SELECT mes, CASE WHEN mes = '2025-02' THEN lower(o_orderpriority) ELSE o_orderpriority END AS prioridad, count(*) AS n,
       mes <> '2025-02' AS intacto, '2025-01 2025-02 2025-03' AS primera_vez, '' AS sin_cambios, '2025-02' AS corregido
FROM (SELECT *, '2025-0' || CAST(1 + o_orderkey % 3 AS VARCHAR) AS mes FROM orders) GROUP BY ALL""")
def csv_month_rerun(spark, sf):
    base = scratch_path(spark, "csv-rerun")
    out, months = os.path.join(base, "out"), ["2025-01", "2025-02", "2025-03"]
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("cuenta"), F.col("o_orderpriority").alias("prioridad"),
                                          F.concat(F.lit("2025-0"), (F.col("o_orderkey") % 3 + 1).cast("string")).alias("mes"))
    source = lambda m: os.path.join(base, "in", m)
    for m in months:
        delimited.write_delimited(o.where(F.col("mes") == m).drop("mes"), source(m))

    def rerun() -> str:
        files = {m: delimited.data_files(spark, source(m)) for m in months}
        stale = {m: files[m] for m in committed.stale_partitions(spark, out, files)}
        if stale:
            parts = [delimited.read_by_header(spark, f).withColumn("mes", F.lit(m)) for m, f in stale.items()]
            df = parts[0]
            for p in parts[1:]:
                df = df.unionByName(p)
            committed.rewrite_partitions(df, out, "mes", stale)
        return " ".join(sorted(stale))

    def written_files() -> dict[str, list[str]]:
        return {m: delimited.list_files(spark, os.path.join(out, f"mes={m}")) for m in months}
    first = rerun()
    before = written_files()
    again = rerun()
    delimited.write_delimited(o.where("mes = '2025-02'").select("cuenta", F.lower("prioridad").alias("prioridad")), source("2025-02"))
    corrected = rerun()
    after = written_files()
    kept = F.col("mes").isin(*[m for m in months if before[m] == after[m]])
    back = delimited.read_delimited(spark, out, "cuenta bigint, prioridad string, mes string", suffix=None)
    return (back.groupBy("mes", "prioridad").agg(F.count(F.lit(1)).alias("n"))
            .select("mes", "prioridad", "n", kept.alias("intacto"), F.lit(first).alias("primera_vez"), F.lit(again).alias("sin_cambios"),
                    F.lit(corrected).alias("corregido")))


# the customers sorted by segment and balance: read by file name, no file
# begins before its predecessor ends, and no row stands before the one above it
@register("csv_ordered_files", """
SELECT c_mktsegment AS segmento, count(*) AS n, CAST(max(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS mayor, true AS ordenado
FROM customer GROUP BY 1""")
def csv_ordered_files(spark, sf):
    base = scratch_path(spark, "csv-ordered")
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segmento"), F.col("c_acctbal").cast("decimal(12,2)").alias("saldo"), F.col("c_custkey").alias("cuenta"))
    delimited.write_delimited(c, base, order_by=["segmento", F.desc("saldo")], max_records_per_file=400)
    back = (delimited.read_delimited(spark, base, "segmento string, saldo decimal(12,2), cuenta bigint", suffix=None)
            .select("segmento", "saldo", F.struct("segmento", (-F.col("saldo")).alias("saldo")).alias("k"),
                    F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i")))
    files = back.groupBy("f").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    later = files.select((F.lag("high").over(Window.orderBy("f")) > F.col("low")).alias("wrong"))               # a row a file
    inside = back.select((F.lag("k").over(Window.partitionBy("f").orderBy("i")) > F.col("k")).alias("wrong"))   # at most 400 rows a file
    ordered = later.unionByName(inside).where("wrong").isEmpty()
    return back.groupBy("segmento").agg(F.count(F.lit(1)).alias("n"), F.max("saldo").alias("mayor"), F.lit(ordered).alias("ordenado"))


# one file of a source in UTF-8, one in Latin-1, headers with accents too
@register("csv_charsets", """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS origen, CAST(s_suppkey AS VARCHAR) AS "código",
       'Señor Muñoz nº ' || s_name AS "razón social" FROM supplier""")
def csv_charsets(spark, sf):
    base = scratch_path(spark, "csv-charsets")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("código"), F.concat(F.lit("Señor Muñoz nº "), "s_name").alias("razón social"))
    for k, charset in enumerate(delimited.CHARSETS):
        delimited.write_delimited(s.where(F.col("`código`").cast("bigint") % 2 == k), os.path.join(base, charset), encoding=charset)
    files = [f for x in delimited.CHARSETS for f in delimited.list_files(spark, os.path.join(base, x))]
    back = delimited.read_by_header(spark, files, encoding=delimited.DETECT, file_column="_file")
    return back.select(F.regexp_extract("_file", "(UTF-8|ISO-8859-1)/[^/]*$", 1).alias("origen"), "código", "razón social")


# orders as files by priority, some rows with a value too few or too many:
# good rows are read, broken ones are reported with their file and line
@register("csv_quarantine", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS fila FROM orders)
SELECT left(o_orderpriority, 1) AS archivo, fila + 1 AS linea,
       CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey || ';' || o_orderstatus ELSE o_orderkey || ';' || o_orderstatus || ';' || o_custkey || ';x;y' END AS registro,
       (SELECT count(*) FROM orders WHERE o_orderkey % 10 NOT IN (3, 7)) AS buenas
FROM n WHERE o_orderkey % 10 IN (3, 7)""")
def csv_quarantine(spark, sf):
    base = scratch_path(spark, "csv-quarantine")
    row = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("o_orderkey"))
    kind = F.col("o_orderkey") % 10
    o = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("archivo"), row.alias("fila"),
        F.concat_ws(";", F.col("o_orderkey"), "o_orderstatus", F.when(kind != 3, F.col("o_custkey").cast("string")), F.when(kind == 7, F.lit("x;y"))).alias("value"))
    heads = o.select("archivo").distinct().select("archivo", F.lit(0).alias("fila"), F.lit("cuenta;estado;cliente").alias("value"))
    (o.unionByName(heads).repartition("archivo").sortWithinPartitions("archivo", "fila").select("value", "archivo")
     .write.partitionBy("archivo").option("compression", "none").text(base))
    fs, folder = delimited.hadoop_fs(spark, base)
    files = [f for d in fs.listStatus(folder) if d.isDirectory() for f in delimited.list_files(spark, d.getPath().toString(), ".txt")]
    rows = quarantine.read_sorted(spark, files, sep=";")
    return rows.bad.select(F.regexp_extract("file", "archivo=([^/]*)/", 1).alias("archivo"), F.col("line").alias("linea"), F.col("record").alias("registro"),
                           F.lit(rows.good.count()).cast("bigint").alias("buenas"))


# at most two files for each output partition
@register("csv_files_per_partition", """
SELECT o_orderstatus AS estado, count(*) AS n, true AS pocos_archivos FROM orders GROUP BY 1""")
def csv_files_per_partition(spark, sf):
    base = scratch_path(spark, "csv-files")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("estado"))
    delimited.write_delimited(o, base, partition_by=["estado"], files_per_partition=2)
    back = delimited.read_delimited(spark, base, "o_orderkey bigint, estado string", suffix=None)
    return back.groupBy("estado").agg(F.count(F.lit(1)).alias("n"),
                                      (F.count_distinct(F.col("_metadata.file_path")) <= 2).alias("pocos_archivos"))


# files without a separator and files that break off are left out and reported
@register("csv_skipped_report", """
SELECT count(*) AS filas, 1 AS sin_separador, 1 AS ilegibles FROM supplier""")
def csv_skipped_report(spark, sf):
    base = scratch_path(spark, "csv-skipped")
    s = table(spark, sf, "supplier")
    delimited.write_delimited(s.select(F.col("s_suppkey").alias("Cuenta_Real"), "s_name"), os.path.join(base, "good"))
    delimited.write_delimited(s.select(F.col("s_name").alias("solo")).coalesce(1), os.path.join(base, "plain"), sep="|")
    # a gzip name over text that is no gzip: it can't be read to its end
    s.select("s_name").coalesce(1).write.text(os.path.join(base, "text"))
    fs, folder = delimited.hadoop_fs(spark, os.path.join(base, "text"))
    jvm = spark.sparkContext._jvm
    text = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    broken = jvm.org.apache.hadoop.fs.Path(os.path.join(base, "broken.csv.gz"))
    fs.rename(text, broken)
    files = [f for d in ("good", "plain") for f in delimited.list_files(spark, os.path.join(base, d))] + [broken.toString()]
    scan = delimited.read_drifting_folder(spark, files, skip_unreadable=True)
    return scan.df.agg(F.count(F.lit(1)).alias("filas"), F.lit(len(scan.skipped)).alias("sin_separador"),
                       F.lit(len(scan.unreadable)).alias("ilegibles"))


# ------------------------------------------------------------ streaming log
# events play the contact-attempt log: the stream reads the given table as it
# stands (one scan, no staging copy), counts attempts per hour and status,
# and the current table is read back. Same answer as the batch query
# contact_log_hourly.

@register("contact_log_stream", """
SELECT date_trunc('hour', ts) AS hora, CASE WHEN event_type = 'error' THEN 'Not sent' ELSE 'Sent' END AS estado,
       count(*) AS n
FROM events GROUP BY ALL""")
def contact_log_stream(spark, sf):
    from ..streaming.contact_log import current_counts, run_hourly_counts
    base = scratch_path(spark, "contact-log-stream")
    sink, ckpt = (os.path.join(base, x) for x in ("out", "ckpt"))
    status = F.when(F.col("event_type") == "error", "Not sent").otherwise("Sent")
    run_hourly_counts(spark, os.path.join(sf, "events.parquet"), table(spark, sf, "events").schema, "ts", "event_id",
                      {"estado": status}, sink, ckpt)
    return current_counts(spark, sink, ["hora", "estado"])


# Failed attempts are reported after all others. What is then older than the
# watermark is no longer counted but kept: late rows by hour and status.

_LATE_AFTER = "10 days"


@register("contact_log_late", f"""
WITH e AS (SELECT *, event_type = 'error' AS second FROM events),
w AS (SELECT epoch_ms(max(ts)) - epoch_ms(TIMESTAMP '1970-01-01' + INTERVAL '{_LATE_AFTER}') AS mark FROM e WHERE NOT second),
k AS (SELECT e.*, CASE WHEN second AND epoch_ms(ts) <= mark THEN 'late' ELSE 'counted' END AS tipo FROM e, w)
SELECT tipo, date_trunc('hour', ts) AS hora, CASE WHEN event_type = 'error' THEN 'Not sent' ELSE 'Sent' END AS estado,
       count(*) AS n
FROM k GROUP BY ALL""")
def contact_log_late(spark, sf):
    from ..streaming.late_rows import LATE, hourly_counts, kept_rows, start_keeping_late
    base = scratch_path(spark, "contact-log-late")
    landing, sink, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "Not sent").otherwise("Sent")
    for delivery in (F.col("event_type") != "error", F.col("event_type") == "error"):
        e.where(delivery).write.mode("append").parquet(landing)
        start_keeping_late(spark, landing, e.schema, "ts", "event_id", {"estado": status}, sink, ckpt,
                           watermark=_LATE_AFTER, slots=32).awaitTermination()
    late = kept_rows(spark, sink, e.schema, LATE).groupBy(F.date_trunc("hour", "ts").cast(e.schema["ts"].dataType).alias("hora"), status.alias("estado")) \
        .agg(F.count(F.lit(1)).alias("n"))
    counted = hourly_counts(spark, sink, ["hora", "estado"])
    return counted.withColumn("tipo", F.lit("counted")).unionByName(late.withColumn("tipo", F.lit("late"))) \
        .select("tipo", "hora", "estado", "n")
