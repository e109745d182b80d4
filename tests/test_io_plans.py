"""Sources/sinks, the assignment pipeline and the contact-log stream on
literal fixtures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from recaudo.plans.assignment import assignment_base
from recaudo.plans.folder_merge import merge_export_folder
from recaudo.session import scratch_path
from recaudo.sources import delimited


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_drifting_folder_merge(spark):
    base = scratch_path(spark, "drift-test")
    _write(f"{base}/a.csv", "Cuenta_Real,Cuenta_Sin_Punto,Marca,Cantidad\n1.1,11,churn,3\n2.2,22,30,1\n")
    _write(f"{base}/b.csv", "Cuenta_Real;Cuenta_Sin_Punto;Telefono\n3.3;33;3001234567\n")
    _write(f"{base}/c.csv", "Cuenta_Real,Cuenta_Sin_Punto,Marca,Cantidad\n1.1,11,churn,3\n")   # duplicate row
    _write(f"{base}/d.csv", "solo\nvalor\n")                                                      # no separator
    _write(f"{base}/e.txt", "ignored,file\n1,2\n")
    scan = merge_export_folder(spark, base, 6, 2024)
    assert [os.path.basename(p) for p in scan.skipped] == ["d.csv"]
    got = sorted((r.Cuenta_Real, r.Marca, r.Telefono) for r in scan.df.collect())
    assert got == [("1.1-", "churn", None), ("2.2-", "30", None), ("3.3-", None, "3001234567")]
    assert set(scan.df.columns) >= {"MES DE ASIGNACION", "PERIODO DE ASIGNACION"}


def test_sink_skips_empty_and_partitions(spark):
    base = scratch_path(spark, "sink-test")
    df = spark.createDataFrame([("a", "2025-01"), ("b", "2025-02")], "v string, mes string")
    assert delimited.write_delimited(df.where("v = 'zzz'"), base + "/empty") is False
    assert not os.path.exists(base + "/empty")
    assert delimited.write_delimited(df, base + "/out", partition_by=["mes"], files_per_partition=1)
    assert sorted(os.listdir(base + "/out")) == ["mes=2025-01", "mes=2025-02"]
    assert not any(n.startswith("_SUCCESS") for n in os.listdir(base + "/out"))
    back = delimited.read_delimited(spark, base + "/out", "v string, mes string", suffix=None)
    assert sorted(tuple(r) for r in back.collect()) == [("a", "2025-01"), ("b", "2025-02")]


def _raw_row(doc, acc, crm, m5, m6, m7, debt, age, name, day, ref=None, ctype="81", m43="N", camp="c"):
    r = {f"{i}_": None for i in range(1, 58)}
    r.update({"1_": doc, "2_": acc, "3_": crm, "5_": m5, "6_": m6, "7_": m7, "9_": debt, "12_": camp,
              "13_": age, "24_": name, "26_": "10/4/2025", "27_": ref, "42_": ctype, "43_": m43, "57_": day})
    return r


def test_assignment_pipeline(spark):
    rows = []
    for d in (1, 2, 3):
        rows.append(_raw_row("CC100", "1.234-5", "BSCS", "Y", "N", "N", "20000", "30", "Sr. Pedro Pérez", f"{d}/4/2025"))
    for d in (1, 3, 5):
        rows.append(_raw_row("CC100", "9.9", "RR", "N", "Y", "N", "20000.01", "60", "ANA", f"{d}/4/2025"))
    rows.append(_raw_row("123", "777", "ASCARD", "N", "N", "N", None, "120", "X", "10/4/2025"))
    rows.append(_raw_row(None, "888", "SGA", "N", "N", "Y", "abc", "90", "Y", "10/4/2025"))
    rows.append(_raw_row("CC", "CRM", "CRM Origen", "x", "x", "x", "x", "x", "x", "1/4/2025"))   # header line
    raw = spark.createDataFrame(rows, ", ".join(f"`{i}_` string" for i in range(1, 58)))
    disc = spark.createDataFrame([("12345", "12.5"), ("99", "0")], "CUENTA string, PORCENTAJE string")
    out = {r["CUENTA"]: r.asDict() for r in assignment_base(raw, disc).collect()}
    assert sorted(out) == ["1.234-5-", "777-", "888-", "9.9-"]
    a = out["1.234-5-"]
    assert (a["MARCA"], a["CUENTA_NEXT"], a["SEGMENTO"], a["RANGO DEUDA"]) == \
        ("Potencial", "12345-", "Personas", "1 Menos a 20 mil")
    assert (a["FECHA INGRESO"], a["FECHA RETIRO"], a["ESTADO CUENTA"]) == ("1/4/2025", "4/4/2025", "Recuperada")
    assert [a[f"Dia_{d}"] for d in range(1, 6)] == ["Asignada", "Asignada", "Asignada", "Retirada", ""]
    assert (a["DIAS ASIGNADA"], a["DIAS RETIRADA"], a["RANGO DE DIAS"]) == (3, 1, 4)
    assert a["PORCENTAJE"] == "12.5" and a["VALOR DESCUENTO"] == "17500,00"
    assert a["VALOR DEUDA"] == "20000,00" and a["RANGO CON DESCUENTO"] == "1 Menos a 20 mil"
    assert (a["DOCUMENTO"], a["TIPO DE DOCUMENTO"], a["NOMBRE"]) == ("100", "Cedula de Ciudadania", "PEDRO PEREZ")
    assert (a["MULTICUENTA"], a["MULTIPRODUCTO"], a["MULTIMORA"]) == ("Aplica", "Aplica", "Aplica")
    b = out["9.9-"]
    assert b["MARCA"] == "Prechurn" and b["REFERENCIA"] == "9.9"
    assert [b[f"Dia_{d}"] for d in range(1, 7)] == ["Asignada", "Sin reasignar", "Asignada", "Sin reasignar",
                                                    "Asignada", "Retirada"]
    c = out["777-"]
    assert c["MARCA"] == "120 - 180" and c["TIPO DE DOCUMENTO"] == "Errado"
    assert c["ESTADO CUENTA"] == "En gestion" and c["FECHA RETIRO"] == "-"
    assert c["MULTICUENTA"] == "No aplica"
    d = out["888-"]
    assert d["MARCA"] == "Castigo" and d["TIPO DE DOCUMENTO"] == "Sin tipologia"
    assert d["RANGO DEUDA"] == "9.1 Mayor a 2 millones" and d["MES DE ASIGNACION"] == "4"


def test_contact_log_stream_dedups(spark):
    from recaudo.streaming.contact_log import current_counts, start_hourly_counts
    base = scratch_path(spark, "stream-test")
    schema = "event_id bigint, ts timestamp_ntz, event_type string"
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    batch1 = [(1, t0, "click"), (2, t0 + dt.timedelta(minutes=5), "error"), (1, t0, "click")]
    batch2 = [(3, t0 + dt.timedelta(hours=1), "click"), (2, t0 + dt.timedelta(minutes=5), "error")]
    for b in (batch1, batch2):
        spark.createDataFrame(b, schema).write.mode("append").parquet(base + "/in")
    status = F.when(F.col("event_type") == "error", "Not sent").otherwise("Sent")
    q = start_hourly_counts(spark, base + "/in", spark.read.parquet(base + "/in").schema, "ts", "event_id",
                            {"estado": status}, base + "/out", base + "/ckpt", files_per_trigger=1)
    q.awaitTermination()
    got = sorted((r.hora, r.estado, r.n) for r in current_counts(spark, base + "/out", ["hora", "estado"]).collect())
    assert got == [(t0, "Not sent", 1), (t0, "Sent", 1), (t0 + dt.timedelta(hours=1), "Sent", 1)]


def test_corrupt_rows_are_kept_and_counted(spark):
    base = scratch_path(spark, "corrupt-test")
    _write(f"{base}/x.csv", "a;b\n1;2\nnot-a-number;3\n4;5\n")
    df = delimited.read_delimited(spark, base, "a int, b int", keep_corrupt=True)
    bad = delimited.corrupt_rows(df).select("a", "b", "_corrupt_record").collect()
    assert [r._corrupt_record for r in bad] == ["not-a-number;3"]
    assert df.where("a is not null").count() == 2


def test_command_line_contacts_and_folder_merge(spark):
    from recaudo.__main__ import main
    base = scratch_path(spark, "cli")
    _write(f"{base}/contacts.csv", "identificacion;cuenta;dato\nD1;1-2;3001234567\nD1;1-2;a@b.co\nD2;9;junk\n")
    assert main(["contacts", "--input", f"{base}/contacts.csv", "--month", "3", "--year", "2025",
                 "--out", f"{base}/out_contacts"]) == 0
    back = delimited.read_delimited(spark, f"{base}/out_contacts", None, sep=";", suffix=None)
    got = {r.cuenta: r["Filtro Demografico"] for r in back.collect()}
    assert got == {"12-": "Celular Email"}
    _write(f"{base}/exports/a.csv", "Cuenta_Real,Cuenta_Sin_Punto,Marca\n1.1,11,churn\n")
    _write(f"{base}/exports/b.csv", "Cuenta_Real;Cuenta_Sin_Punto\n2.2;22\n")
    assert main(["folder-merge", "--input", f"{base}/exports", "--month", "6", "--year", "2024",
                 "--out", f"{base}/out_merge"]) == 0
    merged = delimited.read_delimited(spark, f"{base}/out_merge", None, sep=";", suffix=None)
    assert sorted(r.Cuenta_Real for r in merged.collect()) == ["1.1-", "2.2-"]


def test_command_line_assignment(spark):
    import pandas as pd
    from recaudo.__main__ import main
    base = scratch_path(spark, "cli-asg")
    rows = [_raw_row("CC7", "55", "BSCS", "Y", "N", "N", "1000", "30", "Ana", f"{d}/4/2025") for d in (1, 2)]
    os.makedirs(f"{base}/bases")
    pd.DataFrame(rows).to_csv(f"{base}/bases/day1.csv", sep=";", index=False)
    _write(f"{base}/disc/d.csv", "CUENTA;PORCENTAJE\n55;10\n")
    assert main(["assignment", "--bases", f"{base}/bases", "--discounts", f"{base}/disc",
                 "--out", f"{base}/out"]) == 0
    assert os.listdir(f"{base}/out") == ["mes=2025-04"]
    back = delimited.read_delimited(spark, f"{base}/out", None, sep=";", suffix=None).collect()
    assert len(back) == 1 and back[0]["MARCA"] == "Potencial" and back[0]["VALOR DESCUENTO"] == "900,00"


def test_command_line_touches(spark):
    from recaudo.__main__ import main
    base = scratch_path(spark, "cli-touch")
    for ch, n in (("SMS", 3), ("EMAIL", 1), ("BOT", 0), ("IVR", 2)):
        body = "Cuenta_Real,Cuenta_Sin_Punto,Marca,Cantidad\n" + (f"1.5,15,CHURN,{n}\n" if n else "")
        _write(f"{base}/in/Consolidado {ch}.csv", body)
    assert main(["touches", "--input", f"{base}/in", "--month", "3", "--year", "2025", "--out", f"{base}/out"]) == 0
    r = delimited.read_delimited(spark, f"{base}/out", None, sep=";", suffix=None).collect()
    assert len(r) == 1 and (r[0]["Toques por SMS"], r[0]["Toques por BOT"], r[0]["Toques por IVR"]) == ("3", "0", "2")


def test_drifting_folder_reads_gzipped_exports(spark):
    import gzip
    base = scratch_path(spark, "drift-gz")
    os.makedirs(base)
    with gzip.open(f"{base}/a.csv.gz", "wt", encoding="utf-8") as f:
        f.write("Cuenta_Real;Cuenta_Sin_Punto;Marca\n7.7;77;churn\n")
    _write(f"{base}/b.csv", "Cuenta_Real,Cuenta_Sin_Punto\n8.8,88\n")
    scan = merge_export_folder(spark, base, 6, 2024)
    assert scan.skipped == []
    assert sorted((r.Cuenta_Real, r.Marca) for r in scan.df.collect()) == [("7.7-", "churn"), ("8.8-", None)]


def test_command_line_reads_columns_by_name(spark):
    from recaudo.__main__ import main
    base = scratch_path(spark, "cli-names")
    _write(f"{base}/c.csv", "cuenta;identificacion;origen;dato\n111;CC9;web;3001234567\n")
    assert main(["contacts", "--input", f"{base}/c.csv", "--month", "3", "--year", "2025", "--out", f"{base}/out_c"]) == 0
    r = delimited.read_delimited(spark, f"{base}/out_c", None, suffix=None).collect()
    assert [(x.identificacion, x.cuenta, x.phone1) for x in r] == [("CC9", "111-", "3001234567")]
    for ch in ("SMS", "EMAIL", "BOT", "IVR"):
        _write(f"{base}/t/Consolidado {ch}.csv", "Fecha,Cantidad,Cuenta_Real,Cuenta_Sin_Punto,Marca\n1/4/2025,7,1.5,15,CHURN\n")
    assert main(["touches", "--input", f"{base}/t", "--month", "3", "--year", "2025", "--out", f"{base}/out_t"]) == 0
    r = delimited.read_delimited(spark, f"{base}/out_t", None, suffix=None).collect()
    assert [(x.Cuenta_Real, x["Toques por SMS"]) for x in r] == [("1.5", "7")]
    _write(f"{base}/d/d.csv", "otro;PORCENTAJE;CUENTA\nx;12.345;55\n")
    got = delimited.read_by_header(spark, f"{base}/d", ["CUENTA", "PORCENTAJE"]).collect()
    assert [tuple(x) for x in got] == [("55", "12.345")]
    with pytest.raises(ValueError, match="Falta"):
        delimited.read_by_header(spark, f"{base}/d", ["Falta"])


def test_half_written_file_raises_or_is_reported(spark):
    import gzip
    base = scratch_path(spark, "half")
    os.makedirs(base)
    body = "Cuenta_Real;Cuenta_Sin_Punto\n" + "".join(f"{k}.{k};{k}\n" for k in range(20000))
    whole = gzip.compress(body.encode())
    for name, data in (("a.csv.gz", whole), ("b.csv.gz", whole[:len(whole) // 2])):
        with open(f"{base}/{name}", "wb") as f:
            f.write(data)
    with pytest.raises(Exception):
        merge_export_folder(spark, base, 6, 2024).df.count()
    scan = merge_export_folder(spark, base, 6, 2024, skip_unreadable=True)
    assert [os.path.basename(p) for p in scan.unreadable] == ["b.csv.gz"] and scan.df.count() == 20000


def test_header_of_any_length_keeps_its_columns(spark):
    base = scratch_path(spark, "wide")
    names = [f"column_{k:06d}_{'x' * 300}" for k in range(4000)]
    _write(f"{base}/w.csv", ";".join(names) + "\n" + ";".join(["1"] * 4000) + "\n")
    assert delimited.header_columns(delimited.header_line(spark, f"{base}/w.csv"), ";") == tuple(names)


def test_write_runs_the_plan_once_and_bounds_the_files(spark):
    base = scratch_path(spark, "once")
    seen = spark.sparkContext.accumulator(0)
    df = spark.range(0, 5000, numPartitions=8).select(F.col("id"), F.concat(F.lit("2025-0"), (F.col("id") % 3 + 1).cast("string")).alias("mes"))

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    assert delimited.write_delimited(df.mapInArrow(count, "id long, mes string"), f"{base}/out", partition_by=["mes"])
    assert seen.value == 5000
    for month in os.listdir(f"{base}/out"):
        assert len([f for f in os.listdir(f"{base}/out/{month}") if f.endswith(".csv")]) <= 2


def test_percentages_keep_their_decimals(spark):
    from recaudo.operators.discount import apply_discounts
    base = spark.createDataFrame([("1-", "100000.00"), ("2-", "50.00")], "k string, debt string").select("k", F.col("debt").cast("decimal(18,2)").alias("debt"))
    disc = spark.createDataFrame([("1-", "12.345"), ("1-", "9.5"), ("1-", "raro"), ("2-", None)], "c string, p string")
    got = {r.k: (str(r.valor_descuento), r.porcentaje_texto, r.filtro_descuento) for r in apply_discounts(base, disc, "k", "c", "debt", "p").collect()}
    assert got == {"1-": ("87655.000000", "12.345", "Aplica"), "2-": ("0.000000", "0", "No Aplica")}


def test_undated_rows_are_reported_not_a_second_account(spark):
    from recaudo.operators import calendar
    from recaudo.plans.assignment import assignment_days
    raw = spark.createDataFrame([_raw_row("CC7", "55", "BSCS", "Y", "N", "N", "1000", "30", "Ana", d) for d in ("1/4/2025", "junk", None)],
                                ", ".join(f"`{i}_` string" for i in range(1, 58)))
    disc = spark.createDataFrame([], "CUENTA string, PORCENTAJE string")
    assert assignment_base(raw, disc).count() == 1
    assert [tuple(r) for r in calendar.undated_rows(assignment_days(raw), ["CUENTA"], "_fecha").collect()] == [("55-", 2)]


def test_stream_counts_late_rows_and_compacts(spark):
    from recaudo.streaming.contact_log import compact, current_counts, run_hourly_counts
    base = scratch_path(spark, "late-test")
    schema = "event_id bigint, ts timestamp_ntz, event_type string"
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    at = lambda h: t0 + dt.timedelta(hours=h)
    run = lambda: run_hourly_counts(spark, base + "/in", spark.read.schema(schema).parquet(base + "/in").schema, "ts", "event_id",
                                    {"estado": F.lit("Sent")}, base + "/out", base + "/ckpt", files_per_trigger=1)
    spark.createDataFrame([(1, at(0), "a"), (2, at(9), "a")], schema).coalesce(1).write.mode("append").parquet(base + "/in")
    assert run() == {"rows": 2, "late": 0}
    spark.createDataFrame([(3, at(1), "late"), (4, at(9), "a")], schema).coalesce(1).write.mode("append").parquet(base + "/in")
    assert run() == {"rows": 2, "late": 1}
    now = sorted(tuple(r) for r in current_counts(spark, base + "/out", ["hora", "estado"]).collect())
    assert now == [(at(0), "Sent", 1), (at(9), "Sent", 2)]
    compact(spark, base + "/out", ["hora", "estado"], base + "/compact")
    assert sorted(tuple(r) for r in current_counts(spark, base + "/compact", ["hora", "estado"]).collect()) == now
