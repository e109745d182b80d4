"""Consolidation: left chain from the filtered base equals the full outer
chain with the base filters at the end; the monthly pipeline on literal
fixtures of the eleven sources."""

import os
import random

from pyspark.sql import functions as F

from recaudo.operators import consolidate, geo
from recaudo.plans import monthly


def test_left_chain_equals_full_outer_filtered(spark):
    rnd = random.Random(11)
    for trial in range(3):
        keys = [str(k) if k % 7 else None for k in range(40)]
        base_rows = [(rnd.choice(keys), rnd.choice(["Castigo", "Potencial", None]), f"b{i}", rnd.randint(1, 3))
                     for i in range(60)]
        base = spark.createDataFrame(base_rows, "k string, marca string, v string, doc int") \
            .where(F.col("k").isNotNull()).dropDuplicates(["k"])
        sides = []
        for s in range(3):
            rows = [(rnd.choice(keys), rnd.randint(0, 9)) for _ in range(50)]
            side = spark.createDataFrame(rows, f"k string, x{s} int")
            sides.append((side.groupBy("k").agg(F.max(f"x{s}").alias(f"x{s}")), ["k"]))
        docs = spark.createDataFrame([(1, "APLICA"), (3, "APLICA")], "doc int, excl string")
        sides.insert(1, (docs, ["doc"]))
        flt = F.col("marca") != "Castigo"
        left = consolidate.consolidate(base, flt, sides)
        outer = consolidate.consolidate_full_outer(base, flt, sides, "v")
        cols = sorted(left.columns)
        a = sorted(tuple(r) for r in left.select(cols).collect())
        b = sorted(tuple(r) for r in outer.select(cols).collect())
        assert a == b


def _src(spark):
    m = "2025-04"
    mk = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("mes", F.lit(m))
    base = mk([
        ("100", "Potencial", "BSCS", "Bogota/DC", "1/4/2025", "2/4/2025"),
        ("200", "Castigo", "RR", "Cali", "1/4/2025", "1/4/2025"),          # brand Castigo: vanishes
        ("300", "Churn", "RR", None, "1/4/2025", "Manual"),                # Manual entry: vanishes
        ("350", "Churn", "RR", None, "1/4/2025", None),                    # no entry date: vanishes
        ("400", "Churn", "SGA", "", "31/02/2025", "1/4/2025"),
        ("500", "Potencial", "RR", "Pueblo Raro", "5/4/2025", "1/4/2025"),
    ], "CUENTA_NEXT string, Marca string, `CRM Origen` string, Ciudad string, `Fecha de Vencimiento` string, "
       "`FECHA INGRESO` string")
    assignment = mk([
        ("100-", "100-", "111", "Potencial", "5/4/2025", "-", "12.5", "3", "1", "4", "En gestion"),
        ("100-", "100-", "111", "Otra", "6/4/2025", "-", "0", "3", "1", "4", "En gestion"),   # duplicate key
        ("400-", "400-", "444", "Churn", "1/4/2025", "9/4/2025", "0", "8", "0", "8", "Recuperada"),
        ("999-", "999-", "999", "Churn", "1/4/2025", "-", "0", "1", "0", "1", "En gestion"),  # not in base
    ], "CUENTA_NEXT string, CUENTA string, DOCUMENTO string, MARCA string, `FECHA INGRESO` string, "
       "`FECHA RETIRO` string, PORCENTAJE string, `DIAS ASIGNADA` string, `DIAS RETIRADA` string, "
       "`RANGO DE DIAS` string, `ESTADO CUENTA` string")
    contacts = mk([("D1", "100-", "3001234567", "a@b.co"), ("D2", "1.00", "3007654321", None)],    # two documents, one account
                  "identificacion string, cuenta string, phone1 string, email1 string")
    touches = mk([("1.00", "100", "potencial", "3", "0", "1", "0")],
                 "Cuenta_Real string, Cuenta_Sin_Punto string, marca string, `Toques por SMS` string, "
                 "`Toques por EMAIL` string, `Toques por BOT` string, `Toques por IVR` string")
    queues = mk([("1.00", "raro", "10", "R1"), ("100", "3/4/2025", "20", "R2")],
                "Cuenta string, Fecha string, Valor string, Referencia string")
    ranking = mk([("1.0-0", "4", "ACTIVO"), ("100", "9", None)], "CUENTA string, SERVICIOS string, ESTADO string")
    exc_doc = mk([("444",)], "DOCUMENTO string")
    exc_acc = mk([("500",), ("500",)], "CUENTA string")
    psa = mk([("100", "2"), ("100", "1")], "CUENTA string, RECUENTO string")
    ng = mk([("400", "0")], "CUENTA string, RECUENTO string")
    report = mk([("1.00", "1/4/2025", "Promesa"), ("1.00", "2/4/2025", "colgo"), ("1.00", "3/4/2025", "raro")],
                "` Cuenta ` string, fecha_gestion string, `tipificacion ` string")
    return monthly.MonthlySources(base, assignment, contacts, touches, queues, ranking, exc_doc, exc_acc,
                                  psa, ng, report)


def test_monthly_consolidation_fixture(spark):
    pats = geo.pattern_table(spark, [(1, "BOGOTA", "CUNDINAMARCA", 2), (1, "CALI", "VALLE DEL CAUCA", 1)])
    out = monthly.monthly_consolidation(_src(spark), pats)
    got = {r["BG_cuenta_next"]: r.asDict() for r in out.collect()}
    assert sorted(got) == ["100-", "400-", "500-"]
    a = got["100-"]
    assert a["DS_VAR_departamento"] == "CUNDINAMARCA"
    assert a["DS_VAR_nombre_campana"] in ("Otra", "Potencial")      # one row per key, deterministic
    assert a["AD_filtro_descuento"] in ("Aplica", "No Aplica")
    assert a["DS_VAR_cantidad_demograficos"] == 3                  # '' counts as 0
    assert a["DS_VAR_filtro_reporte_gestion"] == "CDIR CIND"
    assert a["AD_toques_por_sms"] == 3
    assert a["AD_recuento_pagos_sin_aplicar"] == 3 and a["AD_filtro_pagos_sin_aplicar"] == "Aplica"
    assert a["AD_filtro_colas"] == "APLICA" and a["AD_estado_ranking"] == "ACTIVO"       # a missing state comes last
    assert (a["FLT_phone1"], a["FLT_phone2"], a["FLT_email1"]) == ("3001234567", "3007654321", "a@b.co")
    assert a["DS_VAR_filtro_demograficos"] == "Celular Email"
    assert out.columns.index("DOCUMENTO") > out.columns.index("AD_filtro_colas")
    b = got["400-"]
    assert b["DS_VAR_departamento"] == "VACIO"
    assert b["AD_exclusion_documento"] == "APLICA"
    assert b["DS_VAR_dias_mora"] is None and b["DS_VAR_rango_de_dias_mora"] == "Nulo"
    assert b["AD_filtro_pagos_no_gestion"] == ""
    c = got["500-"]
    assert c["DS_VAR_departamento"] == "NO IDENTIFICADO"
    assert c["AD_exclusion_cuenta"] == "APLICA"
    assert c["DS_VAR_nombre_campana"] is None and c["AD_filtro_descuento"] == "No Aplica"
    assert a["mes"] == "2025-04"


def test_month_range_rolls_over():
    assert monthly.month_range((2024, 9), (2025, 3)) == [
        (2024, 9), (2024, 10), (2024, 11), (2024, 12), (2025, 1), (2025, 2), (2025, 3)]
    assert monthly.month_range((2024, 12), (2024, 12)) == [(2024, 12)]


def test_read_months_backfill_in_one_job(spark, tmp_path):
    src = _src(spark)
    folder = str(tmp_path)
    for name, layout in monthly.DEFAULT_LAYOUT.items():
        pdf = getattr(src, name).drop("mes").toPandas()
        for y, m in ((2025, 3), (2025, 4)):
            path = os.path.join(folder, layout.format(year=y, month=f"{m:02d}"))
            os.makedirs(os.path.dirname(path), exist_ok=True)
            pdf.to_csv(path, sep=";", index=False)
    months = monthly.month_range((2025, 3), (2025, 4))
    read = monthly.read_months(spark, folder, months)
    pats = geo.pattern_table(spark, [(1, "BOGOTA", "CUNDINAMARCA", 2)])
    out = monthly.monthly_consolidation(read, pats)
    got = sorted((r["mes"], r["BG_cuenta_next"]) for r in out.collect())
    assert got == [(m, k) for m in ("2025-03", "2025-04") for k in ("100-", "400-", "500-")]


def test_monthly_base_family_keeps_renamed_base_columns(spark):
    pats = geo.pattern_table(spark, [(1, "BOGOTA", "CUNDINAMARCA", 2)])
    cols = monthly.monthly_consolidation(_src(spark), pats).columns
    for c in ("BG_marca_asignacion", "BG_crm_origen", "BG_ciudad", "BG_cuenta_next", "BG_fecha_ingreso"):
        assert c in cols


def test_read_months_skips_missing_monthly_files(spark, tmp_path):
    src = _src(spark)
    folder = str(tmp_path)
    for name, layout in monthly.DEFAULT_LAYOUT.items():
        pdf = getattr(src, name).drop("mes").toPandas()
        months = [(2025, 4)] if name == "queues" else [(2025, 3), (2025, 4)]   # queues: March missing
        for y, m in months:
            path = os.path.join(folder, layout.format(year=y, month=f"{m:02d}"))
            os.makedirs(os.path.dirname(path), exist_ok=True)
            pdf.to_csv(path, sep=";", index=False)
    read = monthly.read_months(spark, folder, monthly.month_range((2025, 3), (2025, 4)))
    assert [os.path.basename(p) for p in read.missing] == ["queues 2025-03.csv"]
    pats = geo.pattern_table(spark, [(1, "BOGOTA", "CUNDINAMARCA", 2)])
    out = {(r["mes"], r["BG_cuenta_next"]): r["AD_filtro_colas"] for r in
           monthly.monthly_consolidation(read, pats).collect()}
    assert out[("2025-04", "100-")] == "APLICA" and out[("2025-03", "100-")] is None


def test_command_line_monthly(spark, tmp_path):
    from recaudo.__main__ import main
    src = _src(spark)
    folder = str(tmp_path / "in")
    for name, layout in monthly.DEFAULT_LAYOUT.items():
        pdf = getattr(src, name).drop("mes").toPandas()
        for y, m in ((2025, 3), (2025, 4)):
            path = os.path.join(folder, layout.format(year=y, month=f"{m:02d}"))
            os.makedirs(os.path.dirname(path), exist_ok=True)
            pdf.to_csv(path, sep=";", index=False)
    pats = tmp_path / "dict.csv"
    pats.write_text("ord;pattern;department;grp\n1;BOGOTA;CUNDINAMARCA;2\n", encoding="utf-8")
    out = str(tmp_path / "out")
    assert main(["monthly", "--input", folder, "--start", "2025-03", "--end", "2025-04",
                 "--patterns", str(pats), "--out", out]) == 0
    assert sorted(os.listdir(out)) == ["mes=2025-03", "mes=2025-04"]
    from recaudo.sources.delimited import read_delimited
    back = read_delimited(spark, out, None, sep=";", suffix=None)
    assert sorted((r["mes"], r["BG_cuenta_next"]) for r in back.collect()) == \
        [(m, k) for m in ("2025-03", "2025-04") for k in ("100-", "400-", "500-")]


def test_read_months_matches_columns_by_name(spark, tmp_path):
    layout = {k: v.replace(" ", "_") for k, v in monthly.DEFAULT_LAYOUT.items()}
    for month, text in (("01", "CUENTA_NEXT;Marca;Ciudad\n1;M;CALI\n"), ("02", "CUENTA_NEXT;Ciudad;Extra;Marca\n1;CALI;x;M\n")):
        path = tmp_path / layout["base"].format(year=2025, month=month)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    out = monthly.read_source(spark, str(tmp_path), "base", [(2025, 1), (2025, 2)], layout)
    got = sorted((r.mes, r.CUENTA_NEXT, r.Marca, r.Ciudad, r.Extra) for r in out.collect())
    assert got == [("2025-01", "1", "M", "CALI", None), ("2025-02", "1", "M", "CALI", "x")]


def test_null_comes_last_among_survivors(spark):
    from recaudo.operators.topn import keyed_distinct
    df = spark.createDataFrame([("k", None, "a"), ("k", "2", "b"), ("k", "3", "c")], "k string, o string, v string")
    assert [tuple(r) for r in keyed_distinct(df, ["k"], ["o"]).collect()] == [("k", "2", "b")]
