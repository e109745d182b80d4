"""The assignment base folds its days once, carries narrow rows through its
joins, and picks rows, labels and brands as the plain rules say."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from recaudo.functions import classify, fixed
from recaudo.operators import calendar
from recaudo.plans import assignment


def _raw(spark):
    cells = {"1_": "CC7", "2_": "5.1", "3_": "RR", "5_": "Y", "6_": "N", "7_": "N", "9_": "10", "24_": "ANA", "57_": "1/3/2025"}
    made = [{**cells}, {**cells, "57_": "4/3/2025"}, {**cells, "2_": "6.1", "3_": "SGA"}, {**cells, "2_": "8.1", "57_": "31/02/2025"}]
    cols = [f"{i}_" for i in range(1, 58)]
    raw = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in made], ", ".join(f"{c} string" for c in cols))
    return raw, spark.createDataFrame([("5.1", "12.5")], "CUENTA string, PORCENTAJE string")


def _plan(spark):
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    try:
        return assignment.assignment_base(*_raw(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.debug.maxToStringFields", before)


def test_flags_read_the_folded_days_from_the_same_shuffle(spark):
    out = assignment.assignment_base(*_raw(spark))
    got = {r["CUENTA"]: r for r in out.collect()}
    assert set(got) == {"5.1-", "6.1-"}          # a day that is no date is left out
    assert got["5.1-"]["MULTICUENTA"] == got["5.1-"]["MULTIPRODUCTO"] == fixed.APPLIES
    assert [got["5.1-"][f"Dia_{d}"] for d in range(1, 6)] == ["Asignada", "Sin reasignar", "Sin reasignar", "Asignada", ""]
    plan = _plan(spark)
    assert len(re.findall(r"partial_bit_or", plan)) == 1 and "ReusedExchange" in plan


def test_rows_between_the_joins_hold_no_day_labels(spark):
    plan = _plan(spark)
    joins = plan.index("Join")
    assert "Asignada" in plan[:joins] and "Asignada" not in plan[joins:]


@pytest.mark.parametrize("last", [1, 2, 30, 31])
def test_day_labels_by_definition(spark, last):
    masks = [1, 1 | 1 << 4, 1 << (last - 1), (1 << last) - 1, 5 << max(last - 4, 0)]
    rows_ = [(m, (m & -m).bit_length(), m.bit_length(), last) for m in masks if m.bit_length() <= last]
    df = spark.createDataFrame(rows_, "m bigint, f int, l int, ml int").select("*", calendar.day_status_array("m", "f", "l", "ml").alias("s"))
    for r in df.collect():
        assert r["s"] == ["Asignada" if r["m"] >> (d - 1) & 1 else "Sin reasignar" if r["f"] < d < r["l"]
                          else "Retirada" if r["l"] + 1 == d <= r["ml"] else "" for d in range(1, 32)]


def test_brand_of_a_debt_age_spelled_as_a_brand(spark):
    special = fixed.PREPOTENCIAL_ESPECIAL_CAMPAIGNS[0]
    rows_ = [("N", "Y", "BSCS", special, "30"), ("N", "Y", "BSCS", "Otra", "30"), ("N", "N", "BSCS", special, fixed.BRAND_PREPOTENCIAL),
             ("N", "N", "RR", special, fixed.BRAND_PREPOTENCIAL), ("N", "N", "BSCS", None, "150"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows_, "a string, b string, crm string, camp string, age string")
    got = [r[0] for r in df.select(classify.brand("a", "b", F.lit("N"), F.lit("N"), "crm", "camp", "age")).collect()]
    assert got == [fixed.BRAND_PREPOTENCIAL_ESPECIAL, fixed.BRAND_PREPOTENCIAL, fixed.BRAND_PREPOTENCIAL_ESPECIAL,
                   fixed.BRAND_PREPOTENCIAL, fixed.BRAND_ARREARS_MERGED_LABEL, None]


def test_month_without_a_date_is_no_group(spark):
    df = spark.createDataFrame([("a", dt.date(2025, 1, 3)), ("a", None), ("b", None)], "k string, d date")
    assert [(r["k"], r["day_mask"]) for r in calendar.day_mask_agg(df, ["k"], "d").collect()] == [("a", 4)]
