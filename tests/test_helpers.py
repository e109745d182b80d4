"""Join / partitioning helpers and file-based dictionaries."""

import os

from pyspark.sql import functions as F

from recaudo.operators import geo
from recaudo.operators.joins import broadcast_if_small, spread_null_key
from recaudo.session import cut_lineage, scratch_path


def _is_broadcast_hint(df):
    return "ResolvedHint" in df._jdf.queryExecution().logical().toString() or \
        "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_broadcast_only_below_the_bound(spark):
    small = spark.range(10)
    assert _is_broadcast_hint(broadcast_if_small(small, max_rows=10))
    assert not _is_broadcast_hint(broadcast_if_small(small, max_rows=9))


def test_spread_null_key_never_matches_and_spreads(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), (None, "3")], "k string, acc string")
    keys = [r[0] for r in df.select(spread_null_key(F.col("k"), F.col("acc"))).collect()]
    assert keys[0] == "a" and keys[1] != keys[2] and keys[1].startswith("\u0000")


def test_pattern_dictionary_from_csv(spark):
    folder = scratch_path(spark, "patterns")
    os.makedirs(folder)
    with open(os.path.join(folder, "dict.csv"), "w", encoding="utf-8") as f:
        f.write("ord;pattern;department;grp\n1;CALI;VALLE DEL CAUCA;1\n2;BOGOTA;CUNDINAMARCA;2\n3;;X;1\n")
    pats = geo.read_pattern_table(spark, os.path.join(folder, "dict.csv"))
    assert pats.lengths == [4, 6]
    df = spark.createDataFrame([("Cali",), ("bogota/dc",)], "c string")
    got = sorted(r.departamento for r in geo.resolve_departments(df, "c", pats).collect())
    assert got == ["CUNDINAMARCA", "VALLE DEL CAUCA"]


def test_cut_lineage_uses_the_shared_checkpoint_dir(spark):
    df = spark.range(5).withColumn("y", F.col("id") * 2)
    cut = cut_lineage(df)
    assert sorted(r.y for r in cut.collect()) == [0, 2, 4, 6, 8]
    assert "LogicalRDD" in cut._jdf.queryExecution().logical().toString() or cut.count() == 5


def test_monthly_backfill_fills_empty_months(spark):
    import datetime as dt
    from recaudo.operators.reshape import monthly_backfill
    df = spark.createDataFrame([(dt.date(2024, 11, 3), 5), (dt.date(2025, 2, 1), 7), (dt.date(2025, 2, 9), 1)],
                               "d date, v int")
    out = monthly_backfill(df, "d", {"n": F.count(F.lit(1)), "s": F.sum("v")}, fill={"n": 0, "s": 0},
                           where=F.col("v") > 1)
    got = sorted((r.mes.isoformat(), r.n, r.s) for r in out.collect())
    assert got == [("2024-11-01", 1, 5), ("2024-12-01", 0, 0), ("2025-01-01", 0, 0), ("2025-02-01", 1, 7)]


def test_append_log_keeps_earlier_rows(spark):
    from recaudo.sources.delimited import append_log, read_delimited
    path = scratch_path(spark, "log")
    append_log(spark.createDataFrame([("1", "Sent")], "n string, estado string"), path)
    append_log(spark.createDataFrame([("2", "Not sent")], "n string, estado string"), path)
    back = read_delimited(spark, path, "n string, estado string", suffix=None)
    assert sorted(tuple(r) for r in back.collect()) == [("1", "Sent"), ("2", "Not sent")]
