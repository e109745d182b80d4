"""Sinks that leave the earlier output alone until the new one is whole."""

import os

import pytest
from pyspark.sql import functions as F

from recaudo.operators import geo
from recaudo.plans import monthly
from recaudo.session import scratch_path
from recaudo.sources import committed, delimited
from test_consolidation import _src


def read(spark, path, schema="v string, n int"):
    return sorted(tuple(r) for r in delimited.read_delimited(spark, path, schema, suffix=None).collect())


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "committed-test")


def test_empty_and_failed_runs_leave_the_earlier_output(spark, folder):
    out = f"{folder}/out"
    one = spark.createDataFrame([("a", 1), ("b", 2)], "v string, n int")
    assert delimited.write_delimited(one.limit(0), out) is False and not os.path.exists(out)
    assert delimited.write_delimited(one, out) is True
    files = sorted(os.listdir(out))
    assert delimited.write_delimited(one.where("n > 9"), out) is False
    broken = spark.range(0, 1000, numPartitions=4).select(F.lit("x").alias("v"), F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).alias("n"))
    with pytest.raises(Exception, match="broken"):
        delimited.write_delimited(broken, out)
    with pytest.raises(Exception, match="broken"):
        delimited.append_log(broken, out)
    assert delimited.append_log(one.limit(0), out) is False
    assert sorted(os.listdir(out)) == files and read(spark, out) == [("a", 1), ("b", 2)]
    assert os.listdir(folder) == ["out"]                                       # no staging left
    assert delimited.write_delimited(one.where("n = 2"), out) is True
    assert read(spark, out) == [("b", 2)] and os.listdir(folder) == ["out"]
    assert delimited.append_log(one.where("n = 1"), out) is True
    assert read(spark, out) == [("a", 1), ("b", 2)]
    assert delimited.write_delimited(one.limit(0), out, skip_empty=False) is False
    assert read(spark, out) == []


def test_a_driver_that_died_during_the_swap_is_recovered(spark, folder):
    out = f"{folder}/out"
    one = spark.createDataFrame([("a", 1)], "v string, n int")
    delimited.write_delimited(one, out)
    os.rename(out, f"{folder}/.out.previous-0123456789ab")                     # died after the first rename
    assert delimited.write_delimited(one.limit(0), out) is False
    assert read(spark, out) == [("a", 1)]
    assert committed.recover(spark, out) is False


def test_a_swap_that_fails_puts_the_old_output_back(spark, folder, monkeypatch):
    out = f"{folder}/out"
    one = spark.createDataFrame([("a", 1)], "v string, n int")
    delimited.write_delimited(one, out)
    real = committed._rename

    def rename(spark, source, target):
        if ".staging-" in source:
            raise OSError("store is away")
        real(spark, source, target)
    monkeypatch.setattr(committed, "_rename", rename)
    with pytest.raises(OSError, match="away"):
        delimited.write_delimited(spark.createDataFrame([("z", 9)], "v string, n int"), out)
    assert read(spark, out) == [("a", 1)] and os.listdir(folder) == ["out"]


def test_rewriting_one_month_leaves_the_others(spark, folder):
    out = f"{folder}/out"
    src = {}
    for m in ("2025-01", "2025-02"):
        os.makedirs(f"{folder}/in", exist_ok=True)
        src[m] = [f"{folder}/in/{m}.csv"]
        with open(src[m][0], "w") as f:
            f.write("v\nx\n")
    df = spark.createDataFrame([("a", 1, "2025-01"), ("b", 2, "2025-02"), ("c", 3, "2024-12")], "v string, n int, mes string")
    assert committed.stale_partitions(spark, out, src) == ["2025-01", "2025-02"]
    assert committed.rewrite_partitions(df, out, "mes", src) == {"2025-01": 1, "2025-02": 1}      # other months aren't written
    assert committed.stale_partitions(spark, out, src) == []
    january = os.listdir(f"{out}/mes=2025-01")
    with open(src["2025-02"][0], "a") as f:
        f.write("y\n")
    assert committed.stale_partitions(spark, out, src) == ["2025-02"]
    february = {"2025-02": src["2025-02"]}
    assert committed.rewrite_partitions(df.where("n = 1"), out, "mes", february) == {"2025-02": 0}    # nothing found: kept, and still stale
    assert committed.stale_partitions(spark, out, src) == ["2025-02"]
    assert committed.rewrite_partitions(df.withColumn("v", F.upper("v")), out, "mes", february) == {"2025-02": 1}
    assert os.listdir(f"{out}/mes=2025-01") == january
    assert read(spark, out, "v string, n int, mes string") == [("B", 2, "2025-02"), ("a", 1, "2025-01")]
    assert committed.read_manifest(spark, out, "2025-02")["rows"] == 1
    assert committed.rewrite_partitions(df, out, "mes", {}) == {}


def test_monthly_rerun_takes_changed_months_only(spark, tmp_path):
    src, folder, out = _src(spark), str(tmp_path / "in"), str(tmp_path / "out")
    for name, layout in monthly.DEFAULT_LAYOUT.items():
        pdf = getattr(src, name).drop("mes").toPandas()
        for y, m in ((2025, 3), (2025, 4)):
            if name == "queues" and m == 3:
                continue                                                       # a source that one month lacks
            path = os.path.join(folder, layout.format(year=y, month=f"{m:02d}"))
            os.makedirs(os.path.dirname(path), exist_ok=True)
            pdf.to_csv(path, sep=";", index=False)
    months = monthly.month_range((2025, 3), (2025, 4))
    pats = geo.pattern_table(spark, [(1, "BOGOTA", "CUNDINAMARCA", 2)])
    assert monthly.rerun_months(spark, folder, out, months, pats) == {"2025-03": 3, "2025-04": 3}
    april = sorted(os.listdir(f"{out}/mes=2025-04"))
    assert monthly.rerun_months(spark, folder, out, months, pats) == {}
    path = os.path.join(folder, monthly.DEFAULT_LAYOUT["excluded_accounts"].format(year=2025, month="03"))
    with open(path, "a") as f:
        f.write("400\n")
    assert monthly.rerun_months(spark, folder, out, months, pats) == {"2025-03": 3}
    assert sorted(os.listdir(f"{out}/mes=2025-04")) == april
    back = delimited.read_delimited(spark, out, None, suffix=None)
    got = {(r["mes"], r["BG_cuenta_next"]): r["AD_exclusion_cuenta"] for r in back.collect()}
    assert got["2025-03", "400-"] == "APLICA" and got["2025-04", "400-"] is None and len(got) == 6
