"""Types of columns that differ from file to file."""

import datetime as dt
from decimal import Decimal

import pytest

from recaudo.session import scratch_path
from recaudo.sources import typed


@pytest.mark.parametrize("values, kind", [
    (["1", "-7", None, ""], "int"), (["2147483647"], "int"), (["2147483648", "1"], "bigint"), (["9223372036854775808", "1"], "decimal(38,0)"),
    (["123456789012345678901"], "decimal(38,0)"), (["1", "2.50"], "decimal(18,2)"), (["0.5", "123456789012345678"], "decimal(38,1)"),
    (["1e3", "2"], "double"), (["-1.5E-3"], "double"), (["1", "x"], "string"), (["007", "1"], "string"), (["+1"], "string"), (["1,5"], "string"), (["1" * 39], "string"),
    (["1" * 38 + ".5"], "string"), (["2025-02-28", " 2024-02-29 "], "date"), (["2025-02-30"], "string"), (["1/4/2025", "31/12/2025"], "date"),
    (["1/4/2025", "2025-04-01"], "string"), (["2025-04-01", "3"], "string"), ([None, "", "  "], "string"), (["true"], "string"), (["0", "-0"], "int"), (["."], "string"), (["-"], "string"),
    (["2025-04-01 10:00"], "string"), (["NaN"], "string")])
def test_type_of_a_column(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a b` string")
    assert typed.infer_types(df)["a b"][0] == kind


def test_files_with_clashing_types_give_the_widest(spark):
    import os
    base = scratch_path(spark, "typed-test")
    os.makedirs(base)
    for name, text in (("a.csv", "k;v;d;solo\n1;10;1/4/2025;9\n"), ("b.csv", "v,k,d\n2.25,99999999999,2/4/2025\n"), ("c.csv", "d;k;v\n;3; 7 \n")):
        with open(f"{base}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    df = typed.read_typed(spark, base, sep=None)
    assert dict(df.dtypes) == {"k": "bigint", "v": "decimal(18,2)", "d": "date", "solo": "int"}
    assert sorted(tuple(r) for r in df.select("k", "v", "d", "solo").collect()) == [
        (1, Decimal("10.00"), dt.date(2025, 4, 1), 9), (3, Decimal("7.00"), None, None), (99999999999, Decimal("2.25"), dt.date(2025, 4, 2), None)]
    with open(f"{base}/e.csv", "w", encoding="utf-8") as f:
        f.write("k;v\n4;raro\n")
    assert dict(typed.read_typed(spark, base, sep=None).dtypes)["v"] == "string"


def test_one_pass_over_all_files(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("typed-one-pass", "")
    typed.infer_types(df)
    jobs = tracker.getJobIdsForGroup("typed-one-pass")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2                                              # AQE runs the two stages of one aggregate
    assert typed.infer_types(df.select()) == {}
