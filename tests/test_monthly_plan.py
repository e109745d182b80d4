"""One row a key without packing wide rows, and the chain's wide sides last."""
from recaudo.operators.topn import first_row_per_key, keyed_distinct
from recaudo.plans import monthly


def test_keyed_distinct_ranks_instead_of_packing(spark):
    rows_ = [(1, "x", 2, None), (1, "x", 2, "b"), (1, "x", None, "a"), (None, "x", 5, "q"), (None, "x", 4, "z"), (2, None, 1, "c"), (2, None, 1, "c")]
    df = spark.createDataFrame(rows_, "k int, m string, o int, v string")
    got = keyed_distinct(df, ["k", "m"], ["o"])
    as_before = first_row_per_key(df, ["k", "m"], ["o"], df.columns).select(*df.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, as_before.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_wide_sides_join_last(spark):
    import recaudo.plans.q_consolidation as q
    _, sides, _ = monthly.prepare_sources(q._monthly_sources(spark, "/root/testdata/sf0.001"))
    width = [len(side.columns) for side, _ in sides]
    assert width == sorted(width)
