"""Co-bucketed monthly sources: the chain over them has no exchange on the key."""

import re

from recaudo.operators import geo
from recaudo.plans import monthly
from recaudo.session import scratch_path
from recaudo.sources import bucketed
from test_consolidation import _src


def chain_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chain_over_bucketed_sources_has_no_exchange_on_the_key(spark):
    pats = geo.pattern_table(spark, [(1, "BOGOTA", "CUNDINAMARCA", 2), (1, "CALI", "VALLE DEL CAUCA", 1)])
    plain = lambda: monthly.monthly_consolidation(_src(spark), pats)
    store = monthly.bucketed_store(spark, scratch_path(spark, "bucketed-test"), 4, "prueba")
    kept = lambda: monthly.monthly_consolidation(_src(spark), pats, store=store)
    on_key = r"Exchange hashpartitioning\(CUENTA_NEXT#\d+"
    plan = chain_plan(spark, kept)
    assert plan.count("SortMergeJoin") == 10                       # nine sides and the document list
    assert len(re.findall(on_key, plan)) == 0
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3     # the document list: its distinct rows and its join, on another key
    assert plan.count("Bucketed: true") == 10 and "SelectedBucketsCount: 4 out of 4" in plan
    assert len(re.findall(on_key, chain_plan(spark, plain))) >= 9
    assert sorted(map(tuple, kept().collect()), key=repr) == sorted(map(tuple, plain().collect()), key=repr)


def test_a_bucket_is_one_sorted_file(spark):
    import os
    path = scratch_path(spark, "bucket-files")
    df = spark.range(0, 2000, numPartitions=7).selectExpr("cast(id % 100 as string) as k", "id as v")
    back = bucketed.write_bucketed(df, "prueba_archivos", ["k"], 5, path)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 5
    assert back.count() == 2000
    again = bucketed.write_bucketed(df.limit(10), "prueba_archivos", ["k"], 5, path)
    assert again.count() == 10
