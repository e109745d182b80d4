"""Plan properties of the catalog queries and determinism."""

import re

import pytest

from recaudo.plans.catalog import QUERIES
from tools.check_oracle import table_hash

SF = "/root/testdata/sf0.001"
WRITES = {"csv_roundtrip", "csv_drift_merge", "csv_month_drift", "csv_by_name", "csv_inferred",
          "csv_append_log", "csv_ordered_files", "csv_charsets", "csv_quarantine", "csv_inferred_drift", "calendar_day_by_day", "monthly_bucketed", "csv_committed_rewrite", "csv_month_rerun", "csv_files_per_partition", "csv_skipped_report", "contact_log_stream"}   # plan after a write/stream


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_filters_and_pruning_reach_the_scan(spark):
    p = _plan(spark, "discount_value_band")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_returnflag,R\)", p)
    p = _plan(spark, "calendar_status")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    p = _plan(spark, "outcome_rollup")
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in p


def test_top_n_limit_runs_before_the_shuffle(spark):
    p = _plan(spark, "slots_topn")
    # partial WindowGroupLimit below the exchange, final one above it
    assert p.count("WindowGroupLimit") == 2
    partial = p.index("WindowGroupLimit", p.index("Exchange"))
    assert partial > p.index("Exchange")


def test_union_aggregate_uses_fewer_exchanges_than_outer_chain(spark):
    a = _plan(spark, "touch_union_agg").count("Exchange hashpartitioning")
    b = _plan(spark, "touch_consolidate").count("Exchange hashpartitioning")
    assert a < b


@pytest.mark.parametrize("name", ["first_row_per_key", "touch_union_agg", "slots_topn", "multi_flags",
                                  "latest_verdict", "consolidate_left", "contact_slots"])
def test_same_answer_for_any_partitioning(spark, name):
    hashes = set()
    for n in (3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = QUERIES[name](spark, SF)
        hashes.add(table_hash(df.columns, [tuple(r) for r in df.collect()])[0])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(hashes) == 1


def test_monthly_chain_shuffles_the_wide_row_once(spark):
    import recaudo.plans.q_consolidation as q
    from recaudo.operators import geo
    from recaudo.plans import monthly
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = monthly.monthly_consolidation(q._monthly_sources(spark, SF), geo.pattern_table(spark, q.CITY_PATTERNS))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # down the left side of the joins: the exclusion by document, nine sides by account and month, the city
    left = []
    for row in plan.splitlines():
        m = re.match(r"^([ :+-]*)(?:\* ?)?(?:\*\(\d+\) )?(\w[\w ]*)(.*)$", row)
        if not m:
            continue
        name, rest = m[2], m[3]
        if name.startswith(("SortMergeJoin", "Exchange hashpartitioning")):
            left.append((len(m[1]), name.split()[0], rest))
    top = left[0]
    assert top[1] == "SortMergeJoin" and "_key" in top[2]
    # the first exchange below the document join holds the wide row; below it the account joins follow without another
    chain = [x for x in left[1:] if x[1] == "SortMergeJoin" and "CUENTA_NEXT" in x[2] and "mes" in x[2]]
    assert len(chain) >= 9
    first, ninth = left.index(chain[0]), left.index(chain[8])
    on_the_left = [x for x in left[first:ninth] if x[1] == "Exchange" and x[0] <= chain[8][0]]
    assert not [x for x in on_the_left if x[0] < chain[8][0]], on_the_left
    city = [k for k, x in enumerate(left) if x[1] == "SortMergeJoin" and "_city_key" in x[2]]
    assert city and city[0] > ninth


@pytest.mark.parametrize("name", ["assignment_table", "contact_slots", "contact_profile", "name_clean", "arrears_days", "multi_flags"])
def test_building_a_query_runs_no_job(spark, name):
    QUERIES[name](spark, SF)                     # table handles are open
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    QUERIES[name](spark, SF)
    jobs = tracker.getJobIdsForGroup(f"build-{name}")
    spark.sparkContext.setJobGroup("tests", "")
    assert list(jobs) == []
