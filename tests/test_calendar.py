"""Assignment calendar: closed form versus a naive simulation of the
pass-by-pass labelling (mark assigned days, fill withdrawn days after the
first day, trim to the day after the last assigned day, relabel all but the
last gap), and the Spark operator versus the closed form."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from recaudo.operators import calendar

A, G, W = "Asignada", "Sin reasignar", "Retirada"


def simulate(S, M):
    lab = {d: (A if d in S else "") for d in range(1, 32)}
    if S:
        mn = min(S)
        for d in range(M, 0, -1):                       # fill after the first day
            if lab[d] != A:
                lab[d] = W if mn <= d else ""
        final = max(d for d in range(1, M + 1) if lab[d] == A) + 1
        for d in range(M, 0, -1):                       # trim
            if lab[d] != A:
                lab[d] = W if (final >= d and mn < d) else ""
        withdrawn = [d for d in range(1, M + 1) if lab[d] == W]
        last_w = max(withdrawn) if withdrawn else 999
        for d in range(M, 0, -1):                       # relabel
            if d + 1 <= 31 and lab[d] == W and (lab[d + 1] == A or last_w > d):
                lab[d] = G
    exit_days = [d for d in range(M, 0, -1) if lab[d] == W]
    return {
        "labels": [lab[d] for d in range(1, 32)],
        "assigned": sum(1 for d in range(1, 32) if lab[d] == A),
        "retired": sum(1 for d in range(1, 32) if lab[d] in (W, G)),
        "exit": exit_days[0] if exit_days else None,
    }


def closed(S, M):
    mn, mx = min(S), max(S)
    labels = []
    for d in range(1, 32):
        if d in S:
            labels.append(A)
        elif mn < d < mx:
            labels.append(G)
        elif d == mx + 1 and d <= M:
            labels.append(W)
        else:
            labels.append("")
    return {"labels": labels, "assigned": len(S),
            "retired": (mx - mn + 1 - len(S)) + (1 if mx < M else 0),
            "exit": mx + 1 if mx < M else None}


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 31).flatmap(lambda M: st.tuples(
    st.just(M), st.sets(st.integers(1, M), min_size=1))))
def test_closed_form_equals_simulation(case):
    M, S = case
    assert closed(S, M) == simulate(S, M)


def test_spark_operator_matches_closed_form(spark):
    rnd = random.Random(7)
    data, expect = [], {}
    for month in (1, 2, 3):
        M = rnd.randint(5, 28)
        sets = [{M}, {1, 2, 3}, {1, 3, 5}, {5}, {M - 1}] + \
            [set(rnd.sample(range(1, M + 1), rnd.randint(1, M))) for _ in range(40)]
        for i, S in enumerate(sets):
            acc = f"{month}-{i}"
            for d in S:
                data.append((acc, dt.date(2025, month, d)))
                if d == min(S):
                    data.append((acc, dt.date(2025, month, d)))   # duplicate day
            expect[(acc, month)] = closed(S, M)
    df = spark.createDataFrame(data, "acc string, fecha date")
    out = calendar.assignment_calendar(df, ["acc"], "fecha", labels="array").collect()
    assert len(out) == len(expect)
    for r in out:
        e = expect[(r.acc, r.month.month)]
        assert list(r.day_status) == e["labels"]
        assert r.dias_asignada == e["assigned"]
        assert r.dias_retirada == e["retired"]
        assert r.rango_de_dias == e["assigned"] + e["retired"]
        if e["exit"] is None:
            assert r.fecha_retiro == "-" and r.estado_cuenta == "En gestion"
        else:
            assert r.fecha_retiro == f"{e['exit']}/{r.month.month}/2025"
            assert r.estado_cuenta == "Recuperada"
        assert r.fecha_ingreso == f"{r.first_day}/{r.month.month}/2025"


def test_representative_row_is_earliest_and_deterministic(spark):
    data = [("a", dt.date(2025, 1, 3), "late"), ("a", dt.date(2025, 1, 1), "z-first"),
            ("a", dt.date(2025, 1, 1), "a-first"), ("b", dt.date(2025, 1, 2), "only")]
    df = spark.createDataFrame(data, "acc string, fecha date, name string")
    out = {r.acc: r.name for r in calendar.assignment_calendar(df, ["acc"], "fecha", attrs=["name"],
                                                               labels=None).collect()}
    assert out == {"a": "a-first", "b": "only"}


# ------------------------------------------------------------ kept up file by file

def assigned_rows(rng, n=400):
    base = dt.datetime(2025, 1, 5)
    return [(rng.choice("abcd"), base + dt.timedelta(days=rng.randint(0, 100), hours=rng.randint(0, 23)), f"v{rng.randint(0, 9)}") for _ in range(n)]


def test_state_after_any_files_equals_the_batch(spark):
    from recaudo.operators import calendar_state
    from recaudo.session import scratch_path
    rng = random.Random(6)
    path, keys = scratch_path(spark, "state-test"), ["k"]
    rows = assigned_rows(rng)
    files = [rows[i::5] for i in range(5)]
    order = [3, 0, 3, 1, 4, 2, 0]                                   # in no order, two of them twice
    schema = "k string, ts timestamp_ntz, v string"
    seen: list = []
    for step in order:
        calendar_state.add_days(spark.createDataFrame(files[step], schema), path, keys, "ts", ["v"])
        seen += files[step] if step not in order[:order.index(step)] else []
        if step in (1, 2):
            batch = calendar.assignment_calendar(spark.createDataFrame([r for s in set(order[:order.index(step) + 1]) for r in files[s]], schema), keys, "ts", ["v"], labels="wide")
            got = calendar_state.calendar_from(calendar_state.read_state(spark, path), keys, ["v"], labels="wide")
            assert got.columns == batch.columns
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)


def test_a_file_leaves_the_months_alone_that_it_does_not_hold(spark):
    import os

    import pytest
    from pyspark.sql import functions as F
    from recaudo.operators import calendar_state
    from recaudo.session import scratch_path
    path = scratch_path(spark, "state-months")
    day = lambda m, d, k="a": (k, dt.datetime(2025, m, d))
    make = lambda *r: spark.createDataFrame(list(r), "k string, ts timestamp_ntz")
    assert calendar_state.add_days(make(day(1, 3), day(2, 4)), path, ["k"], "ts") == ["month=2025-01-01", "month=2025-02-01"]
    january = sorted(os.listdir(f"{path}/month=2025-01-01"))
    assert calendar_state.add_days(make(day(2, 9), day(2, 2, "b")), path, ["k"], "ts") == ["month=2025-02-01"]
    assert sorted(os.listdir(f"{path}/month=2025-01-01")) == january
    assert calendar_state.add_days(make(("a", None)), path, ["k"], "ts") == []
    broken = make(day(1, 9)).withColumn("ts", F.when(F.col("k") == "a", F.raise_error(F.lit("broken")).cast("timestamp_ntz")).otherwise(F.col("ts")))
    with pytest.raises(Exception, match="broken"):
        calendar_state.add_days(broken, path, ["k"], "ts")
    state = calendar_state.read_state(spark, path)
    assert sorted((r.k, str(r.month), r.first_day, r.last_day) for r in state.collect()) == [("a", "2025-01-01", 3, 3), ("a", "2025-02-01", 4, 9), ("b", "2025-02-01", 2, 2)]
    folder, name = os.path.split(path)
    assert [n for n in os.listdir(folder) if n.startswith(f".{name}.")] == []          # no staging left


def test_masks_merge_by_key_without_a_second_exchange(spark):
    from recaudo.operators import calendar_state
    df = spark.createDataFrame([("a", dt.datetime(2025, 1, 1))], "k string, ts timestamp_ntz")
    state = calendar.day_mask_agg(df, ["k"], "ts")
    plan = calendar_state.merge_states(state.unionByName(state), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan                                  # merged in the tasks before the shuffle
