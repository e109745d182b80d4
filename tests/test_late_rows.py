"""Late rows of the log stream are kept beside the counts."""

import datetime as dt

from pyspark.sql import functions as F

from recaudo.session import scratch_path
from recaudo.streaming.late_rows import COUNTED, LATE, REPEATED, hourly_counts, kept_rows, start_keeping_late


def test_counted_late_and_repeated_rows_are_the_input(spark):
    base = scratch_path(spark, "late-rows")
    schema = spark.createDataFrame([], "event_id bigint, ts timestamp_ntz, note string").schema
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    at = lambda h: t0 + dt.timedelta(hours=h)

    def deliver(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(base + "/in")
        start_keeping_late(spark, base + "/in", schema, "ts", "event_id", {"estado": F.lit("Sent")}, base + "/out", base + "/ckpt").awaitTermination()
    first = [(1, at(0), "a"), (2, at(9), "a"), (2, at(9), "a"), (None, at(9), "x"), (None, at(9), "x"), (9, None, "no time")]
    second = [(3, at(1), "too old"), (4, at(9), "b"), (2, at(9), "again"), (5, at(7), "on the mark"), (6, at(7.01), "just in time")]
    deliver(first)
    deliver(second)
    kinds = {k: sorted((r.event_id or 0, r.note) for r in kept_rows(spark, base + "/out", schema, k).collect()) for k in (COUNTED, LATE, REPEATED)}
    assert kinds[LATE] == [(3, "too old"), (5, "on the mark"), (9, "no time")]
    assert kinds[REPEATED] == [(2, "a"), (2, "again")]
    assert sorted(x for v in kinds.values() for x in v) == sorted((i or 0, n) for i, _, n in first + second)
    counts = {r.hora: r.n for r in hourly_counts(spark, base + "/out", ["hora", "estado"]).collect()}
    assert counts == {at(0): 1, at(7): 1, at(9): 4} and sum(counts.values()) == len(kinds[COUNTED])
    # nothing new: nothing changes
    start_keeping_late(spark, base + "/in", schema, "ts", "event_id", {"estado": F.lit("Sent")}, base + "/out", base + "/ckpt").awaitTermination()
    assert {r.hora: r.n for r in hourly_counts(spark, base + "/out", ["hora", "estado"]).collect()} == counts
