"""Contact-attempt log as a stream: hourly counts per status.

The reference appends one row per attempt to a log file. As a stream:

* file source (new log files as they land), explicit schema;
* event-time watermark, duplicates of an attempt id dropped within it
  (``dropDuplicatesWithinWatermark``: bounded state);
* ``groupBy(window(ts, 1 hour), status...)`` counts, ``update`` output mode
  so open windows are visible at every trigger and state older than the
  watermark is dropped;
* ``foreachBatch`` sink that writes each micro-batch to its own
  ``batch=<id>`` folder with overwrite - a replayed batch after a failure
  rewrites the same folder, so the sink is idempotent;
* the current table = latest value per (hour, status) over all batches
  (``max(struct(batch, n))``, a partial aggregate).
"""

from __future__ import annotations

import os
import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.delimited import hadoop_fs


def start_hourly_counts(spark: SparkSession, source: str, schema, ts: str, key: str,
                        by: dict[str, Column], sink: str, checkpoint: str,
                        watermark: str = "2 hours", files_per_trigger: int | None = None,
                        available_now: bool = True):
    """Start the stream; returns the StreamingQuery."""
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    # a folder of log files, or one file: the stream source lists folders, so a file is picked from its folder
    fs, p = hadoop_fs(spark, source)
    if fs.getFileStatus(p).isFile():
        r, source = r.option("pathGlobFilter", p.getName()), p.getParent().toString()
    s = r.parquet(source)
    ts_type = s.schema[ts].dataType
    # watermarks need a zoned timestamp; wall-clock logs (timestamp_ntz) are
    # read in the session time zone and the hour is cast back at the end
    s = s.withColumn("_ets", F.col(ts).cast("timestamp"))
    s = s.withWatermark("_ets", watermark).dropDuplicatesWithinWatermark([key])
    agg = s.groupBy(F.window("_ets", "1 hour")["start"].cast(ts_type).alias("hora"),
                    *[c.alias(n) for n, c in by.items()]) \
        .agg(F.count(F.lit(1)).alias("n"))

    def write_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))

    w = agg.writeStream.outputMode("update").foreachBatch(write_batch) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_hourly_counts(spark: SparkSession, source: str, schema, ts: str, key: str, by: dict[str, Column],
                      sink: str, checkpoint: str, **options) -> dict[str, int]:
    """Run the stream over what is there and stop. Returns {"rows", "late"}:
    the rows read and those that came later than the watermark allows."""
    seen = _Progress()
    spark.streams.addListener(seen)
    try:
        q = start_hourly_counts(spark, source, schema, ts, key, by, sink, checkpoint, **options)
        q.awaitTermination()
        seen.wait_for(str(q.runId))
    finally:
        spark.streams.removeListener(seen)
    mine = [p for p in seen.updates if str(p.runId) == str(q.runId)]
    return {"rows": sum(p.numInputRows for p in mine),
            "late": sum(s.numRowsDroppedByWatermark for p in mine for s in p.stateOperators)}


class _Progress(StreamingQueryListener):
    """All progress updates; the query itself keeps its latest ones only."""

    def __init__(self):
        self.updates, self.ended, self.news = [], set(), threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.updates.append(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def wait_for(self, run_id: str, seconds: float = 60.0) -> None:
        """Until the updates of a run are all here: they come in order, the end last."""
        with self.news:
            if not self.news.wait_for(lambda: run_id in self.ended, seconds):
                raise TimeoutError("the end of the query was not reported")


def current_counts(spark: SparkSession, sink: str, keys: Sequence[str] = ("hora",)) -> DataFrame:
    """Latest count per key over the micro-batches written so far."""
    d = spark.read.parquet(sink)
    latest = d.groupBy(*keys).agg(F.max(F.struct("batch", "n")).alias("_l"))
    return latest.select(*keys, F.col("_l")["n"].alias("n"))


def compact(spark: SparkSession, sink: str, keys: Sequence[str], into: str) -> None:
    """Writes the current counts as batch 0 of a new sink folder, from which
    readers go on; the old folder's batches are then no longer needed."""
    current_counts(spark, sink, keys).write.mode("overwrite").parquet(os.path.join(into, "batch=0"))
