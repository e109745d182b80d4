"""Contact-attempt log as a stream that keeps its late rows.

Spark's own event-time operators drop rows older than the watermark before
any sink sees them. Here a keyed state (``applyInPandasWithState``) sorts
every row of the log into one of three kinds:

* ``late``: its time is not after the watermark its micro-batch began with;
* ``repeated``: an attempt with the same id was kept before, and the
  watermark has not passed its time since;
* ``counted``: all others.

State is keyed by a slot of the id, so no hour or status is a hot key; a slot
holds the ids that the watermark has not passed, and forgets the others
whenever rows come for it (there is no timer: with processing-time timers a
run over what is there would never end). ``slots`` is sized like shuffle
partitions, to the attempts within the watermark's delay. Each
micro-batch writes its rows by kind into its own ``rows/batch=<id>`` folder,
with overwrite, and its hourly counts, taken from what was written, into
``counts/batch=<id>``; a replayed batch rewrites both. So every row read is in
the sink under exactly one kind, and no count comes from the progress reports
of the query, which Spark cuts to the last ones.

Rows without a time are late (no hour can count them); rows without an id are
never repeated.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructField, StructType

COUNTED, LATE, REPEATED = "counted", "late", "repeated"


def _sort_out(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Kinds of the rows of one slot; state: the ids that were kept, with their times."""
    watermark = state.getCurrentWatermarkMs()
    kept = dict(zip(*state.get)) if state.exists else {}
    kept = {attempt: ms for attempt, ms in kept.items() if ms > watermark}
    for rows in batches:
        kinds = []
        for ms, attempt in zip(rows["_ms"], rows["_id"]):
            if pd.isna(ms) or ms <= watermark:
                kinds.append(LATE)
            elif attempt is not None and attempt in kept:
                kinds.append(REPEATED)
            else:
                kinds.append(COUNTED)
                if attempt is not None:
                    kept[attempt] = int(ms)
        yield rows.assign(kind=kinds)
    if kept:
        state.update((list(kept), list(kept.values())))
    elif state.exists:
        state.remove()


def sorted_out(log: DataFrame, ts: str, key: str, watermark: str, slots: int = 256) -> DataFrame:
    """A streaming ``log`` with column ``kind``. Its other columns, of any
    type, travel beside the state's own columns under a prefix."""
    if "kind" in log.columns:
        raise ValueError("the log already has a column kind")
    d = log.select(F.col(ts).cast("timestamp").alias("_ets"), F.col(key).cast("string").alias("_id"),
                   *[F.col(c).alias(f"r_{c}") for c in log.columns]).withWatermark("_ets", watermark)
    d = d.withColumn("_ms", F.unix_millis("_ets"))
    of = F.when(F.col("_id").isNotNull(), F.xxhash64("_id")).otherwise(F.xxhash64("_ms"))
    d = d.withColumn("_slot", F.pmod(of, F.lit(slots)))
    out = StructType([*d.schema.fields, StructField("kind", StringType())])
    kinds = d.groupBy("_slot").applyInPandasWithState(
        _sort_out, out, "ids array<string>, times array<bigint>", "append", GroupStateTimeout.NoTimeout)
    return kinds.select("kind", *[F.col(f"r_{c}").alias(c) for c in log.columns])


def start_keeping_late(spark: SparkSession, source: str, schema, ts: str, key: str, by: dict[str, Column],
                       sink: str, checkpoint: str, watermark: str = "2 hours", slots: int = 256,
                       files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stream over the parquet files of folder ``source``; returns the StreamingQuery."""
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    kinds = sorted_out(r.parquet(source), ts, key, watermark, slots)

    def write_batch(df: DataFrame, batch_id: int) -> None:
        rows = os.path.join(sink, "rows", f"batch={batch_id}")
        df.write.mode("overwrite").partitionBy("kind").parquet(rows)
        written = spark.read.schema(df.schema).parquet(rows).where(F.col("kind") == COUNTED)
        written.groupBy(F.date_trunc("hour", ts).cast(df.schema[ts].dataType).alias("hora"), *[c.alias(n) for n, c in by.items()]) \
            .agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(os.path.join(sink, "counts", f"batch={batch_id}"))

    w = kinds.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def hourly_counts(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Counts over all micro-batches: each attempt is counted in one batch only, so they add up."""
    return spark.read.parquet(os.path.join(sink, "counts")).groupBy(*keys).agg(F.sum("n").alias("n"))


def kept_rows(spark: SparkSession, sink: str, schema: StructType, kind: str = LATE) -> DataFrame:
    """The log's rows of one kind, with the micro-batch they came in."""
    read = StructType([*schema.fields, StructField("batch", StringType()), StructField("kind", StringType())])
    return spark.read.schema(read).parquet(os.path.join(sink, "rows")).where(F.col("kind") == kind).drop("kind")
