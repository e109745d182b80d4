"""Campaign messages and contact logs as Spark jobs.

The reference sends messages one row at a time from the driver; here the
data part becomes columns and aggregates: the message text per account
(template table, placeholders replaced), the sending-window eligibility,
counts per status and hour from the attempt log, and the latest channel
verdict per number attached to the contacts. Sending itself (a browser
robot) is outside a data engine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from .joins import broadcast_if_small

TEMPLATE_SCHEMA = "template_id string, texto string"
PLACEHOLDERS = ("cuenta", "nombre", "saldo_total", "valor_pago", "entidad")


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """Template texts are input data ({id: text}) with ``{placeholder}``
    fields."""
    return spark.createDataFrame(list(templates.items()), TEMPLATE_SCHEMA)


def render_messages(df: DataFrame, templates: DataFrame, template_col: str,
                    fields: Mapping[str, Column | str], max_templates: int = 10_000) -> DataFrame:
    """Join each row with its template (broadcast when a bounded count finds
    at most ``max_templates`` of them, a shuffle join otherwise) and replace
    every ``{name}`` by the row's value (NULL -> '')."""
    t = broadcast_if_small(templates.withColumnRenamed("template_id", "_tid"), max_templates)
    j = df.join(t, df[template_col] == t["_tid"], "left").drop("_tid")
    msg = F.col("texto")
    for name, c in fields.items():
        c = F.col(c) if isinstance(c, str) else c
        msg = F.replace(msg, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return j.withColumn("mensaje", msg).drop("texto")


def in_send_window(ts: Column | str, window=fixed.SEND_WINDOW) -> Column:
    """True when the time of day (minute precision) lies inside the sending
    window, both ends inclusive."""
    t = F.col(ts) if isinstance(ts, str) else ts
    (h0, m0), (h1, m1) = window
    minute = F.hour(t) * 60 + F.minute(t)
    return minute.between(h0 * 60 + m0, h1 * 60 + m1)


def attempts_per_hour(log: DataFrame, ts: str, by: Sequence[str]) -> DataFrame:
    """Attempt counts per hour bucket and the ``by`` columns (status,
    operator ...). Partial aggregation: a hot hour costs one row per task."""
    # date_trunc yields a zoned timestamp; keep the log's own timestamp type
    hour = F.date_trunc("hour", F.col(ts)).cast(log.schema[ts].dataType)
    return log.groupBy(hour.alias("hora"), *by).agg(F.count(F.lit(1)).alias("n"))


def latest_verdict(checks: DataFrame, key: str, verdict: str, ts: str,
                   tie: str | None = None) -> DataFrame:
    """Latest verdict per number (ties by ``tie``): ``max(struct(ts, tie,
    verdict))`` - partial aggregate, never a per-number list."""
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])
    agg = checks.groupBy(key).agg(F.max(F.struct(*order, F.col(verdict).alias("_v"))).alias("_m"))
    return agg.select(key, F.col("_m")["_v"].alias(verdict), F.col("_m")[ts].alias(ts))
