"""Catalog entries for campaign rendering, contact logs and the data-quality
profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify
from ..operators import campaign, outcomes, profile
from ..sources.tables import table
from .registry import register
from .q_assignment import _CRM_BY_SEGMENT, _case_spark, _case_sql
from .q_touch import OUTCOME_BY_EVENT, outcome_group_sql, outcome_text_sql

# Template texts are configuration; these are the catalog's own examples.
TEMPLATES = {
    "T1": "Hola {nombre}, su deuda con {entidad} es de {saldo_total}. Pague hoy {valor_pago} (cuenta {cuenta}).",
    "T2": "{nombre}: oferta especial de {entidad}, salde {saldo_total} con solo {valor_pago}.",
    "T3": "Estimado cliente {cuenta}, comuniquese con {entidad}.",
}
TEMPLATE_BY_SEGMENT = [("AUTOMOBILE", "T1"), ("BUILDING", "T2"), ("FURNITURE", "T3"), ("HOUSEHOLD", "T1")]


def _sql_replace(expr: str, fields: dict[str, str]) -> str:
    for k, v in fields.items():
        expr = f"replace({expr}, '{{{k}}}', coalesce(CAST({v} AS VARCHAR), ''))"
    return expr


_TEMPLATES_SQL = ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())
_MSG_FIELDS_SQL = {
    "cuenta": "CAST(c_custkey AS VARCHAR) || '-'",
    "nombre": "c_name",
    "saldo_total": "replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), '.', ',')",
    "valor_pago": "replace(CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(3,2)) AS DECIMAL(16,4)) AS VARCHAR), '.', ',')",
    "entidad": "entidad",
}


@register("message_render", f"""
WITH c AS (SELECT *, {_case_sql('c_mktsegment', _CRM_BY_SEGMENT, 'OTRO')} AS entidad,
                  {_case_sql('c_mktsegment', TEMPLATE_BY_SEGMENT, None)} AS template_id FROM customer),
t AS (SELECT * FROM (VALUES {_TEMPLATES_SQL}) v(template_id, texto))
SELECT c_custkey, c.template_id, {_sql_replace('texto', _MSG_FIELDS_SQL)} AS mensaje
FROM c LEFT JOIN t ON c.template_id = t.template_id""")
def message_render(spark, sf):
    c = table(spark, sf, "customer")
    amount = F.col("c_acctbal").cast("decimal(12,2)")
    rows = c.select(
        "c_custkey",
        _case_spark(F.col("c_mktsegment"), TEMPLATE_BY_SEGMENT, None).alias("template_id"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("-")).alias("cuenta"),
        F.col("c_name").alias("nombre"),
        classify.decimal_comma(amount).alias("saldo_total"),
        classify.decimal_comma((amount * F.lit(0.6).cast("decimal(3,2)")).cast("decimal(16,4)")).alias("valor_pago"),
        _case_spark(F.col("c_mktsegment"), _CRM_BY_SEGMENT, "OTRO").alias("entidad"))
    t = campaign.template_table(spark, TEMPLATES)
    out = campaign.render_messages(rows, t, "template_id",
                                   {k: k for k in campaign.PLACEHOLDERS})
    return out.select("c_custkey", "template_id", "mensaje")


@register("send_window", """
SELECT event_type, (hour(ts) * 60 + minute(ts)) BETWEEN 480 AND 1139 AS elegible, count(*) AS n
FROM events GROUP BY ALL""")
def send_window(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type", campaign.in_send_window("ts").alias("elegible")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("contact_log_hourly", """
SELECT date_trunc('hour', ts) AS hora, CASE WHEN event_type = 'error' THEN 'Not sent' ELSE 'Sent' END AS estado,
       count(*) AS n
FROM events GROUP BY ALL""")
def contact_log_hourly(spark, sf):
    e = table(spark, sf, "events").select(
        "ts", F.when(F.col("event_type") == "error", "Not sent").otherwise("Sent").alias("estado"))
    return campaign.attempts_per_hour(e, "ts", ["estado"])


@register("latest_verdict", """
WITH v AS (
  SELECT user_id, arg_max(event_type, (ts, event_id)) AS ultimo_evento, max(ts) AS ts FROM events GROUP BY user_id)
SELECT c_custkey, ultimo_evento, ts AS fecha_verificacion,
       CASE WHEN ultimo_evento IS NULL THEN NULL WHEN ultimo_evento = 'purchase' THEN 'True' ELSE 'False' END AS canal_verificado
FROM customer LEFT JOIN v ON c_custkey = v.user_id""")
def latest_verdict(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts",
                                          F.col("event_type").alias("ultimo_evento"))
    v = campaign.latest_verdict(e, "user_id", "ultimo_evento", "ts", tie="event_id")
    c = table(spark, sf, "customer").select("c_custkey")
    j = c.join(v, c.c_custkey == v.user_id, "left")
    return j.select("c_custkey", "ultimo_evento", F.col("ts").alias("fecha_verificacion"),
                    F.when(F.col("ultimo_evento").isNull(), F.lit(None))
                    .when(F.col("ultimo_evento") == "purchase", "True").otherwise("False").alias("canal_verificado"))


# ------------------------------------------------------------ quality profile


@register("quality_profile", f"""
SELECT 'orders' AS tabla, count(*) AS filas, count(DISTINCT CAST(o_orderdate AS DATE)) AS fechas_distintas,
       count(*) FILTER (WHERE o_custkey IS NULL) AS claves_nulas, CAST(0 AS BIGINT) AS sin_mapear FROM orders
UNION ALL
SELECT 'lineitem', count(*), count(DISTINCT CAST(l_shipdate AS DATE)),
       count(*) FILTER (WHERE l_orderkey IS NULL), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) FROM lineitem
UNION ALL
SELECT 'events', count(*), count(DISTINCT CAST(ts AS DATE)), count(*) FILTER (WHERE user_id IS NULL),
       count(*) FILTER (WHERE {outcome_group_sql("replace(lower(" + outcome_text_sql() + "), ' ', '')")} IS NULL) FROM events
UNION ALL
SELECT 'customer', count(*), CAST(NULL AS BIGINT), count(*) FILTER (WHERE c_custkey IS NULL),
       count(*) FILTER (WHERE c_acctbal < 0) FROM customer""")
def quality_profile(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    e = table(spark, sf, "events")
    c = table(spark, sf, "customer")
    tipif = _case_spark(F.col("event_type"), OUTCOME_BY_EVENT, None)

    parts = [profile.source_profile(o, "orders", "o_custkey", "o_orderdate"),
             profile.source_profile(li, "lineitem", "l_orderkey", "l_shipdate", ~F.col("l_returnflag").isin("A", "N", "R")),
             profile.source_profile(e, "events", "user_id", "ts", outcomes.outcome_group(tipif).isNull()),
             profile.source_profile(c, "customer", "c_custkey", None, F.col("c_acctbal") < 0)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# texts of a due date (pending orders have an impossible one) that are no date

@register("unparsable_dates", """
SELECT '31/02/' || CAST(year(o_orderdate) AS VARCHAR) AS valor, count(*) AS filas
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""")
def unparsable_dates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderdate")
    due = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string"))) \
        .otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    return profile.unparsable_dates(o.select(due.alias("vencimiento")), "vencimiento")
