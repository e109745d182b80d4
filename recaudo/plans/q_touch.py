"""Catalog entries for touches (channel merge) and contact outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import outcomes, touches
from ..sources.tables import table
from .registry import register

# events as touch logs: four event types play the four channels
CHANNEL_BY_EVENT = [("click", "SMS"), ("view", "EMAIL"), ("signup", "BOT"), ("purchase", "IVR")]
# events as a contact report: event type -> outcome text as agents type it
OUTCOME_BY_EVENT = [("click", "Colgo"), ("view", "No Contestan"), ("signup", "Promesa Parcial"),
                    ("purchase", "Ya Pago"), ("error", "Error De Marcacion")]


def _touch_base(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return e.select(
        "event_type",
        F.concat(F.lit("1."), F.col("user_id").cast("string")).alias("cuenta_real"),
        F.concat(F.lit("1"), F.col("user_id").cast("string")).alias("cuenta_sin_punto"),
        # brand text in mixed case; 240 is outside the portfolio list
        F.when(k.isNull(), F.lit("Sin Marca"))
         .otherwise((F.floor(k / 12) * 30).cast("int").cast("string")).alias("marca"),
    )


def _channels(spark, sf):
    base = _touch_base(spark, sf)
    out = {}
    for ev, ch in CHANNEL_BY_EVENT:
        out[ch] = base.where(F.col("event_type") == ev) \
            .groupBy("cuenta_real", "cuenta_sin_punto", "marca") \
            .agg(F.count(F.lit(1)).cast("string").alias("cantidad"))
    return out


_BRANDS_SQL = ", ".join(f"'{b}'" for b in fixed.PORTFOLIO_BRANDS)
_TOUCH_SQL = f"""
WITH b AS (
  SELECT event_type, '1.' || CAST(user_id AS VARCHAR) AS cuenta_real, '1' || CAST(user_id AS VARCHAR) AS cuenta_sin_punto,
         CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'Sin Marca'
              ELSE CAST(CAST(floor(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) / 12) * 30 AS INTEGER) AS VARCHAR) END AS marca
  FROM events),
a AS (
  SELECT cuenta_real, cuenta_sin_punto, lower(marca) AS marca,
    {", ".join(f"CAST(count(*) FILTER (WHERE event_type = '{ev}') AS BIGINT) AS toques_{ch.lower()}" for ev, ch in CHANNEL_BY_EVENT)}
  FROM b WHERE event_type IN ({", ".join(f"'{ev}'" for ev, _ in CHANNEL_BY_EVENT)})
  GROUP BY cuenta_real, cuenta_sin_punto, lower(marca)),
k AS (
  SELECT *, row_number() OVER (PARTITION BY cuenta_sin_punto
     ORDER BY -({" + ".join(f"toques_{ch.lower()}" for _, ch in CHANNEL_BY_EVENT)}), marca, cuenta_real) AS rn
  FROM a WHERE marca IN ({_BRANDS_SQL}))
SELECT cuenta_real, cuenta_sin_punto, marca, {", ".join(f"toques_{ch.lower()}" for _, ch in CHANNEL_BY_EVENT)}
FROM k WHERE rn = 1
"""


@register("touch_consolidate", _TOUCH_SQL)
def touch_consolidate(spark, sf):
    return touches.merge_touches_outer_chain(_channels(spark, sf))


@register("touch_union_agg", _TOUCH_SQL)
def touch_union_agg(spark, sf):
    return touches.merge_touches(_channels(spark, sf))


def _report(spark, sf):
    e = table(spark, sf, "events")
    t = None
    for ev, txt in OUTCOME_BY_EVENT:
        t = F.when(F.col("event_type") == ev, F.lit(txt)) if t is None \
            else t.when(F.col("event_type") == ev, F.lit(txt))
    return e.select("event_id", F.col("user_id").alias("cuenta"), F.col("ts").alias("fecha_gestion"),
                    t.alias("tipificacion"))


def outcome_group_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{a}' THEN '{b}'" for a, b in fixed.OUTCOME_GROUPS.items()) + " END"


def outcome_text_sql(event_type: str = "event_type") -> str:
    return "CASE " + " ".join(f"WHEN {event_type} = '{a}' THEN '{b}'" for a, b in OUTCOME_BY_EVENT) + " END"


_OUT_MAP_SQL = outcome_group_sql("k")
_REPORT_SQL = """
WITH r AS (
  SELECT event_id, user_id AS cuenta, ts AS fecha_gestion,
    CASE """ + " ".join(f"WHEN event_type = '{a}' THEN '{b}'" for a, b in OUTCOME_BY_EVENT) + """ END AS tipificacion
  FROM events),
m AS (SELECT *, replace(lower(tipificacion), ' ', '') AS k FROM r),
g AS (SELECT *, """ + _OUT_MAP_SQL + """ AS grupo_tipificacion FROM m)
"""


@register("outcome_map", _REPORT_SQL + "SELECT event_id, k AS tipificacion_clean, grupo_tipificacion FROM g")
def outcome_map(spark, sf):
    r = _report(spark, sf)
    return r.select("event_id", outcomes.normalise_outcome("tipificacion").alias("tipificacion_clean"),
                    outcomes.outcome_group("tipificacion").alias("grupo_tipificacion"))


@register("outcome_rollup", _REPORT_SQL + """
SELECT cuenta, cantidad_contacto_directo, cantidad_contacto_indirecto, cantidad_nocontacto,
  concat_ws(' ', CASE WHEN cantidad_contacto_directo > 0 THEN 'CDIR' END,
                 CASE WHEN cantidad_contacto_indirecto > 0 THEN 'CIND' END,
                 CASE WHEN cantidad_nocontacto > 0 THEN 'NOC' END) AS filtro_reporte_gestion
FROM (SELECT cuenta,
        count(*) FILTER (WHERE grupo_tipificacion = 'CDIR') AS cantidad_contacto_directo,
        count(*) FILTER (WHERE grupo_tipificacion = 'CIND') AS cantidad_contacto_indirecto,
        count(*) FILTER (WHERE grupo_tipificacion = 'NOC') AS cantidad_nocontacto
      FROM g GROUP BY cuenta)""")
def outcome_rollup(spark, sf):
    r = _report(spark, sf).withColumn("grupo", outcomes.outcome_group("tipificacion"))
    return outcomes.outcome_rollup(r, "cuenta", "grupo")
