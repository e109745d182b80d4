"""Catalog entries for the monthly consolidation: department lookup,
arrears, left-chain consolidation (and its full-outer equivalent), extra
flags, exclusion flag, prefix renames, month backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands, classify, dates, fixed, keys
from ..operators import calendar, consolidate, geo, outcomes
from ..session import scratch_path
from ..sources.tables import table
from .registry import register
from .q_assignment import _CRM_BY_SEGMENT, _case_spark, _case_sql
from .q_touch import CHANNEL_BY_EVENT, OUTCOME_BY_EVENT

# ------------------------------------------------------------ departments
# City text of a customer: its nation name and region as "CITY/REGION";
# customers with a negative balance have no city (-> VACIO). The pattern
# dictionary is a query parameter (two ordered groups): it exercises
# last-match-wins (NATION_12 also contains NATION_1), a group-1 hit that is
# not a department (falls to group 2), and cities resolved by group 2 only.
CITY_PATTERNS = [
    (1, "NATION_1", "ANTIOQUIA", 1),
    (2, "NATION_2", "BOLIVAR", 1),
    (3, "NATION_12", "CALDAS", 1),
    (4, "ATION_2", "SIN DEPARTAMENTO", 1),
    (5, "TION_3", "CESAR", 1),
    (1, "NATION", "META", 2),
    (2, "_2", "HUILA", 2),
    (3, "NATION_24", "TOLIMA", 2),
    (4, "N_0", "NARINO", 2),
]


def _cities(spark, sf, keep=()):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = c.join(nr, c.c_nationkey == nr.n_nationkey, "left")
    city = F.when(F.col("c_acctbal") < 0, F.lit("")) \
        .otherwise(F.concat(F.lower("n_name"), F.lit("/"), F.col("r_name")))
    return j.select("c_custkey", *keep, city.alias("ciudad_raw"))


def _depts_ctes(patterns=CITY_PATTERNS) -> str:
    """CTEs ending in ``dept(c_custkey, ciudad, departamento)``."""
    vals = ", ".join(f"({o}, '{p}', '{d}', {g})" for o, p, d, g in patterns)
    depts = ", ".join(f"'{d}'" for d in fixed.DEPARTMENTS)
    return f"""
dc AS (
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE lower(n_name) || '/' || r_name END AS raw
  FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) nr
       ON c_nationkey = nr.n_nationkey),
dn AS (SELECT c_custkey, upper(split_part(CASE WHEN raw IS NULL OR raw = '' THEN 'VACIO' ELSE raw END, '/', 1)) AS ciudad FROM dc),
dp AS (SELECT * FROM (VALUES {vals}) t(ord, pattern, department, grp)),
dm AS (SELECT ciudad, grp, arg_max(department, ord) AS dept
       FROM (SELECT DISTINCT ciudad FROM dn) JOIN dp ON contains(ciudad, pattern) GROUP BY ciudad, grp),
dr AS (SELECT dn.c_custkey, dn.ciudad, coalesce(m1.dept, dn.ciudad) AS d1, coalesce(m2.dept, dn.ciudad) AS d2
       FROM dn LEFT JOIN dm m1 ON m1.ciudad = dn.ciudad AND m1.grp = 1
               LEFT JOIN dm m2 ON m2.ciudad = dn.ciudad AND m2.grp = 2),
dept AS (
  SELECT c_custkey, ciudad,
    CASE WHEN ciudad = 'VACIO' THEN 'VACIO' WHEN d1 IN ({depts}) THEN d1 WHEN d2 IN ({depts}) THEN d2
         ELSE 'NO IDENTIFICADO' END AS departamento
  FROM dr)"""


@register("substring_lookup", "WITH " + _depts_ctes() + " SELECT c_custkey, ciudad, departamento FROM dept")
def substring_lookup(spark, sf):
    pats = geo.pattern_table(spark, CITY_PATTERNS)
    out = geo.resolve_departments(_cities(spark, sf), "ciudad_raw", pats, out_city="ciudad")
    return out.select("c_custkey", "ciudad", "departamento")


# a dictionary of the size the reports use: every different part name with
# brand (over a thousand patterns from sf0.01 on) and every supplier, looked
# up in every part's text; Brand#2 stands in Brand#21, so the last one decides
@register("pattern_index_lookup", f"""
WITH p AS (
  SELECT max(p_partkey) AS ord, upper(p_name || ' ' || p_brand) AS pattern FROM part GROUP BY 2
  UNION ALL SELECT 100000000 + s_suppkey, upper(s_name) FROM supplier),
d AS (SELECT ord, pattern, {list(fixed.DEPARTMENTS)}[1 + ord % {len(fixed.DEPARTMENTS)}] AS department, 1 + ord % 2 AS grp FROM p),
t AS (SELECT p_partkey, upper(p_name || ' ' || p_brand || ' ' || p_type) AS texto FROM part),
m AS (SELECT texto, arg_max(department, ord) FILTER (grp = 1) AS d1, arg_max(department, ord) FILTER (grp = 2) AS d2, count(*) AS hallados
      FROM (SELECT DISTINCT texto FROM t) JOIN d ON contains(texto, pattern) GROUP BY 1)
SELECT p_partkey, texto, coalesce(hallados, 0) AS hallados, coalesce(d1, d2, 'NO IDENTIFICADO') AS departamento FROM t LEFT JOIN m USING (texto)""")
def pattern_index_lookup(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    named = part.groupBy(F.upper(F.concat_ws(" ", "p_name", "p_brand")).alias("pattern")).agg(F.max("p_partkey").alias("ord"))
    suppliers = table(spark, sf, "supplier").select(F.upper("s_name").alias("pattern"), (F.col("s_suppkey") + 100_000_000).alias("ord"))
    names = F.array(*[F.lit(d) for d in fixed.DEPARTMENTS])
    patterns = geo.PatternDictionary(named.unionByName(suppliers).select(
        F.col("ord").cast("int").alias("ord"), "pattern", F.get(names, (F.col("ord") % len(fixed.DEPARTMENTS)).cast("int")).alias("department"),
        (F.col("ord") % 2 + 1).cast("int").alias("grp")), lengths=[geo.GRAM])     # none is shorter than a trigram
    texts = part.select("p_partkey", F.upper(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("texto"))
    hits = geo.pattern_hits(texts.select("texto").distinct(), "texto", patterns)
    found = hits.groupBy(F.col("_city").alias("texto")).agg(
        *[F.max(F.when(F.col("grp") == g, F.struct("ord", "department")))["department"].alias(f"d{g}") for g in (1, 2)], F.count(F.lit(1)).alias("hallados"))
    return texts.join(found, "texto", "left").select("p_partkey", "texto", F.coalesce("hallados", F.lit(0).cast("bigint")).alias("hallados"),
                                                     F.coalesce("d1", "d2", F.lit(fixed.CITY_UNRESOLVED)).alias("departamento"))


# ------------------------------------------------------------ arrears
# entry date = ship date, due date = order date, both as d/M/yyyy text (as
# the source files carry them); pending orders carry an impossible due date.


@register("unidentified_cities", "WITH " + _depts_ctes(CITY_PATTERNS[:5]) + """
SELECT raw AS valor, count(*) AS filas FROM dept JOIN dc USING (c_custkey) WHERE departamento = 'NO IDENTIFICADO' GROUP BY 1""")
def unidentified_cities(spark, sf):
    from ..operators.profile import unidentified_cities as run
    return run(_cities(spark, sf), "ciudad_raw", geo.pattern_table(spark, CITY_PATTERNS[:5]))


def _arrears_band_sql(x: str) -> str:
    lo, hi, lab = fixed.ARREARS_BAND_LOW
    parts = [f"WHEN {x} <= {hi} AND {x} >= {lo} THEN '{lab}'"]
    parts += [f"WHEN {x} >= {a} AND {x} <= {b} THEN '{lab2}'" for a, b, lab2 in fixed.DAY_BANDS]
    lo, hi, lab = fixed.ARREARS_BAND_HIGH
    parts += [f"WHEN {x} >= {lo} AND {x} <= {hi} THEN '{lab}'", f"WHEN {x} IS NULL THEN '{fixed.ARREARS_BAND_NULL}'"]
    return "CASE " + " ".join(parts) + f" ELSE '{fixed.DAY_BAND_OUT}' END"


@register("arrears_days", f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%-d/%-m/%Y') AS fecha_ingreso,
         CASE WHEN o_orderstatus = 'P' THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
              ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS fecha_vencimiento
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (
  SELECT *, CAST(datediff('day', try_strptime(trim(fecha_vencimiento), '%d/%m/%Y'),
                                 try_strptime(trim(fecha_ingreso), '%d/%m/%Y')) AS INTEGER) AS dias_mora FROM t)
SELECT l_orderkey, l_linenumber, fecha_ingreso, fecha_vencimiento, dias_mora,
       {_arrears_band_sql('dias_mora')} AS rango_de_dias_mora
FROM d""")
def arrears_days(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    # the due date is written and read once an order, not once a line
    due = F.when(F.col("o_orderstatus") == "P",
                 F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string"))) \
        .otherwise(dates.format_dmy("o_orderdate"))
    o = o.select("o_orderkey", due.alias("fecha_vencimiento")) \
        .withColumn("_vence", dates.parse_dmy("fecha_vencimiento"))
    t = li.join(o, li.l_orderkey == o.o_orderkey) \
        .select("l_orderkey", "l_linenumber", dates.format_dmy("l_shipdate").alias("fecha_ingreso"),
                "fecha_vencimiento", "_vence") \
        .withColumn("dias_mora", F.datediff(dates.parse_dmy("fecha_ingreso"), "_vence")).drop("_vence")
    return t.withColumn("rango_de_dias_mora", bands.arrears_band("dias_mora"))


# ------------------------------------------------------------ consolidation
# Monthly consolidated table per (account, month). Sources:
#   base      orders -> calendar per (customer, month) + first order of the
#             month + month balance (ONE aggregate), customer attributes,
#             city -> department; brand from the portfolio rules
#   lineitem  per (customer, month): returns, discount, first ship date
#   events    per customer (all time): touches per channel, outcome rollup
#   lists     excluded accounts (negative balance), excluded documents
#             (nations of one region)
# Base filters: entry date not "Manual", brand not "Castigo".

EXCLUDED_REGION = "MIDDLE EAST"

FAMILIES = {
    fixed.PREFIX_BASE: ["cuenta_next", "marca_asignacion", "crm_origen", "ciudad",
                        "fecha_de_vencimiento", "saldo", "segmento_asignacion", "fecha_ingreso"],
    fixed.PREFIX_SCIENCE: ["rango_deuda", "departamento", "rango_de_dias_asignada", "dias_en_base",
                           "dias_asignada", "dias_retirada", "dias_mora", "rango_de_dias_mora",
                           "cantidad_contacto_directo", "cantidad_contacto_indirecto",
                           "cantidad_nocontacto", "filtro_reporte_gestion"],
    fixed.PREFIX_ADDED: ["estado_cuenta", "filtro_descuento", "filtro_pagos_sin_aplicar",
                         "exclusion_cuenta", "exclusion_documento", "toques_sms", "toques_email",
                         "toques_bot", "toques_ivr"],
}


def _consolidation_parts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                          "o_orderstatus", "o_orderpriority", "o_totalprice")
    cal = calendar.assignment_calendar(
        o, ["o_custkey"], "o_orderdate", attrs=["o_orderkey", "o_orderstatus", "o_orderpriority"],
        extra_aggs={"saldo": F.sum(bands.to_amount("o_totalprice")).cast("decimal(28,2)")},
        labels=None)
    # customer attributes in one pass: the nation/region dimension joins in
    # (tiny, broadcast by the planner), no second scan of customer
    cust = _cities(spark, sf, keep=["c_nationkey", "c_mktsegment"])
    cust = geo.resolve_departments(cust, "ciudad_raw", geo.pattern_table(spark, CITY_PATTERNS))
    cust = cust.select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "ciudad", "departamento",
        _case_spark(F.col("c_mktsegment"), _CRM_BY_SEGMENT, "OTRO").alias("crm_origen"),
        classify.segment((F.col("c_nationkey") + 70).cast("string")).alias("segmento_asignacion"))
    base = cal.join(cust, "o_custkey", "left")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    marca = classify.brand(
        F.when(pr == "1-URGENT", "Y").when(pr == "4-NOT SPECIFIED", F.lit(None)).otherwise("N"),
        F.when(pr == "2-HIGH", "Y").otherwise("N"),
        F.when((st == "P") & (pr == "5-LOW"), "Y").otherwise("N"),
        F.when(st == "F", "Y").otherwise("N"),
        F.col("crm_origen"),
        F.when(F.col("saldo") > 250000, "PrePotencial Convergente Masivo_2").otherwise("Otra"),
        (F.col("first_day") % 8 * 30).cast("string"))
    base = base.select(
        "o_custkey", F.col("month").alias("mes"), "c_nationkey",
        keys.account_key(F.col("o_custkey").cast("string")).alias("cuenta_next"),
        marca.alias("marca_asignacion"), "crm_origen", "ciudad", "departamento", "saldo",
        "segmento_asignacion", "fecha_ingreso", "estado_cuenta",
        bands.debt_band("saldo").alias("rango_deuda"),
        F.col("grupo_rango_de_dias").alias("rango_de_dias_asignada"),
        F.col("dias_asignada").alias("dias_en_base"),
        F.col("rango_de_dias").alias("dias_asignada"), "dias_retirada")
    base_filter = ~F.col("fecha_ingreso").contains("Manual") & \
        (F.col("marca_asignacion") != fixed.BRAND_CASTIGO)

    # lineitem is pre-aggregated per order BEFORE the join with orders: the
    # shuffle carries one row per order instead of one per line, and a hot
    # order collapses map-side
    li = table(spark, sf, "lineitem")
    ret = F.col("l_returnflag") == "R"
    per_order = li.groupBy("l_orderkey").agg(
        F.count_if(ret).alias("n_devoluciones"),
        F.max(F.when(ret, (F.col("l_discount") * 100).cast("decimal(5,2)"))).alias("pct"),
        F.min("l_shipdate").alias("primer_envio"))
    om = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("mes"))
    lside = per_order.join(om, per_order.l_orderkey == om.o_orderkey).groupBy("o_custkey", "mes").agg(
        F.sum("n_devoluciones").alias("n_devoluciones"), F.max("pct").alias("pct"),
        F.min("primer_envio").alias("primer_envio"))

    ev = table(spark, sf, "events").select("user_id", "event_type")
    outcome_txt = _case_spark(F.col("event_type"), OUTCOME_BY_EVENT, None)
    grp = outcomes.outcome_group(outcome_txt)
    eside = ev.groupBy(F.col("user_id").alias("o_custkey")).agg(
        *[F.count_if(F.col("event_type") == e).alias(f"toques_{ch.lower()}") for e, ch in CHANNEL_BY_EVENT],
        *[c.alias(n) for n, c in outcomes.outcome_counts(grp).items()]
    ).withColumn("filtro_reporte_gestion", outcomes.outcome_label())

    cust_all = table(spark, sf, "customer")
    excl_acc = cust_all.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region").where(F.col("r_name") == EXCLUDED_REGION)
    # small dimension-derived list: AQE broadcasts it from runtime statistics
    excl_doc = n.join(r, n.n_regionkey == r.r_regionkey, "left_semi") \
        .select(F.col("n_nationkey").alias("c_nationkey"))
    acc_marks = excl_acc.dropDuplicates(["o_custkey"]).withColumn("exclusion_cuenta", F.lit(fixed.LIST_FLAG))
    doc_marks = excl_doc.dropDuplicates(["c_nationkey"]).withColumn("exclusion_documento",
                                                                   F.lit(fixed.LIST_FLAG))
    sides = [(lside, ["o_custkey", "mes"]), (eside, ["o_custkey"]), (acc_marks, ["o_custkey"]),
             (doc_marks, ["c_nationkey"])]
    return base, base_filter, sides


def _finish(df):
    venc = dates.format_dmy("primer_envio")
    d, band = dates.arrears("fecha_ingreso", venc)
    out = df.select(
        "*", venc.alias("fecha_de_vencimiento"), d.alias("dias_mora"), band.alias("rango_de_dias_mora"),
        classify.discount_filter("pct").alias("filtro_descuento"),
        bands.count_flag("n_devoluciones").alias("filtro_pagos_sin_aplicar"))
    return consolidate.prefix_families(out, FAMILIES, keep=["mes"])


def _consolidation_sql() -> str:
    from .q_assignment import _debt_band_sql, day_band_sql
    from .q_touch import _OUT_MAP_SQL
    brand = """
  CASE WHEN b IN ('120', '150', '180') THEN '120 - 180'
       WHEN b = 'Prepotencial' AND crm_origen = 'BSCS' AND campaign IN
            ('PrePotencial Convergente Masivo_2', 'PrePotencial Convergente Pyme_2')
       THEN 'Prepotencial Especial' ELSE b END"""
    outcome_case = "CASE " + " ".join(f"WHEN event_type = '{a}' THEN '{b}'" for a, b in OUTCOME_BY_EVENT) + " END"
    touches_sql = ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS toques_{ch.lower()}"
                            for e, ch in CHANNEL_BY_EVENT)
    cols = ["mes"]
    for prefix, names in FAMILIES.items():
        cols += [f"{n} AS {prefix}{n}" for n in names]
    return "WITH " + _depts_ctes() + f""",
o AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, CAST(dayofmonth(o_orderdate) AS INTEGER) AS d
  FROM orders),
agg AS (
  SELECT o_custkey, mes, bit_or(CAST(1 AS BIGINT) << (d - 1)) AS day_mask, min(d) AS first_day, max(d) AS last_day,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS saldo
  FROM o GROUP BY o_custkey, mes),
fr AS (
  SELECT o_custkey, mes, o_orderstatus, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, mes ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM o)
  WHERE rn = 1),
mm AS (SELECT mes, max(d) AS month_last_day FROM o GROUP BY mes),
cal AS (
  SELECT a.*, fr.o_orderstatus, fr.o_orderpriority, mm.month_last_day,
         CAST(bit_count(a.day_mask) AS INTEGER) AS asg,
         CAST(a.last_day - a.first_day + 1 - bit_count(a.day_mask)
              + CASE WHEN a.last_day < mm.month_last_day THEN 1 ELSE 0 END AS INTEGER) AS ret
  FROM agg a JOIN fr USING (o_custkey, mes) LEFT JOIN mm USING (mes)),
cust AS (
  SELECT c_custkey AS o_custkey, c_nationkey, dept.ciudad, dept.departamento,
         {_case_sql('c_mktsegment', _CRM_BY_SEGMENT, 'OTRO')} AS crm_origen,
         CASE WHEN CAST(c_nationkey + 70 AS VARCHAR) IN ('81', '84', '87') THEN 'Personas' ELSE 'Negocios' END AS segmento_asignacion
  FROM customer LEFT JOIN dept USING (c_custkey)),
b0 AS (
  SELECT cal.*, cust.c_nationkey, cust.ciudad, cust.departamento, cust.crm_origen, cust.segmento_asignacion,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'N' END AS m5,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS m6,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Y' ELSE 'N' END AS m7,
    CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS m43,
    CASE WHEN saldo > 250000 THEN 'PrePotencial Convergente Masivo_2' ELSE 'Otra' END AS campaign,
    CAST(first_day % 8 * 30 AS VARCHAR) AS debt_age
  FROM cal LEFT JOIN cust USING (o_custkey)),
b1 AS (
  SELECT *,
  CASE WHEN m5 = 'Y' AND crm_origen = 'BSCS' THEN 'Potencial'
       WHEN m5 = 'Y' AND crm_origen IN ('RR', 'SGA') THEN 'Churn'
       WHEN m5 = 'Y' AND crm_origen = 'ASCARD' THEN 'Provision'
       WHEN m6 = 'Y' AND crm_origen = 'BSCS' THEN 'Prepotencial'
       WHEN m6 = 'Y' AND crm_origen IN ('RR', 'SGA') THEN 'Prechurn'
       WHEN m6 = 'Y' AND crm_origen = 'ASCARD' THEN 'Preprovision'
       WHEN m7 = 'Y' THEN 'Castigo'
       WHEN m5 = 'N' AND m6 = 'N' AND m7 = 'N' AND m43 = 'Y' THEN 'Potencial a Castigar'
       ELSE debt_age END AS b FROM b0),
base AS (
  SELECT o_custkey, mes, c_nationkey, CAST(o_custkey AS VARCHAR) || '-' AS cuenta_next,
    {brand} AS marca_asignacion, crm_origen, ciudad, departamento, saldo, segmento_asignacion,
    CAST(first_day AS VARCHAR) || '/' || strftime(mes, '%-m/%Y') AS fecha_ingreso,
    CASE WHEN last_day < month_last_day THEN 'Recuperada' ELSE 'En gestion' END AS estado_cuenta,
    {_debt_band_sql('saldo')} AS rango_deuda,
    {day_band_sql('asg + ret')} AS rango_de_dias_asignada,
    asg AS dias_en_base, asg + ret AS dias_asignada, ret AS dias_retirada
  FROM b1),
lside AS (
  SELECT o.o_custkey, o.mes, count(*) FILTER (WHERE l_returnflag = 'R') AS n_devoluciones,
         max(CASE WHEN l_returnflag = 'R' THEN CAST(l_discount * 100 AS DECIMAL(5,2)) END) AS pct,
         min(l_shipdate) AS primer_envio
  FROM lineitem JOIN o ON l_orderkey = o.o_orderkey GROUP BY o.o_custkey, o.mes),
ev AS (SELECT user_id, event_type, replace(lower({outcome_case}), ' ', '') AS k FROM events),
eside0 AS (
  SELECT user_id AS o_custkey, {touches_sql},
    count(*) FILTER (WHERE {_OUT_MAP_SQL} = 'CDIR') AS cantidad_contacto_directo,
    count(*) FILTER (WHERE {_OUT_MAP_SQL} = 'CIND') AS cantidad_contacto_indirecto,
    count(*) FILTER (WHERE {_OUT_MAP_SQL} = 'NOC') AS cantidad_nocontacto
  FROM ev GROUP BY user_id),
eside AS (
  SELECT *, concat_ws(' ', CASE WHEN cantidad_contacto_directo > 0 THEN 'CDIR' END,
                           CASE WHEN cantidad_contacto_indirecto > 0 THEN 'CIND' END,
                           CASE WHEN cantidad_nocontacto > 0 THEN 'NOC' END) AS filtro_reporte_gestion
  FROM eside0),
excl_acc AS (SELECT DISTINCT c_custkey AS o_custkey, 'APLICA' AS exclusion_cuenta FROM customer WHERE c_acctbal < 0),
excl_doc AS (
  SELECT DISTINCT n_nationkey AS c_nationkey, 'APLICA' AS exclusion_documento FROM nation
  WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = '{EXCLUDED_REGION}')),
j AS (
  SELECT * FROM base
    LEFT JOIN lside USING (o_custkey, mes)
    LEFT JOIN eside USING (o_custkey)
    LEFT JOIN excl_acc USING (o_custkey)
    LEFT JOIN excl_doc USING (c_nationkey)
  WHERE NOT contains(fecha_ingreso, 'Manual') AND marca_asignacion <> 'Castigo'),
f AS (
  SELECT *, strftime(primer_envio, '%-d/%-m/%Y') AS fecha_de_vencimiento,
    CAST(datediff('day', try_strptime(strftime(primer_envio, '%-d/%-m/%Y'), '%d/%m/%Y'),
                         try_strptime(trim(fecha_ingreso), '%d/%m/%Y')) AS INTEGER) AS dias_mora,
    CASE WHEN coalesce(pct, 0) = 0 THEN 'No Aplica' ELSE 'Aplica' END AS filtro_descuento,
    CASE WHEN n_devoluciones >= 1 THEN 'Aplica' ELSE '' END AS filtro_pagos_sin_aplicar
  FROM j),
g AS (SELECT *, {_arrears_band_sql('dias_mora')} AS rango_de_dias_mora FROM f)
SELECT {', '.join(cols)} FROM g"""


@register("consolidate_left", _consolidation_sql())
def consolidate_left(spark, sf):
    base, flt, sides = _consolidation_parts(spark, sf)
    return _finish(consolidate.consolidate(base, flt, sides))


@register("consolidate_full_outer_filtered", _consolidation_sql())
def consolidate_full_outer_filtered(spark, sf):
    base, flt, sides = _consolidation_parts(spark, sf)
    return _finish(consolidate.consolidate_full_outer(base, flt, sides, "cuenta_next"))


# ------------------------------------------------------------ monthly pipeline
# The eleven monthly sources of plans.monthly derived from the driver tables
# (month = order month; account text = custkey followed by custkey % 7, so
# that the assignment table's account key matches):
#   base        per (customer, month) from orders: brand from the month's
#               order statuses, billing system, city, due and entry dates
#               (entry "Manual" for months whose orders are all low priority)
#   assignment  the whole assignment-base pipeline (assignment_table)
#   contacts    contact table from the documents (doc_id as customer), month
#               of the customer's first order
#   touches, report   events per user (user as customer), same month rule
#   queues      lines with return flag A; ranking: orders per month
#   exclusions  documents of one region, accounts with negative balance
#   counts      returned lines (unapplied payments), pending orders


def _monthly_sources(spark, sf):
    from .assignment import assignment_base
    from .contact_plan import contact_table
    from .monthly import MonthlySources
    from .q_assignment import _raw_assignment
    o = table(spark, sf, "orders")
    cust = table(spark, sf, "customer")
    mes = F.date_format(F.trunc(F.to_date("o_orderdate"), "month"), "yyyy-MM")

    def acc(c):
        return F.concat(F.col(c).cast("string"), (F.col(c) % 7).cast("string"))

    cities = _cities(spark, sf, keep=["c_mktsegment"])
    base = o.groupBy("o_custkey", mes.alias("mes")).agg(
        F.min("o_orderstatus").alias("_st"), F.min("o_orderpriority").alias("_pr"),
        F.min(F.to_date("o_orderdate")).alias("_d"))
    base = base.join(cities, base.o_custkey == cities.c_custkey, "left").select(
        acc("o_custkey").alias("CUENTA_NEXT"), "mes",
        F.when(F.col("_st") == "F", "Potencial").when(F.col("_st") == "O", "Churn")
         .otherwise(fixed.BRAND_CASTIGO).alias("Marca"),
        _case_spark(F.col("c_mktsegment"), _CRM_BY_SEGMENT, "OTRO").alias("CRM Origen"),
        F.col("ciudad_raw").alias("Ciudad"),
        dates.format_dmy(F.date_add("_d", 30)).alias("Fecha de Vencimiento"),
        F.when(F.col("_pr") == "5-LOW", F.lit("Manual")).otherwise(dates.format_dmy("_d")).alias("FECHA INGRESO"))

    asg = assignment_base(*_raw_assignment(spark, sf))
    asg = asg.withColumn("mes", F.concat_ws("-", "PERIODO DE ASIGNACION",
                                            F.lpad("MES DE ASIGNACION", 2, "0")))

    first_month = o.groupBy(F.col("o_custkey").alias("_k")).agg(F.min(mes).alias("mes"))
    docs = table(spark, sf, "documents")
    # two documents make one account: their contacts meet in its slots
    pair = F.col("doc_id") - F.col("doc_id") % 2
    clist = docs.select(F.col("doc_id").cast("string").alias("identificacion"),
                        F.concat(pair.cast("string"), (pair % 7).cast("string")).alias("cuenta"), "text")
    from ..operators.contacts import extract_contacts
    clist = extract_contacts(clist, "text", ["identificacion", "cuenta"])
    from .q_contacts import DOC_LANDLINE, DOC_MOBILE
    ct = contact_table(clist, 0, 0, DOC_MOBILE, DOC_LANDLINE, mobile_count=DOC_MOBILE,
                       landline_count=DOC_LANDLINE).drop("MES DE ASIGNACION", "PERIODO DE ASIGNACION")
    ct = ct.join(docs.select(pair.alias("_k")).distinct().withColumn("_c", acc("_k")),
                 F.col("cuenta") == F.concat(F.col("_c"), F.lit("-")), "left") \
        .join(first_month, "_k", "left").drop("_k", "_c")

    ev = table(spark, sf, "events").join(first_month, F.col("user_id") == F.col("_k"))
    touches = ev.groupBy(F.concat(F.col("user_id").cast("string"), F.lit("."),
                                  (F.col("user_id") % 7).cast("string")).alias("Cuenta_Real"), "mes").agg(
        *[F.count_if(F.col("event_type") == e).cast("string").alias(f"Toques por {ch}")
          for e, ch in CHANNEL_BY_EVENT])
    report = ev.select(F.concat(F.col("user_id").cast("string"), F.lit("."),
                                (F.col("user_id") % 7).cast("string")).alias(" Cuenta "),
                       F.date_format("ts", "d/M/yyyy").alias("fecha_gestion"),
                       _case_spark(F.col("event_type"), OUTCOME_BY_EVENT, None).alias("tipificacion "), "mes")

    li = table(spark, sf, "lineitem")
    lo = li.join(o.select("o_orderkey", "o_custkey", mes.alias("mes")), li.l_orderkey == o.o_orderkey)
    queues = lo.where(F.col("l_returnflag") == "A").select(
        acc("o_custkey").alias("Cuenta"), dates.format_dmy("l_shipdate").alias("Fecha"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("Valor"),
        F.col("l_orderkey").cast("string").alias("Referencia"), "mes")
    ranking = o.groupBy(acc("o_custkey").alias("CUENTA"), mes.alias("mes")).agg(
        F.count(F.lit(1)).cast("string").alias("SERVICIOS"),
        F.when(F.count_if(F.col("o_orderstatus") == "O") > 0, "ACTIVO").otherwise("INACTIVO").alias("ESTADO"))
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region").where(F.col("r_name") == EXCLUDED_REGION)
    region_nations = n.join(r, n.n_regionkey == r.r_regionkey, "left_semi").select("n_nationkey")
    months_of = o.select(F.col("o_custkey").alias("_k"), mes.alias("mes")).distinct()
    exc_doc = cust.join(region_nations, cust.c_nationkey == region_nations.n_nationkey, "left_semi") \
        .join(months_of, F.col("c_custkey") == F.col("_k")) \
        .select(F.col("c_custkey").cast("string").alias("DOCUMENTO"), "mes")
    exc_acc = cust.where(F.col("c_acctbal") < 0).join(months_of, F.col("c_custkey") == F.col("_k")) \
        .select(acc("c_custkey").alias("CUENTA"), "mes")
    psa = lo.where(F.col("l_returnflag") == "R").groupBy(acc("o_custkey").alias("CUENTA"), "mes") \
        .agg(F.count(F.lit(1)).cast("string").alias("RECUENTO"))
    ng = o.where(F.col("o_orderstatus") == "P").groupBy(acc("o_custkey").alias("CUENTA"), mes.alias("mes")) \
        .agg(F.count(F.lit(1)).cast("string").alias("RECUENTO"))
    return MonthlySources(base, asg, ct, touches, queues, ranking, exc_doc, exc_acc, psa, ng, report)


def _monthly_sql() -> str:
    """DuckDB twin of monthly_consolidation (same derived sources, same
    chain, same column catalogue)."""
    from .monthly import ADDED, FINAL, SCIENCE, SLOT_COLUMNS
    from .q_assignment import _assignment_sql, day_band_sql
    from .q_contacts import DOC_LANDLINE, DOC_MOBILE, PHONES, EMAILS
    from .q_touch import outcome_group_sql
    from ..functions.text import snake
    from ..operators import contacts
    asg_sql = _assignment_sql()
    asg_ctes = asg_sql[asg_sql.index("WITH") + 4:asg_sql.rindex("SELECT")].strip().rstrip(",")
    asg_final = asg_sql[asg_sql.rindex("SELECT"):]
    acc = lambda c: f"(CAST({c} AS VARCHAR) || CAST({c} % 7 AS VARCHAR))"
    mes = "strftime(o_orderdate, '%Y-%m')"
    depts = ", ".join(f"'{d}'" for d in fixed.DEPARTMENTS)
    vals = ", ".join(f"({o}, '{p}', '{d}', {g})" for o, p, d, g in CITY_PATTERNS)
    n = "TRY_CAST(trim(dato) AS BIGINT)"
    slot_cols = [f"max(CASE WHEN grp = 'phone' AND slot = {i} THEN dato END) AS phone{i}" for i in range(1, PHONES + 1)]
    slot_cols += [f"max(CASE WHEN grp = 'email' AND slot = {i} THEN dato END) AS email{i}" for i in range(1, EMAILS + 1)]
    slot_cols += [
        f"CAST(count(*) FILTER (WHERE grp = 'phone' AND slot <= {PHONES} AND {n} BETWEEN {DOC_MOBILE[0]} AND {DOC_MOBILE[1]}) AS INTEGER) AS nm",
        f"CAST(count(*) FILTER (WHERE grp = 'phone' AND slot <= {PHONES} AND {n} BETWEEN {DOC_LANDLINE[0]} AND {DOC_LANDLINE[1]}) AS INTEGER) AS nf",
        f"CAST(count(*) FILTER (WHERE grp = 'email' AND slot <= {EMAILS} AND contains(dato, '@')) AS INTEGER) AS ne"]
    profile = """CASE WHEN nm > 0 AND nf > 0 AND ne > 0 THEN 'Celular Fijo Email'
       WHEN nm > 0 AND nf > 0 THEN 'Celular Fijo' WHEN nm > 0 AND ne > 0 THEN 'Celular Email'
       WHEN nm > 0 THEN 'Celular' WHEN nf > 0 AND ne > 0 THEN 'Fijo Email' WHEN nf > 0 THEN 'Fijo'
       WHEN ne > 0 THEN 'Email' ELSE 'No posee Demograficos' END"""
    touch_cols = ", ".join(f"CAST(count(*) FILTER (WHERE event_type = '{e}') AS VARCHAR) AS \"Toques por {ch}\""
                           for e, ch in CHANNEL_BY_EVENT)
    outcome_txt = "CASE " + " ".join(f"WHEN event_type = '{a}' THEN '{b}'" for a, b in OUTCOME_BY_EVENT) + " END"
    grp = outcome_group_sql(f"replace(lower({outcome_txt}), ' ', '')")
    # output catalogue
    base_cols = {"CUENTA_NEXT": "m_chain.CUENTA_NEXT", "MARCA_ASIGNACION": "Marca", "CRM_ORIGEN": '"CRM Origen"',
                 "Ciudad": "Ciudad", "Fecha de Vencimiento": '"Fecha de Vencimiento"',
                 "FECHA INGRESO": '"FECHA INGRESO"'}
    science = {
        "NOMBRE_CAMPANA": '"MARCA DATA"', "CRM": '"CRM"', "MULTIPRODUCTO": '"MULTIPRODUCTO"',
        "MULTIMORA": '"MULTIMORA"', "MULTICUENTA": '"MULTICUENTA"', "RANGO_DEUDA": '"RANGO DEUDA"',
        "RANGO CON DESCUENTO": '"RANGO CON DESCUENTO"', "TIPO_DE_DOCUMENTO": '"TIPO DE DOCUMENTO"',
        "DEPARTAMENTO": "DEPARTAMENTO", "RANGO_DE_DIAS_ASIGNADA": '"GRUPO RANGO DE DIAS"',
        "RANGO_DE_DIAS_EN_BASE": day_band_sql('TRY_CAST("DIAS ASIGNADA" AS INTEGER)'),
        "RANGO_DE_DIAS_RETIRADA": day_band_sql('TRY_CAST("DIAS RETIRADA" AS INTEGER)'),
        "RANGO_DE_DIAS_MORA": _arrears_band_sql("dias_mora"),
        "FILTRO_REPORTE_GESTION": "FILTRO_REPORTE_GESTION", "FILTRO_REFERENCIA": '"FILTRO REFERENCIA"',
        "FILTRO_DEMOGRAFICOS": '"Filtro Demografico"',
        "CANTIDAD_DEMOGRAFICOS": "coalesce(TRY_CAST(NumMovil AS INTEGER), 0) + coalesce(TRY_CAST(NumFijo AS INTEGER), 0)"
                                 " + coalesce(TRY_CAST(NumEmail AS INTEGER), 0)",
        "CANTIDAD_MOVILES": "NumMovil", "CANTIDAD_FIJOS": "NumFijo", "CANTIDAD_EMAILS": "NumEmail",
        "CANTIDAD_CONTACTO_DIRECTO": "CANTIDAD_CONTACTO_DIRECTO",
        "CANTIDAD_CONTACTO_INDIRECTO": "CANTIDAD_CONTACTO_INDIRECTO", "CANTIDAD_NOCONTACTO": "CANTIDAD_NOCONTACTO",
        "CUSTOMER_TYPE": '"CUSTOMER TYPE"', "DIAS_ASIGNADA": '"RANGO DE DIAS"', "DIAS_EN_BASE": '"DIAS ASIGNADA"',
        "DIAS_RETIRADA": '"DIAS RETIRADA"', "DIAS_MORA": "dias_mora"}
    added = {
        "ESTADO CUENTA": '"ESTADO CUENTA"',
        "FILTRO DESCUENTO": """CASE WHEN coalesce(TRY_CAST("PORCENTAJE" AS DECIMAL(12,8)), 0) = 0 THEN 'No Aplica' ELSE 'Aplica' END""",
        "FILTRO_PAGOS_SIN_APLICAR": """CASE WHEN TRY_CAST("RECUENTO PAGOS SIN APLICAR" AS BIGINT) >= 1 THEN 'Aplica' ELSE '' END""",
        "FILTRO_PAGOS_NO_GESTION": """CASE WHEN TRY_CAST("RECUENTO NO GESTION" AS BIGINT) >= 1 THEN 'Aplica' ELSE '' END""",
        "EXCLUSION CUENTA": '"EXCLUSION CUENTA"', "EXCLUSION DOCUMENTO": '"EXCLUSION DOCUMENTO"',
        "ESTADO RANKING": '"ESTADO RANKING"', "SERVICIOS RANKING": '"SERVICIOS RANKING"',
        "RECUENTO PAGOS SIN APLICAR": '"RECUENTO PAGOS SIN APLICAR"', "RECUENTO NO GESTION": '"RECUENTO NO GESTION"',
        "FILTRO COLAS": '"FILTRO COLAS"'}
    added.update({f"Toques por {ch}": f'"Toques por {ch}"' for ch in fixed.TOUCH_CHANNELS})
    assert set(science) == set(SCIENCE) and set(added) == set(ADDED)
    sel = ["m_chain.mes AS mes"] + [f'"{c}" AS "{c}"' for c in FINAL]
    sel += [f'{e} AS "{fixed.PREFIX_BASE}{snake(c)}"' for c, e in base_cols.items()]
    sel += [f'{e} AS "{fixed.PREFIX_SCIENCE}{snake(c)}"' for c, e in science.items()]
    sel += [f'{e} AS "{fixed.PREFIX_ADDED}{snake(c)}"' for c, e in added.items()]
    sel += [f'"{c}" AS "{fixed.PREFIX_SLOTS}{snake(c)}"' for c in SLOT_COLUMNS]
    return f"""WITH {asg_ctes},
asg AS ({asg_final}),
m_first AS (SELECT o_custkey AS k, min({mes}) AS mes FROM orders GROUP BY o_custkey),
m_city AS (
  SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN '' ELSE lower(n_name) || '/' || r_name END AS ciudad_raw
  FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) nr
       ON c_nationkey = nr.n_nationkey),
m_base0 AS (
  SELECT o_custkey, {mes} AS mes, min(o_orderstatus) AS st, min(o_orderpriority) AS pr,
         min(CAST(o_orderdate AS DATE)) AS d
  FROM orders GROUP BY o_custkey, {mes}),
m_base AS (
  SELECT {acc('o_custkey')} || '-' AS CUENTA_NEXT, mes,
    CASE WHEN st = 'F' THEN 'Potencial' WHEN st = 'O' THEN 'Churn' ELSE 'Castigo' END AS Marca,
    {_case_sql('c_mktsegment', _CRM_BY_SEGMENT, 'OTRO')} AS "CRM Origen",
    ciudad_raw AS Ciudad,
    strftime(d + INTERVAL 30 DAY, '%-d/%-m/%Y') AS "Fecha de Vencimiento",
    CASE WHEN pr = '5-LOW' THEN 'Manual' ELSE strftime(d, '%-d/%-m/%Y') END AS "FECHA INGRESO"
  FROM m_base0 LEFT JOIN m_city ON o_custkey = c_custkey),
m_base_f AS (SELECT * FROM m_base WHERE NOT contains("FECHA INGRESO", 'Manual') AND Marca <> 'Castigo'),
m_data AS (
  SELECT * EXCLUDE (rn, "MES DE ASIGNACION", "PERIODO DE ASIGNACION", "MARCA", "FECHA INGRESO", "FECHA RETIRO"),
         "MARCA" AS "MARCA DATA", "FECHA INGRESO" AS "FECHA INGRESO DATA", "FECHA RETIRO" AS "FECHA RETIRO DATA"
  FROM (SELECT *, "PERIODO DE ASIGNACION" || '-' || lpad("MES DE ASIGNACION", 2, '0') AS mes,
               row_number() OVER (PARTITION BY "CUENTA_NEXT", "PERIODO DE ASIGNACION" || '-' || lpad("MES DE ASIGNACION", 2, '0')
                                  ORDER BY "CUENTA" NULLS FIRST) AS rn FROM asg) WHERE rn = 1),
m_src AS (SELECT {acc('(doc_id - doc_id % 2)')} AS cuenta0, doc_id, text FROM documents),
m_ex AS (
  SELECT regexp_replace(cuenta0, '-', '', 'g') || '-' AS cuenta, doc_id, trim(dato) AS dato FROM (
    SELECT cuenta0, doc_id, unnest(list_concat(
        regexp_extract_all(text, '{contacts.EMAIL_PATTERN}'),
        list_transform(regexp_extract_all(text, '{contacts.PHONE_PATTERN}'),
                       lambda p: regexp_replace(p, '[^0-9]', '', 'g')))) AS dato
    FROM m_src)),
m_cl AS (
  SELECT *, CASE WHEN TRY_CAST(trim(dato) AS BIGINT) BETWEEN {DOC_MOBILE[0]} AND {DOC_MOBILE[1]} THEN 'mobile'
                 WHEN TRY_CAST(trim(dato) AS BIGINT) BETWEEN {DOC_LANDLINE[0]} AND {DOC_LANDLINE[1]} THEN 'landline'
                 WHEN contains(dato, '@') THEN 'email' END AS kind
  FROM m_ex),
m_slots AS (
  SELECT cuenta, {', '.join(slot_cols)}
  FROM (SELECT cuenta, grp, dato,
               row_number() OVER (PARTITION BY cuenta, grp ORDER BY dato) AS slot
        FROM (SELECT DISTINCT cuenta, CASE WHEN kind = 'email' THEN 'email' ELSE 'phone' END AS grp, dato
              FROM m_cl WHERE kind IS NOT NULL AND dato IS NOT NULL))
  WHERE slot <= {max(PHONES, EMAILS)} GROUP BY cuenta),
m_contacts AS (
  SELECT s.cuenta AS CUENTA_NEXT, f.mes,
    CASE WHEN coalesce(nm, 0) = 0 THEN '' ELSE CAST(nm AS VARCHAR) END AS NumMovil,
    CASE WHEN coalesce(nf, 0) = 0 THEN '' ELSE CAST(nf AS VARCHAR) END AS NumFijo,
    CASE WHEN coalesce(ne, 0) = 0 THEN '' ELSE CAST(ne AS VARCHAR) END AS NumEmail,
    {profile} AS "Filtro Demografico",
    {', '.join(f's.phone{i}' for i in range(1, PHONES + 1))}, {', '.join(f's.email{i}' for i in range(1, EMAILS + 1))}
  FROM m_slots s LEFT JOIN (SELECT DISTINCT {acc('(doc_id - doc_id % 2)')} || '-' AS c, doc_id - doc_id % 2 AS k FROM documents) dd ON s.cuenta = dd.c
  LEFT JOIN m_first f ON dd.k = f.k),
m_demo AS (SELECT * FROM m_contacts),
m_ev AS (SELECT e.*, f.mes FROM events e JOIN m_first f ON e.user_id = f.k),
m_touch0 AS (
  SELECT CAST(user_id AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) AS Cuenta_Real, mes, {touch_cols}
  FROM m_ev GROUP BY 1, mes),
m_touch AS (
  SELECT regexp_replace(Cuenta_Real, '\\.', '', 'g') || '-' AS CUENTA_NEXT, mes,
    {', '.join(f'CAST(sum(TRY_CAST("Toques por {ch}" AS BIGINT)) AS BIGINT) AS "Toques por {ch}"' for ch in fixed.TOUCH_CHANNELS)}
  FROM m_touch0 GROUP BY 1, mes),
m_report AS (
  SELECT CUENTA_NEXT, mes, CANTIDAD_CONTACTO_DIRECTO, CANTIDAD_CONTACTO_INDIRECTO, CANTIDAD_NOCONTACTO,
    concat_ws(' ', CASE WHEN CANTIDAD_CONTACTO_DIRECTO > 0 THEN 'CDIR' END,
                   CASE WHEN CANTIDAD_CONTACTO_INDIRECTO > 0 THEN 'CIND' END,
                   CASE WHEN CANTIDAD_NOCONTACTO > 0 THEN 'NOC' END) AS FILTRO_REPORTE_GESTION
  FROM (SELECT CAST(user_id AS VARCHAR) || CAST(user_id % 7 AS VARCHAR) || '-' AS CUENTA_NEXT, mes,
          count(*) FILTER (WHERE {grp} = 'CDIR') AS CANTIDAD_CONTACTO_DIRECTO,
          count(*) FILTER (WHERE {grp} = 'CIND') AS CANTIDAD_CONTACTO_INDIRECTO,
          count(*) FILTER (WHERE {grp} = 'NOC') AS CANTIDAD_NOCONTACTO
        FROM m_ev GROUP BY 1, mes)),
m_lo AS (SELECT l.*, o.o_custkey, {mes} AS mes FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey),
m_queues AS (SELECT DISTINCT {acc('o_custkey')} || '-' AS CUENTA_NEXT, mes, 'APLICA' AS "FILTRO COLAS"
             FROM m_lo WHERE l_returnflag = 'A'),
m_ranking AS (
  SELECT {acc('o_custkey')} || '-' AS CUENTA_NEXT, {mes} AS mes, CAST(count(*) AS VARCHAR) AS "SERVICIOS RANKING",
         CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O') > 0 THEN 'ACTIVO' ELSE 'INACTIVO' END AS "ESTADO RANKING"
  FROM orders GROUP BY 1, 2),
m_months AS (SELECT DISTINCT o_custkey AS k, {mes} AS mes FROM orders),
m_exc_doc AS (
  SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS "DOCUMENTO", mes, 'APLICA' AS "EXCLUSION DOCUMENTO"
  FROM customer JOIN m_months ON c_custkey = k
  WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                        WHERE r_name = '{EXCLUDED_REGION}')),
m_exc_acc AS (
  SELECT DISTINCT {acc('c_custkey')} || '-' AS CUENTA_NEXT, mes, 'APLICA' AS "EXCLUSION CUENTA"
  FROM customer JOIN m_months ON c_custkey = k WHERE c_acctbal < 0),
m_psa AS (SELECT {acc('o_custkey')} || '-' AS CUENTA_NEXT, mes, CAST(count(*) AS BIGINT) AS "RECUENTO PAGOS SIN APLICAR"
          FROM m_lo WHERE l_returnflag = 'R' GROUP BY 1, 2),
m_ng AS (SELECT {acc('o_custkey')} || '-' AS CUENTA_NEXT, {mes} AS mes, CAST(count(*) AS BIGINT) AS "RECUENTO NO GESTION"
         FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2),
m_pats AS (SELECT * FROM (VALUES {vals}) t(ord, pattern, department, grp)),
m_chain AS (
  SELECT b.*, d.* EXCLUDE (CUENTA_NEXT, mes), c.* EXCLUDE (CUENTA_NEXT, mes), t.* EXCLUDE (CUENTA_NEXT, mes),
         q."FILTRO COLAS", r."SERVICIOS RANKING", r."ESTADO RANKING", xa."EXCLUSION CUENTA", xd."EXCLUSION DOCUMENTO",
         p."RECUENTO PAGOS SIN APLICAR", g."RECUENTO NO GESTION", rp.* EXCLUDE (CUENTA_NEXT, mes),
         upper(split_part(CASE WHEN b.Ciudad IS NULL OR b.Ciudad = '' THEN 'VACIO' ELSE b.Ciudad END, '/', 1)) AS city_n
  FROM m_base_f b
  LEFT JOIN m_demo c ON b.CUENTA_NEXT = c.CUENTA_NEXT AND b.mes = c.mes
  LEFT JOIN m_touch t ON b.CUENTA_NEXT = t.CUENTA_NEXT AND b.mes = t.mes
  LEFT JOIN m_data d ON b.CUENTA_NEXT = d."CUENTA_NEXT" AND b.mes = d.mes
  LEFT JOIN m_queues q ON b.CUENTA_NEXT = q.CUENTA_NEXT AND b.mes = q.mes
  LEFT JOIN m_ranking r ON b.CUENTA_NEXT = r.CUENTA_NEXT AND b.mes = r.mes
  LEFT JOIN m_exc_acc xa ON b.CUENTA_NEXT = xa.CUENTA_NEXT AND b.mes = xa.mes
  LEFT JOIN m_exc_doc xd ON d."DOCUMENTO" = xd."DOCUMENTO" AND b.mes = xd.mes
  LEFT JOIN m_psa p ON b.CUENTA_NEXT = p.CUENTA_NEXT AND b.mes = p.mes
  LEFT JOIN m_ng g ON b.CUENTA_NEXT = g.CUENTA_NEXT AND b.mes = g.mes
  LEFT JOIN m_report rp ON b.CUENTA_NEXT = rp.CUENTA_NEXT AND b.mes = rp.mes),
m_hits AS (
  SELECT city_n, grp, arg_max(department, ord) AS dept
  FROM (SELECT DISTINCT city_n FROM m_chain) JOIN m_pats ON contains(city_n, pattern) GROUP BY city_n, grp),
m_full AS (
  SELECT m_chain.*,
    CASE WHEN m_chain.city_n = 'VACIO' THEN 'VACIO'
         WHEN coalesce(h1.dept, m_chain.city_n) IN ({depts}) THEN coalesce(h1.dept, m_chain.city_n)
         WHEN coalesce(h2.dept, m_chain.city_n) IN ({depts}) THEN coalesce(h2.dept, m_chain.city_n)
         ELSE 'NO IDENTIFICADO' END AS DEPARTAMENTO,
    CAST(datediff('day', try_strptime(trim(CAST("Fecha de Vencimiento" AS VARCHAR)), '%d/%m/%Y'),
                         try_strptime(trim(CAST("FECHA INGRESO DATA" AS VARCHAR)), '%d/%m/%Y')) AS INTEGER) AS dias_mora
  FROM m_chain LEFT JOIN m_hits h1 ON h1.city_n = m_chain.city_n AND h1.grp = 1
               LEFT JOIN m_hits h2 ON h2.city_n = m_chain.city_n AND h2.grp = 2)
SELECT {', '.join(sel)} FROM m_full m_chain"""



@register("monthly_consolidation", _monthly_sql())
def monthly_consolidation(spark, sf):
    from .monthly import monthly_consolidation as run
    from .q_contacts import DOC_LANDLINE, DOC_MOBILE
    return run(_monthly_sources(spark, sf), geo.pattern_table(spark, CITY_PATTERNS),
               mobile_count=DOC_MOBILE, landline_count=DOC_LANDLINE)


# the prepared base and its nine sides kept as tables that are bucketed by
# (account, month); the chain over them has no exchange on the key
@register("monthly_bucketed", _monthly_sql())
def monthly_bucketed(spark, sf):
    from .monthly import bucketed_store
    from .monthly import monthly_consolidation as run
    from .q_contacts import DOC_LANDLINE, DOC_MOBILE
    folder = scratch_path(spark, "monthly-bucketed")
    store = bucketed_store(spark, folder, int(spark.conf.get("spark.sql.shuffle.partitions")), "mensual_" + folder.rsplit("-", 1)[1])
    return run(_monthly_sources(spark, sf), geo.pattern_table(spark, CITY_PATTERNS), mobile_count=DOC_MOBILE, landline_count=DOC_LANDLINE, store=store)
