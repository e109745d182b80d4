"""Catalog entries for reshaping and list / count flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands, fixed
from ..operators import consolidate, flags, reshape
from ..sources.tables import table
from .registry import register


# ------------------------------------------------------------ union by name
# three "files" with drifting columns: all customers, the BUILDING customers
# again (exact duplicates to remove), suppliers (other columns)


def _cust_part(c):
    return c.select(F.col("c_custkey").cast("string").alias("Cuenta_Real"),
                    F.col("c_custkey").cast("string").alias("Cuenta_Sin_Punto"),
                    F.col("c_name").alias("nombre"),
                    F.col("c_acctbal").cast("decimal(12,2)").alias("saldo"))


@register("union_by_name", """
SELECT DISTINCT Cuenta_Real || '-' AS Cuenta_Real, Cuenta_Sin_Punto || '-' AS Cuenta_Sin_Punto,
       nombre, saldo, proveedor, nacion, 6 AS mes_de_asignacion, 2024 AS periodo_de_asignacion
FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS Cuenta_Real, CAST(c_custkey AS VARCHAR) AS Cuenta_Sin_Punto,
         c_name AS nombre, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo FROM customer
  UNION ALL BY NAME
  SELECT CAST(c_custkey AS VARCHAR) AS Cuenta_Real, CAST(c_custkey AS VARCHAR) AS Cuenta_Sin_Punto,
         c_name AS nombre, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL BY NAME
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS Cuenta_Real, 'S' || CAST(s_suppkey AS VARCHAR) AS Cuenta_Sin_Punto,
         s_name AS proveedor, s_nationkey AS nacion FROM supplier)""")
def union_by_name(spark, sf):
    c = table(spark, sf, "customer")
    s = table(spark, sf, "supplier")
    parts = [_cust_part(c), _cust_part(c.where(F.col("c_mktsegment") == "BUILDING")),
             s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Cuenta_Real"),
                      F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("Cuenta_Sin_Punto"),
                      F.col("s_name").alias("proveedor"), F.col("s_nationkey").alias("nacion"))]
    u = reshape.union_by_name(parts, distinct=False)
    u = u.withColumns({"Cuenta_Real": F.concat("Cuenta_Real", F.lit("-")),
                       "Cuenta_Sin_Punto": F.concat("Cuenta_Sin_Punto", F.lit("-")),
                       "mes_de_asignacion": F.lit(6), "periodo_de_asignacion": F.lit(2024)})
    return u.dropDuplicates()


# ------------------------------------------------------------ unpivot

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("unpivot_stack", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS medida, {m} AS valor FROM lineitem" for m in _MEASURES))
def unpivot_stack(spark, sf):
    li = table(spark, sf, "lineitem")
    return reshape.unpivot(li.select("l_orderkey", "l_linenumber", *_MEASURES),
                           ["l_orderkey", "l_linenumber"], _MEASURES)


# ------------------------------------------------------------ distinct


@register("distinct_values", "SELECT DISTINCT CAST(ts AS DATE) AS dia FROM events")
def distinct_values(spark, sf):
    return table(spark, sf, "events").select(F.to_date("ts").alias("dia")).distinct()


# ------------------------------------------------------------ prefix rename

_RAW_NAMES = {"c_custkey": "CUENTA NEXT", "c_name": "Nombre del Cliente", "c_acctbal": "Saldo.",
              "c_mktsegment": "Segmento", "c_nationkey": "Código de país"}
_CATALOGUE = {
    fixed.PREFIX_BASE: ["CUENTA NEXT", "Nombre del Cliente", "Codigo de pais", "Direccion Completa"],
    fixed.PREFIX_SCIENCE: ["Segmento", "RANGO DEUDA"],
    fixed.PREFIX_ADDED: ["Saldo", "Toques por SMS"],
}


@register("prefix_rename", """
SELECT c_custkey AS "BG_cuenta_next", c_name AS "BG_nombre_del_cliente", c_nationkey AS "BG_codigo_de_pais",
       c_mktsegment AS "DS_VAR_segmento", c_acctbal AS "AD_saldo"
FROM customer""")
def prefix_rename(spark, sf):
    c = table(spark, sf, "customer")
    df = consolidate.rename(c, _RAW_NAMES)           # P3: rename by dictionary
    df = consolidate.clean_headers(df)               # P7: accents, {}., removed
    wanted = [n for names in _CATALOGUE.values() for n in names]
    df = consolidate.select_existing(df, wanted)     # P8: only listed columns that exist
    return consolidate.prefix_families(df, _CATALOGUE)   # P5: prefix families


# ------------------------------------------------------------ month backfill


@register("month_backfill", """
WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS lo,
                  CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS hi FROM orders),
m AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS mes FROM b),
p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, count(*) AS n_pedidos,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS valor
      FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT m.mes, coalesce(p.n_pedidos, 0) AS n_pedidos, coalesce(p.valor, CAST(0 AS DECIMAL(28,2))) AS valor
FROM m LEFT JOIN p USING (mes)""")
def month_backfill(spark, sf):
    o = table(spark, sf, "orders")
    urgent_pending = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    # months come from ALL orders; the counted subset leaves months empty
    out = reshape.monthly_backfill(
        o, "o_orderdate",
        {"n_pedidos": F.count(F.lit(1)),
         "valor": F.sum(bands.to_amount("o_totalprice")).cast("decimal(28,2)")},
        where=urgent_pending)
    return out.select("mes", F.coalesce("n_pedidos", F.lit(0).cast("bigint")).alias("n_pedidos"),
                      F.coalesce("valor", F.lit(0).cast("decimal(28,2)")).alias("valor"))


# ------------------------------------------------------------ list flags


@register("exclusion_flag", """
SELECT o_orderkey, o_custkey, e.exclusion_cuenta
FROM orders LEFT JOIN (SELECT DISTINCT c_custkey, 'APLICA' AS exclusion_cuenta FROM customer WHERE c_acctbal < 0) e
  ON o_custkey = e.c_custkey""")
def exclusion_flag(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lst = table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return flags.list_flag(o, lst, ["o_custkey"], "exclusion_cuenta")


@register("flags_extra", """
WITH r AS (SELECT o_custkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           WHERE l_returnflag = 'R' GROUP BY o_custkey),
p AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT c_custkey, r.n AS recuento_pagos_sin_aplicar, p.n AS recuento_no_gestion,
       CASE WHEN r.n >= 1 THEN 'Aplica' ELSE '' END AS filtro_pagos_sin_aplicar,
       CASE WHEN p.n >= 1 THEN 'Aplica' ELSE '' END AS filtro_pagos_no_gestion
FROM customer LEFT JOIN r ON c_custkey = r.o_custkey LEFT JOIN p ON c_custkey = p.o_custkey""")
def flags_extra(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    # returned lines counted per order first (pre-aggregation before the join)
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R") \
        .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = table(spark, sf, "orders")
    r = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey) \
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("n").alias("recuento_pagos_sin_aplicar"))
    p = o.where(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("recuento_no_gestion"))
    out = c.join(r, "c_custkey", "left").join(p, "c_custkey", "left")
    return flags.count_flags(out, {"filtro_pagos_sin_aplicar": "recuento_pagos_sin_aplicar",
                                   "filtro_pagos_no_gestion": "recuento_no_gestion"})
