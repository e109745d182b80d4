"""Catalog entries for the assignment-base operators (calendar, brand,
bands, keys, documents, names, multi-flags, discounts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands, classify, dates, keys, text
from ..functions import fixed
from ..operators import calendar, calendar_state, flags, topn
from ..session import scratch_path
from ..sources.tables import table
from .registry import register


def _assigned(spark, sf):
    # all events: a (user, event type) is "assigned" on every day it has one
    return table(spark, sf, "events").select("user_id", "event_type", "ts")


# ---------------------------------------------------------------- calendar

_CAL_SQL_CTE = """
WITH ev AS (
  SELECT user_id, event_type, CAST(date_trunc('month', ts) AS DATE) AS month,
         CAST(dayofmonth(ts) AS INTEGER) AS d
  FROM events),
agg AS (
  SELECT user_id, event_type, month, bit_or(CAST(1 AS BIGINT) << (d - 1)) AS day_mask,
         min(d) AS first_day, max(d) AS last_day
  FROM ev GROUP BY user_id, event_type, month),
mm AS (SELECT month, max(d) AS month_last_day FROM ev GROUP BY month),
j AS (
  SELECT a.*, m.month_last_day, CAST(bit_count(a.day_mask) AS INTEGER) AS asg,
         CAST(a.last_day - a.first_day + 1 - bit_count(a.day_mask)
              + CASE WHEN a.last_day < m.month_last_day THEN 1 ELSE 0 END AS INTEGER) AS ret
  FROM agg a LEFT JOIN mm m USING (month))
"""

_DAY_BAND_SQL = "CASE " + " ".join(
    f"WHEN {{x}} >= {lo} AND {{x}} <= {hi} THEN '{lab}'" for lo, hi, lab in fixed.DAY_BANDS
) + f" ELSE '{fixed.DAY_BAND_OUT}' END"


def day_band_sql(x: str) -> str:
    return _DAY_BAND_SQL.replace("{x}", x)


_CAL_SQL_COLS = f"""
  user_id, event_type, month, day_mask, first_day, last_day, month_last_day,
  asg AS dias_asignada, ret AS dias_retirada, asg + ret AS rango_de_dias,
  CAST(first_day AS VARCHAR) || '/' || strftime(month, '%-m/%Y') AS fecha_ingreso,
  CASE WHEN last_day < month_last_day
       THEN CAST(last_day + 1 AS VARCHAR) || '/' || strftime(month, '%-m/%Y') ELSE '-' END AS fecha_retiro,
  CASE WHEN last_day < month_last_day THEN 'Recuperada' ELSE 'En gestion' END AS estado_cuenta,
  {day_band_sql('asg + ret')} AS grupo_rango_de_dias
"""


@register("calendar_status", _CAL_SQL_CTE + "SELECT " + _CAL_SQL_COLS + " FROM j")
def calendar_status(spark, sf):
    return calendar.assignment_calendar(_assigned(spark, sf), ["user_id", "event_type"], "ts", labels=None)


def _wide_sql() -> str:
    days = []
    for d in range(1, 32):
        days.append(
            f"CASE WHEN (day_mask >> {d - 1}) & 1 = 1 THEN 'Asignada' "
            f"WHEN first_day < {d} AND last_day > {d} THEN 'Sin reasignar' "
            f"WHEN last_day + 1 = {d} AND month_last_day >= {d} THEN 'Retirada' "
            f"ELSE '' END AS dia_{d}")
    return _CAL_SQL_CTE + "SELECT " + _CAL_SQL_COLS + ", " + ", ".join(days) + " FROM j"


@register("calendar_days_wide", _wide_sql())
def calendar_days_wide(spark, sf):
    return calendar.assignment_calendar(_assigned(spark, sf), ["user_id", "event_type"], "ts", labels="wide")


# the same calendar kept up by files: the days of a month come in four files,
# in no order, and one of them twice
@register("calendar_day_by_day", _CAL_SQL_CTE + "SELECT " + _CAL_SQL_COLS + " FROM j")
def calendar_day_by_day(spark, sf):
    state, keys_ = scratch_path(spark, "calendar-state"), ["user_id", "event_type"]
    days = _assigned(spark, sf)
    for part in (2, 0, 3, 2, 1):
        calendar_state.add_days(days.where(F.dayofmonth("ts") % 4 == part), state, keys_, "ts")
    return calendar_state.calendar_from(calendar_state.read_state(spark, state), keys_, labels=None)


# ------------------------------------------------------ portfolio view
# The driver tables have no receivables columns, so orders x customer are
# read as a portfolio: one account per order, the customer's market segment
# as billing system, order priority / status as the Y/N marks, a debt-age
# text from the order day. Spark and SQL build the same view.

_CRM_BY_SEGMENT = [("AUTOMOBILE", "BSCS"), ("BUILDING", "RR"), ("FURNITURE", "SGA"),
                   ("HOUSEHOLD", "ASCARD")]
_DOC_LETTERS_BY_SEGMENT = [("AUTOMOBILE", "CC"), ("BUILDING", "NT"), ("FURNITURE", "CE"),
                           ("HOUSEHOLD", "XPP")]


def _case_spark(col, pairs, default):
    e = None
    for k, v in pairs:
        e = F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v))
    return e.otherwise(F.lit(default))


def _case_sql(col, pairs, default):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in pairs) + \
        (f" ELSE '{default}' END" if default is not None else " ELSE NULL END")


def _portfolio(spark, sf, customer=()):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", *customer)
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    return j.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority",
        _case_spark(F.col("c_mktsegment"), _CRM_BY_SEGMENT, "OTRO").alias("crm"),
        F.when(pr == "1-URGENT", "Y").when(pr == "4-NOT SPECIFIED", F.lit(None)).otherwise("N").alias("m5"),
        F.when(pr == "2-HIGH", "Y").otherwise("N").alias("m6"),
        F.when((st == "P") & (pr == "5-LOW"), "Y").otherwise("N").alias("m7"),
        F.when(st == "F", "Y").otherwise("N").alias("m43"),
        F.when(F.col("o_totalprice") > 250000, "PrePotencial Convergente Masivo_2")
         .otherwise("Otra").alias("campaign"),
        (F.dayofmonth("o_orderdate") % 8 * 30).cast("string").alias("debt_age"),
        F.when(st == "P", F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("ref_raw"),
        *(["c_custkey", "c_mktsegment", *customer] if customer else []),
    )


_PORTFOLIO_SQL = f"""
WITH pf AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority,
    {_case_sql('c_mktsegment', _CRM_BY_SEGMENT, 'OTRO')} AS crm,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'N' END AS m5,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS m6,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Y' ELSE 'N' END AS m7,
    CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS m43,
    CASE WHEN o_totalprice > 250000 THEN 'PrePotencial Convergente Masivo_2' ELSE 'Otra' END AS campaign,
    CAST(dayofmonth(o_orderdate) % 8 * 30 AS VARCHAR) AS debt_age,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS ref_raw
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
"""

# ------------------------------------------------------ first row per key


@register("first_row_per_key", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def first_row_per_key(spark, sf):
    o = table(spark, sf, "orders")
    return topn.first_row_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                  ["o_totalprice", "o_orderstatus"])


# ------------------------------------------------------ brand


def _brand_sql():
    return f"""
  CASE WHEN b IN ('120', '150', '180') THEN '120 - 180'
       WHEN b = 'Prepotencial' AND crm = 'BSCS' AND campaign IN
            ('PrePotencial Convergente Masivo_2', 'PrePotencial Convergente Pyme_2')
       THEN 'Prepotencial Especial' ELSE b END"""


@register("brand_classify", _PORTFOLIO_SQL + """,
b1 AS (SELECT *,
  CASE WHEN m5 = 'Y' AND crm = 'BSCS' THEN 'Potencial'
       WHEN m5 = 'Y' AND crm IN ('RR', 'SGA') THEN 'Churn'
       WHEN m5 = 'Y' AND crm = 'ASCARD' THEN 'Provision'
       WHEN m6 = 'Y' AND crm = 'BSCS' THEN 'Prepotencial'
       WHEN m6 = 'Y' AND crm IN ('RR', 'SGA') THEN 'Prechurn'
       WHEN m6 = 'Y' AND crm = 'ASCARD' THEN 'Preprovision'
       WHEN m7 = 'Y' THEN 'Castigo'
       WHEN m5 = 'N' AND m6 = 'N' AND m7 = 'N' AND m43 = 'Y' THEN 'Potencial a Castigar'
       ELSE debt_age END AS b FROM pf)
SELECT o_orderkey, crm, """ + _brand_sql() + """ AS marca FROM b1""")
def brand_classify(spark, sf):
    p = _portfolio(spark, sf)
    return p.select("o_orderkey", "crm",
                    classify.brand("m5", "m6", "m7", "m43", "crm", "campaign", "debt_age").alias("marca"))


# ------------------------------------------------------ segment


@register("segment_flag", """
SELECT c_custkey, CAST(c_nationkey + 70 AS VARCHAR) AS customer_type,
  CASE WHEN CAST(c_nationkey + 70 AS VARCHAR) IN ('81', '84', '87') THEN 'Personas' ELSE 'Negocios' END AS segmento
FROM customer""")
def segment_flag(spark, sf):
    c = table(spark, sf, "customer")
    ct = (F.col("c_nationkey") + 70).cast("string")
    return c.select("c_custkey", ct.alias("customer_type"), classify.segment(ct).alias("segmento"))


# ------------------------------------------------------ debt band


def _debt_band_sql(x: str, zero: bool = False) -> str:
    parts = [f"WHEN {x} = 0 THEN '{fixed.DISCOUNT_BAND_ZERO}'"] if zero else []
    parts += [f"WHEN {x} <= {b} THEN '{lab}'" for b, lab in fixed.DEBT_BANDS]
    return "CASE " + " ".join(parts) + f" ELSE '{fixed.DEBT_BAND_OVER}' END"


@register("debt_band", f"""
SELECT rango_deuda, count(*) AS n_cuentas, CAST(sum(v) AS DECIMAL(28,2)) AS valor_deuda FROM (
  SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS v,
         {_debt_band_sql('CAST(o_totalprice AS DECIMAL(18,2))')} AS rango_deuda FROM orders)
GROUP BY rango_deuda""")
def debt_band(spark, sf):
    o = table(spark, sf, "orders")
    v = bands.to_amount("o_totalprice")
    return o.select(v.alias("v"), bands.debt_band(v).alias("rango_deuda")) \
        .groupBy("rango_deuda").agg(F.count(F.lit(1)).alias("n_cuentas"),
                                    F.sum("v").cast("decimal(28,2)").alias("valor_deuda"))


# ------------------------------------------------------ discount


@register("discount_value_band", f"""
WITH d AS (
  SELECT l_orderkey AS cuenta, max(TRY_CAST(CAST(CAST(l_discount * 100 + l_tax AS DECIMAL(7,4)) AS VARCHAR) AS DECIMAL(12,8))) AS pct
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
j AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS debt, coalesce(d.pct, 0) AS porcentaje
  FROM orders LEFT JOIN d ON o_orderkey = d.cuenta),
v AS (
  SELECT *, CASE WHEN porcentaje = 0 THEN CAST(0 AS DECIMAL(24,6))
    ELSE CAST(debt * (CAST(1 AS DECIMAL(14,10)) - CAST(porcentaje * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,10))) AS DECIMAL(24,6)) END AS valor_descuento
  FROM j)
SELECT o_orderkey, CAST(porcentaje AS DECIMAL(12,8)) AS porcentaje, valor_descuento,
  {_debt_band_sql('valor_descuento', zero=True)} AS rango_con_descuento,
  CASE WHEN coalesce(porcentaje, 0) = 0 THEN 'No Aplica' ELSE 'Aplica' END AS filtro_descuento,
  replace(CAST(valor_descuento AS VARCHAR), '.', ',') AS valor_descuento_texto
FROM v""")
def discount_value_band(spark, sf):
    from ..operators.discount import apply_discounts
    o = table(spark, sf, "orders").select(
        "o_orderkey", bands.to_amount("o_totalprice").alias("debt"))
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("cuenta"),
        (F.col("l_discount") * 100 + F.col("l_tax")).cast("decimal(7,4)").cast("string").alias("pct_text"))
    out = apply_discounts(o, li, "o_orderkey", "cuenta", "debt", "pct_text")
    return out.select("o_orderkey", "porcentaje", "valor_descuento", "rango_con_descuento",
                      "filtro_descuento", "valor_descuento_texto")


# ------------------------------------------------------ reference


@register("reference_fill", _PORTFOLIO_SQL + """
SELECT o_orderkey, r AS referencia,
  CASE WHEN length(r) > 3 THEN 'Con referencia' ELSE 'Sin Referencia' END AS filtro_referencia
FROM (SELECT o_orderkey, CASE WHEN crm = 'RR' THEN CAST(o_orderkey AS VARCHAR)
                              WHEN ref_raw IS NULL THEN '0' ELSE ref_raw END AS r FROM pf)""")
def reference_fill(spark, sf):
    p = _portfolio(spark, sf)
    r = classify.reference("ref_raw", "crm", F.col("o_orderkey").cast("string"))
    return p.select("o_orderkey", r.alias("referencia"),
                    classify.reference_flag(r).alias("filtro_referencia"))


# ------------------------------------------------------ account key


@register("account_key", """
SELECT c_custkey,
  regexp_replace(raw, '[.-]', '', 'g') || '-' AS cuenta_next,
  regexp_replace(raw, '[-]', '', 'g') || '-' AS cuenta_con_puntos
FROM (SELECT c_custkey, c_name || '.' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS raw FROM customer)""")
def account_key(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.concat(F.col("c_name"), F.lit("."), F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    return c.select("c_custkey", keys.account_key(raw).alias("cuenta_next"),
                    keys.account_key(raw, strip="-").alias("cuenta_con_puntos"))


# ------------------------------------------------------ document split


@register("document_split", f"""
SELECT c_custkey,
  CASE WHEN letters = 'CC' THEN 'Cedula de Ciudadania' WHEN letters = 'PS' THEN 'Pasaporte'
       WHEN letters = 'PP' THEN 'Pasaporte' WHEN letters = 'XPP' THEN 'Permiso de Permanencia'
       WHEN letters = 'NT' THEN 'Nit' WHEN letters = 'CD' THEN 'Carnet Diplomatico'
       WHEN letters = 'CE' THEN 'Cedula de Extranjeria' WHEN letters IS NULL THEN 'Sin tipologia'
       ELSE 'Errado' END AS tipo_de_documento,
  regexp_replace(doc, '[^0-9]', '', 'g') AS documento
FROM (SELECT c_custkey, doc, regexp_replace(doc, '[^a-zA-Z]', '', 'g') AS letters FROM (
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE
    {_case_sql('c_mktsegment', _DOC_LETTERS_BY_SEGMENT, '')} || CAST(c_custkey AS VARCHAR) END AS doc
  FROM customer))""")
def document_split(spark, sf):
    c = table(spark, sf, "customer")
    doc = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(
        F.concat(_case_spark(F.col("c_mktsegment"), _DOC_LETTERS_BY_SEGMENT, ""),
                 F.col("c_custkey").cast("string")))
    return c.select("c_custkey", classify.document_type(doc).alias("tipo_de_documento"),
                    classify.document_number(doc).alias("documento"))


# ------------------------------------------------------ name cleaning


def _name_clean_sql(x: str) -> str:
    s = f"replace({x}, 'ß', 'SS')"
    for bad in text.MISENCODED_N:
        s = f"replace({s}, '{bad}', 'N')"
    for bad, good in text.MISENCODED_OTHER:
        s = f"replace({s}, '{bad}', '{good}')"
    s = f"upper({s})"
    s = f"translate({s}, '{text.ACCENTED}', '{text.PLAIN}')"
    s = f"regexp_replace({s}, '[^A-Z&()/. ]', ' ', 'g')"
    s = f"regexp_replace({s}, '\\((A|AS|ES)\\)', '\\1', 'g')"
    honor = "|".join(text.HONORIFICS)
    s = f"regexp_replace({s}, '\\b({honor})\\b\\.?', ' ', 'g')"
    s = f"regexp_replace({s}, '[^A-Z&]+', ' ', 'g')"
    s = f"trim({s})"
    s = f"regexp_replace({s}, '^(A )+', '')"
    return s


@register("name_clean", f"SELECT doc_id, {_name_clean_sql('text')} AS nombre FROM documents")
def name_clean(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", text.clean_person_name("text").alias("nombre"))


def _strict_name_sql(x: str) -> str:
    q = lambda t: t.replace("'", "''")
    s = f"upper(replace({x}, 'ß', 'SS'))"
    for wrong in fixed.STRICT_N:
        s = f"regexp_replace({s}, '{q(wrong.lstrip(chr(92)))}', 'N', 'g')"
    for wrong, right in fixed.STRICT_LETTERS:
        s = f"regexp_replace({s}, '{q(wrong)}', '{right}', 'g')"
    for t in [*fixed.STRICT_DELETED, "[^A-Z& ]", *fixed.STRICT_DELETED_LAST]:
        s = f"regexp_replace({s}, '{q(t)}', '', 'g')"
    return f"regexp_replace({s}, '^(A\\s+| )+', '')"


@register("name_clean_strict", f"SELECT o_orderkey, {_strict_name_sql('n')} AS nombre FROM (SELECT o_orderkey, "
          "'sr. ' || o_orderpriority || ' señor(a) peña  ' || o_orderstatus || '_' || CAST(o_custkey AS VARCHAR) AS n FROM orders)")
def name_clean_strict(spark, sf):
    n = F.concat(F.lit("sr. "), F.col("o_orderpriority"), F.lit(" señor(a) peña  "), F.col("o_orderstatus"), F.lit("_"),
                 F.col("o_custkey").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", text.clean_person_name(n, strict=True).alias("nombre"))


# ------------------------------------------------------ multi-flags


@register("multi_flags", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS documento,
  CASE WHEN count(*) OVER w > 1 THEN 'Aplica' ELSE 'No aplica' END AS multicuenta,
  CASE WHEN max(o_orderstatus) OVER w > min(o_orderstatus) OVER w THEN 'Aplica' ELSE 'No aplica' END AS multiproducto,
  CASE WHEN max(o_orderpriority) OVER w > min(o_orderpriority) OVER w THEN 'Aplica' ELSE 'No aplica' END AS multimora
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def multi_flags(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("documento"),
        "o_orderstatus", "o_orderpriority")
    out = flags.multi_flags(o, "documento", "o_orderkey",
                            {"multiproducto": "o_orderstatus", "multimora": "o_orderpriority"})
    return out.select("o_orderkey", "documento", "multicuenta", "multiproducto", "multimora")


# Finished and pending orders, two thirds of all, stand under one collective document.

@register("multi_flags_hot", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'COLECTIVO' ELSE CAST(o_custkey AS VARCHAR) END AS documento,
                  o_orderstatus, o_orderpriority FROM orders)
SELECT o_orderkey, documento,
  CASE WHEN count(*) OVER w > 1 THEN 'Aplica' ELSE 'No aplica' END AS multicuenta,
  CASE WHEN max(o_orderstatus) OVER w > min(o_orderstatus) OVER w THEN 'Aplica' ELSE 'No aplica' END AS multiproducto,
  CASE WHEN max(o_orderpriority) OVER w > min(o_orderpriority) OVER w THEN 'Aplica' ELSE 'No aplica' END AS multimora
FROM o WINDOW w AS (PARTITION BY documento)""")
def multi_flags_hot(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus").isin("F", "P"), "COLECTIVO")
        .otherwise(F.col("o_custkey").cast("string")).alias("documento"),
        "o_orderstatus", "o_orderpriority")
    out = flags.multi_flags(o, "documento", "o_orderkey",
                            {"multiproducto": "o_orderstatus", "multimora": "o_orderpriority"}, hot_share=0.01)
    return out.select("o_orderkey", "documento", "multicuenta", "multiproducto", "multimora")


# ------------------------------------------------------ whole assignment base
# The reference's main pipeline end to end: orders x customer rendered in
# the positional 57-column text layout of the daily assignment files (one
# row per order = one assigned day of the customer's account), discounts
# from returned lines; plans.assignment.assignment_base does the rest.

def _raw_assignment(spark, sf):
    from pyspark.sql.types import StringType
    j = _portfolio(spark, sf, ["c_name", "c_nationkey", "c_acctbal"])
    acc = F.concat(F.col("o_custkey").cast("string"), F.lit("."), (F.col("o_custkey") % 7).cast("string"))
    cols = {f"{i}_": F.lit(None).cast(StringType()) for i in range(1, 58)}
    cols.update({
        "1_": F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(
            F.concat(_case_spark(F.col("c_mktsegment"), _DOC_LETTERS_BY_SEGMENT, ""),
                     F.col("c_custkey").cast("string"))),
        "2_": acc, "3_": F.col("crm"), "5_": F.col("m5"), "6_": F.col("m6"), "7_": F.col("m7"),
        "9_": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        "12_": F.col("campaign"), "13_": F.col("debt_age"), "24_": F.col("c_name"),
        "26_": dates.format_dmy(F.date_add(F.to_date("o_orderdate"), 30)),
        "27_": F.col("ref_raw"), "42_": (F.col("c_nationkey") + 70).cast("string"), "43_": F.col("m43"),
        "57_": dates.format_dmy("o_orderdate"),
    })
    raw = j.select(*[v.alias(k) for k, v in cols.items()])
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    disc = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.col("o_custkey").cast("string"), (F.col("o_custkey") % 7).cast("string")).alias("CUENTA"),
        (F.col("l_discount") * 100 + F.col("l_tax")).cast("decimal(7,4)").cast("string").alias("PORCENTAJE"))
    # the days alone, for the last day of each month: no join is needed to know them
    days = table(spark, sf, "orders").select(F.lit("").alias("3_"), dates.format_dmy("o_orderdate").alias("57_"))
    return raw, disc, days


def _doc_type_sql(letters: str) -> str:
    parts = " ".join(f"WHEN {letters} = '{code}' THEN '{name}'" for code, name in fixed.DOCUMENT_TYPES)
    return f"CASE {parts} WHEN {letters} IS NULL THEN 'Sin tipologia' ELSE 'Errado' END"


def _assignment_sql() -> str:
    from .assignment import DAY_COLUMNS, LAYOUT, TAIL
    # earliest day first, then the raw columns in the order the Spark side
    # compares them (plans.assignment.RAW_USED)
    raw_sql = {"1_": "d1", "2_": "a2", "3_": "c3", "5_": "m5", "6_": "m6", "7_": "m7", "9_": "debt9",
               "12_": "c12", "13_": "c13", "24_": "n24", "26_": "due26", "27_": "r27", "42_": "t42", "43_": "m43"}
    from .assignment import RAW_USED
    order = ", ".join(["_fecha NULLS FIRST"] + [f"raw_{raw_sql[a]} NULLS FIRST" for a in RAW_USED])
    raw_cols = ", ".join(f"{raw_sql[a]} AS raw_{raw_sql[a]}" for a in RAW_USED)
    labels = ", ".join(
        f"CASE WHEN (day_mask >> {d - 1}) & 1 = 1 THEN 'Asignada' "
        f"WHEN first_day < {d} AND last_day > {d} THEN 'Sin reasignar' "
        f"WHEN last_day + 1 = {d} AND month_last_day >= {d} THEN 'Retirada' ELSE '' END AS \"Dia_{d}\""
        for d in range(1, 32))
    out_cols = ", ".join(f'"{c}"' for c in LAYOUT + DAY_COLUMNS + TAIL)
    return _PORTFOLIO_SQL + f""",
raw AS (
  SELECT
    CASE WHEN c_acctbal < 0 THEN NULL ELSE
      {_case_sql('c_mktsegment', _DOC_LETTERS_BY_SEGMENT, '')} || CAST(c_custkey AS VARCHAR) END AS d1,
    CAST(pf.o_custkey AS VARCHAR) || '.' || CAST(pf.o_custkey % 7 AS VARCHAR) AS a2,
    crm AS c3, m5, m6, m7, m43,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS debt9,
    campaign AS c12, debt_age AS c13, c_name AS n24,
    strftime(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY, '%-d/%-m/%Y') AS due26,
    ref_raw AS r27, CAST(c_nationkey + 70 AS VARCHAR) AS t42,
    strftime(o_orderdate, '%-d/%-m/%Y') AS f57
  FROM pf LEFT JOIN customer ON pf.o_custkey = c_custkey),
r0 AS (
  SELECT *, regexp_replace(d1, '[^0-9]', '', 'g') AS docnum, regexp_replace(d1, '[^a-zA-Z]', '', 'g') AS letters,
         TRY_CAST(debt9 AS DECIMAL(18,2)) AS debt,
         CASE WHEN c3 = 'RR' THEN a2 WHEN r27 IS NULL THEN '0' ELSE r27 END AS ref
  FROM raw WHERE c3 <> 'CRM Origen'),
r1 AS (
  SELECT *, CASE WHEN m5 = 'Y' AND c3 = 'BSCS' THEN 'Potencial'
       WHEN m5 = 'Y' AND c3 IN ('RR', 'SGA') THEN 'Churn'
       WHEN m5 = 'Y' AND c3 = 'ASCARD' THEN 'Provision'
       WHEN m6 = 'Y' AND c3 = 'BSCS' THEN 'Prepotencial'
       WHEN m6 = 'Y' AND c3 IN ('RR', 'SGA') THEN 'Prechurn'
       WHEN m6 = 'Y' AND c3 = 'ASCARD' THEN 'Preprovision'
       WHEN m7 = 'Y' THEN 'Castigo'
       WHEN m5 = 'N' AND m6 = 'N' AND m7 = 'N' AND m43 = 'Y' THEN 'Potencial a Castigar'
       ELSE c13 END AS b, c3 AS crm_, c12 AS campaign_ FROM r0),
rows AS (
  SELECT
    CASE WHEN trim(docnum) = '' THEN NULL ELSE docnum END AS "DOCUMENTO",
    {_doc_type_sql('letters')} AS "TIPO DE DOCUMENTO",
    a2 || '-' AS "CUENTA",
    regexp_replace(a2, '[.\\-]', '', 'g') || '-' AS "CUENTA_NEXT",
    CASE WHEN b IN ('120', '150', '180') THEN '120 - 180'
         WHEN b = 'Prepotencial' AND crm_ = 'BSCS' AND campaign_ IN
              ('PrePotencial Convergente Masivo_2', 'PrePotencial Convergente Pyme_2')
         THEN 'Prepotencial Especial' ELSE b END AS "MARCA",
    c3 AS "CRM",
    CASE WHEN t42 IN ('81', '84', '87') THEN 'Personas' ELSE 'Negocios' END AS "SEGMENTO",
    t42 AS "CUSTOMER TYPE",
    {_debt_band_sql('debt')} AS "RANGO DEUDA",
    debt AS "VALOR DEUDA",
    due26 AS "FECHA VENCIMIENTO",
    ref AS "REFERENCIA",
    CASE WHEN length(ref) > 3 THEN 'Con referencia' ELSE 'Sin Referencia' END AS "FILTRO REFERENCIA",
    {_name_clean_sql('n24')} AS "NOMBRE",
    CAST(try_strptime(trim(f57), '%d/%m/%Y') AS DATE) AS _fecha,
    {raw_cols}
  FROM r1),
ev AS (SELECT *, CAST(date_trunc('month', _fecha) AS DATE) AS month, CAST(dayofmonth(_fecha) AS INTEGER) AS d FROM rows),
agg AS (SELECT "CUENTA", month, bit_or(CAST(1 AS BIGINT) << (d - 1)) AS day_mask, min(d) AS first_day,
               max(d) AS last_day FROM ev GROUP BY "CUENTA", month),
fr AS (SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY "CUENTA", month ORDER BY {order}) AS rn FROM ev)
       WHERE rn = 1),
mm AS (SELECT month, max(d) AS month_last_day FROM ev GROUP BY month),
cal AS (
  SELECT fr.* EXCLUDE (d, _fecha), a.day_mask, a.first_day, a.last_day, mm.month_last_day,
         CAST(bit_count(a.day_mask) AS INTEGER) AS asg,
         CAST(a.last_day - a.first_day + 1 - bit_count(a.day_mask)
              + CASE WHEN a.last_day < mm.month_last_day THEN 1 ELSE 0 END AS INTEGER) AS ret
  FROM agg a JOIN fr ON a."CUENTA" = fr."CUENTA" AND a.month IS NOT DISTINCT FROM fr.month
  LEFT JOIN mm ON a.month = mm.month),
c2 AS (
  SELECT *,
    CAST(first_day AS VARCHAR) || '/' || strftime(month, '%-m/%Y') AS "FECHA INGRESO",
    CASE WHEN last_day < month_last_day THEN CAST(last_day + 1 AS VARCHAR) || '/' || strftime(month, '%-m/%Y')
         ELSE '-' END AS "FECHA RETIRO",
    {day_band_sql('asg + ret')} AS "GRUPO RANGO DE DIAS",
    asg + ret AS "RANGO DE DIAS", asg AS "DIAS ASIGNADA", ret AS "DIAS RETIRADA",
    CASE WHEN last_day < month_last_day THEN 'Recuperada' ELSE 'En gestion' END AS "ESTADO CUENTA",
    strftime(month, '%-m') AS "MES DE ASIGNACION", strftime(month, '%Y') AS "PERIODO DE ASIGNACION",
    {labels}
  FROM cal),
disc AS (
  SELECT CAST(o_custkey AS VARCHAR) || CAST(o_custkey % 7 AS VARCHAR) || '-' AS dk,
         max(CAST(l_discount * 100 + l_tax AS DECIMAL(7,4))) AS pct
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1),
c3t AS (
  SELECT c2.*, coalesce(disc.pct, 0) AS pct, coalesce(CAST(disc.pct AS VARCHAR), '0') AS "PORCENTAJE"
  FROM c2 LEFT JOIN disc ON c2."CUENTA_NEXT" = disc.dk),
c4 AS (
  SELECT *, CASE WHEN pct = 0 THEN CAST(0 AS DECIMAL(24,6))
    ELSE CAST("VALOR DEUDA" * (CAST(1 AS DECIMAL(14,10)) - CAST(pct * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,10))) AS DECIMAL(24,6)) END AS vd
  FROM c3t),
c5 AS (
  SELECT * EXCLUDE ("VALOR DEUDA"),
    replace(CAST("VALOR DEUDA" AS VARCHAR), '.', ',') AS "VALOR DEUDA",
    replace(CAST(CAST(vd AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS "VALOR DESCUENTO",
    {_debt_band_sql('vd', zero=True)} AS "RANGO CON DESCUENTO",
    CASE WHEN "DOCUMENTO" IS NULL THEN 'No aplica'
         WHEN count(*) OVER w > 1 THEN 'Aplica' ELSE 'No aplica' END AS "MULTICUENTA",
    CASE WHEN "DOCUMENTO" IS NULL THEN 'No aplica'
         WHEN max("CRM") OVER w > min("CRM") OVER w THEN 'Aplica' ELSE 'No aplica' END AS "MULTIPRODUCTO",
    CASE WHEN "DOCUMENTO" IS NULL THEN 'No aplica'
         WHEN max("MARCA") OVER w > min("MARCA") OVER w THEN 'Aplica' ELSE 'No aplica' END AS "MULTIMORA"
  FROM c4 WINDOW w AS (PARTITION BY month, "DOCUMENTO"))
SELECT {out_cols} FROM c5"""


@register("assignment_table", _assignment_sql())
def assignment_table(spark, sf):
    from .assignment import assignment_base
    return assignment_base(*_raw_assignment(spark, sf))
