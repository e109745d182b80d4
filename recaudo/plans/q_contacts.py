"""Catalog entries for contact data: extraction from whole document texts,
top-N slots, row-wise slot counts, slot order code, contact profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contacts, topn
from ..sources.tables import table
from .registry import register

# The driver documents carry North-American style numbers; these ranges play
# the role of the mobile / landline ranges for them (query parameters).
DOC_MOBILE = (2000000000, 5999999999)
DOC_LANDLINE = (6000000000, 9999999999)
PHONES, EMAILS = 20, 5


def _contact_list(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("cuenta"), F.col("source").alias("identificacion"), "text")
    return contacts.extract_contacts(d, "text", ["cuenta", "identificacion"])


def _classified(spark, sf):
    return contacts.classify_contacts(_contact_list(spark, sf), "dato", DOC_MOBILE, DOC_LANDLINE)


def _slots(spark, sf, kinds=None):
    c = _classified(spark, sf)
    if kinds:
        c = c.where(F.col("kind").isin(*kinds))
    return contacts.contact_slots(c, ["cuenta", "identificacion"], "dato", PHONES, EMAILS,
                                  mobile_count=DOC_MOBILE, landline_count=DOC_LANDLINE)


_SQL_CL = f"""
WITH src AS (SELECT CAST(doc_id AS VARCHAR) AS cuenta, source AS identificacion, text FROM documents),
ex AS (
  SELECT cuenta, identificacion, unnest(list_concat(
      regexp_extract_all(text, '{contacts.EMAIL_PATTERN}'),
      list_transform(regexp_extract_all(text, '{contacts.PHONE_PATTERN}'),
                     lambda p: regexp_replace(p, '[^0-9]', '', 'g')))) AS dato
  FROM src),
cl AS (
  SELECT *, CASE WHEN TRY_CAST(trim(dato) AS BIGINT) BETWEEN {DOC_MOBILE[0]} AND {DOC_MOBILE[1]} THEN 'mobile'
                 WHEN TRY_CAST(trim(dato) AS BIGINT) BETWEEN {DOC_LANDLINE[0]} AND {DOC_LANDLINE[1]} THEN 'landline'
                 WHEN contains(dato, '@') THEN 'email' END AS kind
  FROM ex)
"""


@register("contact_extract", _SQL_CL + "SELECT cuenta, identificacion, dato, kind FROM cl WHERE kind IS NOT NULL")
def contact_extract(spark, sf):
    return _classified(spark, sf).select("cuenta", "identificacion", "dato", "kind")


def _slots_cte(name: str, kind_filter: str = "") -> str:
    """CTE ``name``: slots and counts per (cuenta, identificacion), the SQL
    twin of contacts.contact_slots."""
    n = "TRY_CAST(trim(dato) AS BIGINT)"
    cols = [f"max(CASE WHEN grp = 'phone' AND slot = {i} THEN dato END) AS phone{i}" for i in range(1, PHONES + 1)]
    cols += [f"max(CASE WHEN grp = 'email' AND slot = {i} THEN dato END) AS email{i}" for i in range(1, EMAILS + 1)]
    cols += [
        f"CAST(count(*) FILTER (WHERE grp = 'phone' AND slot <= {PHONES} AND {n} BETWEEN {DOC_MOBILE[0]} AND {DOC_MOBILE[1]}) AS INTEGER) AS num_movil",
        f"CAST(count(*) FILTER (WHERE grp = 'phone' AND slot <= {PHONES} AND {n} BETWEEN {DOC_LANDLINE[0]} AND {DOC_LANDLINE[1]}) AS INTEGER) AS num_fijo",
        f"CAST(count(*) FILTER (WHERE grp = 'email' AND slot <= {EMAILS} AND contains(dato, '@')) AS INTEGER) AS num_email",
    ]
    return f"""{name} AS (
  SELECT cuenta, identificacion, {', '.join(cols)}
  FROM (SELECT cuenta, identificacion, grp, dato,
               row_number() OVER (PARTITION BY cuenta, identificacion, grp ORDER BY dato) AS slot
        FROM (SELECT DISTINCT cuenta, identificacion,
                     CASE WHEN kind = 'email' THEN 'email' ELSE 'phone' END AS grp, dato
              FROM cl WHERE kind IS NOT NULL {kind_filter}))
  WHERE slot <= {max(PHONES, EMAILS)} GROUP BY cuenta, identificacion)"""


_PH = ", ".join(f"phone{i}" for i in range(1, PHONES + 1))
_EM = ", ".join(f"email{i}" for i in range(1, EMAILS + 1))


@register("contact_slots", _SQL_CL + ", " + _slots_cte("s") + f" SELECT cuenta, identificacion, {_PH}, {_EM}, num_movil, num_fijo, num_email FROM s")
def contact_slots(spark, sf):
    return _slots(spark, sf)


@register("slots_topn", """
SELECT o_custkey, """ + ", ".join(f"max(CASE WHEN rn = {i} THEN o_orderkey END) AS slot{i}" for i in range(1, 6)) + """
FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
      FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_orderkey IS NOT NULL))
WHERE rn <= 5 GROUP BY o_custkey""")
def slots_topn(spark, sf):
    o = table(spark, sf, "orders")
    return topn.top_n_slots(o, ["o_custkey"], "o_orderkey", 5, "slot")


def _rowwise_sql(lo, hi, prefix, n):
    return " + ".join(
        f"CASE WHEN TRY_CAST(trim({prefix}{i}) AS BIGINT) BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END"
        for i in range(1, n + 1))


@register("slot_counts", _SQL_CL + ", " + _slots_cte("s") + f"""
SELECT cuenta, identificacion,
  CAST({_rowwise_sql(DOC_MOBILE[0], DOC_MOBILE[1], 'phone', PHONES)} AS INTEGER) AS num_movil,
  CAST({_rowwise_sql(DOC_LANDLINE[0], DOC_LANDLINE[1], 'phone', PHONES)} AS INTEGER) AS num_fijo,
  CAST({' + '.join(f"CASE WHEN contains(email{i}, '@') THEN 1 ELSE 0 END" for i in range(1, EMAILS + 1))} AS INTEGER) AS num_email
FROM s""")
def slot_counts(spark, sf):
    s = _slots(spark, sf)
    ph = topn.slot_columns("phone", PHONES)
    em = topn.slot_columns("email", EMAILS)
    return s.select("cuenta", "identificacion",
                    contacts.count_in_range(ph, *DOC_MOBILE).alias("num_movil"),
                    contacts.count_in_range(ph, *DOC_LANDLINE).alias("num_fijo"),
                    contacts.count_containing(em, "@").alias("num_email"))


@register("slot_sort_key", _SQL_CL + ", " + _slots_cte("s", "AND kind <> 'email'") + """
SELECT cuenta, identificacion, """ + " || ".join(
    f"CASE WHEN phone{i} IS NULL OR phone{i} = '' THEN '3' "
    f"WHEN TRY_CAST(trim(phone{i}) AS BIGINT) <= {DOC_MOBILE[1]} THEN '1' ELSE '2' END"
    for i in range(1, PHONES + 1)) + " AS order_code FROM s")
def slot_sort_key(spark, sf):
    s = _slots(spark, sf, kinds=["mobile", "landline"])
    return s.select("cuenta", "identificacion",
                    contacts.slot_order_code(topn.slot_columns("phone", PHONES), DOC_MOBILE)
                    .alias("order_code"))


def _profile_sql() -> str:
    cols_ph = ", ".join(f"p.phone{i}" for i in range(1, PHONES + 1))
    cols_em = ", ".join(f"e.email{i}" for i in range(1, EMAILS + 1))
    return _SQL_CL + ", " + _slots_cte("ph", "AND kind <> 'email'") + ", " + \
        _slots_cte("em", "AND kind = 'email'") + f""",
j AS (
  SELECT coalesce(p.cuenta, e.cuenta) AS cuenta, coalesce(p.identificacion, e.identificacion) AS identificacion,
         p.num_movil, p.num_fijo, e.num_email, {cols_ph}, {cols_em}
  FROM ph p FULL OUTER JOIN em e ON p.cuenta = e.cuenta AND p.identificacion = e.identificacion)
SELECT cuenta, identificacion,
  CASE WHEN coalesce(num_movil, 0) > 0 AND coalesce(num_fijo, 0) > 0 AND coalesce(num_email, 0) > 0 THEN 'Celular Fijo Email'
       WHEN coalesce(num_movil, 0) > 0 AND coalesce(num_fijo, 0) > 0 THEN 'Celular Fijo'
       WHEN coalesce(num_movil, 0) > 0 AND coalesce(num_email, 0) > 0 THEN 'Celular Email'
       WHEN coalesce(num_movil, 0) > 0 THEN 'Celular'
       WHEN coalesce(num_fijo, 0) > 0 AND coalesce(num_email, 0) > 0 THEN 'Fijo Email'
       WHEN coalesce(num_fijo, 0) > 0 THEN 'Fijo'
       WHEN coalesce(num_email, 0) > 0 THEN 'Email'
       ELSE 'No posee Demograficos' END AS filtro_demografico,
  CASE WHEN coalesce(num_movil, 0) = 0 THEN '' ELSE CAST(num_movil AS VARCHAR) END AS num_movil,
  CASE WHEN coalesce(num_fijo, 0) = 0 THEN '' ELSE CAST(num_fijo AS VARCHAR) END AS num_fijo,
  CASE WHEN coalesce(num_email, 0) = 0 THEN '' ELSE CAST(num_email AS VARCHAR) END AS num_email,
  {_PH}, {_EM}
FROM j"""


@register("contact_profile", _profile_sql())
def contact_profile(spark, sf):
    return contacts.contact_profile(_slots(spark, sf))
