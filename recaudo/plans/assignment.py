"""Assignment base: daily files of assigned accounts -> one row per account
and month with brand, segment, debt band, reference, document type, clean
name, the assignment calendar, discount and multi-flags.

Input (all text, as exported): positional columns ``1_`` .. ``57_``; used:
``1_`` document, ``2_`` account, ``3_`` billing system (CRM), ``5_`` / ``6_``
/ ``7_`` potential / pre-potential / write-off marks, ``9_`` debt, ``12_``
campaign, ``13_`` debt age, ``24_`` name, ``26_`` due date, ``27_``
reference, ``42_`` customer type, ``43_`` refinanced mark, ``57_`` day of
assignment (``d/M/yyyy``). Discounts: ``CUENTA``, ``PORCENTAJE``.

Plan: filter the embedded header rows first; ONE aggregate per (account,
month) for the calendar and the representative (earliest) raw row; the
row-level rules run on that row only (once per account and month, not once
per assigned day); one left join for the discounts (reduced to one row per
account); one aggregate + join for the multi-flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, classify, dates, fixed, keys, text
from ..operators import calendar, flags
from ..operators.discount import apply_discounts

HEADER_MARK = "CRM Origen"

LAYOUT, TAIL = fixed.ASSIGNMENT_LAYOUT, fixed.ASSIGNMENT_TAIL
DAY_COLUMNS = [f"Dia_{d}" for d in range(1, fixed.DAY_SLOTS + 1)]
_ROW_ATTRS = ["DOCUMENTO", "TIPO DE DOCUMENTO", "CUENTA_NEXT", "MARCA", "CRM", "SEGMENTO",
              "CUSTOMER TYPE", "RANGO DEUDA", "VALOR DEUDA", "FECHA VENCIMIENTO", "REFERENCIA",
              "FILTRO REFERENCIA", "NOMBRE"]
# what the joins need of the row, and what the calendar's columns are derived from
_JOIN_ATTRS = ["DOCUMENTO", "CUENTA_NEXT", "MARCA", "CRM", "VALOR DEUDA"]
_DAYS = ["CUENTA", "month", "day_mask", "first_day", "last_day"]
CALENDAR_NAMES = {"fecha_ingreso": "FECHA INGRESO", "fecha_retiro": "FECHA RETIRO", "grupo_rango_de_dias": "GRUPO RANGO DE DIAS",
                  "rango_de_dias": "RANGO DE DIAS", "dias_asignada": "DIAS ASIGNADA", "dias_retirada": "DIAS RETIRADA",
                  "estado_cuenta": "ESTADO CUENTA"}
# raw columns the row-level rules read (kept from the earliest row of the month)
RAW_USED = ["1_", "2_", "3_", "5_", "6_", "7_", "9_", "12_", "13_", "24_", "26_", "27_", "42_", "43_"]


def row_columns() -> dict[str, Column]:
    """Row-level columns of the assignment base from the raw text columns."""
    c = F.col
    debt = bands.to_amount("9_")
    ref = classify.reference("27_", "3_", "2_")
    return {
        "DOCUMENTO": keys.blank_to_null(classify.document_number("1_")),
        "TIPO DE DOCUMENTO": classify.document_type("1_"),
        "CUENTA_NEXT": keys.account_key("2_"),
        "MARCA": classify.brand("5_", "6_", "7_", "43_", "3_", "12_", "13_"),
        "CRM": c("3_"),
        "SEGMENTO": classify.segment("42_"),
        "CUSTOMER TYPE": c("42_"),
        "RANGO DEUDA": bands.debt_band(debt),
        "VALOR DEUDA": debt,
        "FECHA VENCIMIENTO": c("26_"),
        "REFERENCIA": ref,
        "FILTRO REFERENCIA": classify.reference_flag(ref),
        "NOMBRE": text.clean_person_name("24_"),
    }


def assignment_days(raw: DataFrame) -> DataFrame:
    """One row per account and assigned day; a day that is no date is NULL
    (``calendar.undated_rows(assignment_days(raw), ["CUENTA"], "_fecha")``
    reports such rows, which the calendar leaves out)."""
    return raw.where(F.col("3_") != HEADER_MARK).select(
        F.concat(F.col("2_"), F.lit("-")).alias("CUENTA"), dates.parse_dmy("57_").alias("_fecha"), *RAW_USED)


def assignment_base(raw: DataFrame, discounts: DataFrame, dates_of: DataFrame | None = None) -> DataFrame:
    """Only the earliest row of an account's month reaches the report, so the
    raw row is picked first (inside the calendar aggregate) and the
    row-level rules run once per account and month instead of once per
    assigned day. ``dates_of``: columns ``3_`` and ``57_`` of ``raw``, where
    they can be read without the joins that build the other columns."""
    masks = calendar.day_mask_agg(assignment_days(raw), ["CUENTA"], "_fecha", RAW_USED)
    # the joins carry the raw row and the folded days; the rules that no join needs and the labels come last
    rules = row_columns()
    out = masks.select(*_DAYS, *[F.col("first_row")[a].alias(a) for a in RAW_USED]) \
        .withColumns({n: rules[n] for n in _JOIN_ATTRS})
    disc = discounts.select(keys.account_key("CUENTA").alias("_dk"),
                            F.col("PORCENTAJE").alias("_pt"))
    out = apply_discounts(out, disc, "CUENTA_NEXT", "_dk", "VALOR DEUDA", "_pt")
    out = out.drop("porcentaje", "filtro_descuento", "valor_descuento_texto")
    out = out.withColumnsRenamed({"porcentaje_texto": "PORCENTAJE", "valor_descuento": "VALOR DESCUENTO",
                                  "rango_con_descuento": "RANGO CON DESCUENTO"})
    # flags per document within the month (one file set = one month); the document leads,
    # so that sorts are decided by the key's first bytes
    out = out.withColumn("_doc_month", F.when(F.col("DOCUMENTO").isNotNull(),
                                              F.concat_ws("|", F.col("DOCUMENTO"), F.col("month").cast("string"))))
    out = flags.multi_flags(out, "_doc_month", "CUENTA",
                            {"MULTIPRODUCTO": "CRM", "MULTIMORA": "MARCA"}, rows_flag="MULTICUENTA")
    last_days = calendar.month_last_days((raw if dates_of is None else dates_of).where(F.col("3_") != HEADER_MARK)
                                         .select(dates.parse_dmy("57_").alias("_fecha")), "_fecha")
    # the rules stand in the labels' projection, which Spark compiles function by function; with
    # the joins they would make one method that the JVM doesn't compile
    out = calendar.calendar_of(out, last_days, ["CUENTA"], labels="array", extra=[
        *[c for c in out.columns if c not in _DAYS and c not in RAW_USED], *[rules[n].alias(n) for n in _ROW_ATTRS if n not in _JOIN_ATTRS]])
    out = out.withColumnsRenamed(CALENDAR_NAMES).withColumns({
        "MES DE ASIGNACION": F.date_format("month", "M"),
        "PERIODO DE ASIGNACION": F.date_format("month", "yyyy"),
        **{f"Dia_{d}": F.col("day_status")[d - 1] for d in range(1, fixed.DAY_SLOTS + 1)},
        "VALOR DEUDA": classify.decimal_comma(F.col("VALOR DEUDA")),
        "VALOR DESCUENTO": classify.decimal_comma(F.col("VALOR DESCUENTO").cast("decimal(18,2)")),
    })
    return out.select(*[F.col(f"`{c}`") for c in LAYOUT + DAY_COLUMNS + TAIL])
