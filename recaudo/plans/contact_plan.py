"""Contact table: a contact list (identificacion, cuenta, dato) -> one row
per (account, document) with up to 20 phone and 5 e-mail slots, counts per
kind and the contact-profile label.

One scan of the list: each value is classified once, phones and e-mails
are ranked by one window and pivoted by one aggregate (the reference scans
the list twice, unions, ranks, pivots, joins back and full-outer joins the
two halves).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, keys
from ..operators import contacts
from ..operators.topn import slot_columns
from ..sources.delimited import write_delimited


def contact_table(raw: DataFrame, month: int, year: int,
                  mobile=fixed.MOBILE_RANGE, landline=fixed.LANDLINE_RANGE,
                  phone_slots: int = fixed.PHONE_SLOTS, email_slots: int = fixed.EMAIL_SLOTS,
                  counted_phone_slots: int | None = None, order_by_slot_code: bool = False,
                  mobile_count=fixed.MOBILE_COUNT_RANGE,
                  landline_count=fixed.LANDLINE_COUNT_RANGE) -> DataFrame:
    """``order_by_slot_code`` sorts the sink by the per-slot code (mobiles
    first, then landlines, then empty slots) - a global sort, only when the
    file is meant to be read in that order."""
    d = raw.select(F.col("identificacion"), keys.account_key("cuenta", strip="-").alias("cuenta"),
                   F.trim(F.col("dato")).alias("dato"))
    c = contacts.classify_contacts(d, "dato", mobile, landline)
    s = contacts.contact_slots(c, ["cuenta", "identificacion"], "dato", phone_slots, email_slots,
                               mobile_count=mobile_count, landline_count=landline_count,
                               counted_phone_slots=counted_phone_slots)
    label = contacts.profile_label("num_movil", "num_fijo", "num_email")
    counts = {n: F.when(F.coalesce(F.col(c_), F.lit(0)) == 0, F.lit("")).otherwise(F.col(c_).cast("string"))
              for n, c_ in (("NumMovil", "num_movil"), ("NumFijo", "num_fijo"), ("NumEmail", "num_email"))}
    out = s.select(
        "identificacion", "cuenta", *[v.alias(k) for k, v in counts.items()],
        label.alias("Filtro Demografico"),
        F.lit(month).alias("MES DE ASIGNACION"), F.lit(year).alias("PERIODO DE ASIGNACION"),
        *slot_columns("phone", phone_slots), *slot_columns("email", email_slots))
    if order_by_slot_code:
        out = out.orderBy(contacts.slot_order_code(slot_columns("phone", phone_slots)))
    return out


def write_contact_table(table: DataFrame, path: str, phone_slots: int = fixed.PHONE_SLOTS, sep: str = ";") -> bool:
    """Writes a contact table so that its files, read by name, list the rows
    by slot code (mobiles first, then landlines, then empty slots), then account."""
    code = contacts.slot_order_code(slot_columns("phone", phone_slots))
    return write_delimited(table, path, sep=sep, order_by=[code, "cuenta", "identificacion"])
