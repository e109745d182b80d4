"""Contact data: classify phone / e-mail values, rank them into fixed slots
per (account, document), count slots per kind, label the contact profile.

One pass over the contact list: every value is classified once (mobile,
landline, e-mail or junk) instead of scanning the input once per branch and
unioning; phones and e-mails are ranked by one window (partial
WindowGroupLimit before the shuffle) and pivoted by one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .topn import ranked_values

MOBILE, LANDLINE, EMAIL = "mobile", "landline", "email"


def contact_kind(value: Column | str, mobile=fixed.MOBILE_RANGE,
                 landline=fixed.LANDLINE_RANGE) -> Column:
    """mobile / landline by numeric range of the text, email when it has an
    ``@``; NULL for anything else (junk never errors: ``try_cast``)."""
    v = F.col(value) if isinstance(value, str) else value
    n = F.trim(v).try_cast("bigint")
    return (F.when(n.between(*mobile), F.lit(MOBILE))
            .when(n.between(*landline), F.lit(LANDLINE))
            .when(v.contains("@"), F.lit(EMAIL)))


def classify_contacts(df: DataFrame, value: str, mobile=fixed.MOBILE_RANGE,
                      landline=fixed.LANDLINE_RANGE) -> DataFrame:
    """Keep classifiable contacts, with ``kind``."""
    return df.withColumn("kind", contact_kind(value, mobile, landline)) \
        .where(F.col("kind").isNotNull())


def contact_slots(df: DataFrame, keys: Sequence[str], value: str,
                  phone_slots: int = fixed.PHONE_SLOTS, email_slots: int = fixed.EMAIL_SLOTS,
                  phone_prefix: str = "phone", email_prefix: str = "email",
                  mobile_count=fixed.MOBILE_COUNT_RANGE,
                  landline_count=fixed.LANDLINE_COUNT_RANGE,
                  counted_phone_slots: int | None = None) -> DataFrame:
    """``df`` has ``keys``, ``value`` and ``kind`` (see classify_contacts).

    One row per key with phone slots (distinct numbers in text order, mobiles
    and landlines together), e-mail slots, and the counts ``num_movil``,
    ``num_fijo``, ``num_email`` over all slots (D3: every slot counts;
    ``counted_phone_slots=16`` reproduces the old reports that counted
    phone slots 1..16 only).
    """
    counted = counted_phone_slots or phone_slots
    grp = F.when(F.col("kind") == EMAIL, F.lit(EMAIL)).otherwise(F.lit("phone"))
    d = df.withColumn("_grp", grp)
    n = max(phone_slots, email_slots)
    r = ranked_values(d.select(*keys, "_grp", value), [*keys, "_grp"], value, n)
    is_phone, is_mail = F.col("_grp") == "phone", F.col("_grp") == EMAIL
    v, slot = F.col(value), F.col("slot")
    num = F.trim(v).try_cast("bigint")
    aggs = [F.max(F.when(is_phone & (slot == i), v)).alias(f"{phone_prefix}{i}")
            for i in range(1, phone_slots + 1)]
    aggs += [F.max(F.when(is_mail & (slot == i), v)).alias(f"{email_prefix}{i}")
             for i in range(1, email_slots + 1)]
    aggs += [
        F.count_if(is_phone & (slot <= counted) & num.between(*mobile_count)).cast("int").alias("num_movil"),
        F.count_if(is_phone & (slot <= counted) & num.between(*landline_count)).cast("int").alias("num_fijo"),
        F.count_if(is_mail & (slot <= email_slots) & v.contains("@")).cast("int").alias("num_email"),
    ]
    return r.groupBy(*keys).agg(*aggs)


def count_in_range(cols: Sequence[str], lo: int, hi: int) -> Column:
    """Row-wise: how many of the slot columns hold a number in [lo, hi]."""
    arr = F.array(*[F.trim(F.col(c)).try_cast("bigint") for c in cols])
    return F.aggregate(arr, F.lit(0),
                       lambda acc, x: acc + F.when(x.between(lo, hi), 1).otherwise(0))


def count_containing(cols: Sequence[str], needle: str) -> Column:
    """Row-wise: how many of the slot columns contain ``needle``."""
    arr = F.array(*[F.col(c) for c in cols])
    return F.aggregate(arr, F.lit(0),
                       lambda acc, x: acc + F.when(x.contains(needle), 1).otherwise(0))


def slot_order_code(cols: Sequence[str], mobile=fixed.MOBILE_COUNT_RANGE) -> Column:
    """Per slot 1 mobile / 2 other number / 3 empty, as one text key (equal
    length, so text order = the numeric order the layout wants)."""
    codes = []
    for c in cols:
        x = F.col(c)
        n = F.trim(x).try_cast("bigint")
        codes.append(F.when(x.isNull() | (x == ""), F.lit("3"))
                     .when(n <= mobile[1], F.lit("1")).otherwise(F.lit("2")))
    return F.concat(*codes)


def profile_label(num_movil: Column | str, num_fijo: Column | str, num_email: Column | str) -> Column:
    """8-way contact-profile label; NULL counts are "none"."""
    m, f, e = [(F.col(c) if isinstance(c, str) else c) for c in (num_movil, num_fijo, num_email)]
    has = [F.coalesce(m, F.lit(0)) > 0, F.coalesce(f, F.lit(0)) > 0, F.coalesce(e, F.lit(0)) > 0]
    expr = None
    for pattern, label in fixed.PROFILE_LABELS:
        cond = F.lit(True)
        for flag, h in zip(pattern, has):
            if flag:
                cond = cond & h
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.PROFILE_NONE))


def contact_profile(slots: DataFrame) -> DataFrame:
    """The profile label of :func:`contact_slots` rows, and counts as text
    with '' for zero / missing."""
    out = slots.withColumn("filtro_demografico", profile_label("num_movil", "num_fijo", "num_email"))
    return out.withColumns({c: F.when(F.coalesce(F.col(c), F.lit(0)) == 0, F.lit("")).otherwise(F.col(c).cast("string"))
                            for c in ("num_movil", "num_fijo", "num_email")})


def merged_slots(df: DataFrame, keys: Sequence[str], phones: Sequence[str], emails: Sequence[str],
                 mobile_count=fixed.MOBILE_COUNT_RANGE, landline_count=fixed.LANDLINE_COUNT_RANGE) -> DataFrame:
    """Slot rows of several documents merged into one row per key: the
    distinct values of all of them, ranked into the same slots anew."""
    have = set(df.columns)

    def values(cols, kind):
        cols = [c for c in cols if c in have]
        if not cols:
            return F.array().cast("array<struct<dato:string,kind:string>>")
        return F.transform(F.filter(F.array(*[F.col(c) for c in cols]), lambda v: v.isNotNull()),
                           lambda v: F.struct(v.alias("dato"), F.lit(kind).alias("kind")))
    one = df.select(*keys, F.explode(F.concat(values(phones, "phone"), values(emails, EMAIL))).alias("v")) \
        .select(*keys, "v.dato", "v.kind")
    return contact_slots(one, keys, "dato", len(phones), len(emails), mobile_count=mobile_count, landline_count=landline_count)


# extraction patterns for free text (the driver's documents carry contacts
# inside prose)
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"\(\d{3}\) \d{3}-\d{4}"


def extract_contacts(df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """Whole-text extraction of e-mails and phone numbers (digits only), one
    row per occurrence: ``keep`` columns + ``dato``. Each regex runs only on
    texts that contain its mandatory character ('@', ') '): a substring test
    is far cheaper than a regex scan, and the result is the same."""
    t = F.col(text_col)
    none = F.array().cast("array<string>")
    mails = F.when(t.contains("@"), F.regexp_extract_all(t, F.lit(EMAIL_PATTERN), 0)).otherwise(none)
    phones = F.when(t.contains(") "), F.transform(
        F.regexp_extract_all(t, F.lit(PHONE_PATTERN), 0),
        lambda p: F.regexp_replace(p, r"[^0-9]", ""))).otherwise(none)
    return df.select(*keep, F.explode(F.concat(mails, phones)).alias("dato"))
