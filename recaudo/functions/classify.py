"""Row-level classification rules: brand, segment, reference, document type,
discount.

All are single CASE expressions over typed columns, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .bands import debt_band


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def brand(mark_potential, mark_prepotential, mark_writeoff, mark_refinanced,
          crm, campaign, debt_age) -> Column:
    """Portfolio brand of an account, first matching rule wins.

    A NULL mark makes its rule NULL, so the row falls through to the next
    rule; without any rule the debt-age text is the brand. Debt ages 120,
    150 and 180 are merged; a pre-potential BSCS account of the two special
    campaigns becomes "Prepotencial Especial".
    """
    m5, m6, m7, m43 = (_c(x) for x in (mark_potential, mark_prepotential,
                                        mark_writeoff, mark_refinanced))
    crm, campaign, debt_age = _c(crm), _c(campaign), _c(debt_age)
    rr_sga = crm.isin("RR", "SGA")
    special = campaign.isin(*fixed.PREPOTENCIAL_ESPECIAL_CAMPAIGNS)
    # the debt age, which may itself be spelled as a brand, passes the merge and the special case as well
    by_age = (
        F.when(debt_age.isin(*fixed.BRAND_ARREARS_MERGED), F.lit(fixed.BRAND_ARREARS_MERGED_LABEL))
        .when((debt_age == fixed.BRAND_PREPOTENCIAL) & (crm == "BSCS") & special, F.lit(fixed.BRAND_PREPOTENCIAL_ESPECIAL))
        .otherwise(debt_age)
    )
    return (
        F.when((m5 == "Y") & (crm == "BSCS"), F.lit(fixed.BRAND_POTENCIAL))
        .when((m5 == "Y") & rr_sga, F.lit(fixed.BRAND_CHURN))
        .when((m5 == "Y") & (crm == "ASCARD"), F.lit(fixed.BRAND_PROVISION))
        .when((m6 == "Y") & (crm == "BSCS"),
              F.when(special, F.lit(fixed.BRAND_PREPOTENCIAL_ESPECIAL)).otherwise(F.lit(fixed.BRAND_PREPOTENCIAL)))
        .when((m6 == "Y") & rr_sga, F.lit(fixed.BRAND_PRECHURN))
        .when((m6 == "Y") & (crm == "ASCARD"), F.lit(fixed.BRAND_PREPROVISION))
        .when(m7 == "Y", F.lit(fixed.BRAND_CASTIGO))
        .when((m5 == "N") & (m6 == "N") & (m7 == "N") & (m43 == "Y"),
              F.lit(fixed.BRAND_POTENCIAL_A_CASTIGAR))
        .otherwise(by_age)
    )


def segment(customer_type: Column | str) -> Column:
    """Persons for the person customer types, business otherwise (NULL too)."""
    return F.when(_c(customer_type).isin(*fixed.PERSON_CUSTOMER_TYPES),
                  F.lit(fixed.SEGMENT_PERSON)).otherwise(F.lit(fixed.SEGMENT_BUSINESS))


def reference(ref: Column | str, crm: Column | str, account: Column | str) -> Column:
    """Payment reference: for RR accounts the account itself; otherwise the
    given reference, "0" when missing."""
    ref, crm, account = _c(ref), _c(crm), _c(account)
    return (F.when(crm == "RR", account)
            .when(ref.isNull(), F.lit(fixed.REFERENCE_DEFAULT))
            .otherwise(ref))


def reference_flag(ref: Column | str) -> Column:
    return F.when(F.length(_c(ref)) > 3, F.lit(fixed.REFERENCE_WITH)) \
        .otherwise(F.lit(fixed.REFERENCE_WITHOUT))


def document_letters(doc: Column | str) -> Column:
    return F.regexp_replace(_c(doc), "[^a-zA-Z]+", "")


def document_number(doc: Column | str) -> Column:
    """Digits of the document; '' when there are none (use
    ``keys.blank_to_null`` before grouping on it)."""
    return F.regexp_replace(_c(doc), "[^0-9]+", "")


def document_type(doc: Column | str) -> Column:
    """Document type name from the letters of the document text."""
    letters = document_letters(doc)
    expr = None
    for code, name in fixed.DOCUMENT_TYPES:
        expr = F.when(letters == code, F.lit(name)) if expr is None \
            else expr.when(letters == code, F.lit(name))
    return expr.when(letters.isNull(), F.lit(fixed.DOCUMENT_TYPE_NULL)) \
        .otherwise(F.lit(fixed.DOCUMENT_TYPE_OTHER))


#: Percentages keep eight decimals, and the source text stays beside them.
PERCENTAGE = "decimal(12,8)"


def discounted_value(debt: Column | str, pct: Column | str) -> Column:
    """Debt after a percentage discount, exact decimal arithmetic; 0 when
    there is no discount. ``debt`` decimal(18,2), ``pct`` PERCENTAGE."""
    debt, pct = _c(debt), _c(pct)
    factor = (F.lit(1).cast("decimal(14,10)") - (pct / F.lit(100)).cast("decimal(14,10)"))
    return F.when(pct == 0, F.lit(0).cast("decimal(24,6)")) \
        .otherwise((debt * factor).cast("decimal(24,6)"))


def discount_band(value: Column | str) -> Column:
    return debt_band(value, zero_label=True)


def discount_filter(pct: Column | str) -> Column:
    """"Aplica" for a positive discount; 0 or missing -> "No Aplica"."""
    return F.when(F.coalesce(_c(pct), F.lit(0)) == 0, F.lit(fixed.DISCOUNT_NOT_APPLIES)) \
        .otherwise(F.lit(fixed.DISCOUNT_APPLIES))


def decimal_comma(c: Column | str) -> Column:
    """Decimal amount as text with a decimal comma (``12500000,50``)."""
    return F.translate(_c(c).cast("string"), ".", ",")
