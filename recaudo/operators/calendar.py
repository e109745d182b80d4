"""Assignment calendar: per account and month, which days the account was in
the assigned base, when it entered, when it left, and the gaps.

Input is one row per (account, day assigned). Instead of materialising 31
slot columns and rewriting them in five passes, the days of a month are
folded into a 31-bit mask by one partial aggregate (``bit_or``), together
with the first and last day. Every output is a closed form of (mask, first,
last, last day present in the month):

* day d is ``Asignada`` when its bit is set; ``Sin reasignar`` when it lies
  strictly between first and last day without being assigned; ``Retirada``
  when it is the day after the last assigned day and that day exists in the
  data of the month; otherwise ''.
* ``dias_asignada`` = bits set; ``dias_retirada`` = gap days + 1 when the
  account left before the last day of the month; ``rango_de_dias`` = sum.
* ``fecha_retiro`` = day after the last assigned day when that is before the
  month's last day, else ``-``; ``estado_cuenta`` = ``Recuperada`` then,
  ``En gestion`` otherwise.

Scale: one shuffle (the aggregate, map-side combined, so a hot account costs
one partial row per map task). The month table (one row per calendar month
present, at most 120,000 rows for the whole date range) is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.bands import day_band
from .joins import broadcast_bounded

# a DateType column has at most 9999 * 12 distinct months
MAX_MONTHS = 9999 * 12


def day_mask_agg(df: DataFrame, keys: Sequence[str], date_col: str,
                 attrs: Sequence[str] = (), extra_aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per (keys, month): ``day_mask`` (bigint), ``first_day``,
    ``last_day`` and, when ``attrs`` are given, a struct ``first_row`` with
    those columns from the row with the earliest date (ties: smallest
    values, so the choice is deterministic)."""
    d = F.to_date(F.col(date_col))
    day = F.dayofmonth(d)
    aggs = [
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), day - 1)).alias("day_mask"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    ]
    if attrs:
        aggs.append(F.min(F.struct(d.alias("_d"), *[F.col(a) for a in attrs])).alias("first_row"))
    aggs += [c.alias(n) for n, c in (extra_aggs or {}).items()]
    out = df.groupBy(*[F.col(k) for k in keys], F.trunc(d, "month").alias("month")).agg(*aggs)
    # rows without a date fold into a group without a day, left out here: a filter on the date
    # itself would parse it twice a row. The condition reads every day aggregate, so that plans
    # which read this table twice need the same columns of it and share one shuffle.
    return out.where((F.col("day_mask") > 0) & (F.col("first_day") <= F.col("last_day")))


def undated_rows(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Rows without a date have no day in any month: the calendar leaves them
    out, and this reports how many each key has (``undated``)."""
    return df.where(F.col(date_col).isNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("undated"))


def month_last_days(df: DataFrame, date_col: str) -> DataFrame:
    """Last day of each month that is present in the data (D15: per month,
    not one global maximum)."""
    d = F.to_date(F.col(date_col))
    return df.where(F.col(date_col).isNotNull()).groupBy(F.trunc(d, "month").alias("month")) \
        .agg(F.max(F.dayofmonth(d)).alias("month_last_day"))


def calendar_columns(mask: Column, first: Column, last: Column, month_last: Column,
                     month: Column) -> dict[str, Column]:
    """The closed-form outputs as named columns."""
    assigned = F.bit_count(mask).cast("int")
    left_early = last < month_last
    gaps = (last - first + 1 - assigned)
    retired = (gaps + F.when(left_early, 1).otherwise(0)).cast("int")
    # month/year as the day-of-assignment text writes them (d/M/yyyy)
    mm_yyyy = F.date_format(month, "M/yyyy")
    return {
        "dias_asignada": F.coalesce(assigned, F.lit(0)),
        "dias_retirada": F.coalesce(retired, F.lit(0)),
        "rango_de_dias": F.coalesce(assigned + retired, F.lit(0)),
        "fecha_ingreso": F.coalesce(F.concat(first.cast("string"), F.lit("/"), mm_yyyy), F.lit("")),
        "fecha_retiro": F.when(left_early, F.concat((last + 1).cast("string"), F.lit("/"), mm_yyyy))
                         .otherwise(F.lit(fixed.NO_EXIT_DATE)),
        "estado_cuenta": F.when(left_early, F.lit(fixed.STATUS_RECOVERED))
                          .otherwise(F.lit(fixed.STATUS_ACTIVE)),
    }


def day_status_array(mask: str, first: str, last: str, month_last: str) -> Column:
    """All 31 day labels as one ``array<string>``. Before the first day and
    after the last the labels are constant, so only the days between (one for
    most accounts) are looked up in the mask."""
    return F.expr(
        f"coalesce(slice(concat(array_repeat('', {first} - 1), "
        f"transform(sequence({first}, {last}), d -> CASE WHEN shiftright({mask}, d - 1) & 1 = 1 "
        f"THEN '{fixed.DAY_ASSIGNED}' ELSE '{fixed.DAY_GAP}' END), "
        f"CASE WHEN {last} < {month_last} THEN array('{fixed.DAY_WITHDRAWN}') ELSE array('') END, "
        f"array_repeat('', {fixed.DAY_SLOTS} - {last})), 1, {fixed.DAY_SLOTS}), array_repeat('', {fixed.DAY_SLOTS}))")


def assignment_calendar(df: DataFrame, keys: Sequence[str], date_col: str,
                        attrs: Sequence[str] = (), labels: str | None = "array",
                        day_prefix: str = "dia_", extra_aggs: Mapping[str, Column] | None = None,
                        wide: bool = False, dates: DataFrame | None = None) -> DataFrame:
    """Calendar per (keys, month); rows without a date are left out (see
    :func:`undated_rows`). ``dates``: the date column alone, where it is
    cheaper to read than from ``df`` (the last day of each month needs no
    more than that).

    ``labels``: ``"array"`` adds ``day_status`` (array of 31 labels),
    ``"wide"`` adds ``dia_1`` .. ``dia_31``, ``None`` adds no labels (the
    counts, dates and status do not need them). ``attrs`` come from the
    earliest row of the month; ``extra_aggs`` ({name: aggregate}) ride along
    in the same aggregate.
    """
    if wide:
        labels = "wide"
    return calendar_of(day_mask_agg(df, keys, date_col, attrs, extra_aggs), month_last_days(df if dates is None else dates, date_col),
                       keys, attrs, labels, day_prefix, list(extra_aggs or {}))


def calendar_of(masks: DataFrame, last_days: DataFrame, keys: Sequence[str], attrs: Sequence[str] = (), labels: str | None = "array",
                day_prefix: str = "dia_", extra: Sequence[str | Column] = ()) -> DataFrame:
    """The calendar's columns from the folded days (:func:`day_mask_agg`) and the last day of each month.
    ``extra``: further columns of ``masks``, or expressions over them."""
    months = broadcast_bounded(last_days, MAX_MONTHS, reason="one row per calendar month")
    j = masks.join(months, "month", "left") \
        .withColumn("day_mask", F.coalesce(F.col("day_mask"), F.lit(0).cast("bigint")))
    mask = F.col("day_mask")
    first, last, mlast = F.col("first_day"), F.col("last_day"), F.col("month_last_day")
    cols = calendar_columns(mask, first, last, mlast, F.col("month"))
    out = [*[F.col(k) for k in keys], F.col("month"), mask, first, last, mlast]
    out += [c.alias(n) for n, c in cols.items()]
    out.append(day_band(cols["rango_de_dias"]).alias("grupo_rango_de_dias"))
    if attrs:
        out += [F.col("first_row")[a].alias(a) for a in attrs]
    out += [F.col(f"`{n}`") if isinstance(n, str) else n for n in extra]
    if labels:
        out.append(day_status_array("day_mask", "first_day", "last_day", "month_last_day")
                   .alias("day_status"))
    res = j.select(*out)
    if labels == "wide":
        res = res.select("*", *[F.col("day_status")[d - 1].alias(f"{day_prefix}{d}")
                                for d in range(1, fixed.DAY_SLOTS + 1)]).drop("day_status")
    return res
