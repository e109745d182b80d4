"""Date parsing for ``d/M/yyyy`` text and days in arrears."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bands import arrears_band

DMY = "d/M/yyyy"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_dmy(c: Column | str) -> Column:
    """``d/M/yyyy`` or ``dd/MM/yyyy`` text -> date; impossible dates
    (31/02/2025), junk and NULL -> NULL (never an error)."""
    return F.try_to_date(F.trim(_c(c)), DMY)


def format_dmy(c: Column | str) -> Column:
    """date/timestamp -> ``d/M/yyyy`` text."""
    return F.date_format(_c(c), DMY)


def days_in_arrears(entry_text: Column | str, due_text: Column | str) -> Column:
    """Days between due date and entry date, NULL unless both parse."""
    return F.datediff(parse_dmy(entry_text), parse_dmy(due_text))


def arrears(entry_text: Column | str, due_text: Column | str) -> tuple[Column, Column]:
    """(days in arrears, arrears band)."""
    d = days_in_arrears(entry_text, due_text)
    return d, arrears_band(d)
