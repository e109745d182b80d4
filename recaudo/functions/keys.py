"""Business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def account_key(c: Column | str, strip: str = ".-") -> Column:
    """Canonical account key: punctuation in ``strip`` removed, then a
    trailing ``-`` (keeps spreadsheets from turning the key into a number).

    Every source spells the account differently; all joins go through this
    one function so that the spellings meet.
    """
    pattern = "[" + "".join("\\" + ch for ch in strip) + "]"
    return F.concat(F.regexp_replace(_c(c), pattern, ""), F.lit("-"))


def blank_to_null(c: Column | str) -> Column:
    """'' (and blanks only) -> NULL, so that empty keys never group together."""
    c = _c(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)
