"""Column types inferred over files whose columns change type.

Files are read as text by header groups (:func:`delimited.read_by_header`).
One aggregate over all of them asks of every column which types hold ALL its
values, so the type of a column is the join of its files' types in the order

    int < bigint < decimal < double < text      date < text

The aggregate is one pass with partial sums, whatever the number of files,
and gives one row. A type is only taken if it loses nothing: numbers with
leading zeros or a plus sign, and decimals of more than 38 digits, are text
(an account ``007`` isn't 7); an exponent makes a double. Blank and empty
values are null and fit every type; a column without any value is text.
Blanks around a value don't count. ``True`` and times of day stay text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import read_by_header

INT = r"^-?(?:0|[1-9][0-9]*)$"
DECIMAL = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?$"
DOUBLE = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$"
#: Written forms of a day, in the order they are tried; a column has one of them throughout.
DATES = ("yyyy-MM-dd", "d/M/yyyy")


def _value(name: str) -> Column:
    v = F.trim(F.col(f"`{name}`"))
    return F.when(v != "", v)


def _evidence(name: str, k: int) -> list[Column]:
    """What all values of a column have in common, and how many digits they need."""
    v = _value(name)
    number = v.rlike(DECIMAL)
    whole = F.length(F.regexp_replace(F.regexp_extract(v, r"^-?([0-9]+)", 1), "^0$", ""))
    scale = F.length(F.regexp_extract(v, r"\.([0-9]+)$", 1))
    every = lambda c: F.min(F.when(v.isNotNull(), c))
    out = [every(v.rlike(INT) & v.try_cast("int").isNotNull()).alias(f"int{k}"), every(v.rlike(INT) & v.try_cast("bigint").isNotNull()).alias(f"big{k}"),
           every(number).alias(f"dec{k}"), every(v.rlike(DOUBLE)).alias(f"dbl{k}"), F.max(F.when(number, whole)).alias(f"whole{k}"), F.max(F.when(number, scale)).alias(f"scale{k}")]
    return out + [every(F.try_to_date(v, f).isNotNull()).alias(f"day{k}_{j}") for j, f in enumerate(DATES)]


def decimal_type(whole: int, scale: int) -> str | None:
    """The decimal of 18 or 38 digits that holds so many before and behind the point."""
    return next((f"decimal({p},{scale})" for p in (18, 38) if whole + scale <= p), None)


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple[str, str | None]]:
    """Column -> (type, format of dates). One job; a row of flags comes back."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return {}
    seen = df.agg(*[c for k, name in enumerate(columns) for c in _evidence(name, k)]).first()
    out: dict[str, tuple[str, str | None]] = {}
    for k, name in enumerate(columns):
        kind: tuple[str, str | None] = ("string", None)
        if seen[f"int{k}"]:
            kind = ("int", None)
        elif seen[f"big{k}"]:
            kind = ("bigint", None)
        elif seen[f"dec{k}"]:
            kind = (decimal_type(seen[f"whole{k}"], seen[f"scale{k}"]) or "string", None)
        elif seen[f"dbl{k}"]:
            kind = ("double", None)
        else:
            day = next((f for j, f in enumerate(DATES) if seen[f"day{k}_{j}"]), None)
            if day:
                kind = ("date", day)
        out[name] = kind
    return out


def with_types(df: DataFrame, types: dict[str, tuple[str, str | None]]) -> DataFrame:
    """``df`` with its text columns cast; columns that ``types`` doesn't name stay as they are."""
    def typed(name: str) -> Column:
        kind, day = types.get(name, (None, None))
        if kind is None or kind == "string":
            return F.col(f"`{name}`")
        return (F.try_to_date(_value(name), day) if day else _value(name).cast(kind)).alias(name)
    return df.select(*[typed(c) for c in df.columns])


def read_typed(spark: SparkSession, files: str | Sequence[str], columns: Sequence[str] | None = None, sep: str | None = ";", encoding: str = "UTF-8") -> DataFrame:
    """All files by column name, each column in the narrowest type that holds
    its values in every file; a column that a file lacks is null there."""
    df = read_by_header(spark, files, columns, sep=sep, encoding=encoding)
    return with_types(df, infer_types(df))
