"""Consolidation helpers: header cleaning, tolerant projection, prefix
families, renames, and the left chain from a base with early base filters.

The reference consolidates ~11 sources with a chain of full outer joins and
filters on base columns at the very end; the filters reject every row
without a base, so the chain is a chain of LEFT joins from the (filtered)
base. Writing it that way keeps the base filters below the joins, joins
only the rows that survive, and lets same-key joins share one hash
partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_header, snake


def clean_headers(df: DataFrame) -> DataFrame:
    """Accents and ``{ } . ,`` removed from every column name (schema only)."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in have])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; names that do not exist are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def prefix_families(df: DataFrame, families: Mapping[str | None, Sequence[str]],
                    keep: Sequence[str] = ()) -> DataFrame:
    """One projection: every listed column that exists becomes
    ``prefix + lower_snake(name)``, those of the family ``None`` keep their
    names; ``keep`` columns come first, unchanged; other columns are dropped (catalogue order: families in the given order)."""
    have = set(df.columns)
    sel: list[Column] = [F.col(f"`{k}`") for k in keep if k in have]
    seen = set(keep)
    for prefix, cols in families.items():
        for c in cols:
            if c in have and c not in seen:
                sel.append(F.col(f"`{c}`").alias(c if prefix is None else prefix + snake(c)))
                seen.add(c)
    return df.select(*sel)


def consolidate(base: DataFrame, base_filter: Column | None,
                sides: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Filter the base first, then left-join each side (one row per key)."""
    out = base if base_filter is None else base.where(base_filter)
    for side, keys in sides:
        out = out.join(side, list(keys), "left")
    return out


def consolidate_full_outer(base: DataFrame, base_filter: Column,
                           sides: Sequence[tuple[DataFrame, Sequence[str]]],
                           base_marker: str) -> DataFrame:
    """The literal form: full outer chain, filters at the end. Equivalent to
    :func:`consolidate` when ``base_filter`` rejects rows without a base
    (``base_marker`` is a base column that is never NULL on base rows)."""
    out = base
    for side, keys in sides:
        out = out.join(side, list(keys), "full_outer")
    return out.where(F.col(base_marker).isNotNull() & base_filter)
