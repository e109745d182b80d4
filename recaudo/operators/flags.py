"""Per-document flags and list flags.

Multi-flags per document: several rows (accounts), several billing systems,
several brands. "More than one distinct value" is ``max(c) > min(c)`` - an
O(1) partial aggregate, so no distinct sets are ever built, and a document
holding a third of all rows is pre-aggregated map-side. The per-document row
is joined back to the detail by a plain left join, whose hot documents AQE
splits from runtime sizes; NULL / empty documents are spread over all partitions with a key that never
matches (they get "No aplica").
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.keys import blank_to_null
from .hot_keys import hot_left_join
from .joins import spread_null_key


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(fixed.APPLIES)).otherwise(F.lit(fixed.NOT_APPLIES))


def multi_flags(df: DataFrame, doc: str, spread: str,
                distinct_flags: dict[str, str], rows_flag: str = "multicuenta",
                hot_share: float | None = None, salts: int = 64) -> DataFrame:
    """Adds ``rows_flag`` (more than one row for the document) and, for each
    ``{flag_name: column}``, a flag that the column takes more than one
    distinct non-NULL value within the document. ``spread`` is a near-unique
    column used to spread NULL documents. With ``hot_share`` documents that
    hold at least that share of the rows are found by a sketch and dealt over
    ``salts`` keys (:mod:`.hot_keys`), for plans that don't rely on AQE."""
    key = blank_to_null(F.col(doc))
    per_doc = (
        df.select(key.alias("_doc"), *[F.col(c).alias(f"_v_{n}") for n, c in distinct_flags.items()])
        .where(F.col("_doc").isNotNull())
        .groupBy("_doc")
        .agg(F.count(F.lit(1)).alias("_n"),
             *[(F.max(f"_v_{n}") > F.min(f"_v_{n}")).alias(f"_m_{n}") for n in distinct_flags])
        .withColumn("_doc", F.col("_doc").cast("string")).withColumnRenamed("_doc", "_jk")
    )
    detail = df.withColumn("_jk", spread_null_key(key, F.col(spread)))
    j = detail.join(per_doc, "_jk", "left") if hot_share is None else \
        hot_left_join(detail, per_doc, "_jk", spread, hot_share, salts)
    out = j.withColumn(rows_flag, _flag(F.col("_n") > 1))
    for n in distinct_flags:
        out = out.withColumn(n, _flag(F.col(f"_m_{n}")))
    return out.drop("_jk", "_n", *[f"_m_{n}" for n in distinct_flags])


def list_flag(df: DataFrame, lst: DataFrame, on: Sequence[str], name: str,
              label: str = fixed.LIST_FLAG) -> DataFrame:
    """``name`` = ``label`` when the row's key is on the list, else NULL.
    The list is reduced to distinct keys first (no fan-out)."""
    keys = list(on)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    marks = lst.select(*keys).where(present).dropDuplicates(keys).withColumn(name, F.lit(label))
    return df.join(marks, keys, "left")


def count_flags(df: DataFrame, counts: dict[str, str], label: str = fixed.APPLIES) -> DataFrame:
    """``{flag: count_column}``: label when the count is >= 1, else ''."""
    from ..functions.bands import count_flag
    return df.withColumns({f: count_flag(c, label) for f, c in counts.items()})
