"""Contact outcomes: free-text outcome -> outcome group, and the per-account
rollup (direct / indirect / no contact counts and a label)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def normalise_outcome(c: Column | str) -> Column:
    """lower case, blanks removed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(c), " ", "")


def outcome_group(c: Column | str, mapping: Mapping[str, str] = fixed.OUTCOME_GROUPS) -> Column:
    """Literal map lookup (21 entries, inlined in the plan); unmapped -> NULL."""
    m = F.create_map(*[F.lit(x) for x in chain(*mapping.items())])
    return m[normalise_outcome(c)]


def outcome_counts(group: Column | str) -> dict[str, Column]:
    """Aggregate columns: how many outcomes fall in each group."""
    g = F.col(group) if isinstance(group, str) else group
    return {
        "cantidad_contacto_directo": F.count_if(g == "CDIR"),
        "cantidad_contacto_indirecto": F.count_if(g == "CIND"),
        "cantidad_nocontacto": F.count_if(g == "NOC"),
    }


def outcome_label(direct: Column | str = "cantidad_contacto_directo",
                  indirect: Column | str = "cantidad_contacto_indirecto",
                  none: Column | str = "cantidad_nocontacto") -> Column:
    """Present groups joined by ONE blank (D10: absent groups are NULL, not
    '', so no double blanks)."""
    d, i, n = [F.col(x) if isinstance(x, str) else x for x in (direct, indirect, none)]
    return F.concat_ws(" ", F.when(d > 0, F.lit("CDIR")), F.when(i > 0, F.lit("CIND")),
                       F.when(n > 0, F.lit("NOC")))


def outcome_rollup(df: DataFrame, key: str, group: str) -> DataFrame:
    """Per key: counts per outcome group (unmapped outcomes count in none) and
    ``filtro_reporte_gestion``."""
    agg = df.groupBy(key).agg(*[c.alias(n) for n, c in outcome_counts(group).items()])
    return agg.withColumn("filtro_reporte_gestion", outcome_label())
