"""Discount cross: attach a discount percentage per account and derive the
discounted value, its band and the discount filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify


def apply_discounts(base: DataFrame, discounts: DataFrame, base_key: str, disc_key: str,
                    debt: str, pct_text: str) -> DataFrame:
    """Left join of the discount list (text percentages, possibly several per
    account: the largest wins, D13) onto the base; missing -> 0.

    ``porcentaje_texto`` is the percentage as the list spells it.
    The list is reduced to one row per account before the join, so the join
    never fans out; the reduction is a partial aggregate.
    """
    d = discounts.select(F.col(disc_key).alias("_dk"),
                         F.struct(F.col(pct_text).try_cast(classify.PERCENTAGE).alias("p"), F.col(pct_text).alias("t")).alias("_p")) \
        .where(F.col("_p.p").isNotNull()).groupBy("_dk").agg(F.max("_p").alias("_p"))
    j = base.join(d, base[base_key] == d["_dk"], "left").drop("_dk")
    pct = F.coalesce(F.col("_p.p"), F.lit(0).cast(classify.PERCENTAGE))
    val = classify.discounted_value(F.col(debt), pct)
    return (j.withColumn("porcentaje", pct)
             .withColumn("porcentaje_texto", F.coalesce("_p.t", F.lit("0")))
             .withColumn("valor_descuento", val)
             .withColumn("rango_con_descuento", classify.discount_band(F.col("valor_descuento")))
             .withColumn("filtro_descuento", classify.discount_filter(F.col("porcentaje")))
             .withColumn("valor_descuento_texto", classify.decimal_comma(F.col("valor_descuento")))
             .drop("_p"))
