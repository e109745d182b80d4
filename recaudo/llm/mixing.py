"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture. Its mean repetition rate is
share * total size * ``scale`` / size of the source. A document's count is
the inverse of the Poisson distribution with that mean at a uniform number
that is hashed from (seed, doc_id), so a rerun, a lost executor or another
partitioning gives the same counts. Documents are exploded by their counts
and dealt out by a hash of (seed, doc_id, copy), sorted by it: a global
random order in one shuffle. A document of more than ``CHUNK`` copies (a source of
few rows with a large share) is exploded in two steps with a shuffle between
them, so that no task makes all its copies.

Only DataFrame functions. A hot source is pre-aggregated before its size is
known, and its documents never meet in one task: the rates, one row a source,
are joined to the documents, which stay where they are when the rates are
small enough for Spark to broadcast, and AQE splits the source otherwise.

Null text counts as empty; each document's size is its code points plus one,
so a source of empty texts has a rate too. A null source is a source of its
own. Rows that repeat a doc_id get the same count each. All columns are kept,
whatever their names; where the input has a column copy, mix_rate or mix_key,
the added one has an underscore behind its name. An empty table gives
an empty result. Sources without a given weight get ``default_weight``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name, read_table, text_of, whole_row, written
from .registry import register

#: A mean above this is split into equal parts whose counts are added, so that exp(-mean) stays well above zero.
PART = 500.0
#: Copies of a document that one row is exploded into at once.
CHUNK = 1024


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0,
                 scale: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """source, n_docs, size, rate, parts and the distribution function of one
    part as an array; a row a source."""
    weight = F.lit(float(default_weight))
    for name, w in (weights or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    sizes = written(docs.select(F.col(source_col).alias("source"), (F.length(text_of(text_col)) + 1).cast("long").alias("n"))
                    .groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("size"))
                    .withColumn("weight", weight), "source-sizes")
    total = sizes.agg(F.sum("size").cast("double").alias("size"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(total.weight or 1.0)
    rates = (sizes.withColumn("rate", share * F.lit((total.size or 0.0) * scale) / F.col("size"))
             .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
             .withColumn("mean", F.col("rate") / F.col("parts"))
             .withColumn("terms", F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 20).cast("int")))
    cdf = F.expr("""aggregate(sequence(1, terms),
        named_struct('p', exp(-mean), 'c', exp(-mean), 'all', array(exp(-mean))),
        (s, k) -> named_struct('p', s.p * mean / k, 'c', s.c + s.p * mean / k,
                               'all', concat(s.all, array(s.c + s.p * mean / k))), s -> s.all)""")
    return rates.select("source", "n_docs", "size", "rate", "parts", cdf.alias("cdf"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0, scale: float = 1.0,
        seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` plus copy (from 1), mix_rate and mix_key, in
    the order of mix_key within each part."""
    rates = (source_rates(docs, weights, default_weight, scale, source_col, text_col)
             .select(F.col("source").alias("of_source"), F.col("rate").alias("mix_rate"), "parts", "cdf"))
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    draws = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda i: uniform(seed, F.col("id"), i))
    count = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: u >= c)))
    counted = (rows.join(rates, F.col("source").eqNullSafe(F.col("of_source")), "inner")
               .select("row", "id", "mix_rate", count.alias("count")))
    few = counted.filter(F.col("count").between(1, CHUNK)).withColumn("first", F.lit(1))
    many = (counted.filter(F.col("count") > CHUNK).withColumn("first", F.explode(F.sequence(F.lit(1), F.col("count"), F.lit(CHUNK))))
            .withColumn("count", F.least(F.lit(CHUNK), F.col("count") - F.col("first") + 1)))
    chunks = few.unionByName(many.repartition(F.xxhash64("id", "first")))
    copies = chunks.withColumn("copy", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)))
    key = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("copy").cast("string")))
    dealt = copies.withColumn("mix_key", key).repartition("mix_key").sortWithinPartitions("mix_key")
    return dealt.select("row.*", *[F.col(c).alias(free_name(c, docs.columns)) for c in ("copy", "mix_rate", "mix_key")])


#: Production parameters of op9_mixing and of the pipeline: each source the same share, as large a mixture as the input.
SEED = 17

ORACLE = f"""
WITH RECURSIVE s AS (
  SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY 1),
r AS (
  SELECT source, (1.0::DOUBLE / count(*) OVER ()) * sum(size) OVER ()::DOUBLE / size::DOUBLE AS mean FROM s),
d(source, mean, k, p, c) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM r
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM d
  WHERE k < ceil(mean + 12 * sqrt(mean) + 20)),
u AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || doc_id || ':1'), 1, 13))::BIGINT::DOUBLE / {1 << 52}::DOUBLE AS x FROM documents),
n AS (
  SELECT u.doc_id, count(*) FILTER (u.x >= d.c) AS copies
  FROM u JOIN d ON u.source IS NOT DISTINCT FROM d.source GROUP BY 1)
SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, g.copy::INTEGER AS copy, r.mean AS mix_rate,
       md5('order{SEED}:' || u.doc_id || ':' || g.copy) AS mix_key
FROM u JOIN n USING (doc_id) JOIN r ON u.source IS NOT DISTINCT FROM r.source, unnest(range(1, copies + 1)) AS g(copy)
"""


@register("op9_mixing", ORACLE)
def op9_mixing(spark, sf_dir):
    return mix(read_table(spark, sf_dir, "documents"), seed=SEED)
