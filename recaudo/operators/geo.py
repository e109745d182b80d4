"""Free-text city -> department by substring patterns, last match wins.

The pattern dictionary is input data: rows (ord, pattern, department, grp).
Within a group the matching pattern with the highest ``ord`` wins; group 1
is consulted first, then group 2; a city that matches nothing keeps its own
text, which counts when it is itself a department name; NULL / '' cities are
``VACIO``; everything else is ``NO IDENTIFICADO``.

Plan (no nested CASE of ~1,100 branches, no nested-loop join, and work that
grows with the texts, not with texts times patterns):

1. distinct normalised cities (shuffle of a small, partially aggregated set);
2. an inverted index of the patterns: each stands under ONE of its trigrams,
   the one that fewest patterns hold (patterns of one or two characters under
   themselves), so patterns with a common beginning don't meet under it;
3. each distinct city explodes into its different trigrams, one probe row
   each, which join the index on the trigram; what they find is confirmed by
   ``contains``, and as a pattern has one entry, it is found once;
4. highest ``ord`` per (city, group) via ``max(struct(ord, department))``;
5. the resolved city table joins back to the rows on the city (AQE splits a
   hot city; the table has one row per distinct city that matched; rows
   without a city are spread, as they match nothing).

The index of a dictionary of known size is broadcast; one read from a file
joins as Spark plans it from its size at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from .joins import broadcast_bounded

PATTERN_SCHEMA = "ord int, pattern string, department string, grp int"
#: Characters of an index entry.
GRAM = 3


def normalise_city(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    filled = F.when(c.isNull() | (c == ""), F.lit(fixed.CITY_EMPTY)).otherwise(c)
    return F.upper(F.split(filled, "/").getItem(0))


@dataclass
class PatternDictionary:
    """The (ord, pattern, department, grp) table plus what the plan needs to
    know about it: the distinct pattern lengths (None: any) and, when known,
    its size."""
    df: DataFrame
    lengths: list[int] | None = None
    rows: int | None = None

    @property
    def gram_sizes(self) -> list[int]:
        """Sizes of the index entries: three characters, or the whole of a shorter pattern."""
        return list(range(1, GRAM + 1)) if self.lengths is None else sorted({min(n, GRAM) for n in self.lengths})

    def index(self) -> DataFrame:
        """gram, pattern, ord, department, grp: a row a pattern."""
        p = self.df.select("ord", "pattern", "department", "grp")
        entries = p.withColumn("gram", F.explode(grams_of(F.col("pattern"), [GRAM], whole=True)))
        held = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
        index = (entries.join(held, "gram").groupBy("ord", "pattern", "department", "grp")
                 .agg(F.min(F.struct("held", "gram"))["gram"].alias("gram")))
        if self.rows is None:
            return index
        return broadcast_bounded(index, self.rows, reason="pattern dictionary of known size")


def grams_of(text: Column, sizes: list[int], whole: bool = False) -> Column:
    """The different substrings of the given sizes. ``whole``: a text that is
    shorter than the first size is its only one."""
    def of_size(n: int) -> Column:
        # one-argument lambda: transform() reads two arguments as (x, index)
        short = F.when(F.length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>")) if whole else F.array().cast("array<string>")
        return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))).otherwise(short)
    return F.array_distinct(F.flatten(F.array(*[of_size(n) for n in sizes])) if sizes else F.array().cast("array<string>"))


def pattern_table(spark: SparkSession, rows) -> PatternDictionary:
    """rows: iterable of (ord, pattern, department, grp) - configuration held
    by the driver, so lengths and size are known without a Spark job."""
    rows = [r for r in rows if r[1]]
    return PatternDictionary(spark.createDataFrame(rows, PATTERN_SCHEMA),
                             sorted({len(r[1]) for r in rows}), len(rows))


def read_pattern_table(spark: SparkSession, path: str, sep: str = ";") -> PatternDictionary:
    """Pattern dictionary from a CSV file with header ord;pattern;department;grp.
    One small job reads the distinct pattern lengths (bounded by the longest
    pattern)."""
    df = spark.read.schema(PATTERN_SCHEMA).option("header", True).option("sep", sep).csv(path) \
        .where(F.col("pattern").isNotNull() & (F.length("pattern") > 0))
    lengths = sorted(r[0] for r in df.select(F.length("pattern")).distinct().collect())
    return PatternDictionary(df, lengths)


def pattern_hits(texts: DataFrame, text: str, patterns: PatternDictionary) -> DataFrame:
    """``texts``: one row per distinct text (column ``text``). Returns
    (``_city``, ord, pattern, department, grp): every pattern that each text contains."""
    probes = texts.select(F.col(text).alias("_city"), F.explode(grams_of(F.col(text), patterns.gram_sizes)).alias("gram"))
    return probes.join(patterns.index(), "gram").where(F.contains("_city", "pattern")).drop("gram")


def city_hits(cities: DataFrame, city: str, patterns: PatternDictionary) -> DataFrame:
    """``cities``: one row per distinct normalised city (column ``city``).
    Returns (``_city``, ``_d1``, ``_d2``) for the cities with at least one
    matching pattern: the winning department per group."""
    # highest ord per group: max of (ord, department) structs, NULL for the
    # other group (max skips NULLs)
    return pattern_hits(cities, city, patterns).groupBy("_city").agg(*[
        F.max(F.when(F.col("grp") == g, F.struct("ord", "department")))["department"].alias(f"_d{g}")
        for g in (1, 2)])


def department(city: Column, d1: Column, d2: Column) -> Column:
    """Final rule: VACIO; group-1 winner if it is a department; group-2
    winner if it is one; a city without matches counts as itself."""
    d1 = F.coalesce(d1, city)
    d2 = F.coalesce(d2, city)
    return (F.when(city == fixed.CITY_EMPTY, F.lit(fixed.CITY_EMPTY))
            .when(d1.isin(*fixed.DEPARTMENTS), d1)
            .when(d2.isin(*fixed.DEPARTMENTS), d2)
            .otherwise(F.lit(fixed.CITY_UNRESOLVED)))


def resolve_departments(df: DataFrame, city_col: str, patterns: PatternDictionary,
                        out_city: str = "ciudad") -> DataFrame:
    """Adds ``out_city`` (normalised) and ``departamento`` to every row.

    The pattern work runs once per distinct city; only the (usually small)
    table of matched cities joins back to the rows.
    """
    rows = df.withColumn(out_city, normalise_city(city_col))
    empty = F.col(out_city) == fixed.CITY_EMPTY
    hits = city_hits(rows.where(~empty).select(out_city).distinct(), out_city, patterns)
    # rows without a city match nothing: each gets a key of its own, so they don't meet in one task
    key = F.when(empty, F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("string"))).otherwise(F.col(out_city))
    rows = rows.withColumn("_city_key", key)
    j = rows.join(hits, rows["_city_key"] == hits["_city"], "left")
    return j.withColumn("departamento", department(F.col(out_city), F.col("_d1"), F.col("_d2"))) \
        .drop("_city", "_city_key", "_d1", "_d2")
