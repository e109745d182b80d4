"""Connected components of a link table by alternating star contraction.

Every round hangs the neighbours of a row under the smallest id it knows,
first from the side of the larger ids, then from that of the smaller ones,
until all links are stars. Nothing is collected but a count and a checksum a
round, taken while the round's links are written to the shared folder. A hub
with very many links is pre-aggregated (its minimum) and its links are joined
back by a plain equi-join, which AQE splits. More links are added to known
components on the graph of the components alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written, written_with


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    under = links.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return under.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component (smallest id reachable) for every id that has a link."""
    totals = {"n": F.count("*"), "check": F.sum(F.hash("a", "b").cast("long"))}
    state, now = written_with(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct(), "links", **totals)
    check = None
    while now["n"] and now != check:
        check = now
        state, now = written_with(_small_star(_large_star(state)), "links", **totals)
    return state.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        state.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def merged_components(component: DataFrame, links: DataFrame) -> DataFrame:
    """id, component after more links (a, b), from what
    :func:`connected_components` gave before; written."""
    of = lambda c: component.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    between = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    root = connected_components(between).select(F.col("id").alias("old"), F.col("component").alias("root"))
    known = component.join(root, component["component"] == root["old"], "left").select("id", F.coalesce("root", "component").alias("component"))
    fresh = root.join(component, root["old"] == component["id"], "left_anti").select(F.col("old").alias("id"), F.col("root").alias("component"))
    return written(known.union(fresh), "components")
