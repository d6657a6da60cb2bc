"""Connected components of a link table by alternating large-star and small-star contraction.

Each step reads and writes tables in the shared folder: no link, node or component list reaches the driver, and
a lost executor costs a re-read. A node with very many links only ever meets others through a pre-aggregated
minimum and an equality join of two stored tables, whose skewed side adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tape_audit.operators.staging import stage


def _star(sides: DataFrame, keep: Column, name: str) -> DataFrame:
    """``sides`` (u, v): links every v that ``keep`` names, and u itself, to the least of u and its v."""
    least = stage(sides.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), f"{name}-least")
    joined = sides.join(least, "u")
    moved = joined.where(keep & (F.col("v") != F.col("m"))).select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.where("u != m").select(F.col("u").alias("a"), F.col("m").alias("b"))
    return stage(moved.union(own).distinct(), name)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node of its component.

    Self-links, repeated links and either direction are allowed; an empty table gives an empty result.
    """
    now = stage(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, state = None, _state(now)
    while state != before and state[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        now = _star(both, F.col("v") > F.col("u"), "large-star")
        down = now.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        now = _star(down, F.lit(True), "small-star")
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
