"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep


def _minimum_star(links: DataFrame) -> DataFrame:
    """Every node ``u`` of ``links`` with ``m``, the least of itself and its neighbours."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Links the greater neighbours of every node to its least one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.join(_minimum_star(both), "u").filter("v > u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links every node and its lesser neighbours to the least one."""
    least = _minimum_star(links)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``.

    The component is the least node of it. A round is a few aggregations and
    joins by node; what it makes is written to the shared folder. A node with
    many links never comes together in one task: minima are taken before the
    shuffle, and the joins back to them are skew joins.
    """
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = keep(ordered.filter("u > v").distinct(), purpose)
    before = None
    while True:
        row = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == before or not row[0]:
            break
        before = row
        stars = _small_star(keep(_large_star(current).distinct(), purpose)).filter("u > v").distinct()
        current = keep(stars, purpose)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
