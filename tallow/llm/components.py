"""Connected components of a link table, by alternating star contractions.

Large-star and small-star rounds (Kiveris et al., 2014): every node's links
move to the smallest node it sees, first for its larger neighbours, then for
its smaller ones, until nothing changes. Minima are pre-aggregated and joined
back, so a hub with very many links is never gathered in one task; each round
is cut by a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallow.llm.common import drop_table, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(links: DataFrame) -> DataFrame:
    """Each row of ``links (u, v)`` with ``m``, the least of u and its v."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``edges (u, v)``; the component is its least id."""
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct(), "links")
    state = _state(now)
    while True:
        large = _star(_both_ways(now)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _star(large)
        small = (low.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        new = materialize(small, "links")
        new_state = _state(new)
        drop_table(now)
        now = new
        if new_state == state:
            break
        state = new_state
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
