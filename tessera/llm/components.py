"""Connected components of a table of links, by alternating large and small stars.

Every step is a minimum per node (combined map-side) and a join back, so a node with very many
links is split like any skewed key. Each step is written to the shared folder; links and
labels never reach the driver, only their count and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import settle


def _minimum(edges: DataFrame, name: str) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return settle(least.select("u", F.least("u", "m").alias("m")), name)


def _state(edges: DataFrame) -> tuple[int, int]:
    # decimal, since a sum of 64-bit hashes passes their range
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node on a link (u, v): the smallest node reachable from it."""
    both = F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = settle(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        around = edges.select(F.explode(both).alias("e")).select("e.*")
        large = around.join(_minimum(around, "large_star"), "u").filter("v > u")
        large = settle(large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large_edges")
        small = large.join(_minimum(large, "small_star"), "u")
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        edges = settle(
            small.select(F.explode(pairs).alias("e")).select("e.*").filter("u <> v").distinct(), "small_edges"
        )
    inner = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return settle(inner.unionByName(roots), "components")
