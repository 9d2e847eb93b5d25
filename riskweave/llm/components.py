"""Connected components of a link graph, as Spark jobs.

Alternating stars: the large star links every larger neighbour of a node to the
smallest node it sees, the small star does the same for the smaller neighbours
and the node itself. Both keep components and shorten paths; a fixed point is a
star around each component's smallest node. Minima are pre-aggregated before the
shuffle, so a hub costs each task one row; the joins are plain equi-joins that
adaptive execution may split. Each round is written to the shared folder and the
round before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import drop_staged, stage


def _star(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    return pairs.join(smallest, "u").select("u", "v", "m")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``links`` has two long columns; self-links and repeats do not matter. Nodes
    without a link are not listed.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges, seen = stage(edges, "links"), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _star(both.filter("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, low).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        mark = after.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        drop_staged(edges)
        edges = after
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
