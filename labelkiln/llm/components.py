"""Connected components of an edge table, as Spark joins.

Alternates the large-star and small-star steps: every node hands its larger
(then its smaller) neighbours to the smallest node it knows, until nothing
changes and each component is a star around its smallest node. The number of
rounds is logarithmic. Minima are pre-aggregated before the shuffle and the
joins have one row per node on one side, so a node with very many edges is
split like any skewed join. Each round is written under the shared checkpoint
folder, so the plan stays short and a lost executor costs one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkiln.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of one orderable type -> ``(node, root)`` for every node with
    an edge but the roots themselves; ``root`` is the component's smallest node.
    Nulls and loops are ignored, repeated edges count once; no edges: no rows."""
    edges = cut_lineage(edges.select("u", "v").filter("u != v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        edges = cut_lineage(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (now["n"], now["h"]):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = (now["n"], now["h"])
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
