"""Connected components by alternating large and small stars, all in joins and
aggregates that combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) rows to (v, least of u and its neighbours)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    return _star(both).where("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    near = _star(down)
    return near.select(F.col("v").alias("a"), F.col("least").alias("b")).union(near.select("u", "least"))


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node of the edges (a, b).

    Each round keeps at most as many edges as there were; a long chain of n
    nodes takes about log n rounds.  Rounds are written to the shared folder, so
    lineage stays short and a lost executor repeats one round at most.  Null
    ends and loops are dropped, repeated edges count once; no edges, no rows.
    """
    now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    while True:
        now = stored(_small(_large(now).distinct()).where("a <> b").distinct(), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
