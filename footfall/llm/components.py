"""Connected components of an undirected graph, as repeated star contractions.

Each round points every node at the smallest node it touches (first its larger neighbours, then
itself and its smaller ones) until the edges are stars around the smallest node of each component.
Rounds grow with the logarithm of a component's size. Every round is written to the shared folder:
lineage stays short and a lost executor costs one round. A hub's edges are joined with one row, so
the join can be split, and minima are aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import staged

NODE, TO = "node", "component"


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("v").agg(F.min("u").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of v is linked with the smallest of v and its neighbours."""
    both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    low = _minimum(both)
    return (
        both.where(F.col("u") > F.col("v"))
        .join(low, "v")
        .select(F.col("u").alias("v"), F.least("v", "low").alias("u"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """v and its smaller neighbours are linked with the smallest of them (rows are v > u)."""
    low = _minimum(edges)
    linked = edges.join(low, "v").where(F.col("u") > F.col("low")).select(F.col("u").alias("v"), F.col("low").alias("u"))
    return linked.unionByName(low.select("v", F.col("low").alias("u"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))
    ).first()
    return tuple(row)


def connected_components(
    edges: DataFrame, left: str, right: str, stage: Callable[[DataFrame, str], DataFrame] = staged
) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    Edges may repeat, point either way or be loops. Edges with a null end link nothing. Nodes that
    occur only in loops are their own component. An empty table gives an empty result. ``stage``
    stores a round (``session.staging`` removes them at the end of a job).
    """
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    pairs = ends.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    stars = stage(pairs, "edges")
    seen = _state(stars)
    while seen[0]:
        stars = stage(_small_star(_large_star(stars)), "stars")
        now = _state(stars)
        if now == seen:
            break
        seen = now
    loops = ends.where("a = b").select(F.col("a").alias(NODE), F.col("a").alias(TO))
    members = stars.select(F.col("v").alias(NODE), F.col("u").alias(TO))
    centres = stars.select(F.col("u").alias(NODE), F.col("u").alias(TO))
    return members.unionByName(centres).unionByName(loops).groupBy(NODE).agg(F.min(TO).alias(TO))
