"""Connected components of an undirected edge table, without driver or single-task state.

Alternating star contraction: a large star hooks a node's larger neighbours to the smallest node
around it, a small star does the same with its smaller ones, until every node hangs on the
smallest node of its component. A node's neighbourhood is only ever reduced to its minimum
(combined before the shuffle) and joined back; the minima are a written table, so adaptive
execution can split a hub's edges in that join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.session import materialise


def _smallest(edges: DataFrame, node: str, other: str) -> DataFrame:
    minima = edges.groupBy(node).agg(F.min(other).alias("least"))
    return materialise(minima.select(F.col(node).alias("_node"), "least"), "minima")


def _edges(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("high"), F.least(a, b).alias("low")]


def _large_star(edges: DataFrame) -> DataFrame:
    around = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    minima = _smallest(around, "high", "low")
    smallest = F.least("low", "least")  # of an edge's smaller end and all around it
    hooked = edges.join(minima, F.col("low") == F.col("_node")).select(F.col("high"), smallest.alias("low"))
    return hooked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    minima = _smallest(edges, "high", "low")
    joined = edges.join(minima, F.col("high") == F.col("_node"))
    centre = minima.select(F.col("_node").alias("high"), F.col("least").alias("low"))
    moved = joined.filter("low <> least").select(*_edges(F.col("low"), F.col("least")))
    return moved.unionByName(centre).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node of its component for every node that is not that one itself.

    `edges` holds pairs of integers; pairs of a node with itself are ignored.
    """
    current = materialise(edges.filter(F.col(a) != F.col(b)).select(*_edges(F.col(a), F.col(b))).distinct(), "edges")

    def state(table: DataFrame) -> tuple:
        hashes = F.xxhash64("high", "low").cast("decimal(38,0)")
        return tuple(table.agg(F.count("*"), F.sum(hashes)).first())

    before = None
    while (now := state(current)) != before:
        before = now
        current = materialise(_small_star(materialise(_large_star(current), "large")), "edges")
    return current.select(F.col("high").alias("node"), F.col("low").alias("label"))
