"""Connected components of a graph given by its edges, as joins and groupings.

Alternating stars: in the large star every vertex hands its larger neighbours to its smallest one, in the small star its
smaller neighbours and itself. Both keep components whole, and the rounds end with every vertex next to the smallest
of its component. A hub's edges meet its smallest neighbour in a join, not in one group. The smallest neighbours are stored
first: a grouped side would bring its partitioning into the join, while of two stored sides Spark can split a hub that
holds a third of all edges over many tasks. All steps of a round are written to the shared scratch folder.

A round has three shuffles for groupings, besides those of its joins if these do not broadcast. Neither star makes more
edges than it gets, so edges are made distinct once a round. The first grouping of a round also tells whether all
components are stars, and is then the result itself: no round runs only to see that nothing moves.

Defined results: edges with NULL ends and loops are left out, repeated edges count once, a table without edges has no vertices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import keep


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root): the smallest vertex of the component of each vertex in ``edges`` (a, b), of long type."""
    current = keep(_oriented(edges.select("a", "b")), "edges")
    while True:
        least = keep(_least(current), "least")
        if not least.agg(F.max("moves")).first()[0]:
            return least.select(F.col("u").alias("vertex"), F.col("m").alias("root"))
        current = keep(_ordered(_small_star(_large_star(current, least))), "edges")


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller vertex, without loops."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller vertex."""
    return _oriented(edges).distinct()


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, moves): the smallest of each vertex and its neighbours. In a star no vertex has smaller neighbours that differ,
    or both a smaller and a larger one; ``moves`` marks those that have."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    sums = both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return sums.select("u", F.least("low", "u").alias("m"), F.expr("low < u AND high != low").alias("moves"))


def _large_star(edges: DataFrame, least: DataFrame | None = None) -> DataFrame:
    """Larger neighbours go to the smallest; ``edges`` lead from the larger to the smaller vertex, and so do the results."""
    least = keep(_least(edges), "least") if least is None else least
    return edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = keep(edges, "large-star")
    least = keep(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))
