"""Connected components of a graph given as a table of links, without the graph ever being in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node with a link; component is the least node reachable.

    links has the long columns a and b. Alternates two rounds until nothing changes: every node links its larger
    neighbours to the least of its neighbourhood; then every node links itself and its smaller neighbours to the least of
    those. What is left is a star around each least node. Each round groups by node, with no node's neighbours in one row:
    only the least neighbour is gathered, by a partial aggregate, and joined back. Tables between rounds are written to the
    shared folder and go when the next one is there. Every round that changes anything lowers some label, so it ends.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:  # both directions; larger neighbours move to the least of the neighbourhood
            both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:  # from the larger to the smaller end
            down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            least = down.groupBy("a").agg(F.min("b").alias("m"))
            joined = down.join(least, "a")
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    def mark(edges: DataFrame) -> tuple:
        return tuple(
            edges.agg(F.count("*"), F.sum(F.xxhash64(F.least("a", "b"), F.greatest("a", "b")).cast("decimal(38,0)"))).first()
        )

    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = mark(edges)
    while seen[0]:
        older, edges = edges, materialize(star(star(edges, True), False), name)
        discard(older)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    return down.union(down.select(F.col("component").alias("node"), "component")).distinct()
