"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, join_unique, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """Least node of each node's component, from links (a, b): rows (node, root), for nodes with a link only.

    Every step is a minimum per node, combined on the map side, and a join back that keeps a hot node's links where
    they are; it is written to the shared folder, so that lineage stays short, and the step before it is deleted. The
    steps end when they change no link; their number grows as the logarithm of the longest chain.
    """
    edges = materialize(links.where("a <> b"), "links")
    before = None
    while True:
        large = Star(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")))
        if large.checksum == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = large.checksum
        out = large.step(edges, large=True)
        edges = Star(out.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))).step(out, large=False)


class Star:
    """Neighbours v of each u, the least of u and its neighbours, and what one counting job tells of them."""

    def __init__(self, sides: DataFrame):
        self.sides = sides
        self.least = sides.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        seen = sides.groupBy("u").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        total, most, self.checksum = seen.agg(F.sum("n"), F.max("n"), F.sum("h")).first()
        self.uses = (total or 0, most or 0)

    def step(self, before: DataFrame, large: bool) -> DataFrame:
        """Link each neighbour (the larger ones, or all and u itself) to the least; written, and ``before`` deleted."""
        tied = join_unique(self.sides, self.least, ["u"], "n", self.uses)
        out = (tied.where(F.col("v") > F.col("u")) if large else tied).select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(self.least.select("u", "m"))
        done = materialize(out.where("a <> b").distinct(), "links")
        discard(before)
        return done
