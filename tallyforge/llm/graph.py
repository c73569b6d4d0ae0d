"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import cut


#: Edges that one part of an edge list holds between the rounds.
EDGES_PER_PART = 200_000


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether they are stars: each node points to one root, and no root points on."""
    ends = F.array(F.struct(F.col("u").alias("k"), F.lit(1).alias("out"), F.lit(0).alias("root")),
                   F.struct(F.col("v").alias("k"), F.lit(0).alias("out"), F.lit(1).alias("root")))
    nodes = edges.select(F.explode(ends).alias("e")).select("e.*").groupBy("k").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    row = nodes.agg(F.sum("out").alias("n"), F.coalesce(F.max((F.col("out") + F.col("root")) > 1), F.lit(False)).alias("more")).first()
    return row.n or 0, not row.more


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.

    Alternates the large-star and small-star steps: every step replaces the edges of a node by edges to
    its smallest neighbour, until only stars around the smallest nodes are left. Edges stay distributed and
    no step has more of them than there were; only a count and a flag reach the driver. A hub with a third
    of all edges is folded by partial aggregates before it is shuffled for its minimum; its edges, two numbers each, stream through one task.

    Null ends and self loops are ignored; repeated edges change nothing; without edges the result is empty.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    ends = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    count, stars = None, False
    while not stars:
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.array(F.struct(F.col("u").alias("p"), F.col("m").alias("q")), F.struct(F.col("v").alias("p"), F.col("m").alias("q")))
        small = large.join(low, "u").select(F.explode(pair).alias("e")).select(F.col("e.p").alias("u"), F.col("e.q").alias("v"))
        small = small.where("u <> v").distinct()
        # never more edges than before, so a size for the files is known
        ends = cut(small if count is None else small.coalesce(1 + count // EDGES_PER_PART))
        count, stars = _shape(ends)
    return ends.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        ends.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
