"""Connected components of a distributed edge list (large-star, small-star).

Every pass is two aggregates and two joins over the edges; the edge list is
written to the shared checkpoint folder after each pass, and the loop ends
when a pass changes nothing, after a number of passes that grows with the
logarithm of the input.  No node gathers its neighbours: a star's centre only
needs their minimum, a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, release, tracking


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of the edges; label: the smallest node
    of the component.  Loops and repeated edges are allowed."""
    spark = edges.sparkSession
    big, small = F.greatest(a, b), F.least(a, b)
    first = edges.filter(F.col(a) != F.col(b)).select(big.alias("u"), small.alias("v")).distinct()
    paths: list[str] = []
    with tracking(paths):
        now, seen = materialize(first, "edges"), None
        while True:
            state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
            if state == seen or not state[0]:
                break
            seen = state
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = _min_neighbour(both).select("u", F.least("u", "m").alias("m"))
            large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = large.filter(F.col("u") != F.col("v")).distinct()
            down = large.join(_min_neighbour(large), "u")
            moved = down.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            stars = moved.unionByName(down.select("u", F.col("m").alias("v"))).distinct()
            now = materialize(stars, "edges")
            release(spark, [paths.pop(0)])
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("label"))
    labels = materialize(leaves.unionByName(centres).distinct(), "labels")
    release(spark, paths)
    return labels
