"""Connected components of an edge table, by alternating large and small stars.

Each round is joins and grouped minima over a stored table; no node's neighbours
are gathered in one place. The number of rounds grows with the logarithm of the
largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stallkeep.session import stored

MOST_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest neighbour, or to itself."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable. `edges` has columns u and v.

    Self-edges and nulls are ignored; nodes without another edge are not returned.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(ordered, "edges")
    state = None
    for _ in range(MOST_ROUNDS):
        # bit-wise sums of the edges' hashes, taken while they are written: equal only when no edge has moved
        seen = Observation()
        sums = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "v", "u")).alias("b")]
        now = stored(_small(_large(now).where("u > v")).where("u > v").distinct().observe(seen, *sums), "edges")
        found = seen.get
        if found == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = found
    raise RuntimeError("components did not settle")
