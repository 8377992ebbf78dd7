"""Connected components by alternating large and small stars.

Every round is two aggregations and two equi-joins; nothing is collected but one row of
counts, by which the next round's edges are written to no more files than they need. Minima are combined before the shuffle, and the joins are plain sort-merge joins, so
adaptive execution can split the node of a hot star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
    return edges.join(least, "u").select(ends.alias("e")).select("e.u", "e.v").where("u > v").distinct()


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for each node of an edge (a, b), root being the smallest node of its component.

    Loops and repeated edges change nothing; nodes without an edge to another do not appear.
    Raises RuntimeError if the stars have not settled after `most_rounds`.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    said = None
    for _ in range(most_rounds):
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark["n"] == 0 or said == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v"), F.col("v")).distinct())
        said = mark
        now = cut(_small_star(_large_star(now)).coalesce(8 + mark["n"] // 250_000))  # edges become no more
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
