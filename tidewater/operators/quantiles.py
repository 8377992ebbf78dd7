"""Exact order statistics without an order of all rows.

The value at a rank is found by selection: a sketch (a few kB, merged over tasks) gives bounds
that most likely hold it, one aggregation counts the rows below and between them, and only the
rows between go on, a few ten-thousandths of those before. When few are left, their distinct
values are counted and summed up. A pass over the data reads the one column and shuffles one row a
task. If a sketch's bounds miss, which the counts tell, the next pass takes the whole span again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks a sketch may be off, as a part of its rows: one by this.
ACCURACY = 10_000


@dataclass
class Span:
    """A wanted value: one of the `inside` rows from low to high (both included; None: no bound), at this rank from 1 among them."""

    rank: int
    inside: int
    low: object = None
    high: object = None

    def holds(self, value: Column) -> Column:
        ok = F.lit(True) if self.low is None else value >= F.lit(self.low)
        return ok if self.high is None else ok & (value <= F.lit(self.high))


def at_ranks(df: DataFrame, column: str, ranks: list[int], few: int = 100_000, accuracy: int = ACCURACY) -> list:
    """The values of a numeric column at ranks from 1 of its values in ascending order; nulls are left out, ranks must be within the rows."""
    rows = df.select(F.col(column).alias("v")).where("v is not null")
    v, n = F.col("v"), rows.count()
    spans = [Span(rank, n) for rank in ranks]
    missed: set[int] = set()
    while open_ := [i for i, s in enumerate(spans) if s.inside > few and i not in missed and not (s.low is not None and s.low == s.high)]:
        shares = lambda s: [max(0.0, (s.rank - 1) / s.inside - 2 / accuracy), min(1.0, s.rank / s.inside + 2 / accuracy)]
        guess = rows.agg(*[F.percentile_approx(F.when(spans[i].holds(v), v), shares(spans[i]), accuracy).alias(str(i)) for i in open_]).first()
        near = {i: Span(0, 0, *guess[str(i)]) for i in open_}
        told = rows.agg(*[f.alias(f"{name}{i}") for i in open_ for name, f in (("b", F.count_if(spans[i].holds(v) & (v < F.lit(near[i].low)))), ("n", F.count_if(near[i].holds(v))))]).first()
        for i in open_:
            below, inside = told[f"b{i}"], told[f"n{i}"]
            if below < spans[i].rank <= below + inside and inside < spans[i].inside:
                spans[i] = Span(spans[i].rank - below, inside, near[i].low, near[i].high)
            else:
                missed.add(i)
    wanted = [F.struct(F.lit(i).alias("i"), F.lit(s.rank).alias("rank")) for i, s in enumerate(spans)]
    within = F.filter(F.array(*[F.when(s.holds(v), w) for s, w in zip(spans, wanted)]), lambda x: x.isNotNull())
    counted = rows.withColumn("w", within).where(F.size("w") > 0).groupBy("v", "w").agg(F.count("*").alias("n")).select("v", "n", F.explode("w").alias("w")).select("v", "n", "w.*")
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    found = counted.withColumn("upto", upto).where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).select("i", "v").collect()  # a row for each rank
    values = {r["i"]: r["v"] for r in found}
    return [values[i] for i in range(len(spans))]


def index_percentiles(df: DataFrame, column: str, quantiles: list[float], few: int = 100_000) -> DataFrame:
    """(quantile, value): the element at int(n * q) of the sorted values; exact. No row without values."""
    n = df.where(F.col(column).isNotNull()).count()
    values = at_ranks(df, column, [min(int(n * q) + 1, n) for q in quantiles], few) if n else []
    return df.sparkSession.createDataFrame([(float(q), float(v)) for q, v in zip(quantiles, values)], "quantile double, value double")
