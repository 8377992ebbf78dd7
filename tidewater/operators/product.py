"""The first rows of a product of axes, without the product.

Each axis is put in its own order, and combinations are compared so that a step forward on any
axis is a step forward in the whole order (by the costs of all axes, then by their values). A
combination at the places p1, p2, ... of its axes has p1 * p2 * ... - 1 others before it at least,
so only those whose product of places is at most `n` can be among the first n. These are some
n * ln(n) ^ (axes - 1) rows, however long the axes are, and are made axis by axis.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_of_product(axes: dict[str, DataFrame], n: int) -> DataFrame:
    """The first n combinations by the costs n_<axis> of all axes in their order, then by the values. axes: (<axis>, n_<axis>) by name, values once each."""
    made: DataFrame | None = None
    for name, axis in axes.items():
        order = [f"n_{name}", name]
        few = axis.orderBy(*order).limit(n)  # nothing beyond can be among the first
        placed = few.withColumn("__place", F.row_number().over(Window.orderBy(*order)).cast("long"))
        if made is None:
            made = placed.withColumnRenamed("__place", "__product")
            continue
        room = F.floor(F.lit(n) / F.col("__product"))
        most = placed.agg(F.max("__place").alias("__most"))  # one row
        steps = made.join(F.broadcast(most)).where("__most > 0").withColumn("__place", F.explode(F.sequence(F.lit(1).cast("long"), F.least(room, F.col("__most")))))
        made = steps.join(placed, "__place").withColumn("__product", F.col("__product") * F.col("__place")).drop("__place", "__most")
    return made.drop("__product").orderBy(*[f"n_{a}" for a in axes], *axes).limit(n)


def coverage_grid(axes: dict[str, DataFrame], counts: dict[str, DataFrame], limit: int) -> DataFrame:
    """The first rows of the product of axes (one column each), the least covered first. counts: (value, n) for each axis; a value without one has none."""
    costed = {}
    for name, axis in axes.items():
        n = counts[name].select(F.col(counts[name].columns[0]).alias(name), F.col("n").alias(f"n_{name}"))
        costed[name] = axis.join(n, name, "left").fillna({f"n_{name}": 0})
    return first_of_product(costed, limit)
