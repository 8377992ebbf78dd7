"""Instructions and answers from pools of templates, by mode and tier, where pools are tables.

A mix (mode, tier, place, pool, weight, needs, otherwise) says how often a tier of a mode takes each pool;
`needs` names a slot that a pool's templates fill, and `otherwise` the pool to take where a row has
nothing for it. Templates (mode, pool, seed, place, template) are a pool's sentences; `{slot}` stands for a row's
value. All picks are by the md5 of a row's key after a seed, so a row always gets the same one, and
tables that grow or change need no change of code. Tiers without a mix take that of `default`.
Rows go through joins with the two tables, which are lookup tables but of no fixed size; no row is shuffled
for them as long as Spark can broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seed of the pick of a pool.
POOL_SEED = "pool"


def hash_place(key: Column, size: Column) -> Column:
    """The md5 of a text as a whole number, modulo a column."""
    digits, at = F.md5(key), F.lit(0).cast("long")
    for start in range(1, 33, 8):
        at = (at * (1 << 32) + F.conv(F.substring(digits, start, 8), 16, 10).cast("long")) % size
    return at


def filled(template: Column, slots: dict[str, Column]) -> Column:
    """A template with each `{slot}` replaced by its value, a missing one by nothing; values are taken as they are."""
    piece = F.split(template, "[{}]", -1)  # texts and names of slots in turn
    value = F.create_map(*[x for name, c in slots.items() for x in (F.lit(name), F.coalesce(c, F.lit("")))])
    return F.array_join(F.transform(piece, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.coalesce(F.try_element_at(value, x), F.lit("")))), "")


def pools(rows: DataFrame, mix: DataFrame, mode: str, tier: str, key: str, slots: dict[str, Column], default: str = "normal") -> DataFrame:
    """rows with `pool`, by the weights of their mode and tier; rows of a mode without a mix are left out."""
    upto = F.sum("weight").over(Window.partitionBy("mode", "tier").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("weight").over(Window.partitionBy("mode", "tier"))
    ranges = mix.where("weight > 0").withColumn("__end", upto).withColumn("__of", total).select(F.col("mode").alias("__mode"), F.col("tier").alias("__tier"), "pool", "needs", "otherwise", (F.col("__end") - F.col("weight")).alias("__from"), "__end", "__of")
    sizes = ranges.select("__mode", "__tier", "__of").distinct()
    fallback = sizes.where(F.col("__tier") == default).select(F.col("__mode").alias("__dmode"), F.col("__of").alias("__dof"))
    d = rows.join(sizes, (F.col(mode) == F.col("__mode")) & (F.col(tier) == F.col("__tier")), "left").join(fallback, F.col(mode) == F.col("__dmode"), "left")
    d = d.withColumn("__size", F.coalesce("__of", "__dof")).where("__size is not null").withColumn("__as", F.when(F.col("__of").isNotNull(), F.col(tier)).otherwise(default))
    d = d.withColumn("__at", hash_place(F.concat(F.lit(f"{POOL_SEED}:"), F.col(key)), F.col("__size"))).drop("__mode", "__tier", "__of", "__dmode", "__dof", "__size")
    met = d.join(ranges.drop("__of"), (F.col(mode) == F.col("__mode")) & (F.col("__as") == F.col("__tier")) & (F.col("__at") >= F.col("__from")) & (F.col("__at") < F.col("__end")))
    has = F.create_map(*[x for name, c in slots.items() for x in (F.lit(name), F.coalesce(c, F.lit("")) != "")])
    lacks = F.col("needs").isNotNull() & ~F.coalesce(F.try_element_at(has, F.col("needs")), F.lit(False))
    return met.withColumn("pool", F.when(lacks, F.col("otherwise")).otherwise(F.col("pool"))).select(*rows.columns, "pool")


def templated(rows: DataFrame, templates: DataFrame, mode: str, pool: str, key: str, slots: dict[str, Column], name: str = "instruction") -> DataFrame:
    """rows with one of their pool's templates, filled; rows of a pool without templates are left out."""
    own = Window.partitionBy("mode", "pool")
    numbered = templates.withColumn("__place", F.row_number().over(own.orderBy("place")) - 1).withColumn("__n", F.count("*").over(own))
    sizes = numbered.select(F.col("mode").alias("__mode"), F.col("pool").alias("__pool"), "__n", "seed", "__place").where("__place = 0").drop("__place")
    d = rows.join(sizes, (F.col(mode) == F.col("__mode")) & (F.col(pool) == F.col("__pool"))).withColumn("__at", hash_place(F.concat("seed", F.lit(":"), F.col(key)), F.col("__n"))).drop("__mode", "__pool", "__n", "seed")
    said = numbered.select(F.col("mode").alias("__mode"), F.col("pool").alias("__pool"), "__place", F.col("template").alias("__template"))
    met = d.join(said, (F.col(mode) == F.col("__mode")) & (F.col(pool) == F.col("__pool")) & (F.col("__at") == F.col("__place")))
    return met.withColumn(name, filled(F.col("__template"), slots)).select(*rows.columns, name)


def instructions(rows: DataFrame, mix: DataFrame, templates: DataFrame, mode: str, tier: str, key: str, slots: dict[str, Column], default: str = "normal") -> DataFrame:
    """rows with `pool` and `instruction`: a pool by mode and tier, then one of its templates."""
    return templated(pools(rows, mix, mode, tier, key, slots, default), templates, mode, "pool", key, slots)
