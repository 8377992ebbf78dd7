"""Mixing of sources to target weights by entropy balancing, with DataFrame functions only.

A source's target is its weight's share of the mix, at most `ceiling` times its size; what is
above is shared among the others by weight (a water level, found from sorted prefix sums).
Document rates r minimise sum(r ln r - r) under sum(r * size) = target and r <= ceiling; the
dual has one multiplier a source, and its solution is r = min(ceiling, exp(multiplier * size)).
Newton steps, guarded by a bracket that is known in advance, run for all sources at once on
the exact histogram of sizes, several of them in a job. Rates become whole copies: the extra copies of a source go
evenly down its sizes, a last correction by whole documents brings the source's words to its
target, and within a size the documents with the smallest hashes get the extra copy.

Edge cases: a null text has size 0, rate 1 and one copy of no words; a null source is a source, the last in order;
a source of size 0 has target 0; repeated rows are documents each; an empty table gives no
rows; ties of hashes go by doc_id; only doc_id, source and text (and the columns named in
carry) are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, cut, durable, table


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys in which null equals null; the right keys go."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def targets(sizes: DataFrame, weights: list[int], share: float, ceiling: float) -> DataFrame:
    """source, source_size, target, full from (source, size): a row a source. full: the target is all that the ceiling allows."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))  # by code point; a row a source
    s = sums.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1))
    s = s.withColumn("cap", F.col("source_size") * ceiling).withColumn("level", F.col("cap") / F.col("weight"))
    order = Window.orderBy("level", F.asc_nulls_last("source"))
    everything = Window.orderBy("level", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("at", F.row_number().over(order)).withColumn("below", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("heavier", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))).withColumn("all", F.sum("source_size").over(everything))
    s = s.withColumn("water", (F.col("all") * share - F.col("below")) / F.col("heavier"))
    first = F.min(F.when(F.col("water") <= F.col("level"), F.struct("at", "water"))).over(everything)
    s = s.withColumn("first", first).withColumn("full", F.col("first").isNull() | (F.col("at") < F.col("first.at")))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.col("first.water") * F.col("weight")))
    return s.select("source", "source_size", target.cast("double").alias("target"), (F.col("full") | (target >= F.col("cap") * (1 - 1e-12))).alias("full"))


def _grid(histogram: DataFrame, state: DataFrame, ceiling: float, points: int) -> DataFrame:
    """state with its bracket narrowed to the two of `points` points between which the target lies, and u put between them."""
    at = [F.col("low") + (F.col("high") - F.col("low")) * (j / (points - 1)) for j in range(points)]
    met = _same(histogram, state, ["source"])
    words = F.array(*[F.sum(F.col("n") * F.col("size") * F.least(F.exp(F.col("sign") * F.exp(u) * F.col("size")), F.lit(float(ceiling)))) for u in at])
    sums = met.groupBy(*state.columns).agg(words.alias("f")).withColumn("at", F.array(*at))
    under = F.size(F.filter("f", lambda f: (f - F.col("target")) * F.col("sign") < 0))
    sums = sums.withColumn("k", F.least(F.greatest(under, F.lit(1)), F.lit(points - 1)))
    ends = [F.element_at("at", F.col("k")), F.element_at("at", F.col("k") + 1)]
    off = [F.log(F.element_at("f", F.col("k")) / F.col("target")), F.log(F.element_at("f", F.col("k") + 1) / F.col("target"))]
    part = F.when(off[0] * off[1] < 0, off[0] / (off[0] - off[1])).otherwise(F.lit(0.5))
    return sums.select("source", "target", "sign", ends[0].alias("low"), ends[1].alias("high"), (ends[0] + (ends[1] - ends[0]) * part).alias("u"), F.lit(1.0).alias("off"))


def _newton(histogram: DataFrame, state: DataFrame, ceiling: float) -> DataFrame:
    """state after one step for all sources: Newton's for the logarithm of the words taken, or the middle of the bracket where that leaves it."""
    x = F.col("sign") * F.exp("u")
    rate = F.exp(x * F.col("size"))
    weighed = F.col("n") * F.col("size")
    sums = _same(histogram, state, ["source"]).groupBy(*state.columns)
    sums = sums.agg(F.sum(weighed * F.least(rate, F.lit(float(ceiling)))).alias("f"), F.sum(F.when(rate < ceiling, weighed * F.col("size") * rate).otherwise(F.lit(0.0))).alias("d"))
    short = (F.col("f") - F.col("target")) * F.col("sign") < 0  # the root lies above u
    low, high = F.when(short, F.col("u")).otherwise(F.col("low")), F.when(short, F.col("high")).otherwise(F.col("u"))
    step = F.col("u") - F.log(F.col("f") / F.col("target")) * F.col("f") / (F.col("d") * x)
    inside = F.coalesce((F.col("d") > 0) & (step >= low) & (step <= high), F.lit(False))
    return sums.select("source", "target", "sign", low.alias("low"), high.alias("high"), F.when(inside, step).otherwise((low + high) / 2).alias("u"), F.abs(F.col("f") / F.col("target") - 1).alias("off"))


def multipliers(histogram: DataFrame, goals: DataFrame, ceiling: float, points: int = 16, steps: int = 3, tolerance: float = 1e-7, most_jobs: int = 20) -> DataFrame:
    """(source, multiplier) of the sources that are not full, for all of them at once.

    The multiplier's logarithm lies between those of sources whose documents all have the
    smallest or the largest size. A grid narrows that down, then Newton's steps, `steps` a
    job, go on until the words taken before the last step are off by at most tolerance.
    """
    histogram = histogram.where("size > 0")
    ends = histogram.groupBy("source").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    open_ = _same(goals.where("not full and target > 0 and target <> source_size"), ends, ["source"])
    wide = F.abs(F.log(F.col("target") / F.col("source_size")))
    state = open_.select("source", "target", F.signum(F.col("target") - F.col("source_size")).alias("sign"), F.log(wide / F.col("most")).alias("low"), F.log(wide / F.col("least")).alias("high"), F.lit(0.0).alias("u"), F.lit(1.0).alias("off"))
    state = _grid(histogram, state, ceiling, points)
    for _ in range(most_jobs):
        for _ in range(steps):
            state = _newton(histogram, state, ceiling)
        state = cut(state)
        worst = state.agg(F.max(F.when(F.col("high") - F.col("low") > 1e-15, F.col("off")).otherwise(F.lit(0.0))).alias("off")).first()["off"]
        if worst is None or worst <= tolerance:
            break
    return state.select("source", (F.col("sign") * F.exp("u")).alias("multiplier"))


def _copies_by_size(histogram: DataFrame, goals: DataFrame, ceiling: float, corrections: int = 3) -> DataFrame:
    """(source, size, n, base, extra): each of the n documents gets base copies, and extra of them one more.

    All of it runs over the sizes of a source, a row for each distinct size.
    """
    h = _same(_same(histogram, goals.select("source", "source_size", "target", "full"), ["source"]), multipliers(histogram, goals, ceiling), ["source"], "left")
    tilted = F.when(F.col("target") == F.col("source_size"), F.lit(1.0)).otherwise(F.coalesce(F.exp(F.col("multiplier") * F.col("size")), F.lit(0.0)))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("full"), F.lit(float(ceiling))).otherwise(F.least(F.lit(float(ceiling)), tilted))
    h = h.withColumn("rate", rate).withColumn("base", F.floor("rate"))
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    whole = Window.partitionBy("source")
    upto = F.sum(F.col("n") * (F.col("rate") - F.col("base"))).over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = h.withColumn("upto", F.floor(upto + 0.5)).withColumn("extra", F.col("upto") - F.coalesce(F.lag("upto").over(down), F.lit(0)))
    h = h.withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least("extra", "n")))
    for _ in range(corrections):
        # Of one size, as many documents more or fewer as bring the source nearest to its target.
        h = h.withColumn("off", F.col("target") - F.sum(F.col("size") * (F.col("n") * F.col("base") + F.col("extra"))).over(whole))
        room = F.when(F.col("off") > 0, F.when(F.col("base") + 1 <= ceiling, F.col("n") - F.col("extra")).otherwise(F.lit(0))).otherwise(F.col("extra"))
        h = h.withColumn("move", F.when(F.col("size") > 0, F.least(room, F.floor(F.abs(F.col("off")) / F.col("size")))).otherwise(F.lit(0)))
        best = F.min(F.when(F.col("move") > 0, F.struct((F.abs(F.col("off")) - F.col("move") * F.col("size")).alias("left"), F.col("size").alias("of")))).over(whole)
        h = h.withColumn("best", best)
        h = h.withColumn("extra", F.col("extra") + F.when(F.col("best.of") == F.col("size"), F.col("move") * F.signum("off").cast("long")).otherwise(F.lit(0).cast("long")))
    return h.select("source", "size", "n", "base", F.col("extra").cast("long").alias("extra"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, ceiling: int = 2, carry: tuple[str, ...] = (), run_rows: int = 500) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of each row, and the columns named in carry."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    draw = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))  # not of carry: reruns over other files take the same documents
    rows = durable(docs.select("doc_id", "source", size.alias("size"), draw.alias("draw"), *carry), "mix-sizes")
    goals = cut(targets(rows.select("source", "size"), list(weights), share, ceiling))
    histogram = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    plan = cut(_copies_by_size(histogram, goals, ceiling))
    met = _same(_same(rows, plan, ["source", "size"]), goals.select("source", "source_size", "target"), ["source"])
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    alike = met.where(~some).withColumn("copies", F.col("base") + (F.col("extra") > 0).cast("long"))
    # The documents of one size are ranked in runs of about run_rows, so no task gets a whole hot size.
    runs = met.where(some).withColumn("run", F.pmod(F.col("draw"), F.ceil(F.col("n") / run_rows)))
    key = ["source", "size", "run"]
    lengths = runs.groupBy(*key).agg(F.count("*").alias("m"))
    before = Window.partitionBy("source", "size").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.select(*key, F.coalesce(F.sum("m").over(before), F.lit(0).cast("long")).alias("before"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id", *carry))
    ranked = _same(runs.withColumn("place", place), lengths, key)
    ranked = ranked.withColumn("copies", F.col("base") + (F.col("place") + F.col("before") <= F.col("extra")).cast("long"))
    out = ["doc_id", "size", "source_size", "target", "copies", *carry]
    return alike.select(*out).unionByName(ranked.select(*out)).withColumn("taken", F.col("copies") * F.col("size"))


def op5_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
