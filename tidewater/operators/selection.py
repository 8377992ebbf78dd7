"""Deduplication, caps, strides, balancing and splits on slim keys.

Each takes and returns DataFrames. `order` names columns that give a total order; ties are
broken by what the caller puts there. Windows are over a group's key columns; where a group
may hold most of the rows, ranks come from ranges of the whole order (see placed).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import hash_mod, hex_mod
from tidewater.operators.lineage import settle, written


def first_of(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key; rows with equal nulls are equal. One aggregation with a partial step, so hot keys shrink before the shuffle."""
    named = df.select("*", *[k.alias(f"__k{i}") if isinstance(k, Column) else F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    least = named.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__r"))
    return least.select("__r.*")


def last_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key (the write that stays)."""
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__r"))
    return kept.select("__r.*")


def ranked(df: DataFrame, group: list[str], order: list, name: str = "rank") -> DataFrame:
    """df with each row's rank from 1 in its group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def first_n(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps n rows a task and group before the shuffle."""
    return ranked(df, group, order, "__rank").where(F.col("__rank") <= n).drop("__rank")


def numbered(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """df with each row's rank from 1 in one order of all rows, without putting all in one task.

    Rows are dealt to ranges of the whole order, as many as a shuffle has, and written once;
    a rank is the place in a range after the rows of the ranges before (a row for each range).
    Nulls come first; rows that are equal in the order are ranked as they lie.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    d = written(dealt.withColumn("__at", F.monotonically_increasing_id()))  # the range in the upper bits, the place in the lower 33
    d = d.withColumn("__range", F.shiftright("__at", 33))
    sizes = d.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("__before"))
    d = d.join(F.broadcast(before), "__range")  # as many rows as ranges
    return d.withColumn(name, F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__before") + 1).drop("__at", "__range", "__before")


def placed(df: DataFrame, group: list[str], order: list, name: str = "rank") -> DataFrame:
    """df with each row's rank from 1 in its group, also where a group holds most of the rows: no task sorts a whole group."""
    if not group:
        return numbered(df, order, name)
    d = numbered(df, [*group, *order], "__all")
    first = d.groupBy(*group).agg(F.min("__all").alias("__first")).select(*[F.col(g).alias(f"__of_{g}") for g in group], "__first")
    on = [F.col(g).eqNullSafe(F.col(f"__of_{g}")) for g in group]
    return d.join(first, on).withColumn(name, F.col("__all") - F.col("__first") + 1).drop("__all", "__first", *[f"__of_{g}" for g in group])


def cap_share(df: DataFrame, group: list[str], order: list, share: float) -> DataFrame:
    """At most max(1, int(total * share)) rows of each group."""
    cap = max(1, int(df.count() * share))
    return placed(df, group, order, "__rank").where(F.col("__rank") <= cap).drop("__rank")


def round_robin(df: DataFrame, tier: str, kind: str, order: list, shares: dict[str, float], default: float = 1.0, total: int | None = None) -> DataFrame:
    """For each tier at most int(total * share) rows, taken in turns from its kinds in the order they are first met, and one of each kind at least. total: all rows, if not given."""
    total = df.count() if total is None else total
    cap = F.coalesce(*[F.when(F.col(tier) == k, F.lit(int(total * v))) for k, v in shares.items()], F.lit(int(total * default)))
    firsts = df.groupBy(tier, kind).agg(F.min(F.struct(*order)).alias("__met")).select(F.col(tier).alias("__t"), F.col(kind).alias("__k"), "__met")
    d = placed(df, [tier, kind], order, "__q").join(firsts, F.col(tier).eqNullSafe(F.col("__t")) & F.col(kind).eqNullSafe(F.col("__k"))).drop("__t", "__k")
    d = placed(d, [tier], ["__q", "__met"], "__turn")
    return d.where((F.col("__turn") <= cap) | (F.col("__q") == 1)).drop("__q", "__met", "__turn")


def stride(df: DataFrame, order: list, allowed: int | Column, group: list[str] | None = None) -> DataFrame:
    """Every k-th row of the order, the first `allowed` of them; k = max(1, rows // allowed)."""
    keys = group or []
    d = placed(df, keys, order, "__rank")
    sizes = d.groupBy(*keys).agg(F.count("*").alias("__n")).select(*[F.col(k).alias(f"__of_{k}") for k in keys], "__n")
    d = d.join(sizes, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]).drop(*[f"__of_{k}" for k in keys]) if keys else d.join(F.broadcast(sizes))  # one row
    limit = allowed if isinstance(allowed, Column) else F.lit(allowed)
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / F.greatest(limit, F.lit(1))))
    return d.where(((F.col("__rank") - 1) % step == 0) & ((F.col("__rank") - 1) / step < limit)).drop("__rank", "__n")


def diverse_order(df: DataFrame, group: str, key: str, within: list[str], name: str = "turn") -> DataFrame:
    """df without repeated rows of a key, and with the turn of each row: in each `within`, the first of every group in the groups' order, then the rest by key.

    In the rest a key counts once, and not if a first row has it. Ties of the key go by all columns.
    """
    order = [key, *[c for c in df.columns if c != key]]
    d = placed(df, [*within, group], order, "__q")
    first = d.where("__q = 1").withColumn("__late", F.lit(0)).withColumn("__group", F.col(group))
    rest = first_of(d.where("__q > 1"), [*within, key], order).withColumn("__late", F.lit(1)).withColumn("__group", F.lit(None).cast(df.schema[group].dataType))
    taken = first.select(*[F.col(c).alias(f"__of_{c}") for c in (*within, key)]).distinct()
    rest = rest.join(taken, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in (*within, key)], "left_anti")
    d = first.unionByName(rest).withColumn("__none", F.col("__group").isNull())
    return placed(d, within, ["__late", "__none", "__group", *order], name).drop("__q", "__late", "__group", "__none")


def diverse(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """n rows: the first (by key) of each group in the groups' order, then the rest by key; repeated keys are skipped in the rest."""
    return diverse_order(df, group, key, [], "__turn").where(F.col("__turn") <= n).orderBy("__turn").drop("__turn")


def rebalance(df: DataFrame, positive: str, kept: str, split: str, group: str, key: str, target: float) -> DataFrame:
    """In each split, positives that are kept, and so many others that these make up the target share.

    positive, kept: boolean columns; kept says which positives a diversification leaves. Their
    share of all rows of the split counts (other positives included): from the target on, all
    others stay; below it, the first int(p * (1 - t) / t) others, the groups taken in turn (see
    diverse_order). A split without positives stays whole.
    """
    sizes = df.groupBy(split).agg(F.count("*").alias("__n"), F.count_if(F.col(positive)).alias("__p"), F.count_if(F.col(positive) & F.col(kept)).alias("__c")).withColumnRenamed(split, "__split")
    whole = (F.col("__p") == 0) | (F.col("__c") / F.col("__n") >= target)
    sized = lambda d: d.join(sizes, F.col(split).eqNullSafe(F.col("__split")))
    others = sized(df.where(~F.col(positive)))
    few = sized(diverse_order(others.where(~whole).select(*df.columns), group, key, [split], "__turn")).where(F.col("__turn") <= F.floor(F.col("__c") * (1 - target) / target))
    return df.where(F.col(positive) & F.col(kept)).unionByName(others.where(whole).select(*df.columns)).unionByName(few.select(*df.columns))


def rotated(df: DataFrame, position: Column, key: Column, size: Column) -> DataFrame:
    """df with `turn`: the place of each row when a circle of `size` starts at the md5 of the key."""
    digits, start = F.md5(key), F.lit(0).cast("long")
    for at in range(1, 33, 8):  # the size is a column, so the modulus is taken step by step
        start = (start * (1 << 32) + F.conv(F.substring(digits, at, 8), 16, 10).cast("long")) % size
    return df.withColumn("turn", (position - start + size) % size)


def pick_contexts(df: DataFrame, turn: str, repo: str, parent: str, group: str, n: int) -> DataFrame:
    """n rows with `pass`: the first of each repository, then of each parent folder, then of each source group, then any, by turn."""
    first = lambda keys, order: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    d = df.withColumn("fr", first([repo], [turn]))
    d = d.withColumn("fp", first([parent], [F.desc("fr"), turn]))
    d = d.withColumn("fg", first([group], [F.desc("fr"), F.desc("fp"), turn]))
    d = d.withColumn("pass", F.when(F.col("fr"), 1).when(F.col("fp"), 2).when(F.col("fg"), 3).otherwise(4))
    return d.orderBy("pass", turn).limit(n).drop("fr", "fp", "fg")


def greedy_caps(df: DataFrame, key: str, fingerprint: str, kind: str, group: str, order: list[str], most_kind: int, most_group: int) -> DataFrame:
    """Keys kept by one pass in order: the fingerprint is new, and the kind's and the group's counts are below their caps; what is rejected uses nothing.

    The rule is sequential, but most rows need not wait for those before them. Each round takes
    a row if it is the first undecided one of its fingerprint and, even if all undecided rows
    before it were taken, its kind and group would have room; then it rejects the rows of taken
    fingerprints and of full kinds and groups. (Rows of a kind are only taken while there is
    room for all undecided rows before them, so a kind that is full has none before its last.)
    The first undecided row is settled in every round, so rounds end; a few do in practice, one
    for each row of a chain in which every row's room depends on the row before it.

    Of one fingerprint, kind and group only the first row goes on, and of the fingerprints that
    one row has, the first rows of a kind and group up to the smaller cap. Undecided and taken
    rows are slim tables; ranks end at a cap, so Spark cuts them in each task before the shuffle.
    Nulls are values; rows that are equal in the order go by key.
    """
    slim = df.select(F.col(key).alias("__key"), F.col(fingerprint).alias("__f"), F.col(kind).alias("__k"), F.col(group).alias("__g"), F.struct(*order, key).alias("__o"))
    slim = settle(first_of(slim, ["__f", "__k", "__g"], ["__o"]))
    most = lambda by: slim.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    if most("__k") <= most_kind and most("__g") <= most_group:
        return first_of(slim, ["__f"], ["__o"]).select(F.col("__key").alias(key))

    same = lambda c: F.col(c).eqNullSafe(F.col(f"{c}_"))
    shared = slim.groupBy(F.col("__f").alias("__f_")).count().where("count > 1")
    alone = first_n(slim.join(shared, same("__f"), "left_anti"), ["__k", "__g"], ["__o"], min(most_kind, most_group))
    waiting = slim.join(shared, same("__f"), "left_semi").unionByName(alone)
    none = F.lit(0).cast("long")
    waiting = settle(waiting.select("*", none.alias("__nk"), none.alias("__ng"), F.monotonically_increasing_id().alias("__id")))
    taken: list[DataFrame] = []
    while not waiting.isEmpty():
        room = lambda by, n, cap: ranked(waiting, [by], ["__o"], "__r").where(F.col("__r") <= cap).where(F.col("__r") <= cap - F.col(n))  # noqa: B023, E731
        heads = waiting.groupBy("__f").agg(F.min(F.struct("__o", "__id")).alias("h")).select("h.__id")
        new = room("__k", "__nk", most_kind).join(room("__g", "__ng", most_group).select("__id"), "__id", "left_semi").join(heads, "__id", "left_semi")
        new = settle(new.select("__key", "__f", "__k", "__g"))
        taken.append(new)
        for by, n in (("__k", "__nk"), ("__g", "__ng")):
            more = new.groupBy(F.col(by).alias(f"{by}_")).agg(F.count("*").alias("__more"))
            waiting = waiting.join(more, same(by), "left").withColumn(n, F.col(n) + F.coalesce("__more", none)).drop(f"{by}_", "__more")
        waiting = waiting.where((F.col("__nk") < most_kind) & (F.col("__ng") < most_group))
        waiting = settle(waiting.join(new.select(F.col("__f").alias("__f_")), same("__f"), "left_anti"))
    found = taken[0] if taken else slim.where("false")
    for new in taken[1:]:
        found = found.unionByName(new)
    return found.select(F.col("__key").alias(key))


def stratified(df: DataFrame, kind: str, tier: str, group: str, order: list[str], per_kind: int, tiers: list[str], most: int) -> DataFrame:
    """Held-out rows with `pick`, their place from 0 in their kind: at most per_kind of each kind, in turns over the tiers, no two of a kind from one group, `most` in all by kind and place.

    A missing kind is `unknown`, a missing tier `normal`, a missing group the empty one; order
    names columns that tell rows apart. A group that was taken once bars all its rows of the
    kind, so of a kind, tier and group only the first row counts, and of a kind and tier the
    first 2 * per_kind of those: fewer than per_kind can be barred. The turns are taken on
    these, a bounded number for each kind.
    """
    or_else = lambda c, v: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v))
    slim = df.select(*order, or_else(kind, "unknown").alias("__kind"), or_else(tier, "normal").alias("__tier"), F.coalesce(F.col(group), F.lit("")).alias("__group")).where(F.col("__tier").isin(tiers))
    few = first_n(first_of(slim, ["__kind", "__tier", "__group"], order), ["__kind", "__tier"], order, 2 * per_kind)
    few = few.withColumn("__turn", F.array_position(F.array(*[F.lit(t) for t in tiers]), F.col("__tier")))

    def turns(frame: pd.DataFrame) -> pd.DataFrame:
        waiting = {t: list(rows) for t, rows in frame.sort_values(order).groupby("__turn").groups.items()}
        picked, taken = [], set()
        while len(picked) < per_kind and any(waiting.values()):
            for t in sorted(waiting):
                free = [i for i in waiting[t] if frame["__group"][i] not in taken]
                if free and len(picked) < per_kind:
                    picked.append(free[0])
                    taken.add(frame["__group"][free[0]])
                waiting[t] = free[1:]
        return frame.loc[picked, order].assign(__kind=frame["__kind"].iloc[0], pick=range(len(picked)))

    shape = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in order)
    picked = few.groupBy("__kind").applyInPandas(turns, f"{shape}, __kind string, pick int")
    picked = picked.orderBy("__kind", "pick").limit(most)
    return df.join(picked, order).drop("__kind")


# ---- split rules


def split_fifth(group: Column) -> Column:
    """One group in five validates."""
    return F.when(hash_mod(group, 5) == 0, "validation").otherwise("train")


def split_percent(group: Column, percent: int = 20) -> Column:
    return F.when(hash_mod(group, 100, "sha1") < percent, "validation").otherwise("train")


def split_hex_id(source_id: Column, percent: int = 13) -> Column:
    """By the first 8 hex digits of an id."""
    return F.when(hex_mod(source_id, 8, 100) >= percent, "train").otherwise("validation")


def split_leaks(df: DataFrame, group: str, split: str) -> DataFrame:
    """Groups that span several splits: expected to be none."""
    return df.groupBy(group).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def split_missing(df: DataFrame, split: str) -> DataFrame:
    """Rows that neither output would hold."""
    return df.where(~F.coalesce(F.col(split).isin("train", "validation"), F.lit(False)))
