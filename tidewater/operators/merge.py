"""Joins: pairing, first-hit lookups, upserts, anti-joins and result choice.

Build sides are made unique by an explicit rule before they join, so no join multiplies rows
by accident. Null keys match nothing unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.lineage import spread
from tidewater.operators.selection import first_of, last_of, ranked


def normal_path(path: Column) -> Column:
    """/mnt/c/... as c:/..., forward slashes, lower case."""
    c = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.lower(F.regexp_replace(c, r"\A/mnt/([A-Za-z])/", "$1:/"))


def base_name(path: Column) -> Column:
    return F.regexp_replace(path, r"(?s)\A.*/", "")


def pair_by_name(left: DataFrame, right: DataFrame, left_on: str, right_on: str, left_kind: str, right_kind: str, left_id: str, right_order: list[str]) -> DataFrame:
    """Each left row with one right row of its name, or none: the first of equal kind, else the first. Right columns get the prefix `of_`."""
    r = right.select(*[F.col(c).alias(f"of_{c}") for c in right.columns])
    met = left.join(r, left[left_on] == r[f"of_{right_on}"], "left")
    same = F.coalesce(F.col(left_kind) == F.col(f"of_{right_kind}"), F.lit(False))
    return ranked(met, [left_id], [F.desc(same), *[f"of_{c}" for c in right_order]], "__rank").where("__rank = 1").drop("__rank")


def counterpart(df: DataFrame, other: DataFrame, keys: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """df with the value of the last row of `other` that has its keys."""
    return df.join(last_of(other.select(*keys, value, *[c for c in order if c not in (*keys, value)]), keys, order).select(*keys, F.col(value).alias(name)), keys, "left")


def siblings(df: DataFrame, parent: str, key: str, kind: str, most: int = 4) -> DataFrame:
    """(key, sibling, place): up to `most` others of the same parent; of another kind first, then by the md5 of their key.

    Each side is first cut to what can be chosen, so pairs stay linear in the rows: of a
    parent's rows of one kind only the first `most` + 1 by md5 can be any row's siblings, and
    of its kinds only the `most` + 1 with the smallest first rows, as these hold the `most`
    smallest rows of kinds other than any one. Rows without a key are no siblings. What can be
    chosen of a parent is one array, out of which each row picks its own, so neither memory nor
    rows grow with the pairs; rows come dealt by key, however few files there are.
    """
    other = df.select(F.col(parent).alias("__p"), F.col(key).alias("sibling"), F.col(kind).alias("__kind"), F.md5(F.col(key).cast("string")).alias("__m"))
    other = ranked(other.where("sibling is not null"), ["__p", "__kind"], ["__m", "sibling"], "__k").where(F.col("__k") <= most + 1)
    kinds = other.groupBy("__p", "__kind").agg(F.min(F.struct("__m", "sibling")).alias("__least"))
    lead = ranked(kinds, ["__p"], ["__least"], "__kinds").where(F.col("__kinds") <= most + 1).drop("__least")
    other = other.join(lead, (other["__p"].eqNullSafe(lead["__p"])) & (other["__kind"].eqNullSafe(lead["__kind"]))).drop(lead["__p"]).drop(lead["__kind"])
    lists = other.groupBy("__p").agg(F.collect_list(F.struct("__kind", "__m", "sibling")).alias("__others"))  # (most + 1) squared at most
    met = spread(df.where(F.col(key).isNotNull()).select(F.col(parent).alias("__q"), key, kind)).join(lists, F.col("__q") == F.col("__p"))
    others = F.filter("__others", lambda x: x["sibling"] != F.col(key))
    ordered = F.array_sort(F.transform(others, lambda x: F.struct(x["__kind"].eqNullSafe(F.col(kind)).alias("same"), x["__m"].alias("m"), x["sibling"].alias("sibling"))))
    met = met.select(key, F.explode(F.slice(ordered, 1, most)).alias("__x")).select(key, "__x.*")
    met = ranked(met.repartition(key), [key], ["same", "m", "sibling"], "place")  # of a repeated key's rows, the first of all
    return met.where(F.col("place") <= most).select(key, "sibling", "place")


def first_hit(rows: DataFrame, results: DataFrame, rows_path: str, results_path: str, index: str, last_wins: bool = False) -> DataFrame:
    """Result columns (prefix `result_`) for each row: by (path, index), else by (base name, index)."""
    pick = last_of if last_wins else first_of
    plain = results.withColumn("__path", normal_path(F.col(results_path))).withColumn("__name", base_name(F.col("__path")))
    values = F.struct(*[F.col(c).alias(f"result_{c}") for c in results.columns])
    by_path = pick(plain, ["__path", index], results.columns).select(F.col("__path").alias("__p"), F.col(index).alias("__i"), values.alias("__by_path"))
    by_name = pick(plain, ["__name", index], results.columns).select(F.col("__name").alias("__n"), F.col(index).alias("__j"), values.alias("__by_name"))
    d = rows.withColumn("__path", normal_path(F.col(rows_path))).withColumn("__name", base_name(F.col("__path")))
    d = d.join(by_path, (F.col("__path") == F.col("__p")) & (F.col(index) == F.col("__i")), "left")
    d = d.join(by_name, (F.col("__name") == F.col("__n")) & (F.col(index) == F.col("__j")), "left")
    return d.withColumn("__r", F.coalesce("__by_path", "__by_name")).select(*rows.columns, "__r.*")


def choose_result(rows: DataFrame, results: DataFrame, keys: list[str], ok: str, duration: str, label: str) -> DataFrame:
    """Rows with `state` (working, not_working, not_validated) and the label of the result that counts: any ok one, else the shortest, then the smallest label."""
    best = results.groupBy(*keys).agg(F.min_by(F.struct(F.col(ok).alias("ok"), F.col(label).alias("chosen")), F.struct(~F.coalesce(F.col(ok), F.lit(False)), F.col(duration), F.col(label))).alias("b"))
    state = F.when(F.col("b").isNull(), "not_validated").when(F.col("b.ok"), "working").otherwise("not_working")
    return rows.join(best, keys, "left").withColumn("state", state).withColumn("chosen", F.col("b.chosen")).drop("b")


def upsert(base: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every base row of a key is replaced by the key's new row (the last, if several), rows of new keys are added; null keys are keys."""
    fresh = last_of(new, keys, order)
    on = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    b, n = base.alias("b"), fresh.select(*[F.col(c).alias(f"__{c}") for c in fresh.columns], F.lit(True).alias("__new"))
    met = b.join(n, [F.col(f"b.{k}").eqNullSafe(F.col(f"__{k}")) for k in keys], "full")
    value = lambda c: F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(f"b.{c}")) if c in new.columns else F.col(f"b.{c}")
    return met.select(*[value(c).alias(c) for c in base.columns])


def without(df: DataFrame, seen: DataFrame, *keys: str | list[str]) -> DataFrame:
    """Rows whose key is in none of the key sets of `seen` (one or several)."""
    for key in keys:
        names = [key] if isinstance(key, str) else key
        df = df.join(seen.select(*names).where(" and ".join(f"{n} is not null" for n in names)).distinct(), names, "left_anti")
    return df


def restricted_without(df: DataFrame, flagged: DataFrame, key: str, only: Column) -> DataFrame:
    """Without the rows that satisfy `only` and whose key is flagged."""
    hit = flagged.select(F.col(key).alias("__f")).where("__f is not null").distinct().withColumn("__hit", F.lit(True))
    return df.join(hit, df[key] == hit["__f"], "left").where(~(only & F.coalesce("__hit", F.lit(False)))).drop("__f", "__hit")


def last_event_open(events: DataFrame, keys: list[str], order: list[str], closes: Column) -> DataFrame:
    """Keys whose last event does not close them (a retry set folded in order)."""
    return last_of(events.select(*keys, *[c for c in order if c not in keys], closes.alias("__closed")), keys, order).where(~F.coalesce("__closed", F.lit(False))).select(*keys)
