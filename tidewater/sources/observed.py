"""Sinks that count what they write in the same pass.

Counts are metrics of the write itself (`DataFrame.observe`, just before the sink), so a table
is read once and no number can differ from what was written. They are there when the write has
ended; a task that is run again counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def written_and_counted(df: DataFrame, path: str, counts: dict[str, Column], by: list[str] | None = None) -> dict[str, object]:
    """Writes df as Parquet, partitioned by `by`, and gives the aggregates over all its rows; counts of no rows are 0, other aggregates null."""
    seen = Observation()
    out = df.observe(seen, F.count("*").alias("__n"), *[c.alias(k) for k, c in counts.items()]).write.mode("errorifexists")
    (out.partitionBy(*by) if by else out).parquet(path)
    told = seen.get
    return {"rows": told.pop("__n"), **told}


def kept_and_dropped(df: DataFrame, path: str, reasons: str, known: list[str], cost: Column | None = None) -> dict[str, object]:
    """Writes df partitioned by `kept` (a row without reasons is kept) and gives rows, kept, dropped, the rows with each known reason, those with another, and what all cost.

    A null list of reasons is none; a row with several counts for each.
    """
    of = F.coalesce(F.col(reasons), F.array().cast("array<string>"))
    kept = F.size(of) == 0
    counts = {"kept": F.count_if(kept), "dropped": F.count_if(~kept)}
    counts |= {f"reason_{k}": F.count_if(F.array_contains(of, k)) for k in known}
    counts["reason_other"] = F.count_if(F.size(F.array_except(of, F.array(*[F.lit(k) for k in known]).cast("array<string>"))) > 0)
    if cost is not None:
        counts["cost"] = F.sum(cost)
    return written_and_counted(df.withColumn("kept", kept), path, counts, ["kept"])


def summary_rows(df: DataFrame, told: dict[str, object]) -> DataFrame:
    """(name, value): a summary as a table."""
    return df.sparkSession.createDataFrame([(k, None if v is None else float(v)) for k, v in told.items()], "name string, value double")
