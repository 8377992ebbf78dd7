"""Aggregates: counts, shares, coverage, audits, ledgers. For percentiles see quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def most_common(df: DataFrame, key: str, n: int, order: str) -> DataFrame:
    """The n most frequent values; of equal counts the one that is met first."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first_at")).orderBy(F.desc("n"), "first_at").limit(n)


def summaries(df: DataFrame, *keys: str) -> DataFrame:
    """Counts by each key alone and of all rows, from one scan: `by` names the key, `value` its value."""
    sets = [(k,) for k in keys] + [()]
    view = df.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(F.count("*").alias("n"), *[F.grouping(k).alias(f"__{k}") for k in keys])
    by, value = F.lit("all"), F.lit(None).cast("string")
    for k in keys:
        by, value = F.when(F.col(f"__{k}") == 0, k).otherwise(by), F.when(F.col(f"__{k}") == 0, F.col(k).cast("string")).otherwise(value)
    return view.select(by.alias("by"), value.alias("value"), "n")


def label_coverage(df: DataFrame, column: str) -> DataFrame:
    """(label, n) over a column of lists."""
    return df.select(F.explode(column).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def repetition(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """For each key: rows, distinct texts, and how often the most repeated one occurs."""
    each = df.groupBy(*keys, text).agg(F.count("*").alias("c"))
    return each.groupBy(*keys).agg(F.sum("c").alias("n"), F.count(text).alias("n_distinct"), F.max("c").alias("most"))


def accept_rates(df: DataFrame, key: str, rejected: Column, accepted: Column, limits: tuple[float, float] = (0.6, 0.8)) -> DataFrame:
    d = df.groupBy(key).agg(F.count("*").alias("attempts"), F.count_if(rejected).alias("rejects"), F.count_if(accepted).alias("accepted"))
    d = d.withColumn("reject_rate", F.col("rejects") / F.greatest(F.col("attempts"), F.lit(1)))
    return d.withColumn("above_low", F.col("reject_rate") > limits[0]).withColumn("above_high", F.col("reject_rate") > limits[1])


def pattern_coverage(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """One row of counts: rows that match each pattern, and rows that match it twice or more."""
    out = [F.count("*").alias("n")]
    for name, p in patterns.items():
        out += [F.count_if(F.col(column).rlike(p)).alias(f"{name}_rows"), F.count_if(F.regexp_count(column, F.lit(p)) >= 2).alias(f"{name}_twice")]
    return df.agg(*out)


def verdict_counts(df: DataFrame, verdict: str, confidence: str, error: str) -> DataFrame:
    """Present, absent, uncertain and failed audits by confidence; an unreadable verdict is null."""
    return df.groupBy(confidence).agg(
        F.count_if(F.col(verdict) & ~F.col(error)).alias("present"), F.count_if(~F.col(verdict) & ~F.col(error)).alias("absent"),
        F.count_if(F.col(verdict).isNull() & ~F.col(error)).alias("uncertain"), F.count_if(error).alias("errors"),
    )


def cost_totals(ledger: DataFrame, prices: DataFrame, model: str, tokens_in: str, tokens_out: str, default_in: float = 1.0, default_out: float = 5.0) -> DataFrame:
    """Runs, tokens and USD by model; prices (model, price_in, price_out) are per million tokens, models without one get the defaults."""
    sums = ledger.groupBy(model).agg(F.count("*").alias("runs"), F.sum(tokens_in).alias("tokens_in"), F.sum(tokens_out).alias("tokens_out"))
    p_in, p_out = F.coalesce("price_in", F.lit(default_in)), F.coalesce("price_out", F.lit(default_out))
    return sums.join(prices, model, "left").select(model, "runs", "tokens_in", "tokens_out", ((F.col("tokens_in") * p_in + F.col("tokens_out") * p_out) / 1e6).alias("usd"))


def quality_audit(df: DataFrame, reasons: str) -> DataFrame:
    """(reason, n) over a column of lists of reasons."""
    return label_coverage(df, reasons).select(F.col("label").alias("reason"), "n")


def n_rows(df: DataFrame, *tests: Column | str) -> DataFrame:
    """One row: n, and n_1, n_2, ... that pass each test (what is null does not)."""
    counted = [F.count_if(F.coalesce(F.expr(t) if isinstance(t, str) else t, F.lit(False))).alias(f"n_{i}") for i, t in enumerate(tests, 1)]
    return df.agg(F.count("*").alias("n"), *counted)


def labelled_counts(df: DataFrame, column: str, labels: dict[str, str], missing: str = "unknown") -> DataFrame:
    """(label, n, share) for a chart: values under their labels (several may have one), others under themselves, the largest first."""
    table = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]) if labels else None
    value = F.coalesce(F.col(column), F.lit(missing))
    label = F.coalesce(F.try_element_at(table, value), value) if labels else value
    d = df.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    total = d.agg(F.sum("n").alias("__all"))
    return d.join(F.broadcast(total)).select("label", "n", (F.col("n") / F.col("__all")).alias("share")).orderBy(F.desc("n"), "label")  # the side is one row


def bars(counts: list[tuple[str, int]], title: str, width: int = 640) -> str:
    """An SVG of horizontal bars, for a report's few rows."""
    from html import escape

    most, high = max((n for _, n in counts), default=1) or 1, 24
    lines = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{high * (len(counts) + 2)}" font-family="sans-serif" font-size="12">', f'<text x="8" y="{high - 6}" font-size="15">{escape(title)}</text>']
    for i, (label, n) in enumerate(counts, 1):
        y, long = high * i + 8, max(1, round((width - 300) * n / most))
        lines.append(f'<text x="8" y="{y + 13}">{escape(label)}</text><rect x="220" y="{y}" width="{long}" height="{high - 8}" fill="#4878a8"/><text x="{228 + long}" y="{y + 13}">{n}</text>')
    return "\n".join([*lines, "</svg>"])
