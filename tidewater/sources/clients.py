"""Outside services (generation, compilers) as pluggable clients over partitions, with offline tables as the default."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import strip_right


def with_retry(call: Callable[[dict], dict], tries: int = 4, delay: float = 1.0, busy: tuple[str, ...] = ("Throttling", "TooManyRequests", "429")) -> Callable[[dict], dict]:
    """The call, repeated with doubled waits while the service says it is busy."""

    def run(request: dict) -> dict:
        wait = delay
        for left in range(tries - 1, -1, -1):
            try:
                return call(request)
            except Exception as e:
                if not left or not any(b in f"{type(e).__name__} {e}" for b in busy):
                    raise
                time.sleep(wait)
                wait *= 2
        raise AssertionError

    return run


def call_service(requests: DataFrame, make_client: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """A row for each request from a client that each task makes for itself; finished keys should be taken out first (see pending)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            yield pd.DataFrame([client(r) for r in frame.to_dict("records")])

    return requests.mapInPandas(run, schema)


def offline(requests: DataFrame, answers: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The recorded answers of the requests, the last of each key; requests without one are left out."""
    last = answers.groupBy(*keys).agg(F.max_by(F.struct(*answers.columns), order).alias("a")).select("a.*")
    return requests.join(last, keys)


def pending(jobs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs whose key is not in the log yet."""
    return jobs.join(done.select(*keys).distinct(), keys, "left_anti")


def compile_jobs(rows: DataFrame, done: DataFrame, scopes: dict[str, str], targets: list[str], least_chars: int = 30) -> DataFrame:
    """(input_path, row_index, scope, target, code): each row's texts times targets, without short texts and finished jobs."""
    options = F.array(*[F.struct(F.lit(s).alias("scope"), F.col(c).alias("code")) for s, c in scopes.items()])
    jobs = rows.select("input_path", "row_index", F.explode(options).alias("s")).select("input_path", "row_index", "s.scope", "s.code")
    jobs = jobs.where(F.length("code") >= least_chars).withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
    return pending(jobs, done, ["input_path", "row_index", "scope", "target"])


def chat_rows(df: DataFrame, system: str, user: str, assistant: str) -> DataFrame:
    """df with messages: system, user and assistant."""
    role = lambda name, c: F.struct(F.lit(name).alias("role"), F.col(c).alias("content"))
    return df.withColumn("messages", F.array(role("system", system), role("user", user), role("assistant", assistant)))


def prompt_text(df: DataFrame) -> DataFrame:
    """df with `text` in the instruction, context, response layout."""
    part = lambda title, c: F.concat(F.lit(f"### {title}\n"), F.coalesce(F.col(c), F.lit("")), F.lit("\n\n"))
    return df.withColumn("text", strip_right(F.concat(part("Instruction", "instruction"), part("Context", "context"), part("Response", "response"))))
