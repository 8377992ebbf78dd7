"""Repositories over a host's interface: trees, files, searches, downloads with headers.

The host is a client object with `default_branch(repo)`, `tree(repo, branch)` (of path, sha,
size), `blob(repo, sha)`, `raw(repo, branch, path)` and `search(query)` (of repo, branch, path,
sha); tasks make their own, so tests and mirrors need no network. What a host does not give
(an error) is told in `error` and ends no task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import describe
from tidewater.functions import screens as S
from tidewater.functions.text import content_hash
from tidewater.operators import merge, selection

_FILES = "repo string, branch string, path string, sha string, error string"


def _asked(df: DataFrame, make_host: Callable, schema: str, answer: Callable) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host = make_host()
        for frame in frames:
            found = []
            for row in frame.to_dict("records"):
                try:
                    found += list(answer(host, row))
                except Exception as e:  # the host's trouble with one row
                    found.append({**{n: row.get(n) for n in names}, "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(found, columns=names).astype(object)

    return df.mapInPandas(run, schema)


def trees(targets: DataFrame, make_host: Callable) -> DataFrame:
    """Files of (repo, branch); a missing branch is the repository's own."""

    def answer(host, row):
        branch = row["branch"] or host.default_branch(row["repo"])
        for path, sha, _ in host.tree(row["repo"], branch):
            yield {"repo": row["repo"], "branch": branch, "path": path, "sha": sha, "error": None}

    return _asked(targets.select("repo", "branch"), make_host, _FILES, answer)


def searched(queries: DataFrame, make_host: Callable) -> DataFrame:
    """Files that (query) finds, each once."""

    def answer(host, row):
        for repo, branch, path, sha in host.search(row["query"]):
            yield {"repo": repo, "branch": branch, "path": path, "sha": sha, "error": None}

    return selection.first_of(_asked(queries.select("query"), make_host, _FILES, answer), ["repo", "path", "sha"], ["branch"])


def entries(files: DataFrame, make_host: Callable, seen: DataFrame, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Corpus entries of those files whose path and content are candidates and whose content is new: one for each content, the first by repository and path."""

    def answer(host, row):
        yield {**row, "code": host.blob(row["repo"], row["sha"]), "error": None}

    asked = files.where(F.col("error").isNull() & S.path_candidate(F.col("path"), prefixes)).select("repo", "branch", "path", "sha")
    got = _asked(asked, make_host, "repo string, branch string, path string, sha string, code string, error string", answer)
    code = F.col("code")
    d = got.where(code.isNotNull() & S.content_candidate(code)).withColumn("content", content_hash(code))
    d = selection.first_of(merge.without(d, seen, "content"), ["content"], ["repo", "path"])
    return d.select(
        "repo", "branch", "path", F.regexp_extract("path", r"[^/]*\z", 0).alias("filename"), "code", "content", describe.blob_url(F.col("repo"), F.col("branch"), F.col("path")).alias("source_url"), S.corpus_category(code).alias("category"),
        S.compute_patterns(code).alias("compute_pattern"), S.data_types(code).alias("data_types"), S.corpus_interfaces(code).alias("interfaces"), F.lit("real_world").alias("complexity"),
    )


def discovered(found: DataFrame, known: DataFrame) -> DataFrame:
    """(repo, branch) of repositories that a search found and that are no targets yet."""
    return merge.without(found.where("error is null").select("repo").distinct(), known, "repo").withColumn("branch", F.lit(None).cast("string"))


def downloads(files: DataFrame, make_host: Callable, hints: tuple[str, ...]) -> DataFrame:
    """(repo, branch, path, text, error): relevant files as they are stored, with the header that says where each is from."""

    def answer(host, row):
        yield {**row, "text": host.raw(row["repo"], row["branch"], row["path"]), "error": None}

    got = _asked(files.where("error is null").select("repo", "branch", "path"), make_host, "repo string, branch string, path string, text string, error string", answer)
    low = F.lower("text")
    relevant = F.lit(False)
    for hint in hints:
        relevant = relevant | F.contains(low, F.lit(hint.lower()))
    owner, name = F.substring_index("repo", "/", 1), F.substring_index("repo", "/", -1)
    headed = F.concat(describe.source_header(owner, name, F.col("branch"), F.col("path"), F.col("text")), "text")
    return got.where(F.col("error").isNotNull() | F.coalesce(relevant, F.lit(False))).withColumn("text", headed)
