"""The validated data set as twelve named targets, each a written table that later ones read.

A target is done when its write has left its marker (Spark's `_SUCCESS`), be it empty or not. What
is done is left alone unless it is forced; a target that fails ends the run, leaves no marker, and
is made again by the next run. Services (generation, compiler, mutation, audit) are functions from a DataFrame of
requests to one of answers, live or recorded. Rows of the data set go from version to version
and are never written over.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.operators import conversions, merge, rows, selection
from tidewater.sources import clients

Service = Callable[[DataFrame], DataFrame]
#: Columns of the data set's rows, and where each version of them may lie, the latest first.
ROW = "instruction string, context string, response string, bug_type string, source_id string, variant string, split string"
_VERSIONS = ("add_retry", "rm_absent", "rm_offtop", "merge_mut", "merge_neg")


@dataclass
class Build:
    """Where targets lie, the tables that come from outside, and the services."""

    spark: SparkSession
    path: str
    tables: dict[str, DataFrame]
    services: dict[str, Service]
    #: What ended the last run, by target.
    failures: dict[str, Exception] = field(default_factory=dict)

    def has(self, name: str) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return marker.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)

    def read(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.spark.read.parquet(f"{self.path}/{name}")

    def rows_before(self, name: str) -> DataFrame:
        """The data set as the last version before a target left it."""
        earlier = [v for v in _VERSIONS if v not in _VERSIONS[: _VERSIONS.index(name) + 1]]
        found = next((v for v in earlier if self.has(v)), None)
        return self.read(found or "rows")


def _generated(b: Build) -> DataFrame:
    return b.services["generate"](b.read("topics"))


def _compiled(b: Build) -> DataFrame:
    return b.services["compile"](b.read("generate").where("correct is not null"))


def _mutated(b: Build) -> DataFrame:
    return b.services["mutate"](b.read("compile").where("compile_ok"))


def _negatives(b: Build) -> DataFrame:
    failed = b.read("compile").where(~F.coalesce("compile_ok", F.lit(False)))
    return conversions.compile_negatives(failed.withColumn("candidate_code", F.col("correct")), ["source_id"])


def _with(b: Build, name: str, new: DataFrame) -> DataFrame:
    """The version before, and new rows, one of each triple, earlier ones first."""
    columns = [c.split()[0] for c in ROW.split(", ")]
    both = b.rows_before(name).select(*columns).withColumn("__late", F.lit(0)).unionByName(new.select(*columns).withColumn("__late", F.lit(1)))
    return selection.first_of(both, ["instruction", "context", "response"], ["__late", "source_id"]).drop("__late")


def _pairs(mutations: DataFrame, variant: str) -> DataFrame:
    d = rows.accepted_mutations(mutations)
    context, answer = F.concat(F.lit("Buggy version:\n"), "buggy"), C.fence(F.col("correct"))
    return d.select(F.lit("Fix the bug in this source and return the whole file.").alias("instruction"), context.alias("context"), answer.alias("response"), "bug_type", "source_id", F.lit(variant).alias("variant"), selection.split_percent(F.col("source_id")).alias("split"))


def _off_topic(b: Build) -> DataFrame:
    """Sources whose code has no word of their bug's slug."""
    d = b.read("compile").where("compile_ok").select("source_id", C.topic_hits(F.col("correct"), F.col("slug")).alias("hits"))
    return d.where("hits = 0").select("source_id")


def _absent(b: Build) -> DataFrame:
    """The version before without pairs whose bug the audit did not see."""
    seen = rows.audit_flags(b.read("audit")).where(F.coalesce(~F.col("present"), F.lit(False)) & ~F.col("error")).select(F.col("row_id").alias("source_id"))
    return merge.restricted_without(b.rows_before("rm_absent"), seen, "source_id", F.col("variant") == MUTATION)


def _retried(b: Build) -> DataFrame:
    gone = b.read("rm_offtop").where(F.col("variant") == MUTATION).join(b.read("rm_absent").select("source_id"), "source_id", "left_anti").select("source_id").distinct()
    sources = b.read("compile").select("source_id", "correct", "slug", "label")
    return b.services["mutate"](gone.join(sources, "source_id"))


MUTATION, RETRY = "v4_bedrock_buggy_from_compile_validated_correct", "v4_bedrock_retry"
#: The targets in their order.
STAGES: dict[str, tuple[str, Callable[[Build], DataFrame]]] = {
    "generate": ("generate correct code for each topic", _generated),
    "compile": ("compile the generated code", _compiled),
    "mutate": ("put bugs into code that compiles", _mutated),
    "negatives": ("make rows of code that does not compile", _negatives),
    "merge_neg": ("add those rows to the data set", lambda b: _with(b, "merge_neg", b.read("negatives").withColumn("source_id", F.col("group_id")))),
    "merge_mut": ("add pairs of buggy and correct code", lambda b: _with(b, "merge_mut", _pairs(b.read("mutate"), MUTATION))),
    "screen": ("find sources that miss their topic", _off_topic),
    "rm_offtop": ("remove pairs of such sources", lambda b: merge.restricted_without(b.rows_before("rm_offtop"), b.read("screen"), "source_id", F.col("variant") == MUTATION)),
    "audit": ("ask whether each pair's bug is there", lambda b: b.services["audit"](b.read("rm_offtop").where(F.col("variant") == MUTATION))),
    "rm_absent": ("remove pairs whose bug is not there", _absent),
    "retry": ("put bugs into those sources again", _retried),
    "add_retry": ("add the new pairs", lambda b: _with(b, "add_retry", _pairs(b.read("retry"), RETRY))),
}


def run(build: Build, only: Iterable[str] | None = None, force: bool = False) -> list[tuple[str, str, float]]:
    """(target, outcome, seconds) of the wanted targets in their order; after a failure, which build.failures then has as it was raised, the others are `not run`."""
    wanted = [s for s in STAGES if only is None or s in set(only)]
    build.failures.clear()
    report, broken = [], False
    for name in wanted:
        began = time.time()
        if broken:
            outcome = "not run"
        elif build.has(name) and not force:
            outcome = "skipped"
        else:
            try:
                STAGES[name][1](build).write.mode("overwrite").parquet(f"{build.path}/{name}")
                outcome = "ok"
            except Exception as e:
                outcome, broken = f"failed: {(str(e).splitlines() or [type(e).__name__])[0][:200]}", True
                build.failures[name] = e
        report.append((name, outcome, round(time.time() - began, 1)))
    return report


def recorded(answers: DataFrame, keys: list[str], order: str) -> Service:
    """A service that gives recorded answers."""
    return lambda requests: clients.offline(requests, answers, keys, order)
