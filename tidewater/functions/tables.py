"""Row generators as table functions, for SQL: one row of input, a few of output, by LATERAL join.

    register(spark)
    select s.*, v.* from sources s, lateral variants(s.path, map('fix', array('Fix it', 'Mend it'))) v

They give the rows of the DataFrame forms (rows.variants, recipes.synthesize_all, injection's
kinds) and share their rules. Types of arguments are checked when a query is analysed. Nulls give no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from tidewater.functions.injection import inject
from tidewater.functions.recipes import synthesize


def _expect(name: str, arguments: tuple[AnalyzeArgument, ...], *kinds: type) -> None:
    if len(arguments) != len(kinds):
        raise ValueError(f"{name} takes {len(kinds)} arguments")
    for k, (argument, kind) in enumerate(zip(arguments, kinds), 1):
        if not isinstance(argument.dataType, (kind, T.NullType)):
            raise ValueError(f"{name}: argument {k} is {argument.dataType.simpleString()}, not {kind.typeName()}")


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


class Variants:
    """(variant, instruction) for each entry of a map of variants to templates; the template is chosen by the md5 of path and variant."""

    @staticmethod
    def analyze(path: AnalyzeArgument, templates: AnalyzeArgument) -> AnalyzeResult:
        _expect("variants", (path, templates), T.StringType, T.MapType)
        return AnalyzeResult(T.StructType(_texts("variant", "instruction")))

    def eval(self, path: str | None, templates: dict[str, list[str]] | None) -> Iterator[tuple]:
        for variant, options in (templates or {}).items():
            if path is not None and options:
                yield variant, options[int(hashlib.md5(f"{path}:{variant}".encode()).hexdigest(), 16) % len(options)]


class TaxonomyPairs:
    """(buggy, correct, origin) of a slug and its label."""

    @staticmethod
    def analyze(slug: AnalyzeArgument, label: AnalyzeArgument) -> AnalyzeResult:
        _expect("taxonomy_pairs", (slug, label), T.StringType, T.StringType)
        return AnalyzeResult(T.StructType(_texts("buggy", "correct", "origin")))

    def eval(self, slug: str | None, label: str | None) -> Iterator[tuple]:
        if slug is not None:
            yield synthesize(slug, label or "")


class InjectedBugs:
    """(turn, bug_type, buggy) of a source for each of the kinds, in their order; kinds that change nothing give no row."""

    @staticmethod
    def analyze(code: AnalyzeArgument, category: AnalyzeArgument, kinds: AnalyzeArgument) -> AnalyzeResult:
        _expect("injected_bugs", (code, category, kinds), T.StringType, T.StringType, T.ArrayType)
        return AnalyzeResult(T.StructType([T.StructField("turn", T.IntegerType()), *_texts("bug_type", "buggy")]))

    def eval(self, code: str | None, category: str | None, kinds: list[str] | None) -> Iterator[tuple]:
        for turn, kind in enumerate(kinds or []):
            if (buggy := inject(code, category, kind)) is not None:
                yield turn, kind, buggy


class NumberedNames:
    """(slug, place) of a table of (base, at): in each base's group by at, the first keeps its name, the others get _2, _3; for TABLE arguments.

    The function asks for its own partitions and order, and holds one number, so a group of any size streams through.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or {"base", "at"} - {f.name for f in rows.dataType}:
            raise ValueError("numbered_names takes a table with the columns base and at")
        shape = T.StructType([T.StructField("base", T.StringType()), T.StructField("at", rows.dataType["at"].dataType), T.StructField("slug", T.StringType()), T.StructField("place", T.LongType())])
        return AnalyzeResult(shape, partitionBy=[PartitioningColumn("base")], orderBy=[OrderingColumn("at")])

    def __init__(self) -> None:
        self.place = 0

    def eval(self, row) -> Iterator[tuple]:
        self.place += 1
        yield row["base"], row["at"], row["base"] if self.place == 1 else f"{row['base']}_{self.place}", self.place


FUNCTIONS = {"variants": Variants, "taxonomy_pairs": TaxonomyPairs, "injected_bugs": InjectedBugs, "numbered_names": NumberedNames}


def register(spark: SparkSession) -> None:
    """Makes all of FUNCTIONS known to the session's SQL."""
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, udtf(function))
