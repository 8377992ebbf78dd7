"""Diffs, similarity and windows of changed lines: sequence comparison has no native form, so these are Arrow UDFs of one row at a time. Long sequences go to blocks.Matcher."""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.blocks import matcher

_TEXTS = T.ArrayType(T.StringType())
#: Rows whose results a worker holds as Python values.
ROWS = 200


def unified(buggy: str | None, fixed: str | None, name: str = "aie_source", context: int = 3) -> str:
    """A unified diff with `a/` and `b/` headers on lines of their own; '' where nothing differs."""
    a, b = (buggy or "").splitlines(), (fixed or "").splitlines()
    return "".join(f"{line}\n" for line in difflib.unified_diff(a, b, f"a/{name}", f"b/{name}", lineterm="", n=context))


def similarity(a: str | None, b: str | None) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    return 1.0 if a == b else matcher(a, b).ratio()


def similarity_at_least(a: str | None, b: str | None, least: float) -> float:
    """The ratio where it can reach `least`, else a bound below it: the cheap upper bounds come first."""
    if not a or not b or a == b:
        return similarity(a, b)
    m = matcher(a, b)
    for bound in (m.real_quick_ratio, m.quick_ratio):
        if (most := bound()) < least:
            return most
    return m.ratio()


def changed_lines(a: str | None, b: str | None) -> int:
    """Lines that are added plus lines that are taken away."""
    m = matcher((a or "").splitlines(), (b or "").splitlines())
    return sum((i2 - i1) + (j2 - j1) for tag, i1, i2, j1, j2 in m.get_opcodes() if tag != "equal")


def anchors(a: str | None, b: str | None, most: int = 12) -> tuple[list[str], list[str]]:
    """Distinct stripped lines that only the second, and only the first text has at a change; `most` of each."""
    left, right = (a or "").splitlines(), (b or "").splitlines()
    added, gone = {}, {}
    for tag, i1, i2, j1, j2 in matcher(left, right).get_opcodes():
        if tag != "equal":
            added |= dict.fromkeys(x.strip() for x in right[j1:j2] if x.strip())
            gone |= dict.fromkeys(x.strip() for x in left[i1:i2] if x.strip())
    return list(added)[:most], list(gone)[:most]


def proof(buggy: str | None, fixed: str | None, answer: str | None, least_added: float = 0.5, least_gone: float = 0.6) -> bool:
    """Whether an answer differs from the buggy text, has enough of the fix's added lines, and lacks enough of the removed ones; no lines count as all."""
    added, gone = anchors(buggy, fixed)
    own = {x.strip() for x in (answer or "").splitlines()}
    share = lambda hits, all_: hits / len(all_) if all_ else 1.0
    changed = {x.strip() for x in (buggy or "").splitlines()} != own
    return changed and share(sum(x in own for x in added), added) >= least_added and share(sum(x not in own for x in gone), gone) >= least_gone


def crop(buggy: str | None, fixed: str | None, window: int = 20, most_chars: int = 4000, most_share: float = 0.75) -> str | None:
    """The buggy text's lines around its change; null if equal, or if the piece is neither short nor much shorter than the text."""
    left, right = (buggy or "").splitlines(), (fixed or "").splitlines()
    if left == right:
        return None
    head = next((i for i, (x, y) in enumerate(zip(left, right)) if x != y), min(len(left), len(right)))
    tail = next((i for i, (x, y) in enumerate(zip(reversed(left[head:]), reversed(right[head:]))) if x != y), min(len(left), len(right)) - head)
    piece = "\n".join(left[max(0, head - window) : len(left) - tail + window])
    return piece if len(piece) < most_chars or len(piece) < most_share * len(buggy or "") else None


def _each(f: Callable, kind: pa.DataType, returned: T.DataType) -> Callable[..., Column]:
    """f of each row. Of a batch, which may hold 10,000 rows, the texts of a row are Python's only while it is worked on, and results go to Arrow `ROWS` at a time."""

    def run(*columns: pa.Array) -> pa.Array:
        pieces, size = [], len(columns[0])
        for start in range(0, size, ROWS):
            rows = range(start, min(start + ROWS, size))
            pieces.append(pa.array([f(*(c[i].as_py() for c in columns)) for i in rows], kind))
        return pa.concat_arrays(pieces) if pieces else pa.array([], kind)

    return F.arrow_udf(run, returned)


unified_diff = _each(lambda a, b: unified(a, b), pa.string(), T.StringType())
similarity_ratio = _each(lambda a, b: similarity(a, b), pa.float64(), T.DoubleType())
n_changed_lines = _each(lambda a, b: changed_lines(a, b), pa.int64(), T.LongType())
fix_is_proven = _each(lambda buggy, fixed, answer: proof(buggy, fixed, answer), pa.bool_(), T.BooleanType())
cropped = _each(lambda a, b: crop(a, b), pa.string(), T.StringType())
anchor_lines = _each(
    lambda a, b: dict(zip(("added", "gone"), anchors(a, b))),
    pa.struct([("added", pa.list_(pa.string())), ("gone", pa.list_(pa.string()))]),
    T.StructType([T.StructField("added", _TEXTS), T.StructField("gone", _TEXTS)]),
)


def patched(old: Column, diff: Column) -> Column:
    """The lines of a text after a unified diff, joined by \\n; the text's lines where the diff is empty, null where it does not fit the text.

    The counterpart of unified_diff with native functions: whole hunks are put together, so it
    takes a step for each hunk and not for each line.
    """
    lines = lambda c: F.when(c == "", F.array().cast(_TEXTS)).otherwise(F.split(F.regexp_replace(c, r"\n\z", ""), "\n", -1))
    told = lines(F.coalesce(diff, F.lit("")))
    body = F.slice(told, 3, F.greatest(F.size(told), F.lit(1)))  # without the two headers
    marks = F.filter(F.transform(body, lambda x, i: F.when(x.rlike(r"\A@@ -\d+(,\d+)? \+\d+(,\d+)? @@\z"), i)), lambda i: i.isNotNull())
    number = lambda x, g: F.regexp_extract(x, r"\A@@ -(\d+)(?:,(\d+))?", g)

    def hunk(at: Column, k: Column) -> Column:
        head = F.get(body, at)
        own = F.slice(body, at + 2, F.coalesce(F.get(marks, k + 1), F.size(body)) - at - 1)
        size = F.when(number(head, 2) == "", F.lit(1)).otherwise(number(head, 2).cast("int"))
        text = lambda kinds: F.transform(F.filter(own, lambda x: F.substring(x, 1, 1).isin(*kinds)), lambda x: F.substring(x, 2, 1 << 30))
        return F.struct((number(head, 1).cast("int") - F.when(size == 0, 0).otherwise(1)).alias("first"), size.alias("size"), text([" ", "-"]).alias("gone"), text([" ", "+"]).alias("new"))

    source = lines(old)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_TEXTS).alias("out"), F.lit(True).alias("fits"))
    step = lambda acc, h: F.struct(
        (h["first"] + h["size"]).alias("at"),
        F.concat(acc["out"], F.slice(source, acc["at"] + 1, F.greatest(h["first"] - acc["at"], F.lit(0))), h["new"]).alias("out"),
        (acc["fits"] & (h["first"] >= acc["at"]) & (F.slice(source, h["first"] + 1, h["size"]) == h["gone"])).alias("fits"),
    )
    end = lambda acc: F.when(acc["fits"], F.array_join(F.concat(acc["out"], F.slice(source, acc["at"] + 1, F.greatest(F.size(source), F.lit(1)))), "\n"))
    return F.aggregate(F.transform(marks, hunk), start, step, end)
