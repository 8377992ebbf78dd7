"""Bug injection: a registry of edits, each to the first place that fits, else null.

An edit is a pattern and what replaces its first match (a template or a function of the
match). `comment_out` edits keep the old line as a comment below a marker. The registry can
be extended; `mutations` gives every distinct result for a text as rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import normalized
from tidewater.operators.lineage import held

Edit = Callable[[str], str | None]
REGISTRY: dict[str, Edit] = {}
KINDS: dict[str, str] = {}


def register(slug: str, kind: str, edit: Edit) -> Edit:
    """Adds an edit for artifacts of a kind (kernel, graph or stream)."""
    REGISTRY[slug], KINDS[slug] = edit, kind
    return edit


def change(pattern: str, put: str | Callable[[re.Match], str | None], *more: tuple[str, str | Callable]) -> Edit:
    """Tries each pattern in turn; null if none changes the text."""
    return _first_change([(p, r, None) for p, r in ((pattern, put), *more)])


def comment_out(label: str, *patterns: str) -> Edit:
    return _first_change([(*_lines_of(label, p), p) for p in patterns])


def _first_change(tries: list[tuple[str, str | Callable, str | None]]) -> Edit:
    """An edit by (pattern, what is put, what must be in the pattern's lines). Lines before the first that has the last are passed over, as trying them all takes long."""
    compiled = [(re.compile(p, re.M), r, inside and re.compile(inside, re.M)) for p, r, inside in tries]

    def edit(text: str) -> str | None:
        for p, r, inside in compiled:
            at = inside.search(text) if inside else None
            if inside and not at:
                continue
            for m in p.finditer(text, text.rfind("\n", 0, at.start()) + 1 if at else 0):
                new = r(m) if callable(r) else m.expand(r)
                if new is not None and new != m[0]:
                    return text[: m.start()] + new + text[m.end() :]
        return None

    return edit


def _lines_of(label: str, pattern: str) -> tuple[str, Callable]:
    return rf"^([ \t]*)((?!//)[^\n]*(?:{pattern})[^\n]*)$", lambda m: f"{m[1]}// BUG_INJECTED: {label}\n{m[1]}// ORIGINAL: {m[2]}"


def number(f: Callable[[int], int | None], group: int = 2) -> Callable[[re.Match], str | None]:
    """The match with its number group replaced by f of it (groups 1 to 3 make up the match)."""

    def put(m: re.Match) -> str | None:
        new = f(int(m[group]))
        return None if new is None else "".join(str(new) if i == group else m[i] for i in range(1, m.re.groups + 1))

    return put


def table(values: dict, otherwise=None) -> Callable:
    return lambda x: values.get(x, otherwise)


def _half(n: int) -> int | None:
    return n // 2 if n >= 4 else None


def hoisted_read(text: str) -> str | None:
    """Moves the first `auto x = *it++;` of a loop's body above the loop."""
    rows, heads, depth = text.split("\n"), [], 0
    for i, row in enumerate(rows):
        if re.match(r"\s*for\s*\(", row):
            heads.append((depth, i))
        if heads and re.match(r"\s*(?:const\s+)?auto\s+\w+\s*=\s*\*\w+\+\+\s*;", row) and depth > heads[-1][0] and i - heads[-1][1] <= 30:
            at = heads[-1][1]
            indent = re.match(r"\s*", rows[at])[0]
            return "\n".join([*rows[:at], indent + row.strip(), *rows[at:i], *rows[i + 1 :]])
        depth += row.count("{") - row.count("}")
        while heads and depth < heads[-1][0]:
            heads.pop()
    return None


_RATIO = r"(runtime\s*<\s*ratio\s*>\s*\([^)]*\)\s*=\s*)([0-9.]+)"
_CONNECT = r"connect\s*<[^;\n]*>\s*[^;\n]*;"

for _slug, _kind, _edit in (
    ("stream_deadlock", "stream", comment_out("stream_deadlock", r"\bwriteincr\s*\(", r"\*\s*out\w*\s*\+\+\s*=")),
    ("window_oob", "kernel", change(r"(for\s*\([^;]*;[^;<]*)<(?![=<])([^;]*;)", r"\1<=\2")),
    ("missing_iterator_increment", "kernel", change(r"\*\s*(\w+)\+\+\s*=(?!=)", r"*\1 =")),
    ("dereference_moved_outside_loop", "kernel", hoisted_read),
    ("runtime_ratio_zero", "graph", change(_RATIO, lambda m: f"{m[1]}0" if float(m[2] or 0) else None)),
    ("plio_width_mismatch", "graph", change(r"(plio_)(16|32|64|128)(_bits)", number(table({16: 32, 32: 128, 64: 32, 128: 32})))),
    ("reversed_connect_direction", "graph", change(r"(connect\s*<[^;\n]*>\s*\w*\s*\()\s*([^,;\n]+?)\s*,\s*([^;\n]+?)\s*(\)\s*;)", r"\1\3, \2\4")),
    ("missing_output_write", "kernel", comment_out("missing_output_write", r"\bwriteincr\s*\(", r"\bwindow_writeincr\s*\(", r"\*\s*out\w*\s*\+\+\s*=")),
    ("wrong_vector_lane_width", "kernel", change(r"(begin_vector<\s*)(\d+)(\s*>)", number(table({8: 16, 16: 8}, 8)), (r"(aie::vector<\s*\w+\s*,\s*)(\d+)(\s*>)", number(table({8: 16, 16: 8}, 8))))),
    ("graph_dimension_mismatch", "graph", change(r"(\{\s*)(\d+)([^{}]*\})", number(lambda n: n + 16))),
    ("subtraction_for_addition", "kernel", change(r"^((?!\s*(?://|#|for\b))[^\n+]*\w) \+ (\w[^\n]*)$", r"\1 - \2")),
    ("mul_to_add", "kernel", change(r"\baie::mul\b", "aie::add")),
    ("tovector_shift_fifteen", "kernel", change(r"(to_vector(?:<[^>]*>)?\s*\(\s*)(0)(\s*\))", r"\g<1>15\3", (r"(to_vector(?:<[^>]*>)?\s*\()()(\s*\))", r"\g<1>15\3"))),
    ("acc48_for_acc80", "kernel", change(r"\bacc80\b", "acc48")),
    ("loop_count_halved", "kernel", change(r"(for\s*\([^;]*;[^;]*<\s*)(\d+)(\s*;)", number(_half))),
    ("window_size_halved", "kernel", change(r"(window(?:_size)?\s*[<(]\s*)(\d+)(\s*[>)])", number(_half))),
    ("remove_zeros_init", "kernel", change(r"aie::zeros<([^>]*)>\(\)", r"aie::broadcast<\1>(1)")),
    ("broadcast_width_mismatch", "kernel", change(r"(aie::broadcast<[^,>]*,\s*)(\d+)(\s*>)", number(table({8: 4, 16: 8, 4: 8, 32: 16})))),
    ("duplicate_stream_read", "stream", change(r"(readincr(?:_v\d+)?(?:<[^>]*>)?\s*\(\s*)(\w+)(\s*\)[\s\S]*?readincr(?:_v\d+)?(?:<[^>]*>)?\s*\(\s*)(?!\2\b)(\w+)", r"\1\2\3\2")),
    ("drop_last_sample", "kernel", change(r"(for\s*\([^;]*;[^;]*<\s*)(\w+)(\s*;)", r"\1\2 - 1\3")),
    ("remove_chess_pipelining", "kernel", comment_out("remove_chess_pipelining", r"chess_prepare_for_pipelining")),
    ("readincr_from_output", "stream", change(r"(readincr(?:_v\d+)?(?:<[^>]*>)?\s*\(\s*)(\w+)", lambda m: None if "out" in m[2] else m[1] + (re.sub(r"in", "out", m[2], count=1) if "in" in m[2] else "out"))),
    ("break_in_pipelined_loop", "kernel", change(r"(for\s*\([^{]*\{)", r"\1\n    if (false) { break; }")),
    ("runtime_ratio_overflow", "graph", change(_RATIO, lambda m: f"{m[1]}2.0")),
    ("port_index_oob", "graph", change(r"((?:\.in|\.out)\s*\[\s*)(\d+)(\s*\])", number(lambda n: n + 4))),
    ("missing_graph_wait", "graph", comment_out("missing_graph_wait", r"\.wait\s*\(")),
    ("missing_connect", "graph", comment_out("missing_connect", _CONNECT)),
    ("self_loop_connect", "graph", change(r"(connect\s*<[^;\n]*>\s*\w*\s*\(\s*)(\w+)(\.out\[[^\]]*\]\s*,\s*)(?!\2\b)(\w+)(\.in)", r"\1\2\3\2\5")),
    ("wrong_to_vector_output_type", "kernel", change(r"(to_vector<\s*)(cint16|cint32|int16|int32)(\s*>)", lambda m: m[1] + {"int16": "int32", "int32": "int16", "cint16": "cint32", "cint32": "cint16"}[m[2]] + m[3])),
    ("missing_adf_source", "graph", comment_out("missing_adf_source", r"(?:adf::)?\bsource\s*\(")),
    ("missing_runtime_ratio", "graph", comment_out("missing_runtime_ratio", r"runtime\s*<\s*ratio\s*>")),
    ("window_margin_to_size", "graph", change(r"(window<\s*)(\d+)(\s*,\s*)(\d+)(\s*>)", lambda m: f"{m[1]}{m[2]}{m[3]}{int(m[2]) + 8}{m[5]}")),
    ("bfloat16_on_aie1", "kernel", change(r"aie::vector<\s*int16\s*,\s*(\d+)\s*>", r"aie::vector<bfloat16, \1>")),
    ("signed_unsigned_mismatch", "kernel", change(r"^(\s*(?:const\s+)?)int16(\s+\w+\s*[=;\[])", r"\1uint16\2")),
    ("unaligned_load", "kernel", change(r"(load_v(?:<[^>]*>)?\s*\(\s*)(\w+)(\s*\))", r"\1\2 + 1\3")),
    ("modulo_in_loop", "kernel", change(r"\b(?!out)(\w+)\[i\]", r"\1[i % 32]")),
    ("break_accumulator_reset", "kernel", comment_out("break_accumulator_reset", r"=\s*aie::zeros")),
    ("begin_vector_non_power_of_two", "kernel", change(r"(begin_vector<\s*)(\d+)(\s*>)", number(lambda n: 10 if n == 6 else 6))),
):
    register(_slug, _kind, _edit)

#: Known, but no artifact is given to it.
UNDISPATCHED = {"acc48_for_acc80_reverse": change(r"accum<\s*acc48\s*,", "accum<acc80,")}


def slugs_for(artifact_type: str, interfaces: list[str]) -> list[str]:
    """The edits of an artifact in the registry's order: graph edits, or kernel edits, with the stream edits where it has streams."""
    wanted = {"graph"} if artifact_type == "graph_type" else {"kernel"} | ({"stream"} if "Stream" in interfaces else set())
    return [s for s, k in KINDS.items() if k in wanted]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("bug_type", T.StringType()), T.StructField("buggy", T.StringType())])))
def _apply(code: pd.Series, artifact: pd.Series, interfaces: pd.Series) -> pd.Series:
    out = []
    for c, a, i in zip(code, artifact, interfaces):
        found = [(s, REGISTRY[s](c)) for s in slugs_for(a, list(i) if i is not None else [])] if c else []
        out.append([{"bug_type": s, "buggy": b} for s, b in found if b is not None])
    return pd.Series(out)


def mutations(df: DataFrame, code: str, artifact: str, interfaces: str, most: int = 16) -> DataFrame:
    """A row for each edit that fits (bug_type, buggy), one of equal normalised results, `most` a source in the registry's order."""
    found = F.transform(_apply(code, artifact, interfaces), lambda m: F.struct(m["bug_type"].alias("bug_type"), m["buggy"].alias("buggy"), F.md5(F.concat(m["bug_type"], normalized(m["buggy"]))).alias("key")))
    d = held(df, __m=found)  # normalised once an edit, not once for each pair of edits
    keys = F.transform("__m", lambda m: m["key"])
    first = F.filter("__m", lambda m, i: F.array_position(F.transform("__m", lambda x: x["key"]), m["key"]) == i + 1)
    return d.where(F.size(keys) > 0).withColumn("__m", F.explode(F.slice(first, 1, most))).select(*df.columns, "__m.bug_type", "__m.buggy")


def mutate(df: DataFrame, code: str, slug: str) -> DataFrame:
    """df with `buggy`: the code edited as its slug says, null for unknown slugs and where nothing fits."""

    @F.pandas_udf(T.StringType())
    def run(c: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([REGISTRY[y](x) if x and y in REGISTRY else None for x, y in zip(c, s)], dtype=object)

    return df.withColumn("buggy", run(code, slug))
