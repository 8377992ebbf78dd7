"""Buggy and correct programs from a bug's label: the first recipe whose words fit and whose edit changes its template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.mutators import REGISTRY, change

KERNEL = """#include <aie_api/aie.hpp>

void scale_kernel(input_stream<int16>* __restrict in, output_stream<int16>* __restrict out) {
    aie::accum<acc48, 8> acc = aie::zeros<acc48, 8>();
    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {
        aie::vector<int16, 8> a = readincr_v<8>(in);
        acc = aie::mac(acc, a, a);
        aie::vector<int16, 8> b = aie::mul(a, a).to_vector<int16>(0);
        writeincr(out, aie::add(a, b));
    }
}
"""
GRAPH = """#include <adf.h>
using namespace adf;

class demo_graph : public graph {
public:
    kernel first, second;
    input_plio in;
    output_plio out;
    demo_graph() {
        in = input_plio::create("in", plio_32_bits, "data/in.txt");
        out = output_plio::create("out", plio_32_bits, "data/out.txt");
        first = kernel::create(first_kernel);
        second = kernel::create(second_kernel);
        connect<window<256, 64>>(in.out[0], first.in[0]);
        connect<stream>(first.out[0], second.in[0]);
        connect<stream>(second.out[0], out.in[0]);
        dimensions(first.in[0]) = {64};
        source(first) = "kernels/first.cc";
        source(second) = "kernels/second.cc";
        runtime<ratio>(first) = 0.8;
    }
};
"""

#: (name, words of which a label must have one of each group, template, edit), tried in this order.
RECIPES: list[tuple[str, tuple[tuple[str, ...], ...], str, Callable[[str], str | None]]] = [
    ("accumulator_width", (("accumulator", "acc48", "acc80"), ("width", "type", "acc48", "acc80", "wrong")), KERNEL, change(r"accum<acc48", "accum<acc80")),
    ("vector_lane", (("lane", "vector"), ("width", "lane", "size")), KERNEL, REGISTRY["wrong_vector_lane_width"]),
    ("plio_width", (("plio",), ("width", "bit")), GRAPH, REGISTRY["plio_width_mismatch"]),
    ("missing_window_margin", (("margin",),), GRAPH, change(r"window<256, 64>", "window<256>")),
    ("window_size", (("window",), ("size", "length")), GRAPH, change(r"window<256", "window<128")),
    ("runtime_ratio", (("ratio", "utilization"),), GRAPH, REGISTRY["runtime_ratio_zero"]),
    ("missing_source", (("source",), ("missing", "forgot", "no")), GRAPH, REGISTRY["missing_adf_source"]),
    ("missing_write", (("write", "output"), ("missing", "forgot", "no")), KERNEL, REGISTRY["missing_output_write"]),
    ("missing_increment", (("increment", "iterator"),), KERNEL.replace("writeincr(out, aie::add(a, b))", "*out++ = aie::add(a, b)"), REGISTRY["missing_iterator_increment"]),
    ("add_vs_sub", (("add", "addition"), ("sub", "subtraction")), KERNEL, change(r"aie::add", "aie::sub")),
    ("mul_vs_mac", (("mul", "multiply"), ("mac", "accumulate")), KERNEL, change(r"aie::mac\(acc, a, a\)", "aie::mul(a, a)")),
    ("unconsumed_stream", (("unconsumed", "deadlock", "unread"),), KERNEL, REGISTRY["stream_deadlock"]),
    ("duplicate_read", (("duplicate", "double", "twice"), ("read",)), KERNEL, change(r"(\s+)(aie::vector<int16, 8> a = readincr_v<8>\(in\);)", r"\1\2\1readincr_v<8>(in);")),
    ("cascade_types", (("cascade",),), GRAPH.replace("connect<stream>(first", "connect<cascade>(first"), change(r"connect<cascade>", "connect<stream>")),
    ("shuffle_mode", (("shuffle",),), KERNEL.replace("aie::add(a, b)", "aie::shuffle_up(a, 1)"), change(r"shuffle_up\(a, 1\)", "shuffle_down(a, 1)")),
    ("chess_pragma", (("chess", "pragma", "pipelin"),), KERNEL, change(r" chess_prepare_for_pipelining", "")),
    ("parameter_inside_loop", (("rtp", "parameter"), ("loop",)), KERNEL, change(r"(\{\n)(\s+aie::vector<int16, 8> a)", r"\1        int16 gain = read_parameter();\n\2")),
    ("lock_ordering", (("lock",),), KERNEL.replace("    aie::accum", "    acquire(lock_a); acquire(lock_b);\n    aie::accum"), change(r"acquire\(lock_a\); acquire\(lock_b\);", "acquire(lock_b); acquire(lock_a);")),
    ("saturation", (("saturat", "rounding"),), KERNEL.replace("    aie::accum", "    aie::set_saturation(aie::saturation_mode::saturate);\n    aie::accum"), change(r"\n    aie::set_saturation[^\n]*", "")),
    ("accumulator_init", (("init", "uninitial", "zero"),), KERNEL, change(r" = aie::zeros<acc48, 8>\(\)", "")),
    ("dimensions_mismatch", (("dimension",),), GRAPH, REGISTRY["graph_dimension_mismatch"]),
    ("reversed_connect", (("reversed", "direction", "swapped"),), GRAPH, REGISTRY["reversed_connect_direction"]),
    ("wrong_loop_count", (("loop", "iteration", "trip"),), KERNEL, REGISTRY["loop_count_halved"]),
    ("numeric_swap", ((r"\d",),), KERNEL, lambda text: None),
]


def _swapped_numbers(label: str) -> tuple[str, str] | None:
    """For labels such as `32 instead of 16`: a template that holds the right number, and the wrong one in its place."""
    m = re.search(r"(\d+)\s+(?:instead of|vs\.?|for)\s+(\d+)", label)
    if not m or m[1] == m[2]:
        return None
    right = re.sub(r"i < 32", f"i < {m[2]}", KERNEL)
    return re.sub(rf"i < {m[2]}\b", f"i < {m[1]}", right), right


def _fallback(slug: str) -> tuple[str, str]:
    """Edits chosen by the slug's hash, the first that fits a template."""
    names = sorted(REGISTRY)
    start = int(hashlib.md5(slug.encode()).hexdigest(), 16) % len(names)
    for name in names[start:] + names[:start]:
        for template in (KERNEL, GRAPH):
            if (buggy := REGISTRY[name](template)) is not None:
                return buggy, template
    raise AssertionError("no edit fits a template")


def synthesize(slug: str, label: str, cached: tuple[str, str] | None = None) -> tuple[str, str, str]:
    """(buggy, correct, origin): a cached pair, else the first recipe that fits, else by hash."""
    if cached and cached[0] != cached[1]:
        return (*cached, "cache")
    said = label.lower()
    if pair := _swapped_numbers(said):
        return (*pair, "numeric_swap")
    for name, groups, template, edit in RECIPES:
        if all(any(re.search(w, said) for w in g) for g in groups) and (buggy := edit(template)) not in (None, template):
            return buggy, template, name
    return (*_fallback(slug), "fallback")


def synthesize_all(taxonomy: DataFrame) -> DataFrame:
    """taxonomy (slug, label, ...) with buggy, correct and origin."""

    @F.pandas_udf("struct<buggy:string,correct:string,origin:string>")
    def run(slug: pd.Series, label: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([synthesize(s, t or "") for s, t in zip(slug, label)], columns=["buggy", "correct", "origin"])

    return taxonomy.withColumn("__s", run("slug", "label")).select(*taxonomy.columns, "__s.*")
