"""Detectors, path filters and gates on literal texts."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions import recipes
from tidewater.functions import screens as S


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


def test_detectors(spark):
    code = "adf::connect<stream>(FIR taps); input_stream<cint16>* s; readincr(s); NCO mixer"
    assert one(spark, S.corpus_category(F.col("c")), c=code) == "graph" and one(spark, S.corpus_category(F.col("c")), c="x") == "kernel"
    assert one(spark, S.corpus_interfaces(F.col("c")), c=code) == ["stream"] and one(spark, S.corpus_interfaces(F.col("c")), c="x") == ["unknown"]
    assert one(spark, S.data_types(F.col("c")), c=code) == ["int16", "cint16"]
    assert one(spark, S.compute_patterns(F.col("c")), c=code) == ["fir_filter", "digital_downconversion", "numerically_controlled_oscillator"]
    assert one(spark, S.compute_patterns(F.col("c")), c="") == ["generic_aie"] and len(S.COMPUTE_PATTERNS) == 29


@pytest.mark.parametrize(("path", "ok"), [
    ("aie/k.cc", True), ("X/AIE/k.CPP", True), ("src\\aie\\k.h", True), ("aie/tests/k.cc", False), ("test/aie/k.cc", False), ("aie/k.py", False), ("lib/extern/aie/k.cc", False), ("aie/k_BUGGY.cc", False), ("lib/k.cc", False), ("my_aie_k/x.hpp", True),
])
def test_clean_corpus_path(spark, path, ok):
    assert one(spark, S.clean_corpus_path(F.col("p")), p=path) is ok


def test_candidates(spark):
    assert one(spark, S.path_candidate(F.col("p"), ("Src/",), ("aie",)), p="src/aie/x.h") is True and one(spark, S.path_candidate(F.col("p"), ("lib/",)), p="src/x.h") is False
    assert one(spark, S.content_candidate(F.col("c")), c="AIE::mul") is True and one(spark, S.content_candidate(F.col("c")), c="int") is False


def test_gates(spark):
    reply = "<buggy>```cpp\nint a;\n```</buggy> and <correct>\nint b;\n</correct>"
    assert one(spark, S.pair_gate(F.col("r")), r=reply) == [] and one(spark, S.tagged(F.col("r"), "buggy"), r=reply).strip() == "int a;"
    assert one(spark, S.pair_gate(F.col("r")), r="<buggy>int a;</buggy>") == ["missing_part"]
    assert one(spark, S.pair_gate(F.col("r")), r="<buggy>a;</buggy><correct>a;</correct>") == ["same_as_correct"]
    assert one(spark, S.pair_gate(F.col("r")), r="<buggy>words</buggy><correct>a;</correct>") == ["not_code"]
    gate = S.mutation_gate(F.col("r"), F.col("c"), ("bad_api",), ("injected",))
    correct = "// FILE: a.h\nA;\n// FILE: b.cc\nB;"
    for text, reasons in ((correct.replace("B;", "C;"), []), (correct, ["same_as_correct"]), ("", ["empty_reply"]), ("A;", ["missing_file_markers"]), ("// FILE: a.h\nA", ["file_layout_changed"]), (correct.replace("B;", "bad_api;"), ["quality"]), (correct.replace("B;", "B; // Injected"), ["quality"])):
        assert one(spark, gate, r=text, c=correct) == reasons, text


def test_project_gate(spark):
    graph = recipes.GRAPH.replace("using namespace adf;\n", "void run(int* x);\n").replace("public graph", "public adf::graph").replace("first_kernel", "run").replace("second_kernel", "run")
    for word in ("kernel::create", "input_plio::create", "output_plio::create", "connect<", "plio_32_bits", "stream>", "window<"):
        graph = graph.replace(word, f"adf::{word}")
    graph = graph.replace(" source(", " adf::source(").replace("runtime<ratio>", "adf::runtime<adf::ratio>").replace("adf::window<256, 64>", "adf::stream") + "demo_graph g;\n"
    kernel = "void run(input_stream<int16>* in) {\n readincr(in);\n}\n"
    project = f"// FILE: graph.h\n{graph}// FILE: kernels/k.cc\n{kernel}"
    assert one(spark, S.project_gate(F.col("c")), c=project) == []
    assert one(spark, S.project_gate(F.col("c")), c=project.replace("demo_graph g;", "")) == ["missing_graph_instance"]
    assert one(spark, S.project_gate(F.col("c")), c=project.replace("void run(int* x);\n", "")) == ["missing_kernel_forward_declaration"]
    assert one(spark, S.project_gate(F.col("c")), c=project.replace("input_stream", "input_window")) == ["stream_connect_window_signature_mismatch"]
    assert {"needs_at_least_two_files", "missing_graph_h", "missing_kernel_source_file", "missing_connect", "missing_kernel_function_body"} <= set(one(spark, S.project_gate(F.col("c")), c="int x;"))
    assert "templated_kernel_create" in one(spark, S.project_gate(F.col("c")), c=project.replace("adf::kernel::create(", "adf::kernel::create<run>("))


def test_fix_rules(spark):
    cues = S.fix_cues(F.col("t"), F.col("b"), F.col("c"))
    for t, b, c, said in (("missing_iterator_increment", "*i = v;", "*i++ = v;", ["iterator_increment_added"]), ("loop_count", "i < 8", "i < 16", ["loop_numeric_bound_changed"]), ("deadlock", "x", "readincr(x)", ["stream_io_balance_changed"]), ("other", "a", "b", []), (None, None, None, [])):
        assert one(spark, cues, t=t, b=b, c=c) == said
    assert one(spark, S.dsl_only(F.col("t")), t="'input_stream' was not declared") is True and one(spark, S.dsl_only(F.col("t")), t=None) is False
    assert one(spark, S.quality_score(F.lit(True), F.col("v"), F.lit(True)), v="logical_likely") == 2.25
    ok = S.fix_candidate(F.col("k"), F.col("c"), F.col("g"), F.lit("kernel"), ("compile_error",), ("no member",), ("TIMEOUT",), 3)
    assert one(spark, ok, k="compile_error", c="a\nb", g="no member x") is True and one(spark, ok, k="compile_error", c="a\nb\nc\nd", g="no member x") is False


def test_descriptions(spark):
    code = "void k(input_stream<int16>* in, // first\n  aie::vector<int16, 8>& v) { }"
    assert one(spark, S.kernel_ports(F.col("c")), c=code) == ["input_stream<int16>* in", "aie::vector<int16, 8>& v"] and one(spark, S.kernel_ports(F.col("c")), c="int x;") is None
    ports = one(spark, S.graph_ports(F.col("c")), c=recipes.GRAPH)
    assert ports["declarations"] == ["input_plio in;", "output_plio out;"] and ports["n_kernels"] == 2
    assert one(spark, S.buffers(F.col("c")), c="dimensions(a) = {64}; dimensions(b) = { 64 }; connect<window< 256 >>(x); begin_vector<8>(y)").asDict() == {"dimensions": ["64"], "windows": ["256"], "lanes": ["8"]}
    flags = S.constraint_flags(F.col("c"), F.lit("kernel_type"), F.array(F.lit("Stream")), F.array(F.lit("aie::mul")))
    assert one(spark, flags, c="chess_prepare_for_pipelining") == ["simd", "pipelining", "stream_balance"] and one(spark, S.worded(flags, {"simd": "A.", "stream_balance": "B."}), c="") == "A. B."
    a = one(spark, S.code_anchors(F.col("c")), c="#include <class x>\nclass G {};\nvoid run(int acc_1) {}")
    assert (a["class"], a["function"], a["identifier"], a["n_lines"]) == ("G", "run", "acc_1", 3)
    assert one(spark, S.anchor_phrase(S.code_anchors(F.col("c"))), c="void f() {}") == "Look at function `f` in the source below. "
    assert one(spark, S.clean_name(F.col("f"), F.col("b")), f="x_dma_stall.cc", b="dma_stall") == "x.cc" and one(spark, S.clean_name(F.col("f"), F.col("b")), f="x_BUGGY_oob.cc", b=None) == "x.cc"
    assert one(spark, S.comparable(F.col("c")), c="a b // x\n/* y */ c") == "abc"
