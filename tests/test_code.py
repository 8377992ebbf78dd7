"""Features, predicates, edits and diffs of source code on literal programs."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions import diffs, mutators, recipes


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


CODE = """/* SOURCE: owner/repo, branch main
 * KEY INTRINSICS: aie::mac<a, b>, upd_v
 * Interface: Window and PLIO
 * interface: Stream
 */
// note
void k(input_stream<int16>* in) {
    aie::vector<int16 ,  8> a = readincr_v8(in);
    v8int32 w; aie::accum<acc48, 8> acc; connect<stream>(a, b);
}"""


def test_header_and_body(spark):
    fields = one(spark, C.header_fields(C.leading_comment(F.col("c"))), c=CODE)
    assert fields["source"] == "owner/repo, branch main" and fields["interface"] == "Stream"
    assert one(spark, C.body(F.col("c")), c=CODE).startswith("void k(")
    assert one(spark, C.leading_comment(F.col("c")), c="// SOURCE: x\n// y\nint a;").startswith("// SOURCE") and one(spark, C.leading_comment(F.col("c")), c="// other\nint a;") == ""
    repo, branch = C.repo_and_branch(F.col("c"))
    assert one(spark, F.array(repo, branch), c="owner/repo, branch main") == ["owner/repo", "main"]


def test_types_and_interfaces(spark):
    assert one(spark, C.vector_types(F.col("c"), F.lit(None).cast("string")), c=CODE) == ["aie::vector<int16, 8>", "aie::accum<acc48, 8>", "v8int32"]
    found = one(spark, C.intrinsics(F.col("c"), F.lit("aie::mac<a, b>, upd_v")), c=CODE)
    assert found[:2] == ["aie::mac<a, b>", "upd_v"] and "readincr_v8" in found and len(found) == len(set(found))
    assert one(spark, C.interface_types(F.col("c"), F.lit("Window and PLIO")), c=CODE) == ["Window", "PLIO", "Stream"]


@pytest.mark.parametrize(("code", "path", "kind"), [("class g : public adf::graph {", "a.h", "graph_type"), ("int x;", "src/MyGraph.cc", "graph_type"), ("int x;", "graph/a.cc", "kernel_type")])
def test_artifact_type(spark, code, path, kind):
    assert one(spark, C.artifact_type(F.col("c"), F.col("p")), c=code, p=path) == kind


def test_groups_and_stems(spark):
    assert one(spark, C.source_group(F.col("r"), F.col("p")), r="o/r", p="d/x_BUGGY_deadlock.cc") == "o/r:d/x.cc"
    assert one(spark, C.source_group(F.col("r"), F.col("p")), r="", p="x_CORRECT.cc") == "local:x.cc"
    assert one(spark, C.parent_key(F.col("r"), F.col("p")), r=None, p="x.cc") == "local:."
    assert one(spark, C.canonical_stem(F.col("p")), p="d/x_CORRECT.cc") == "x"


@pytest.mark.parametrize(("text", "whole", "first", "last"), [
    ("```cpp\na\n```", "a", "a\n", "a\n"), ("say\n```cpp\na\n```\nthen\n```\nb\n```", "say\n```cpp\na\n```\nthen\n```\nb\n```", "a\n", "b\n"), ("none", "none", None, None),
])
def test_fences(spark, text, whole, first, last):
    assert [one(spark, f(F.col("t")), t=text) for f in (C.strip_whole_fence, C.first_fenced, C.last_fenced)] == [whole, first, last]


def test_fence_round_trip(spark):
    assert one(spark, C.fence(F.col("t")), t="a  \n  b\t\n\n\n") == "```cpp\na\n  b\n```"
    assert one(spark, C.strip_whole_fence(C.fence(F.col("t"))), t="a\nb") == "a\nb"


def test_sections(spark):
    context = "Buggy version:\nint a\n\nCorrect version:\nint b;"
    assert one(spark, C.buggy_code(F.col("c")), c=context) == "int a" and one(spark, C.correct_code(F.col("c")), c=context) == "int b;"
    assert one(spark, C.buggy_code(F.col("c")), c="nothing") is None
    for text, parts in (("code\n\n--- Error Log ---\nlog x", ["code", "log x"]), ("code\n-- Error Log --\nlog", ["code", "log"]), ("code", ["code", ""])):
        assert one(spark, F.array(*C.code_and_log(F.col("c"))), c=text) == parts
    assert one(spark, C.project_files(F.col("c")), c="// FILE: g.h\nA\n// FILE: k/x.cc\nB\nC\n// FILE: g.h\nD") == {"g.h": "D", "k/x.cc": "B\nC"}
    assert one(spark, C.without_hints(F.col("c")), c="a\n// BUG here\n  // intent: x\nb // BUG stays") == "a\nb // BUG stays"


LOG = "In file included from x\nfatal error: 'my/dep.h' file not found\nnote: see\nerror: b\n"


def test_logs(spark):
    headers = "fatal error: 'a.h' file not found\nfatal error: /abs/b.h: No such file or directory\nfatal error: '../c.h' file not found\nfatal error: 'sys/d.h' file not found\nfatal error: 'a.h' file not found"
    assert one(spark, C.missing_headers(F.col("t")), t=headers) == ["a.h"]
    for text, kind in ((None, "ok"), ("", "ok"), (LOG, "missing_dependency"), ("fatal error: 'adf.h' file not found", "compile_error"), ("use of undeclared identifier 'int16v8'", "missing_aie_types"), ("no member named 'q' in namespace 'aie'", "aie_api_compile_error"), ("x", "compile_error")):
        assert one(spark, C.error_class(F.col("t")), t=text) == kind
    assert one(spark, C.first_error_line(F.col("t")), t=" \n a\nb error: c") == "b error: c" and one(spark, C.first_error_line(F.col("t")), t="\n a\n") == "a"
    assert one(spark, C.error_excerpt(F.col("t")), t=LOG) == "fatal error: 'my/dep.h' file not found\nerror: b"
    assert one(spark, C.clean_log(F.col("t")), t="native_vector_type<x\n\n") == "Compile error: AIE vector type instantiation failed."
    assert one(spark, C.stock_log(F.col("t")), t="k.cc:3:1: error: bad lane") == "Compile error: bad lane"
    assert one(spark, C.stock_log(F.col("t")), t="warning") == "Compile error: AIE compilation failed for this source."
    assert one(spark, C.api_mismatch(F.col("c"), F.col("l"), ("mac", "mul", "srs")), c="srs()", l="mac and mul") is True
    assert one(spark, C.api_mismatch(F.col("c"), F.col("l"), ("mac", "mul", "srs")), c="mac()", l="mac and mul") is False
    assert one(spark, C.vector_sizes_disjoint(F.col("c"), F.col("l")), c="vector<int16, 8>", l="vector<int16, 16>") is True


@pytest.mark.parametrize(("text", "ok"), [("", False), ("a", True), ("f(a[1]{b})", True), ("([)]", False), (")(", False), ("{{{", False), ("((((((((((" + "))))))))))", True)])
def test_balance(spark, text, ok):
    assert one(spark, C.balanced(F.col("t")), t=text) is ok


def test_balance_against_a_stack(spark):
    r, texts = random.Random(5), []
    for _ in range(200):
        texts.append("".join(r.choice("()[]{}x") for _ in range(r.randint(0, 8))))

    def stack(t):
        out = []
        for c in t:
            if c in "([{":
                out.append(c)
            elif c in ")]}" and (not out or out.pop() + c not in ("()", "[]", "{}")):
                return False
        return bool(t) and not out

    found = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(C.balanced(F.col("t"))).collect()
    assert [x[0] for x in found] == [stack(t) for t in texts]


def test_whole_code_reasons(spark):
    reasons = C.whole_code_reasons(F.col("a"), F.col("b"), 5)
    assert one(spark, reasons, a="", b="f(") == ["missing_buggy", "correct_too_short", "correct_unbalanced_delimiters"]
    assert one(spark, reasons, a="f(...existing code...)", b="f(123)") == ["buggy_placeholder_text"]


# ---- diffs


def test_diff_headers_and_content():
    a, b = "one\ntwo\nthree\n", "one\n2\nthree\n"
    d = diffs.unified(a, b)
    assert d.startswith("--- a/aie_source\n+++ b/aie_source\n@@ -1,3 +1,3 @@\n") and "-two\n+2\n" in d
    assert diffs.unified(a, a) == "" and diffs.changed_lines(a, b) == 2


def test_similarity():
    assert (diffs.similarity("", None), diffs.similarity("a", ""), diffs.similarity("x", "x")) == (1.0, 0.0, 1.0)
    assert diffs.similarity("abcd", "bcde") == difflib.SequenceMatcher(None, "abcd", "bcde", autojunk=False).ratio()
    assert diffs.similarity_at_least("a" * 100, "b", 0.5) < 0.5 and diffs.similarity_at_least("abcd", "bcde", 0.5) == 0.75


def test_anchors_proof_and_crop():
    buggy, fixed = "a\nbad\nc", "a\ngood\nmore\nc"
    assert diffs.anchors(buggy, fixed) == (["good", "more"], ["bad"])
    assert diffs.proof(buggy, fixed, fixed) and not diffs.proof(buggy, fixed, buggy) and diffs.proof(buggy, fixed, "a\ngood\nc") and not diffs.proof(buggy, fixed, "a\nc\nbad\ngood")
    assert diffs.proof("x", "x", "y")
    long = "\n".join(f"line {i}" for i in range(1000))
    piece = diffs.crop(long, long.replace("line 500", "changed"), 5)
    assert piece.split("\n") == [f"line {i}" for i in range(495, 506)]
    assert diffs.crop("same", "same") is None


# ---- edits


SAMPLES = [
    ("stream_deadlock", "  writeincr(out, x);", "// ORIGINAL: writeincr(out, x);"), ("window_oob", "for (int i = 0; i < 8; i++)", "for (int i = 0; i <= 8; i++)"),
    ("missing_iterator_increment", "*it++ = v;", "*it = v;"), ("runtime_ratio_zero", "runtime<ratio>(k) = 0.8;", "runtime<ratio>(k) = 0;"),
    ("plio_width_mismatch", "plio_32_bits", "plio_128_bits"), ("reversed_connect_direction", "connect<stream>(a.out[0], b.in[0]);", "connect<stream>(b.in[0], a.out[0]);"),
    ("wrong_vector_lane_width", "begin_vector<8>(x)", "begin_vector<16>(x)"), ("wrong_vector_lane_width", "aie::vector<int16, 4> a", "aie::vector<int16, 8> a"),
    ("graph_dimension_mismatch", "dimensions(x) = {64};", "dimensions(x) = {80};"), ("subtraction_for_addition", "y = a + b;", "y = a - b;"), ("mul_to_add", "aie::mul(a)", "aie::add(a)"),
    ("tovector_shift_fifteen", "x.to_vector<int16>(0)", "x.to_vector<int16>(15)"), ("tovector_shift_fifteen", "x.to_vector<int16>()", "x.to_vector<int16>(15)"), ("acc48_for_acc80", "accum<acc80, 8>", "accum<acc48, 8>"),
    ("loop_count_halved", "for (int i=0; i<32; i++)", "for (int i=0; i<16; i++)"), ("window_size_halved", "window<256>", "window<128>"), ("remove_zeros_init", "aie::zeros<int16, 8>()", "aie::broadcast<int16, 8>(1)"),
    ("broadcast_width_mismatch", "aie::broadcast<int16, 16>(x)", "aie::broadcast<int16, 8>(x)"), ("duplicate_stream_read", "a = readincr(x); b = readincr(y);", "a = readincr(x); b = readincr(x);"),
    ("drop_last_sample", "for (int i = 0; i < N; i++)", "for (int i = 0; i < N - 1; i++)"), ("remove_chess_pipelining", "chess_prepare_for_pipelining", "// ORIGINAL: chess_prepare_for_pipelining"),
    ("readincr_from_output", "readincr(in)", "readincr(out)"), ("break_in_pipelined_loop", "for (;;) {", "break;"), ("runtime_ratio_overflow", "runtime<ratio>(k) = 0.8;", "= 2.0;"), ("port_index_oob", "a.in[1]", "a.in[5]"),
    ("missing_graph_wait", "g.wait();", "// ORIGINAL: g.wait();"), ("missing_connect", "connect<stream>(a, b);", "// ORIGINAL: connect<stream>(a, b);"), ("self_loop_connect", "connect<stream>(a.out[0], b.in[0]);", "connect<stream>(a.out[0], a.in[0]);"),
    ("wrong_to_vector_output_type", "to_vector<int16>(0)", "to_vector<int32>(0)"), ("missing_adf_source", "adf::source(k) = \"x\";", "// ORIGINAL: adf::source"), ("missing_runtime_ratio", "runtime<ratio>(k) = 0.9;", "// ORIGINAL: runtime<ratio>"),
    ("window_margin_to_size", "window<256, 64>", "window<256, 264>"), ("bfloat16_on_aie1", "aie::vector<int16,8>", "aie::vector<bfloat16, 8>"), ("signed_unsigned_mismatch", "  int16 x = 1;", "  uint16 x = 1;"),
    ("unaligned_load", "load_v<8>(p)", "load_v<8>(p + 1)"), ("modulo_in_loop", "buf[i]", "buf[i % 32]"), ("break_accumulator_reset", "acc = aie::zeros<x>();", "// ORIGINAL: acc = aie::zeros"), ("begin_vector_non_power_of_two", "begin_vector<6>", "begin_vector<10>"),
    ("missing_output_write", "window_writeincr(out, v);", "// ORIGINAL: window_writeincr"),
]


@pytest.mark.parametrize(("slug", "text", "expected"), SAMPLES)
def test_edits(slug, text, expected):
    assert expected in mutators.REGISTRY[slug](text) and mutators.REGISTRY[slug]("nothing here") is None


def test_hoisted_read():
    text = "int n;\nfor (int i = 0; i < 8; i++) {\n    auto x = *it++;\n    use(x);\n}"
    assert mutators.REGISTRY["dereference_moved_outside_loop"](text) == "int n;\nauto x = *it++;\nfor (int i = 0; i < 8; i++) {\n    use(x);\n}"


def test_registry_is_complete():
    assert {s for s, _, _ in SAMPLES} | {"dereference_moved_outside_loop"} == set(mutators.REGISTRY) and len(mutators.REGISTRY) == 38
    assert mutators.UNDISPATCHED["acc48_for_acc80_reverse"]("accum<acc48, 8>") == "accum<acc80, 8>"


def test_mutations_are_distinct_and_capped(spark):
    df = spark.createDataFrame([(1, recipes.KERNEL, "kernel_type", ["Stream"]), (2, recipes.GRAPH, "graph_type", []), (3, "", "kernel_type", None), (4, None, None, None)], "id int, code string, kind string, ifs array<string>")
    found = mutators.mutations(df, "code", "kind", "ifs", 5).collect()
    assert {r["id"] for r in found} == {1, 2} and max(sum(r["id"] == i for r in found) for i in (1, 2)) == 5
    assert all(r["buggy"] != r["code"] for r in found)
    done = mutators.mutate(spark.createDataFrame([("aie::mul(a)", "mul_to_add"), ("x", "mul_to_add"), ("x", "unknown"), (None, None)], "code string, slug string"), "code", "slug").collect()
    assert [r["buggy"] for r in done] == ["aie::add(a)", None, None, None]


def test_recipes(spark):
    for label, name in (("wrong accumulator width acc48", "accumulator_width"), ("missing source() call", "missing_source"), ("reversed connect direction", "reversed_connect"), ("16 instead of 32 samples", "numeric_swap"), ("cascade type mismatch", "cascade_types"), ("lock ordering", "lock_ordering"), ("no idea", "fallback")):
        buggy, correct, origin = recipes.synthesize("s", label)
        assert origin == name and buggy != correct
    for name, _, template, edit in recipes.RECIPES:
        assert name == "numeric_swap" or edit(template) not in (None, template), name
    taxonomy = spark.createDataFrame([(f"bug_{i}", f"label {i}") for i in range(30)] + [("n", None)], "slug string, label string")
    out = recipes.synthesize_all(taxonomy).collect()
    assert len(out) == 31 and all(r["buggy"] != r["correct"] for r in out)
