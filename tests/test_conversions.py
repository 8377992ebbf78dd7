"""Conversions, descriptions, injection, loops, crawl and staged builds on small literal rows."""

from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions import describe, injection
from tidewater.operators import conversions, reports
from tidewater.plans import stages
from tidewater.sources import crawl, services


def one(spark, column, **values):
    shape = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'array<string>'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], shape).select(column).first()[0]


CODE = "#include <adf.h>\nvoid run(input_stream<int16>* in) {\n  readincr(in);\n}\n"


def test_fences_and_forms(spark):
    edge = conversions.edges_off(F.col("t"))
    for text, inner in (("```cpp\na\n```", "a"), ("```c++\nb```", "b"), ("```\nc", "c"), ("d\n```", "d"), ("  e ", "e"), ("", "")):
        assert one(spark, edge, t=text) == inner
    for said, form in (("a known-good one", "known_good"), ("compile-ready?", "compile_ready"), ("Does this AIE x", "yes_no"), ("x Does this AIE", "fix"), (None, "fix")):
        assert one(spark, conversions.row_form(F.col("i")), i=said) == form


def test_passthrough_drops_what_is_short(spark):
    long = "int main() { return 0; } // " + "x" * 40
    r = spark.createDataFrame([(1, "known-good", "ctx", f"```cpp\n{long}\n```"), (2, "known-good", "c", "short"), (3, "compile-ready", "c", long), (4, "Does this AIE fail?", f" {long}\n", "yes"), (5, "fix", None, None)], "id int, instruction string, context string, response string")
    found = {x["id"]: x for x in conversions.passthrough(r).collect()}
    assert set(found) == {1, 4, 5} and found[5]["context"] is None and not found[5]["converted"]
    for i, form in ((1, "known_good"), (4, "yes_no")):
        assert (found[i]["context"], found[i]["response"], found[i]["original_form"]) == (long, f"```cpp\n{long}\n```", form) and found[i]["instruction"] in conversions.REVIEW


def test_diff_rows(spark):
    bad = CODE.replace("readincr(in)", "readincr(in, 1)")
    many = CODE + "int a;\nint b;\nint c;\nint d;\n"
    texts = [
        (1, f"Buggy version:\n{bad}", f"```cpp\n{CODE}```"), (2, f"Scenario bug pattern: x\nSource: y\n\nBuggy version:\n{bad}\n\nCorrect version:\n{CODE}", CODE), (3, f"```cpp\n{bad}```", CODE), (4, CODE, CODE), (5, "no code", CODE), (6, None, None), (7, "void q() {}\n" * 9, many), (8, "Scenario bug pattern: x\nnothing else", CODE),
    ]
    r = spark.createDataFrame([(i, "fix", c, a) for i, c, a in texts], "id int, instruction string, context string, response string")
    found = {x["id"]: x for x in conversions.diff_rows(r, F.lit("log")).collect()}
    assert set(found) == {1, 2, 3}
    for x in found.values():
        assert x["context"].endswith("\n\n--- Error Log ---\nlog") and "-  readincr(in, 1);\n+  readincr(in);" in x["response"] and x["response_format"] == "unified_diff" and not x["has_real_error_log"]


def test_negatives_name_the_first_attempt_of_a_candidate(spark):
    log = "note\n\nx.cc:1: error: a\nmore\n fatal error: b\n"
    r = spark.createDataFrame([(1, " c1 ", False, None, log, None), (2, "c1", None, "late", "z", None), (3, "c2", True, None, None, None), (4, None, False, None, None, None), (5, "c3", None, "cls", None, "told")], "at int, candidate_code string, compile_ok boolean, validation_error_class string, validation_error_excerpt string, prompt_error_excerpt string")
    found = {x["context"]: x for x in conversions.compile_negatives(r, ["at"]).collect()}
    assert set(found) == {"c1", "c3"} and found["c1"]["error_reason"] == "note\nx.cc:1: error: a\nfatal error: b" and found["c1"]["error_class"] == "compile_error"
    assert found["c3"]["response"].endswith("The validator reported cls: told") and conversions.compile_negatives(r, ["at"], 1).count() == 1
    assert len(one(spark, conversions.short_excerpt(F.col("t")), t="error: " + "x" * 2000)) == 900


def test_logs_go_to_their_positions(spark):
    r = spark.createDataFrame([(i, f"code{i}{C.ERROR_SEPARATOR}old", i == 2, "unified_diff" if i != 3 else "text") for i in range(6)], "id int, context string, has_real_error_log boolean, response_format string")
    assert [(x["id"], x["position"]) for x in conversions.needing_logs(r, ["id"]).orderBy("id").collect()] == [(0, 0), (1, 1), (4, 2), (5, 3)]
    results = spark.createDataFrame([(0, True, "error: no", "x"), (1, False, "x.cc: error: here\nnote", "x"), (2, False, "", "odd"), (3, False, None, "ok")], "row_index long, compile_ok boolean, stderr_tail string, error_class string")
    found = {x["id"]: (x["context"], x["has_real_error_log"]) for x in conversions.logs_patched(r, results, ["id"]).collect()}
    assert found[1] == (f"code1{C.ERROR_SEPARATOR}x.cc: error: here", True) and found[4] == (f"code4{C.ERROR_SEPARATOR}Compile error: odd", True)
    assert found[0] == (f"code0{C.ERROR_SEPARATOR}old", False) and found[5][0].endswith("old") and len(found) == 6


def test_descriptions(spark):
    for path, code, start in (("a/my_peak_detect.cc", "fir", "Peak"), ("x.cc", "a FIR", "Finite"), ("graph_fir.h", "", "Finite"), ("converter.h", "", "ADF graph"), ("x.cc", None, "AIE dataflow"), ("dir.fir/x.cc", "", "AIE dataflow")):
        assert one(spark, describe.math_operation(F.col("p"), F.col("c")), p=path, c=code).startswith(start), path
    header = one(spark, describe.source_header(F.lit("o"), F.lit("r"), F.lit("b"), F.lit("d/fft.cc"), F.col("c")), c="aie::mac(x); aie::vector< int16, 8 > v; input_stream<int>* s; aie::mac(y);")
    assert header == "/*\nSOURCE: o/r, branch b\nPATH: d/fft.cc\nDOMAIN: DSP — FFT / Channelizer\nINTERFACE: Stream\nKEY INTRINSICS: aie::mac, aie::vector\nVECTOR TYPES: aie::vector<int16,8>\n*/\n\n"
    assert one(spark, describe.source_header(F.lit("o"), F.lit("r"), F.lit("b"), F.lit("p"), F.col("c")), c="").count("Unknown") == 3
    none = F.array().cast("array<string>")
    said = one(spark, describe.answers(F.col("c"), F.lit("kernel_type"), none, none, none, F.lit("Op.")), c=CODE)
    assert said["summary"].startswith("Summary: This AIE kernel uses AIE interfaces interfaces and scalar and vector AIE data types to implement Op.\n\n") and "Parameters: input_stream<int16>* in." in said["feature"] and said["dataflow"].startswith("Dataflow role: Op.")


def test_injected_bugs_are_new_and_in_their_own_order(spark):
    kernel = "void k() {\n    for (unsigned frame = 0; frame < 8; ++frame)\n        chess_prepare_for_pipelining\n    {\n        aie::vector<int16, 8> v;\n        writeincr(out, v);\n    }\n}\n"
    assert injection.inject(kernel, "kernel", "wrong_vector_lane_width") == kernel.replace("int16, 8>", "int16, 4>")
    assert injection.inject(kernel, "kernel", "missing_chess_prepare_for_pipelining") == kernel.replace("        chess_prepare_for_pipelining\n", "")
    assert "frame <= 8; ++frame) // BUG" in injection.inject(kernel, "kernel", "output_buffer_overrun")
    assert injection.inject(kernel, "kernel", "incorrect_shuffle_mode") == kernel.replace("frame < 8", "frame <= 8")
    assert injection.inject("adf::dimensions(a) = {64};", "graph", "buffer_size_mismatch") == "adf::dimensions(a) = {128};"
    assert injection.inject("x", "graph", "rtp_read_inside_loop") is None and injection.inject(None, "graph", "rtp_read_inside_loop") is None
    for a, b in (("plio_128_bits", "plio_32_bits"), ("plio_32_bits", "plio_128_bits"), ('GMIO::create("x", 64, 1)', 'GMIO::create("x", 32, 1)')):
        assert injection.inject(a, "graph", "mismatched_plio_width") == b
    s = spark.createDataFrame([(f"f{i}.cc", kernel + f"// {i}", "kernel", i) for i in range(8)] + [("g.h", None, "graph", 1)], "filename string, code string, category string, seed long")
    found = injection.buggy_sources(s).collect()
    per = {f: [x["bug_type"] for x in found if x["filename"] == f] for f in {x["filename"] for x in found}}
    assert set(per) == {f"f{i}.cc" for i in range(8)} and all(len(v) == 3 for v in per.values()) and len({tuple(v) for v in per.values()}) > 1
    assert {x["category"] for x in found} == {"buggy_kernel"} and len({x["buggy"] for x in found}) == len(found)


def test_rounds_carry_what_was_wrong(spark):
    jobs = spark.createDataFrame([(i,) for i in range(6)], "k int")
    ask = lambda d: d.withColumn("answer", F.concat(F.lit("a"), F.length("feedback").cast("string"))).withColumn("cost", F.lit(1.0))
    judge = lambda a: (a["k"] < 2 * a["attempt"], F.concat(F.lit("bad "), a["k"].cast("string")))
    accepted, log = services.rounds(jobs, ["k"], ask, judge, 5)
    assert sorted((r["k"], r["attempt"]) for r in accepted.collect()) == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (5, 3)]
    assert log.count() == 6 + 4 + 2 and log.where("attempt = 2 and feedback <> concat('bad ', k)").count() == 0
    assert services.rounds(jobs, ["k"], ask, judge, 5, budget=6.0, cost=F.col("cost"))[1].count() == 6


FAKE = r"""#!/usr/bin/env python3
import os, re, sys
code = open("source.cc").read()
for name in re.findall(r'#include "([^"]+)"', code):
    if not os.path.exists(name):
        sys.exit(f"source.cc:1:10: fatal error: {name}: No such file or directory")
for name in re.findall(r"aie::(\w+)\(", code):
    if not re.search(rf"namespace aie .* int {name}\(", code):
        sys.exit(f"source.cc:2: error: '{name}' is not a member of 'aie'")
if "odd_type" in code and "struct odd_type" not in code:
    sys.exit("source.cc:2: error: 'odd_type' was not declared in this scope")
sys.exit("error: expected ';'" if "this is no code" in code else 0)
"""


def test_syntax_check_stubs_what_is_unknown(tmp_path):
    compiler = tmp_path / "cc"
    compiler.write_text(FAKE)
    compiler.chmod(0o755)
    check = lambda code, **more: services.syntax_check({"code": code}, str(compiler), **more)
    assert check("int main() { return 0; } // long enough")["attempts"] == 1
    found = check('#include "not_there/at_all.h"\nodd_type x; int main() { return aie::mac(1, 2); }')
    assert (found["compile_ok"], found["attempts"], found["missing_includes"], found["undeclared"]) == (True, 4, 1, 1)
    assert not check('#include "not_there/at_all.h"\nodd_type x; int main() { return aie::mac(1, 2); }', retries=1)["compile_ok"]
    assert check("int main( { return 0 this is no code")["attempts"] == 1 and check("")["attempts"] == 0
    assert not check('#include "../outside.h"\nint main() { return 0; }')["compile_ok"] and not (tmp_path.parent / "outside.h").exists()
    assert services.compile_with(lambda job, path: ["false", path])({"code": "x"})["return_code"] == 1
    assert services.compile_with(lambda job, path: ["no-such-tool-here"])({"code": "x"})["return_code"] == -3


def test_toolchain(tmp_path):
    (tmp_path / "bin").mkdir()
    (tmp_path / "bin" / "aiecompiler").touch()
    (tmp_path / "include").mkdir()
    found = services.toolchain(None, str(tmp_path / "none"), str(tmp_path))
    assert found.root == str(tmp_path) and found.graph_compiler.endswith("aiecompiler") and found.kernel_compiler is None and found.include_dirs == (str(tmp_path / "include"),)
    assert services.toolchain().root is None


def test_crawl(spark):
    def make():  # goes to the workers by value
        class Host:
            def default_branch(self, repo):
                return "main"

            def tree(self, repo, branch):
                if repo == "a/broken":
                    raise OSError("gone")
                return [("aie/k.cc", f"{repo}1", 9), ("aie/same.cc", "same", 9), ("README.md", "r", 9)]

            def search(self, query):
                return [("b/other", "dev", "aie/s.cc", "s")] * 2

            def blob(self, repo, sha):
                return "void same() { aie::mac(a); }" if sha == "same" else f"void {sha.replace('/', '')}() {{ aie::mac(b); }}"

            def raw(self, repo, branch, path):
                return "aie::load_v" if path.endswith("k.cc") else "plain"

        return Host()

    targets = spark.createDataFrame([("a/one", None), ("a/two", "dev"), ("a/broken", "x")], "repo string, branch string")
    files = crawl.trees(targets, make)
    assert files.where("error is not null").select("repo").collect() == [("a/broken",)] and files.where("repo = 'a/one' and branch = 'main'").count() == 3
    found = crawl.searched(spark.createDataFrame([("q",)], "query string"), make)
    assert found.count() == 1 and [tuple(r) for r in crawl.discovered(found, targets).collect()] == [("b/other", None)]
    none = spark.createDataFrame([], "content string")
    entries = crawl.entries(files, make, none).collect()
    assert sorted((e["repo"], e["filename"]) for e in entries) == [("a/one", "k.cc"), ("a/one", "same.cc"), ("a/two", "k.cc")] and entries[0]["source_url"].startswith("https://")
    got = crawl.downloads(files.where("path <> 'README.md'"), make, ("aie::",)).collect()
    assert sorted(g["repo"] for g in got) == ["a/one", "a/two"] and got[0]["text"].startswith("/*\nSOURCE: a/") and got[0]["text"].endswith("aie::load_v")


def test_staged_build(spark, tmp_path):
    topics = spark.createDataFrame([(f"s{i}", f"stall_{i}", "stall", "easy") for i in range(6)], "source_id string, slug string, label string, tier string")
    generate = lambda t: t.withColumn("correct", F.concat(F.lit("void stall() { /* "), "source_id", F.lit(" */ }")))
    compiled = lambda j: j.withColumns({"compile_ok": F.col("source_id") != "s5", "validation_error_class": F.lit("c"), "validation_error_excerpt": F.lit("error: e"), "prompt_error_excerpt": F.lit("")})
    mutate = lambda s: s.select("source_id", F.concat(F.lit("bad "), "correct").alias("buggy"), "correct", F.lit("b").alias("bug_type"), F.lit(True).alias("parse_ok"), F.lit(True).alias("quality_ok"), F.lit(1).alias("at"))
    audit = lambda p: p.select(F.col("source_id").alias("row_id"), F.when(F.col("source_id") == "s0", '{"bug_present": false}').otherwise('{"bug_present": true}').alias("raw_verdict"), F.lit(False).alias("error"))
    build = stages.Build(spark, f"file://{tmp_path}", {"topics": topics, "rows": spark.createDataFrame([("i", "c", "r", None, None, "old", "train")], stages.ROW)}, {"generate": generate, "compile": compiled, "mutate": mutate, "audit": audit})
    first = stages.run(build)
    assert [n for n, _, _ in first] == list(stages.STAGES) and [o for _, o, _ in first] == ["ok"] * 12, first
    assert build.read("screen").count() == 0 and {o for _, o, _ in stages.run(build)} == {"skipped"}  # an empty target is done too
    kept = build.read("add_retry").collect()
    assert {r["source_id"] for r in kept if r["variant"] == stages.MUTATION} == {"s1", "s2", "s3", "s4"} and [r["source_id"] for r in kept if r["variant"] == stages.RETRY] == ["s0"]
    assert sum(r["variant"] == conversions.NEGATIVE_VARIANT for r in kept) == 1 and sum(r["variant"] == "old" for r in kept) == 1
    assert {o for n, o, _ in stages.run(build, only=["generate", "add_retry"])} == {"skipped"}
    build.services["generate"] = lambda t: t.select("nothing")
    assert [o.split(":")[0] for _, o, _ in stages.run(build, only=["generate", "compile"], force=True)] == ["failed", "not run"]
    assert list(build.failures) == ["generate"]
    (tmp_path / "audit" / "_SUCCESS").unlink()  # as if its write had been cut off
    assert [o for _, o, _ in stages.run(build, only=["mutate", "audit"])] == ["skipped", "ok"] and not build.failures


def test_counts_and_charts(spark):
    d = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string")
    assert [tuple(r) for r in reports.labelled_counts(d, "v", {"a": "A"}).collect()] == [("A", 2, 0.5), ("b", 1, 0.25), ("unknown", 1, 0.25)]
    assert reports.n_rows(d, "v = 'a'").first() == (4, 2)
    assert reports.bars([("<x>", 3)], "t").count("<rect") == 1 and "&lt;x&gt;" in reports.bars([("<x>", 3)], "t")


def test_arrays_and_entries(spark, tmp_path):
    from tidewater.sources import files

    (tmp_path / "a.json").write_text('[{"id": "x", "n": 1},\n {"id": "y"}, {"n": 3}]')
    assert [(r["row_index"], r["id"], r["n"]) for r in files.json_array(spark, f"{tmp_path}/a.json", "id string, n int").orderBy("row_index").collect()] == [(0, "x", 1), (1, "y", None), (2, None, 3)]
    (tmp_path / "c.jsonl").write_text('{"code": "int x;", "metadata": {"data_types": ["int16"], "compute_pattern": "fir"}}\nbroken\n{"filename": "no code"}\n{"code": "y", "filename": "f", "bug_type": "b"}\n')
    found = files.corpus_entries(spark, f"{tmp_path}/c.jsonl").orderBy("row_index").collect()
    assert [(r["row_index"], r["filename"], r["bug_type"]) for r in found] == [(0, "", None), (3, "f", "b")] and len({r["content"] for r in found}) == 2
    assert found[0]["data_types"] == ["int16"] and found[0]["compute_pattern"] == ["fir"]
