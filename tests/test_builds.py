"""Readers, sinks, clients, streams and staged builds on literal rows."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions.text import slug
from tidewater.operators import rows, selection
from tidewater.sources import clients, files
from tidewater.streaming import logs


def write(path, *lines):
    path.write_text("".join(f"{x}\n" for x in lines))
    return f"file://{path}"


def test_json_lines_policies(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"a": 1, "b": "x"}', "", "{broken", '{"a": 2, "extra": [1]}')
    found = sorted(files.json_lines(spark, path, "a int, b string", "tolerant").collect())
    assert [(r["row_index"], r["a"], r["b"]) for r in found] == [(0, 1, "x"), (3, 2, None)]
    assert [(r["row_index"], r["raw"]) for r in files.rejected_lines(spark, path).collect()] == [(2, "{broken")]
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        files.json_lines(spark, path, "a int, b string").collect()
    for mode in ("strict", "tolerant"):
        assert files.json_lines(spark, f"file://{tmp_path}/none.jsonl", "a int", mode).count() == 0
    extras = files.with_extras(spark, write(tmp_path / "b.jsonl", '{"a": 1, "p": "x"}', '{"a": 2, "p": ["y", "z"]}', '{"a": 3}'), "a int")
    assert [r[0] for r in extras.orderBy("a").select(F.filter(files.as_list(F.variant_get("extras", "$.p", "variant")), lambda x: x.isNotNull())).collect()] == [["x"], ["y", "z"], []]


def test_row_index_of_split_files(spark, tmp_path):
    path = write(tmp_path / "long.jsonl", *[json.dumps({"a": i, "pad": "x" * 200}) for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = files.json_lines(spark, path, "a int", "tolerant")
        assert found.where("a <> row_index").count() == 0 and found.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_topics_and_predictions(spark):
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(["DMA BUGS", "stall on read", "", "Stall on Read!", "123", "LOCKS", "order"])], "i int, t string")
    found = [(r["group"], r["slug"]) for r in files.topics(lines, "i", "t", slug(F.col("label"))).orderBy("i").collect()]
    assert found == [("DMA BUGS", "stall_on_read"), ("DMA BUGS", "stall_on_read_2"), ("DMA BUGS", "123"), ("LOCKS", "order")]
    p = spark.createDataFrame([("a", None, "x", None, 0), (None, "a", None, "y", 1), (None, None, "z", None, 2)], "id string, case_id string, prediction string, response string, at int")
    assert [(r["id"], r["answer"]) for r in files.predictions(p, "at").collect()] == [("a", "y")]


def test_source_tree_and_blobs(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("a.cc", "d/b.h", "c.txt"):
        (tmp_path / name).write_text(f"text of {name}\nline 2\n")
    found = {r["path"].rsplit("/", 1)[1]: r["code"] for r in files.source_tree(spark, f"file://{tmp_path}").collect()}
    assert set(found) == {"a.cc", "b.h"} and found["a.cc"] == "text of a.cc\nline 2\n"
    trees = spark.createDataFrame([("r", "main", [("k/x.cc", "blob", "s1", 10, "u1"), ("k/y.py", "blob", "s2", 10, "u2"), ("z.cc", "blob", "s3", 10**9, "u3"), ("k", "tree", "s4", None, None)])], "repo string, branch string, tree array<struct<path:string,type:string,sha:string,size:long,url:string>>")
    import base64
    import hashlib

    blobs = spark.createDataFrame([(hashlib.sha256(u.encode()).hexdigest(), base64.b64encode(f"code {u}".encode()).decode()) for u in ("u1", "u2", "u3")], "key string, content string")
    assert [(r["path"], r["code"]) for r in files.repository_blobs(trees, blobs, (".cc",)).collect()] == [("k/x.cc", "code u1")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, None, "train"), (1, "x", "validation")], "a int, b string, split string")
    files.write_json_lines(df, f"file://{tmp_path}/out", ["a"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [json.loads(x) for x in text.splitlines()] == [{"a": 1, "b": "x", "split": "validation"}, {"a": 2, "b": None, "split": "train"}]
    files.write_splits(df, f"file://{tmp_path}/splits")
    assert spark.read.parquet(f"file://{tmp_path}/splits").where("split = 'train'").count() == 1
    with pytest.raises(Exception, match="already exists"):
        files.write_splits(df, f"file://{tmp_path}/splits")


def test_clients(spark):
    jobs = spark.createDataFrame([("f", i, "x" * 40, "y" * (10 if i else 50)) for i in range(3)], "input_path string, row_index int, a string, b string")
    done = spark.createDataFrame([("f", 0, "buggy", "T1")], "input_path string, row_index int, scope string, target string")
    found = clients.compile_jobs(jobs, done, {"buggy": "a", "correct": "b"}, ["T1", "T2"])
    assert sorted((r["row_index"], r["scope"], r["target"]) for r in found.collect()) == [(0, "buggy", "T2"), (0, "correct", "T1"), (0, "correct", "T2"), (1, "buggy", "T1"), (1, "buggy", "T2"), (2, "buggy", "T1"), (2, "buggy", "T2")]
    out = clients.call_service(spark.createDataFrame([(1,), (2,)], "k int"), lambda: lambda r: {"k": r["k"], "v": r["k"] * 10}, "k int, v int")
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [(1, 10), (2, 20)]
    calls = []

    def busy(request):
        calls.append(request)
        if len(calls) < 3:
            raise RuntimeError("Throttling")
        return {"ok": True}

    assert clients.with_retry(busy, delay=0)({}) == {"ok": True} and len(calls) == 3
    answers = spark.createDataFrame([(1, "old", 0), (1, "new", 1)], "k int, v string, at int")
    assert [r["v"] for r in clients.offline(spark.createDataFrame([(1,), (5,)], "k int"), answers, ["k"], "at").collect()] == ["new"]


def test_streams_resume(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    write(src / "1.json", '{"k": "a", "v": 1}', '{"k": "a", "v": 2}', '{"k": "b", "v": 3}')
    run = lambda: logs.drain(logs.first_per_key(logs.log_stream(spark, f"file://{src}", "k string, v int"), ["k"]), f"file://{tmp_path}/out", f"file://{tmp_path}/ck").awaitTermination()
    run()
    write(src / "2.json", '{"k": "b", "v": 4}', '{"k": "c", "v": 5}')
    run()
    assert sorted(r["k"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b", "c"]


def test_file_info(spark):
    found = rows.file_info(spark.createDataFrame([("k/a_BUGGY_x.cc", "o/r", "// SOURCE: s\nvoid f() { aie::mul(); }"), ("z/b.cc", "o/r", "void f() { aie::mul(); }"), ("c.cc", "o/r", "int main;")], "path string, repo string, code string")).collect()
    assert [(r["path"], r["source_group"], r["artifact_type"], r["intrinsics"]) for r in found] == [("k/a_BUGGY_x.cc", "o/r:k/a.cc", "kernel_type", ["aie::mul"])]


def test_verified_rows(spark):
    shape = "path string, row_index int, group_id string, instruction string, context string, response string, bug_type string"
    data = spark.createDataFrame([("c:/d.jsonl", i, f"g{i % 3}", "fix", f"code {i}", "r", "bug" if i % 2 else None) for i in range(8)], shape)
    results = spark.createDataFrame([("C:/d.jsonl", 0, True), ("C:/d.jsonl", 1, False), ("C:/d.jsonl", 3, True)], "input_path string, row_index int, compile_ok boolean")
    new = spark.createDataFrame([("n", 99, "g9", "fix", "code 1", "r", None)], shape)
    found = {r["row_index"]: r for r in rows.verified_rows(data, results, new, 2).collect()}
    assert {k: v["v4_bucket"] for k, v in found.items()} == {0: "compile_proven", 3: "compile_proven", 99: "validated_replacement", 5: "real_negative", 1: "real_negative"} or set(found) <= {0, 1, 3, 5, 7, 99}
    assert found[0]["v4_bucket"] == "compile_proven" and selection.split_leaks(rows.verified_rows(data, results, new), "group_id", "split").count() == 0


def test_v5_rows_and_sanitizing(spark):
    failures = spark.createDataFrame([("0000000c" + "0" * 32, "a\nb", "a\nc", "k.cc:1:1: error: no mac or mul"), ("0000000d" + "0" * 32, "same", "same", "x"), ("0000000d" + "0" * 32, "x\ny", "x\nz", "error: bad")], "source_id string, buggy string, correct string, log string")
    found = rows.v5_rows(failures, ["i0", "i1", "i2"]).collect()
    assert {(r["split"], r["instruction"]) for r in found} == {("validation", "i0"), ("train", "i1")} and all(r["response"].startswith("--- a/aie_source\n+++ b/aie_source\n@@") for r in found)
    clean = {r["source_id"][:8]: r["context"] for r in rows.sanitized(rows.v5_rows(failures, ["i"]), ("mac", "mul")).collect()}
    assert clean["0000000c"] == "a\nb\n\n--- Error Log ---\nCompile error: no mac or mul"


def test_audits_mutations_and_bands(spark):
    audits = spark.createDataFrame([("1", '{"bug_present": true, "confidence": "high"}', None), ("2", '```json\n{"bug_present": "false"}\n```', False), ("3", "garbage", True)], "row_id string, raw_verdict string, error boolean")
    assert [(r["present"], r["confidence"], r["error"]) for r in rows.audit_flags(audits).orderBy("row_id").collect()] == [(True, "high", False), (None, "unknown", False), (None, "unknown", True)]
    log = spark.createDataFrame([("s", "a", "b", True, True, 0), ("s", "c", "b", True, True, 1), ("s", "d", "b", True, False, 2)], "source_id string, buggy string, correct string, parse_ok boolean, quality_ok boolean, at int")
    assert [r["buggy"] for r in rows.accepted_mutations(log).collect()] == ["c"]
    pairs = spark.createDataFrame([("aaaa", "aaaa"), ("aaaa", "zzzz"), ("abcd", "abzz"), ("abcdefgh", "abcdefgx")], "buggy string, correct string")
    assert sorted(r["band"] for r in rows.screened(pairs).collect()) == ["close", "distant", "equal", "unrelated"]


def test_balanced_rows_keep_groups_on_one_side(spark):
    data = spark.createDataFrame([(i, "fix", f"code number {'x' * (i % 37)}", "r", "v", f"s{i % 9}", f"b{i % 4}" if i % 3 else None, f"g{i % 11}", f"r{i % 5}", ["easy", "normal", "hard"][i % 3], "train" if i % 11 else "validation") for i in range(200)], "id long, instruction string, context string, response string, variant string, source string, bug_type string, source_group string, repo string, tier string, split string")
    kept = rows.balanced_rows(rows.keyed(data)).join(data, "id")
    total = kept.count()
    assert 0 < total < 200 and selection.split_leaks(kept, "source_group", "split").count() == 0


def test_synthetic_sources(spark):
    value = lambda name, *v: spark.createDataFrame([(x,) for x in v], f"{name} string")
    counts = {n: spark.createDataFrame([("fir", 5)] if n == "pattern" else [], f"{n} string, n long") for n in ("pattern", "type", "interface", "complexity")}
    specs = rows.spec_grid(value("pattern", "fir", "mac"), value("type", "int16"), value("interface", "stream", "window"), value("complexity", "simple"), counts, 3)
    found = rows.render_kernel(specs).collect()
    assert [r["pattern"] for r in found] == ["mac", "mac", "fir"] and all(r["code"].count("{") == r["code"].count("}") for r in found)
    assert all(r["code"].count("{") == r["code"].count("}") for r in rows.render_graph(specs).collect())


def test_bug_types_tiers_and_variants(spark):
    taxonomy = spark.createDataFrame([("dma_stall", "DMA stall"), ("dma_stall_2", "dma stall")], "slug string, label string")
    found = rows.canonical_bug_type(spark.createDataFrame([("dma STALL",), ("dma_stall_2",), ("New Bug!",), (None,)], "b string"), "b", taxonomy).collect()
    assert {r["b"]: r["bug_slug"] for r in found} == {"dma STALL": "dma_stall", "dma_stall_2": "dma_stall_2", "New Bug!": "new_bug", None: None}
    tiers = spark.createDataFrame([(None, None), ("x", "hard"), ("missing_y", None), ("q", None)], "s string, k string").select(rows.tier_of(F.col("s"), F.col("k"), [("easy", ("missing",))])).collect()
    assert [t[0] for t in tiers] == ["normal", "hard", "easy", "medium"]
    info = spark.createDataFrame([("p",)], "path string")
    assert rows.variants(info, {"a": ["x", "y"], "b": ["z"]}).count() == 2


def test_prompts(spark):
    df = spark.createDataFrame([("i", None, "r")], "instruction string, context string, response string")
    assert clients.prompt_text(df).first()["text"] == "### Instruction\ni\n\n### Context\n\n\n### Response\nr"
    assert [m["role"] for m in clients.chat_rows(df, "instruction", "context", "response").first()["messages"]] == ["system", "user", "assistant"]
    assert isinstance(clients.chat_rows(df, "instruction", "context", "response").toPandas(), pd.DataFrame) and C.ERROR_SEPARATOR.startswith("\n\n")


def test_chat_examples_and_verdicts(spark):
    shape = "system string, user struct<prompt:string,goal:string,context:string,artifacts:map<string,string>,constraints:array<string>>, assistant struct<response:string>"
    df = spark.createDataFrame([("s", ("p", "", None, {"b.cc": "int b;", "a.txt": "t"}, ["one", "two"]), ("r",)), (None, (None, "g", "c", None, None), (None,))], shape)
    found = [[m["content"] for m in r["messages"]] for r in rows.chat_example(df).collect()]
    assert found[0] == ["s", "p\n\nArtifacts:\na.txt:\n```text\nt\n```\n\nb.cc:\n```cpp\nint b;\n```\n\nConstraints:\n- one\n- two", "r"] and found[1] == [None, "Goal:\ng\n\nContext:\nc", None]
    results = spark.createDataFrame([(True, True, True, False, True), (True, False, True, True, True), (None, True, True, False, True), (True, False, True, False, True), (True, False, False, False, False), (True, False, True, False, False)], "proven boolean, compiled boolean, structure_ok boolean, dsl_only boolean, has_compiler boolean")
    assert [(r["verdict"], r["passed"]) for r in rows.combined_verdict(results).collect()] == [("logical_likely", True), ("dsl_unresolved_but_plausible", True), ("logical_likely", False), ("syntax_error", False), ("structure_broken", False), ("structure_only_no_compiler", True)]
