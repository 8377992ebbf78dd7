"""Expressions that are worked out once a row, rows that are dealt over tasks, and edits that find their line at once."""

import time

from pyspark.sql import functions as F

from tidewater.functions import mutators
from tidewater.operators.lineage import held, spread


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mutations_normalise_an_edit_once(spark):
    df = spark.createDataFrame([("for (int i = 0; i < 8; i++) {\n  *out++ = a + b;\n}", "kernel_type", ["Stream"])], "code string, kind string, interfaces array<string>")
    found = mutators.mutations(df, "code", "kind", "interfaces")
    assert {"window_oob", "missing_iterator_increment"} <= {r["bug_type"] for r in found.collect()}
    assert _plan(found).count("<n>") == 1  # it stood inside the loops over pairs of edits


def test_lines_are_found_without_trying_all():
    text = "connect_nothing_here " * 4000 + "\n  k.wait();"
    start = time.perf_counter()
    assert mutators.REGISTRY["missing_graph_wait"](text).endswith("  // BUG_INJECTED: missing_graph_wait\n  // ORIGINAL: k.wait();")
    assert mutators.REGISTRY["missing_adf_source"](text) is None
    assert time.perf_counter() - start < 1


def test_held_and_spread(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "k int, t string").coalesce(1)
    assert spread(df).rdd.getNumPartitions() >= 32
    found = held(spread(df), n=F.md5("t"), t=F.upper("t")).select("k", "t", F.concat("n", "n", "n").alias("x"))
    assert _plan(found).count("md5") == 1
    assert [(r["k"], r["t"], r["x"] and len(r["x"])) for r in found.orderBy("k").collect()] == [(1, "A B", 96), (2, None, None)]


def test_project_gates_find_the_graph_once(spark):
    from tidewater.functions import screens

    df = spark.createDataFrame([("// FILE: graph.h\nclass g : public adf::graph {};\nadf::x y;\n// FILE: kernels/k.cc\nint a;", ), (None,), ("",)], "code string")
    found = df.select(screens.project_gate(F.col("code")).alias("r"))
    assert _plan(found).count("split(") <= 2  # it stood in each check
    assert "missing_graph_instance" in found.first()["r"] and found.count() == 3


def test_features_of_parts_are_worked_out_once(spark):
    import __spark_entry__ as entry

    for name, word, most in (("section_features", "split(", 12), ("artifact_answers", "chess_loop_range", 1), ("graph_descriptions", "chess_loop_range", 1)):
        assert _plan(entry.queries()[name](spark, "/root/testdata/sf0.001")).count(word) <= most, name


def test_parts_are_dealt_over_tasks(spark):
    import __spark_entry__ as entry

    for name in ("source_features", "section_features", "artifact_answers", "injected_bugs", "sql_injected_bugs", "graph_descriptions", "source_mutations", "project_gates"):
        assert "Repartition" in _plan(entry.queries()[name](spark, "/root/testdata/sf0.001")), name


def test_siblings_make_no_pairs(spark):
    from tidewater.operators import merge

    df = spark.createDataFrame([(i, "p", f"k{i % 7}") for i in range(300)], "id long, parent string, kind string").coalesce(1)
    found = merge.siblings(df, "parent", "id", "kind", 4)
    assert {r["n"] for r in found.groupBy("id").agg(F.count("*").alias("n")).collect()} == {4}
    nodes = found._jdf.queryExecution().executedPlan().toString()
    assert "__others" in nodes and "place" in nodes  # a parent's candidates are one array, not a row for each pair
    twice = merge.siblings(df.union(df), "parent", "id", "kind", 4)
    assert twice.groupBy("id").agg(F.max("place").alias("n")).where("n <> 4").count() == 0


def test_pretty_files_are_fewer_than_rows(spark, tmp_path):
    from tidewater.sources import files

    df = spark.range(1500).selectExpr("id", "if(id % 7 = 0, null, concat('a\nb ', id)) as name").coalesce(1)
    df = df.union(df.where("id < 20"))  # repeated rows stay
    files.write_json_arrays(df, f"{tmp_path}/arrays", 500)
    assert len(list((tmp_path / "arrays").glob("part-*"))) == 4
    back = files.json_documents(spark, f"{tmp_path}/arrays", "id long, name string")
    assert sorted(map(tuple, back.drop("file").collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert back.groupBy("file").count().agg({"count": "max"}).first()[0] == 500
    (tmp_path / "one.json").write_text('{\n  "id": 3,\n  "name": "x"\n}')
    assert [tuple(r)[:2] for r in files.json_documents(spark, f"{tmp_path}/one.json", "id long, name string").collect()] == [(3, "x")]
    files.write_json_arrays(df.where("false"), f"{tmp_path}/none")
    assert files.json_documents(spark, f"{tmp_path}/none", "id long, name string").count() == 0


def test_pretty_json_writes_no_file_a_supplier(spark):
    import __spark_entry__ as entry

    found = entry.queries()["pretty_json"](spark, "/root/testdata/sf0.1")
    assert found.count() == 1000 and len(found.inputFiles()) < 10


def test_diffs_are_worked_out_once(spark):
    import __spark_entry__ as entry
    from tidewater.operators import rows

    assert _plan(entry.queries()["diff_conversions"](spark, "/root/testdata/sf0.001")).count("ArrowEvalPython") == 1  # its condition had one of its own
    failures = spark.createDataFrame([("ab12", "a\nb", "a\nc", "x.cc:1: error: no b")], "source_id string, buggy string, correct string, log string")
    found = rows.v5_rows(failures, ["fix"])
    assert _plan(found).count("ArrowEvalPython") == 1 and "+c" in found.first()["response"]


def test_diffs_of_batches_hold_few_python_values(spark):
    from tidewater.functions import diffs

    assert diffs.unified_diff.evalType == diffs.similarity_ratio.evalType == 250  # Arrow, not pandas
    r = [(i, None if i % 7 == 0 else f"a\n{i}\n", None if i % 11 == 0 else f"a\n{i % 5}\n") for i in range(diffs.ROWS * 2 + 3)]
    df = spark.createDataFrame(r, "i long, a string, b string").coalesce(1)
    found = df.select("i", diffs.unified_diff("a", "b").alias("d"), diffs.cropped("a", "b").alias("c"), diffs.anchor_lines("a", "b").alias("n"), diffs.similarity_ratio("a", "b").alias("s"), diffs.n_changed_lines("a", "b").alias("k"), diffs.fix_is_proven("a", "b", "b").alias("p"))
    wanted = [(i, diffs.unified(a, b), diffs.crop(a, b), diffs.anchors(a, b), diffs.similarity(a, b), diffs.changed_lines(a, b), diffs.proof(a, b, b)) for i, a, b in r]
    assert sorted(((*x[:3], tuple(x[3]), *x[4:]) for x in map(tuple, found.collect())), key=lambda x: x[0]) == wanted
    assert df.where("false").select(diffs.unified_diff("a", "b")).count() == 0


def test_patterns_are_tried_where_their_words_are(spark):
    from tidewater.functions import code as C
    from tidewater.functions import recipes
    from tidewater.functions import screens as S

    kernel = "void k(input_stream<int16>* in, // first\n  aie::vector<int16, 8>& v) { readincr_v8(in); x<int>::run(y) { } aie::mul(a); aie::mul(b); upd_v(1); srs mul4 mac4_x; }"
    texts = [None, "", "void", "void f() {", "void f()", "avoid f(int a) {}", "a<b>::c (int d, e<f, g>& h) {\n}", "template<a>::b; void (x) {", "x<y>::\nz(a) {", "avoid aie:: readincrs connect<> connect<a<b>>x bank(1) tile location runtime<ratio> initialization_functions",
             "\tinput_port a, b;\ninput_ports c;\n output_plio d\n ;x input_plio e;", "kernel::create_object<k>(1) kernel::creat kernel::create(a)", "dimensions(a) = {64}; dimensions(b) = { 64 }; dimensions() = {1}; connect<window< 256 >>(x); connect<window<>>; begin_vector<8>(y) begin_vector<a>", "aie::multiply", "xmac4 simul4", recipes.GRAPH, kernel, kernel * 2]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string").repartition(2)
    c, every = F.col("c"), lambda p, g=0: F.regexp_extract_all("c", F.lit(p), F.lit(g))
    plain_ports = F.when(c.rlike(S.KERNEL_PARAMETERS), F.transform(C.listed(F.regexp_replace(F.regexp_extract("c", S.KERNEL_PARAMETERS, 1), r"(?d)//.*", "")), S.one_space))
    trimmed = lambda a: F.transform(a, S.strip)
    plain = {
        "intrinsics": F.array_distinct(F.concat(F.array().cast("array<string>"), F.transform(every(r"aie::([A-Za-z_][A-Za-z0-9_]*)", 1), lambda x: F.concat(F.lit("aie::"), x)), *[every(p) for p in C.INTRINSICS])),
        "parameters": plain_ports, "declarations": trimmed(F.transform(F.concat(*[every(rf"(?m)^[ \t]*({k}\b[^;]*;)", 1) for k in S.PORT_KEYWORDS]), S.one_space)), "n_kernels": F.regexp_count("c", F.lit(S.KERNEL_MADE)),
        "dimensions": F.array_distinct(trimmed(every(S.DIMENSIONS, 1))), "windows": trimmed(every(S.WINDOWS, 1)), "lanes": F.array_distinct(trimmed(every(S.LANES, 1))),
    }
    found = df.select("i", C.intrinsics(c, F.lit(None).cast("string")).alias("intrinsics"), S.kernel_ports(c).alias("parameters"), S.graph_ports(c).alias("p"), S.buffers(c).alias("b")).select("i", "intrinsics", "parameters", "p.*", "b.*")
    wanted = df.select("i", *[p.alias(n) for n, p in plain.items()])
    assert found.columns == wanted.columns and [f.dataType for f in found.schema] == [f.dataType for f in wanted.schema]
    assert found.orderBy("i").collect() == wanted.orderBy("i").collect()
    flags = lambda found: [r[0] for r in df.orderBy("i").select(S.constraint_flags(c, F.lit("kernel_type"), F.array(F.lit("Stream")), found)).collect()]
    assert flags(S.limiting_intrinsics(c)) == flags(C.intrinsics(c, F.lit(None).cast("string"))) and sum("simd" in (f or []) for f in flags(S.limiting_intrinsics(c))) == 3
    assert _plan(df.select(C.intrinsics(c, F.lit(None).cast("string")))).count("Contains(") == len(C.INTRINSICS) + 1  # each pattern was tried at every place of every text
    assert _plan(df.select(S.kernel_ports(c))).count("(c#") == 3  # two words and one pattern see the whole text; two patterns did
