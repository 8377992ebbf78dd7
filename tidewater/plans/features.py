"""Queries of code, section and log features over sources made of the parts; the twins say what each source was made of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions import screens as S
from tidewater.operators import rows
from tidewater.operators.lineage import held, spread
from tidewater.plans.catalog import _t, query


def _text(template: str) -> Column:
    """A template with columns in braces, as Spark's expression."""
    parts = template.replace("}", "{").split("{")
    return F.concat(*[F.col(x).cast("string") if i % 2 else F.lit(x) for i, x in enumerate(parts) if x])


def _duck(template: str) -> str:
    """The same template as DuckDB's expression."""
    parts = template.replace("}", "{").split("{")
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return " || ".join(f"{x}::varchar" if i % 2 else quoted(x) for i, x in enumerate(parts) if x)


_HEADER = "/*\nSOURCE: own/{k}, branch dev/{n}\nPATH: a/{k}.cc\nINTERFACE: Cascade, {b}\nKEY INTRINSICS: one, two<{n}, 2>\nVECTOR TYPES: v{n}int\n*/\n"
_BODY = "#include <adf.h>\nvoid run_{k}(input_stream<int16>*  in,\n  output_window<cint{n}>* out) [\n  aie::vector<int16 , {n}> v = readincr_v8(in); // {b}\n  aie::accum<acc48,  {n}> a = mac4(v);\n  aie::store_v(v);\n  aie::mac(a);\n]\n"
_KERNEL = (_HEADER + _BODY).replace("[", "⟦").replace("]", "⟧")


def _braces(column: Column) -> Column:
    return F.replace(F.replace(column, F.lit("⟦"), F.lit("{")), F.lit("⟧"), F.lit("}"))


def _parts(spark, d):
    return spread(_t(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("n"), F.replace("p_brand", F.lit("#"), F.lit("")).alias("b"), F.col("p_name").alias("name")))


_PARTS = "select p_partkey as k, p_size as n, replace(p_brand, '#', '') as b, p_name as name from part"


@query(
    f"""with p as ({_PARTS}) select k, {_duck(_HEADER.rstrip(chr(10)))} as header, 'own/' || k || ', branch dev/' || n as source, 'own/' || k as repo, 'dev/' || n as branch,
    ['v' || n || 'int', 'aie::vector<int16, ' || n || '>', 'aie::accum<acc48, ' || n || '>'] as vectors, ['one', 'two<' || n || ', 2>', 'aie::vector', 'aie::accum', 'aie::store_v', 'aie::mac', 'readincr_v8', 'mac4'] as intrinsics,
    ['Cascade', 'Window', 'Stream'] as interfaces, ['input_stream<int16>* in', 'output_window<cint' || n || '>* out'] as ports, 'kernel_type' as artifact, true as relevant, true as candidate from p"""
)
def source_features(spark, d):
    """Comments, headers, types, intrinsics, interfaces, ports and kinds of one kernel a part."""
    p = held(_parts(spark, d), code=_braces(_text(_KERNEL)))
    code = F.col("code")
    p = held(p, header=C.leading_comment(code), body=C.body(code))
    p = held(p, f=C.header_fields(F.col("header")))
    repo, branch = C.repo_and_branch(F.col("f")["source"])
    return p.select(
        "k", "header", F.col("f")["source"].alias("source"), repo.alias("repo"), branch.alias("branch"), C.vector_types(F.col("body"), F.col("f")["vector types"]).alias("vectors"), C.intrinsics(F.col("body"), F.col("f")["key intrinsics"]).alias("intrinsics"),
        C.interface_types(F.col("body"), F.col("f")["interface"]).alias("interfaces"), S.kernel_ports(F.col("body")).alias("ports"), C.artifact_type(F.col("body"), F.concat("k", F.lit(".cc"))).alias("artifact"), C.is_relevant(F.col("body"), F.lit("x")).alias("relevant"), S.content_candidate(F.col("body")).alias("candidate"),
    )


@query(
    f"""with p as ({_PARTS}) select k, 'b' || n || '/src/x' || k || case when k % 3 = 0 then '_CORRECT' when k % 3 = 1 then '_BUGGY_oob' else '' end || '.cc' as path, 'x' || k as canonical, case when n % 4 = 0 then 'local' else b end || ':b' || n || '/src/x' || k || '.cc' as source_group,
    case when n % 4 = 0 then 'local' else b end || ':b' || n || '/src' as parent, 'f' || k || '.cc' as clean, case when n % 3 = 0 then 'x_' || k when n % 3 = 1 then 'lost_label_' || k else 'new_' || k end as bug_slug, case when n % 5 = 0 then 'hard' when n % 3 = 1 then 'easy' else 'medium' end as tier from p"""
)
def path_features(spark, d):
    """Stems, groups, parents, clean names, canonical bug types and tiers."""
    p = _parts(spark, d)
    kind = F.when(F.col("k") % 3 == 0, "_CORRECT").when(F.col("k") % 3 == 1, "_BUGGY_oob").otherwise("")
    p = p.withColumn("path", F.concat(F.lit("b"), "n", F.lit("/src/x"), "k", kind, F.lit(".cc"))).withColumn("repo", F.when(F.col("n") % 4 != 0, F.col("b")))
    p = p.withColumn("bug", F.when(F.col("n") % 3 == 0, F.concat(F.lit("X "), "k")).when(F.col("n") % 3 == 1, F.concat(F.lit("lost_label_"), "k")).otherwise(F.concat(F.lit("New! "), "k")))
    taxonomy = p.where("n % 3 = 0").select(F.concat(F.lit("x_"), "k").alias("slug"), F.concat(F.lit("x "), "k").alias("label")).unionByName(p.where("n % 3 = 1").select(F.col("bug").alias("slug"), F.lit("other").alias("label")))
    p = rows.canonical_bug_type(p, "bug", taxonomy)
    named = F.when(F.col("k") % 2 == 0, F.concat(F.lit("f"), "k", F.lit("_odd_kind.cc"))).otherwise(F.concat(F.lit("f"), "k", F.lit("_deadlock_2.cc")))
    return p.select(
        "k", "path", C.canonical_stem(F.col("path")).alias("canonical"), C.source_group(F.col("repo"), F.col("path")).alias("source_group"), C.parent_key(F.col("repo"), F.col("path")).alias("parent"),
        S.clean_name(named, F.lit("odd_kind")).alias("clean"), "bug_slug", rows.tier_of(F.col("bug_slug"), F.when(F.col("n") % 5 == 0, "hard"), [("easy", ("lost",))]).alias("tier"),
    )


_PAIR = "Scenario: {name}\nBuggy version:\n  int a_{k};\n// case: {b}\nint z;\n\nCorrect version:\n int b_{k};\n"
_REPLY = "text\n```cpp\nfirst {k}\n```\nmore\n```\nlast {n}\n```\n"
_PROJECT = "// FILE: graph.h\nclass g{k};\n// FILE: kernels/k.cc\nvoid k{n}();\n"


@query(
    f"""with p as ({_PARTS}) select k, 'int a_' || k || ';' || chr(10) || '// case: ' || b || chr(10) || 'int z;' as buggy, 'int b_' || k || ';' as correct, 'int a_' || k || ';' || chr(10) || 'int z;' as unhinted, 'first ' || k as first, 'last ' || n as last, 'x ' || name as whole,
    '```cpp' || chr(10) || 'y ' || k || chr(10) || '```' as fenced, 'class g' || k || ';' as graph_file, 'void k' || n || '();' as kernel_file, 'c' || k as code, case when n % 3 = 2 then '' else 'log ' || n end as log,
    case n % 3 when 0 then ['missing_part'] when 1 then ['same_as_correct'] else ['not_code'] end as pair_gate, case n % 3 when 0 then ['same_as_correct'] when 1 then ['file_layout_changed'] else [] end as mutation_gate from p"""
)
def section_features(spark, d):
    """Sections, fences, hints, marked files, code and log, and the gates on replies."""
    p = held(_parts(spark, d), pair=_text(_PAIR), reply=_text(_REPLY), project=_text(_PROJECT))
    p = held(p, buggy=C.buggy_code(F.col("pair")), files=C.project_files(F.col("project")))
    n = F.col("n")
    logged = F.when(n % 3 == 0, _text("c{k}\n\n--- Error Log ---\nlog {n}")).when(n % 3 == 1, _text("c{k}\n-- Error Log --\nlog {n}")).otherwise(_text("c{k}"))
    code, log = C.code_and_log(F.col("logged"))
    told = F.when(n % 3 == 0, F.lit("<buggy>a;</buggy>")).when(n % 3 == 1, F.lit("<buggy>a;</buggy><correct>a;</correct>")).otherwise(F.lit("<buggy>a</buggy><correct>b;</correct>"))
    changed = F.when(n % 3 == 0, F.col("project")).when(n % 3 == 1, F.replace("project", F.lit("k.cc"), F.lit("other.cc"))).otherwise(F.replace("project", F.lit("();"), F.lit("(int);")))
    p = held(p, logged=logged, told=told, changed=changed)
    return p.select(
        "k", "buggy", C.correct_code(F.col("pair")).alias("correct"), C.without_hints(F.col("buggy")).alias("unhinted"), C.first_fenced(F.col("reply")).cast("string").alias("first_raw"), C.last_fenced(F.col("reply")).alias("last_raw"),
        C.strip_whole_fence(_text("```cpp\nx {name}\n```")).alias("whole"), C.fence(_text("y {k}  \n\n")).alias("fenced"), F.col("files")["graph.h"].alias("graph_file"), F.col("files")["kernels/k.cc"].alias("kernel_file"),
        code.alias("code"), log.alias("log"), S.pair_gate(F.col("told")).alias("pair_gate"), S.mutation_gate(F.col("changed"), F.col("project")).alias("mutation_gate"),
    ).withColumn("first", F.rtrim(F.regexp_replace("first_raw", "\n", ""))).withColumn("last", F.rtrim(F.regexp_replace("last_raw", "\n", ""))).drop("first_raw", "last_raw")


_LOG = "In file included from a.h:1:\n\n a{k}.cc:3:1: note: x\na{k}.cc:4:2: error: no member named 'mac{n}'\n fatal error: 'b{k}.h' file not found\n"


@query(
    f"""with p as ({_PARTS}) select k, 'a' || k || '.cc:4:2: error: no member named ''mac' || n || '''' as first_error, 'a' || k || '.cc:4:2: error: no member named ''mac' || n || '''' || chr(10) || ' fatal error: ''b' || k || '.h'' file not found' as excerpt, ['b' || k || '.h'] as headers,
    n % 2 = 0 as dsl_only, n % 3 = 0 as scalar, n % 4 = 0 as disjoint, n % 5 = 0 as mismatch, case when n % 2 = 0 then 'Compile error: AIE vector type instantiation failed.' else 'kept ' || n end as cleaned,
    'Compile error: no member named ''mac' || n || '''' as stock from p"""
)
def log_features(spark, d):
    """First errors, excerpts, headers, and what logs say about code."""
    p = _parts(spark, d).withColumn("log", _text(_LOG))
    n = F.col("n")
    code = F.when(n % 3 == 0, _text("int x_{k};")).otherwise(_text("aie::vector<int16, 8> x_{k};"))
    sized = F.when(n % 4 == 0, "vector<int16, 4>").otherwise("vector<int16, 8> and vector<int16, 4>")
    named = F.when(n % 5 == 0, "mac9 and mul9 are unknown").otherwise("mac9 is unknown")
    return p.select(
        "k", C.first_error_line(F.col("log")).alias("first_error"), C.error_excerpt(F.col("log")).alias("excerpt"), C.missing_headers(F.col("log")).alias("headers"),
        S.dsl_only(F.when(n % 2 == 0, "error: 'input_stream' was not declared").otherwise("error: expected ;")).alias("dsl_only"), C.is_scalar_code(code).alias("scalar"), C.vector_sizes_disjoint(F.lit("vector<int16, 8>"), sized).alias("disjoint"),
        C.api_mismatch(F.lit("plain"), named, ("mac9", "mul9")).alias("mismatch"), C.clean_log(F.when(n % 2 == 0, "\nnative_vector_type<int>\n").otherwise(_text("kept {n}  \nvector_storage<x>"))).alias("cleaned"), C.stock_log(F.col("log")).alias("stock"),
    )
