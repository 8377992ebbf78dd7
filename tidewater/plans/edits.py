"""Edits on differing sources against their recorded results.

Each row of RECORDED is an edit, a piece of code and that piece with the edit, checked by reading; they do not
come from the edits at run time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import mutators
from tidewater.plans.catalog import _duck_rows, _t, query

RECORDED = [
    ("stream_deadlock", "        writeincr(out, aie::add(a, b));", "        // BUG_INJECTED: stream_deadlock\n        // ORIGINAL: writeincr(out, aie::add(a, b));"),
    ("window_oob", "    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {", "    for (int i = 0; i <= 32; i++) chess_prepare_for_pipelining {"),
    ("missing_iterator_increment", "*out++ = x;", "*out = x;"),
    ("dereference_moved_outside_loop", "for (int i = 0; i < 8; i++) {\n    auto v = *it++;\n    f(v);\n}", "auto v = *it++;\nfor (int i = 0; i < 8; i++) {\n    f(v);\n}"),
    ("runtime_ratio_zero", "        runtime<ratio>(first) = 0.8;", "        runtime<ratio>(first) = 0;"),
    ("plio_width_mismatch", "        in = input_plio::create(\"in\", plio_32_bits, \"data/in.txt\");", "        in = input_plio::create(\"in\", plio_128_bits, \"data/in.txt\");"),
    ("reversed_connect_direction", "        connect<window<256, 64>>(in.out[0], first.in[0]);", "        connect<window<256, 64>>(first.in[0], in.out[0]);"),
    ("missing_output_write", "        writeincr(out, aie::add(a, b));", "        // BUG_INJECTED: missing_output_write\n        // ORIGINAL: writeincr(out, aie::add(a, b));"),
    ("wrong_vector_lane_width", "        aie::vector<int16, 8> a = readincr_v<8>(in);", "        aie::vector<int16, 16> a = readincr_v<8>(in);"),
    ("graph_dimension_mismatch", "        dimensions(first.in[0]) = {64};", "        dimensions(first.in[0]) = {80};"),
    ("subtraction_for_addition", "c = a + b;", "c = a - b;"),
    ("mul_to_add", "        aie::vector<int16, 8> b = aie::mul(a, a).to_vector<int16>(0);", "        aie::vector<int16, 8> b = aie::add(a, a).to_vector<int16>(0);"),
    ("tovector_shift_fifteen", "        aie::vector<int16, 8> b = aie::mul(a, a).to_vector<int16>(0);", "        aie::vector<int16, 8> b = aie::mul(a, a).to_vector<int16>(15);"),
    ("acc48_for_acc80", "aie::accum<acc80, 8> a;", "aie::accum<acc48, 8> a;"),
    ("loop_count_halved", "    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {", "    for (int i = 0; i < 16; i++) chess_prepare_for_pipelining {"),
    ("window_size_halved", "connect<window<256>>(a.out[0], b.in[0]);", "connect<window<128>>(a.out[0], b.in[0]);"),
    ("remove_zeros_init", "    aie::accum<acc48, 8> acc = aie::zeros<acc48, 8>();", "    aie::accum<acc48, 8> acc = aie::broadcast<acc48, 8>(1);"),
    ("broadcast_width_mismatch", "auto b = aie::broadcast<int16, 8>(3);", "auto b = aie::broadcast<int16, 4>(3);"),
    ("duplicate_stream_read", "auto a = readincr(in_a);\nauto b = readincr(in_b);", "auto a = readincr(in_a);\nauto b = readincr(in_a);"),
    ("drop_last_sample", "    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {", "    for (int i = 0; i < 32 - 1; i++) chess_prepare_for_pipelining {"),
    ("remove_chess_pipelining", "    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {", "    // BUG_INJECTED: remove_chess_pipelining\n    // ORIGINAL: for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {"),
    ("readincr_from_output", "auto a = readincr(in);\nwriteincr(out, a);", "auto a = readincr(out);\nwriteincr(out, a);"),
    ("break_in_pipelined_loop", "    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {\n        aie::vector<int16, 8> a = readincr_v<8>(in);", "    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {\n    if (false) { break; }\n        aie::vector<int16, 8> a = readincr_v<8>(in);"),
    ("runtime_ratio_overflow", "        runtime<ratio>(first) = 0.8;", "        runtime<ratio>(first) = 2.0;"),
    ("port_index_oob", "        connect<window<256, 64>>(in.out[0], first.in[0]);", "        connect<window<256, 64>>(in.out[4], first.in[0]);"),
    ("missing_graph_wait", "g.run(1);\ng.wait();", "g.run(1);\n// BUG_INJECTED: missing_graph_wait\n// ORIGINAL: g.wait();"),
    ("missing_connect", "        connect<window<256, 64>>(in.out[0], first.in[0]);", "        // BUG_INJECTED: missing_connect\n        // ORIGINAL: connect<window<256, 64>>(in.out[0], first.in[0]);"),
    ("self_loop_connect", "        connect<window<256, 64>>(in.out[0], first.in[0]);", "        connect<window<256, 64>>(in.out[0], in.in[0]);"),
    ("wrong_to_vector_output_type", "        aie::vector<int16, 8> b = aie::mul(a, a).to_vector<int16>(0);", "        aie::vector<int16, 8> b = aie::mul(a, a).to_vector<int32>(0);"),
    ("missing_adf_source", "        source(first) = \"kernels/first.cc\";", "        // BUG_INJECTED: missing_adf_source\n        // ORIGINAL: source(first) = \"kernels/first.cc\";"),
    ("missing_runtime_ratio", "        runtime<ratio>(first) = 0.8;", "        // BUG_INJECTED: missing_runtime_ratio\n        // ORIGINAL: runtime<ratio>(first) = 0.8;"),
    ("window_margin_to_size", "        connect<window<256, 64>>(in.out[0], first.in[0]);", "        connect<window<256, 264>>(in.out[0], first.in[0]);"),
    ("bfloat16_on_aie1", "        aie::vector<int16, 8> a = readincr_v<8>(in);", "        aie::vector<bfloat16, 8> a = readincr_v<8>(in);"),
    ("signed_unsigned_mismatch", "int16 x = 3;", "uint16 x = 3;"),
    ("unaligned_load", "aie::vector<int16, 8> v = aie::load_v<8>(ptr);", "aie::vector<int16, 8> v = aie::load_v<8>(ptr + 1);"),
    ("modulo_in_loop", "out[i] = in[i];", "out[i] = in[i % 32];"),
    ("break_accumulator_reset", "    aie::accum<acc48, 8> acc = aie::zeros<acc48, 8>();", "    // BUG_INJECTED: break_accumulator_reset\n    // ORIGINAL: aie::accum<acc48, 8> acc = aie::zeros<acc48, 8>();"),
    ("begin_vector_non_power_of_two", "begin_vector<8>(in);", "begin_vector<6>(in);"),
]


@query(
    f"""with e(slug, before, after) as (values {_duck_rows([tuple(v.replace("'", "''") for v in r) for r in RECORDED])}), n as (select *, row_number() over (order by slug) - 1 as place from e),
    d as (select doc_id, substr(regexp_replace(text, '[^a-z ]', '', 'g'), 1, 200) as words from documents)
    select doc_id, slug, '// ' || words || chr(10) || after || chr(10) || '// end of ' || words || chr(10) as buggy from d join n on doc_id % {len(RECORDED)} = place"""
)
def edited_sources(spark, d):
    """One of all edits for each document, on code with the document's words around it."""
    names = sorted(RECORDED)
    table = F.array(*[F.struct(F.lit(s).alias("slug"), F.lit(before).alias("before")) for s, before, _ in names])
    docs = _t(spark, d, "documents").select("doc_id", F.substring(F.regexp_replace("text", "[^a-z ]", ""), 1, 200).alias("words"), F.get(table, (F.col("doc_id") % len(names)).cast("int")).alias("e"))
    code = F.concat(F.lit("// "), "words", F.lit("\n"), "e.before", F.lit("\n// end of "), "words", F.lit("\n"))
    return mutators.mutate(docs.select("doc_id", F.col("e.slug").alias("slug"), code.alias("code")), "code", "slug").select("doc_id", "slug", "buggy")
