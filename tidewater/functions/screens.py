"""Detectors, path and content filters, and gates that list their reasons; all native expressions.

A gate's result is an array of reasons; an empty one passes. Keyword and pattern tables are
parameters whose defaults are the values that results depend on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.code import SUFFIXES, any_of, edge_fences, intrinsics, listed, project_files
from tidewater.functions.text import all_said, if_said, lines, once, one_space, strip

# Detector words and gate patterns.
COMPUTE_PATTERNS = {
    "fir_filter": ("fir", "tap", "sliding", "mac"), "fft_butterfly": ("fft", "butterfly", "twiddle"), "matrix_multiply": ("gemm", "matmul", "matrix"), "beamforming": ("beam", "steer", "phase_shift"),
    "interpolation": ("interpol", "upsample"), "decimation": ("decim", "downsample"), "lut_nonlinear": ("lut", "lookup", "piecewise"), "sorting_network": ("sort", "bitonic", "merge_sort"),
    "crc_computation": ("crc", "polynomial"), "peak_detection": ("peak", "threshold"), "moving_average": ("moving average", "boxcar"), "correlation": ("correlation", "matched"),
    "polyphase_filterbank": ("polyphase", "channelizer"), "cordic_rotation": ("cordic", "rotation"), "viterbi_decoder": ("viterbi", "trellis"), "ldpc_update": ("ldpc", "belief"),
    "qam_demodulation": ("qam", "llr", "constellation"), "channel_estimation": ("channel estimation", "pilot"), "mimo_precoding": ("mimo", "precoding"), "sample_rate_conversion": ("sample rate", "resampler"),
    "noise_shaping": ("noise shaping", "sigma delta"), "envelope_detection": ("envelope",), "automatic_gain_control": ("agc", "gain control"), "pulse_compression": ("pulse compression", "chirp"),
    "matched_filtering": ("matched filter",), "doppler_processing": ("doppler",), "cfar_detection": ("cfar",), "digital_downconversion": ("downconversion", "nco", "mixer"),
    "numerically_controlled_oscillator": ("nco", "phase accumulator"),
}
CORPUS_INTERFACES = {
    "buffer": ("input_buffer", "output_buffer", "input_window", "output_window"), "stream": ("input_stream", "output_stream", "readincr", "writeincr"), "cascade": ("cascade",),
    "async": ("async_buffer", "input_async_buffer", "output_async_buffer"), "external_io": ("plio", "gmio"),
}
DATA_TYPES = ("int8", "int16", "int32", "float", "cint16", "cint32", "cfloat")
GRAPH_WORDS = ("adf::graph", "connect<", "kernel::create")
DSL_ONLY = ("chess_prepare_for_pipelining", "is not a member of 'aie'", "is not a member of 'adf'", "'input_stream' was not declared", "'output_stream' was not declared", "runtime<ratio>", "readincr_v<", "writeincr_v<", "expected ';' before 'for'", "statement cannot resolve address of overloaded function")
PROJECT_MUST = {
    "missing_adf_include": r"#include\s*<adf\.h>", "missing_graph_class": r"class\s+\w+\s*:\s*public\s+adf::graph", "missing_kernel_create": r"adf::kernel::create\s*\(", "missing_source_assignment": r"adf::source\s*\(",
    "missing_connect": r"adf::connect\s*<", "missing_runtime_ratio": r"adf::runtime\s*<\s*adf::ratio\s*>\s*\(",
}
KERNEL_MUST = {"missing_kernel_function_body": r"\bvoid\s+\w+\s*\([^)]*\)\s*\{", "missing_aie_kernel_ops": r"readincr|writeincr|load_v|store_v|aie::mac|aie::mul|input_buffer|output_buffer"}
PROJECT_MUST_NOT = {
    "templated_kernel_create": r"adf::kernel::create\s*<", "invalid_vector_zeros_api": r"aie::zeros\s*<\s*(?:int|uint|cint|float|bfloat)\w*\s*,", "missing_to_vector_shift": r"\.to_vector\s*<[^>]+>\s*\(\s*\)",
    "unsupported_sliding_mac_signature": r"aie::mac\s*\([^\n,]+,[^\n,]+,\s*\d+\s*,", "unsupported_shuffle_up_usage": r"aie::shuffle_up\s*\(",
}
KERNEL_PARAMETERS = r"(?s)(?:\b\w+(?:::\w+)?\s*<[^>]+>::\w+|\bvoid\s+\w+)\s*\((.*?)\)\s*\{"
PORT_KEYWORDS, KERNEL_MADE = ("input_port", "output_port", "input_plio", "output_plio"), r"kernel::create(?:_object)?"
DIMENSIONS, WINDOWS, LANES = r"dimensions\([^\)]+\)\s*=\s*\{([^}]+)\}", r"connect<window<\s*([^>]+?)\s*>>", r"begin_vector<\s*(\d+)\s*>"
SIMD_WORDS = ("mul4", "mac4", "aie::mul", "aie::add")
ANCHOR_CLASS = r"\bclass\s+([A-Za-z_][A-Za-z0-9_]*)"
ANCHOR_FUNCTION = r"\b(?:void|int|float|cint32|cint16|int16|int32|uint16|uint32|bfloat16|bool)\s+([A-Za-z_][A-Za-z0-9_]*)\s*\("
ANCHOR_NAME = r"\b(?:in_iter|out_iter|in_stream|out_stream|buf|coeff|delay_line|acc|window|stream)[A-Za-z0-9_]*"
STREAM_USE, NUMBER = r"readincr|writeincr|input_stream|output_stream|connect<", r"\b\d+\b"
GRAPH_STREAM = r"\b(?:input_stream|output_stream)\s*<[^>]+>\s+[A-Za-z_]\w*\s*(?:,|;)"
UNQUALIFIED = (
    r"(?<!adf::)\bkernel::create\s*\(",
    r"(?<!adf::)\binput_plio::create\s*\(",
    r"(?<!adf::)\boutput_plio::create\s*\(",
    r"(?<!adf::)\bconnect\s*<",
    r"(?<!adf::)\bruntime\s*<\s*ratio\s*>",
    r"(?<!adf::)\bplio_(?:32|64|128)_bits\b",
    r"(?<!adf::)\bstream\b",
    r"(?<!adf::)\bwindow\s*<",
)


def labels(text: Column, table: dict[str, tuple[str, ...]], default: str | None = None) -> Column:
    """The labels with a word in the lower-cased text, in the table's order; the default alone if there is none."""
    low = F.lower(text)
    found = F.array_compact(F.array(*[F.when(any_of(low, words), name) for name, words in table.items()]))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default))) if default else found


def corpus_category(code: Column) -> Column:
    return F.when(any_of(F.lower(code), GRAPH_WORDS), "graph").otherwise("kernel")


def corpus_interfaces(code: Column) -> Column:
    return labels(code, CORPUS_INTERFACES, "unknown")


def data_types(code: Column, types: tuple[str, ...] = DATA_TYPES) -> Column:
    return labels(code, {t: (t,) for t in types}, "unknown")


def compute_patterns(code: Column, table: dict[str, tuple[str, ...]] | None = None) -> Column:
    return labels(code, table or COMPUTE_PATTERNS, "generic_aie")


# ---- paths


def _path(path: Column) -> Column:
    return F.lower(F.replace(path, F.lit("\\"), F.lit("/")))


def has_suffix(path: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    return _path(path).rlike("(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + r")\z")


def path_candidate(path: Column, prefixes: tuple[str, ...] = (), hints: tuple[str, ...] = (), suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """A suffix of the list, one of the prefixes (if any are given), one of the hints (if any are given)."""
    p = _path(path)
    out = has_suffix(path, suffixes)
    if prefixes:
        out = out & p.rlike("^(?:" + "|".join(rf"\Q{x.lower()}\E" for x in prefixes) + ")")
    return out & any_of(p, tuple(h.lower() for h in hints)) if hints else out


def clean_corpus_path(path: Column) -> Column:
    """A source file in an engine folder, outside tests, foreign code, build output and bug collections."""
    p = _path(path)
    skipped = p.rlike(r"(?:^|/)tests?/|/(?:experimental|extern|third_party|\.autopilot|_x)/|buggy|debug_pairs")
    return has_suffix(path) & ~skipped & p.rlike(r"(?:^|/)aie/|aie_|/aiesrc/|/aie_src/")


def content_candidate(code: Column, kernel: tuple[str, ...] = ("aie::", "input_buffer", "input_stream", "readincr", "window_readincr", "chess_"), graph: tuple[str, ...] = GRAPH_WORDS) -> Column:
    return any_of(F.lower(code), tuple(x.lower() for x in (*kernel, *graph)))


# ---- gates


def quality_gate(buggy: Column, correct: Column, bad_apis: tuple[str, ...], hints: tuple[str, ...]) -> Column:
    """No forbidden API on either side, no line of the buggy text that gives the bug away."""
    told = F.exists(lines(F.lower(buggy)), lambda x: any_of(x, tuple(h.lower() for h in hints)))
    return ~(any_of(buggy, bad_apis) | any_of(correct, bad_apis) | told)


def tagged(text: Column, tag: str) -> Column:
    """The inside of <tag>...</tag> without outer fences; null without the tag."""
    found = F.regexp_extract(text, rf"(?is)<{tag}>(.*?)</{tag}>", 1)
    return F.when(text.rlike(rf"(?is)<{tag}>.*?</{tag}>"), edge_fences(found))


def pair_gate(reply: Column) -> Column:
    """Reasons against a reply with <buggy> and <correct>: a part is missing, both are equal, or one is no code."""
    return once(F.struct(tagged(reply, "buggy").alias("a"), tagged(reply, "correct").alias("b")), lambda x: _pair_reasons(x["a"], x["b"]))


def _pair_reasons(a: Column, b: Column) -> Column:
    code = lambda c: c.rlike(r"[;{}]")
    there = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return F.array_compact(F.array(F.when(~there, "missing_part"), F.when(there & (a == b), "same_as_correct"), F.when(there & ~(code(a) & code(b)), "not_code")))


def mutation_gate(reply: Column, correct: Column, bad_apis: tuple[str, ...] = (), hints: tuple[str, ...] = ()) -> Column:
    """Reasons against a changed project: empty, same, no file marker, other files, or forbidden content."""
    return once(edge_fences(F.coalesce(reply, F.lit(""))), lambda new: _mutation_reasons(new, correct, bad_apis, hints))


def _mutation_reasons(new: Column, correct: Column, bad_apis: tuple[str, ...], hints: tuple[str, ...]) -> Column:
    names = lambda c: F.array_sort(F.map_keys(project_files(c)))
    marked = new.rlike(r"(?m)^\s*//\s*FILE:")
    return F.array_compact(F.array(
        F.when(new == "", "empty_reply"), F.when(new == strip(correct), "same_as_correct"), F.when((new != "") & ~marked, "missing_file_markers"),
        F.when(marked & (names(new) != names(correct)), "file_layout_changed"), F.when(~quality_gate(new, correct, bad_apis, hints), "quality"),
    ))


def project_gate(code: Column) -> Column:
    """Reasons against a generated project of a graph and its kernels (structure only), in the order of the checks; a graph file without a class is told twice."""
    graph = lambda c: F.coalesce(F.try_element_at(project_files(c), F.lit("graph.h")), F.lit(""))
    return once(code, lambda c: once(graph(c), lambda g: _project_reasons(c, g)))


def _project_reasons(code: Column, graph: Column) -> Column:
    names = F.transform(F.regexp_extract_all(code, F.lit(r"(?m)^\s*//\s*FILE:[ \t]*(\S[^\n]*)"), F.lit(1)), lambda x: F.lower(strip(x)))
    class_name = F.regexp_extract(graph, r"class\s+(\w+)\s*:\s*public\s+adf::graph", 1)
    created = F.array_distinct(F.concat(F.regexp_extract_all(graph, F.lit(r"adf::kernel::create\s*\(\s*([A-Za-z_]\w*)\s*\)"), F.lit(1)), F.regexp_extract_all(graph, F.lit(r"adf::kernel::create\s*<\s*([A-Za-z_]\w*)\s*>\s*\("), F.lit(1))))
    declared = F.regexp_extract_all(graph, F.lit(r"(?:^|\n)\s*(?:extern\s+)?void\s+([A-Za-z_]\w*)\s*\("), F.lit(1))
    instances = F.regexp_extract_all(graph, F.lit(r"\b(\w+)\s+\w+\s*;"), F.lit(1))
    window = graph.rlike(r"adf::connect\s*<\s*adf::window<") & code.rlike(r"\bvoid\s+\w+\s*\([^)]*\b(?:input_stream|output_stream)\s*<")
    stream = graph.rlike(r"adf::connect\s*<\s*adf::stream\s*>") & code.rlike(r"\bvoid\s+\w+\s*\([^)]*\b(?:input_window|output_window)\s*<")
    has_graph = graph != ""
    out = [
        F.when(F.size(names) < 2, "needs_at_least_two_files"), F.when(~F.exists(names, lambda n: F.endswith(n, F.lit("graph.h"))), "missing_graph_h"),
        F.when(~F.exists(names, lambda n: n.rlike(r"kernels/.*\.(?:cc|cpp)\z")), "missing_kernel_source_file"),
        *[F.when(~code.rlike(p), r) for r, p in PROJECT_MUST.items()],
        F.when(has_graph & (class_name == ""), "missing_graph_class").when((class_name != "") & ~F.array_contains(instances, class_name), "missing_graph_instance"),
        F.when(F.size(F.array_except(created, declared)) > 0, "missing_kernel_forward_declaration"), F.when(graph.rlike(GRAPH_STREAM), "kernel_stream_declared_in_graph_h"),
        F.when(graph.rlike("|".join(f"(?:{p})" for p in UNQUALIFIED)), "unqualified_adf_graph_symbols"), *[F.when(code.rlike(p), r) for r, p in PROJECT_MUST_NOT.items()],
        F.when(window, "window_connect_stream_signature_mismatch"), F.when(stream, "stream_connect_window_signature_mismatch"), *[F.when(~code.rlike(p), r) for r, p in KERNEL_MUST.items()],
    ]
    return F.array_compact(F.array(*out))


def fix_candidate(error_class: Column, code: Column, log: Column, file_type: Column, classes: tuple[str, ...], include: tuple[str, ...], exclude: tuple[str, ...], most_lines: int = 80) -> Column:
    """A short kernel with a wanted error class whose log has a wanted and no unwanted pattern."""
    fits = lambda patterns: log.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(True)
    return error_class.isin(*classes) & (F.size(lines(code)) <= most_lines) & (file_type == "kernel") & fits(include) & (~fits(exclude) if exclude else F.lit(True))


def dsl_only(log: Column) -> Column:
    return F.coalesce(any_of(log, DSL_ONLY), F.lit(False))


def fix_cues(bug_type: Column, buggy: Column, correct: Column) -> Column:
    """Cues that a fix touches what its bug type is about."""
    bt, b, c = F.lower(F.coalesce(bug_type, F.lit(""))), F.coalesce(buggy, F.lit("")), F.coalesce(correct, F.lit(""))
    steps = lambda x: any_of(x, ("++", "+="))
    numbers = lambda x: F.regexp_extract_all(x, F.lit(NUMBER), F.lit(0))
    streams = lambda x: F.regexp_count(x, F.lit(STREAM_USE))
    return F.array_compact(F.array(
        F.when(any_of(bt, ("missing_iterator_increment",)) & steps(c) & ~steps(b), "iterator_increment_added"),
        F.when(any_of(bt, ("subtraction_instead_of_addition",)) & any_of(c, ("+",)) & any_of(b, ("-",)), "operator_sub_to_add"),
        F.when(any_of(bt, ("addition_instead_of_subtraction",)) & any_of(c, ("-",)) & any_of(b, ("+",)), "operator_add_to_sub"),
        F.when(any_of(bt, ("loop_count", "loop_bound")) & (numbers(b) != numbers(c)), "loop_numeric_bound_changed"),
        F.when(any_of(bt, ("missing_adf_runtime_line",)) & any_of(c, ("runtime<ratio>",)) & ~any_of(b, ("runtime<ratio>",)), "runtime_ratio_added"),
        F.when(any_of(bt, ("deadlock", "unconsumed_stream", "unbalanced_tokens")) & (streams(b) != streams(c)), "stream_io_balance_changed"),
    ))


def quality_score(logical_ok: Column, verdict: Column, changed: Column) -> Column:
    worth = F.when(verdict == "logical_likely", 1.0).when(verdict == "dsl_unresolved_but_plausible", 0.5).when(verdict == "structure_only_no_compiler", 0.25).otherwise(0.0)
    return F.when(logical_ok, 1.0).otherwise(0.0) + worth + F.when(changed, 0.25).otherwise(0.0)


# ---- descriptions, as structures; wording is a matter of templates


def kernel_ports(code: Column) -> Column:
    """Parameters of the first function, without comments; null without a function."""
    params = lambda head: F.regexp_replace(F.regexp_extract(head, KERNEL_PARAMETERS, 1), r"(?d)//.*", "")
    first = if_said(code, ("void", ">::"), F.regexp_extract(code, KERNEL_PARAMETERS, 0), F.lit(""))
    return once(first, lambda head: F.when(head != "", F.transform(listed(params(head)), one_space)))


def graph_ports(code: Column) -> Column:
    """struct of port declarations (by keyword, then place) and the number of kernels that are made."""
    found = [all_said(code, (k,), rf"(?m)^[ \t]*({k}\b[^;]*;)", 1) for k in PORT_KEYWORDS]
    return F.struct(F.transform(F.concat(*found), lambda x: strip(one_space(x))).alias("declarations"), if_said(code, ("kernel::create",), F.regexp_count(code, F.lit(KERNEL_MADE)), F.lit(0)).alias("n_kernels"))


def buffers(code: Column) -> Column:
    """struct of graph dimensions (distinct), window sizes and vector lanes (distinct)."""
    of = lambda word, p: F.transform(all_said(code, (word,), p, 1), strip)
    return F.struct(F.array_distinct(of("dimensions(", DIMENSIONS)).alias("dimensions"), of("connect<window<", WINDOWS).alias("windows"), F.array_distinct(of("begin_vector<", LANES)).alias("lanes"))


def constraint_flags(code: Column, artifact_type: Column, interfaces: Column, intrinsics: Column) -> Column:
    """Names of what limits an artifact, in order; `default` if nothing does."""
    graph, has = artifact_type == "graph_type", lambda *w: any_of(code, w)
    simd = F.exists(intrinsics, lambda x: any_of(x, SIMD_WORDS))
    limits = F.array_compact(F.array(
        F.when(graph & has("connect<cascade>"), "cascade"), F.when(graph & has("location<kernel>", "bank("), "placement"), F.when(graph & has("runtime<ratio>"), "runtime_ratio"), F.when(graph & F.array_contains(interfaces, "PLIO"), "plio"),
        F.when(~graph & simd, "simd"), F.when(~graph & has("chess_prepare_for_pipelining", "chess_loop_range"), "pipelining"), F.when(~graph & F.array_contains(interfaces, "Stream"), "stream_balance"), F.when(~graph & F.array_contains(interfaces, "Window"), "window_alignment"),
    ))
    return once(limits, lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("default"))))


def limiting_intrinsics(code: Column) -> Column:
    """The intrinsics of a code for constraint_flags: each is a part of the code, so none is looked for in a code without the words that the flags hang on."""
    return if_said(code, SIMD_WORDS, intrinsics(code, F.lit(None).cast("string")), F.array().cast("array<string>"))


def worded(flags: Column, sentences: dict[str, str]) -> Column:
    """One text of the sentences of flags."""
    return F.array_join(F.transform(flags, lambda f: F.create_map(*[x for k, v in sentences.items() for x in (F.lit(k), F.lit(v))])[f]), " ")


def code_anchors(context: Column) -> Column:
    """struct of the first class, function and known identifier (null if none), and the number of lines; includes are skipped."""
    c = F.regexp_replace(context, r"(?m)^\s*#\s*include\b.*$", "")
    some = lambda p, g: F.nullif(F.regexp_extract(c, p, g), F.lit(""))
    n_lines = F.when(F.coalesce(context, F.lit("")) == "", 0).otherwise(F.regexp_count(context, F.lit("\n")) + 1)
    return F.struct(some(ANCHOR_CLASS, 1).alias("class"), some(ANCHOR_FUNCTION, 1).alias("function"), some(ANCHOR_NAME, 0).alias("identifier"), n_lines.alias("n_lines"))


def anchor_phrase(anchors: Column) -> Column:
    parts = F.array_compact(F.array(*[F.concat(F.lit(f"{k} `"), anchors[k], F.lit("`")) for k in ("function", "class", "identifier")]))
    return F.when(F.size(parts) > 0, F.concat(F.lit("Look at "), F.array_join(parts, " and "), F.lit(" in the source below. "))).otherwise("")


def clean_name(filename: Column, bug_type: Column, tokens: tuple[str, ...] = ("deadlock", "oob", "overflow", "mismatch", "missing", "wrong", "buggy", "bug")) -> Column:
    """The clean file's name: without _<bug type>, else without the first of the tokens before the suffix."""
    stem, suffix = F.regexp_extract(filename, r"(?s)\A(.*?)(\.[^.]*)?\z", 1), F.regexp_extract(filename, r"(?s)\A.*?(\.[^.]*)?\z", 1)
    ends = F.concat(F.lit("_"), bug_type)
    other = F.regexp_replace(stem, "(?i)_(?:" + "|".join(tokens) + r")\w*\z", "")
    return F.concat(F.when(bug_type.isNotNull() & F.endswith(stem, ends), F.substring(stem, F.lit(1), F.length(stem) - F.length(ends))).otherwise(other), suffix)


def comparable(code: Column) -> Column:
    """Without comments and white space, for comparison."""
    return F.regexp_replace(F.regexp_replace(code, r"(?s)//[^\n]*|/\*.*?\*/", ""), r"(?U)\s+", "")


def axes(index: Column, sizes: dict[str, int]) -> Column:
    """struct of digits of a number in mixed radix, the first axis the fastest."""
    out, rest = [], index
    for name, n in sizes.items():
        out.append((rest % n).alias(name))
        rest = F.floor(rest / n)
    return F.struct(*out)
