"""Features and predicates of source code and compiler logs, as native expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import all_said, lines, once, one_space, or_text, strip, strip_right

# Words and patterns that results depend on.
GRAPH_PATTERNS = (r"class\s+\w+\s*:\s*public\s+(?:adf::)?graph", r"\binput_plio\b", r"\boutput_plio\b", r"\bconnect<", r"\bkernel::create", r"\bdimensions\(")
RELEVANT = ("#include <adf.h>", "#include <aie_api/aie.hpp>", "input_buffer", "output_buffer", "input_window", "output_window", "input_stream", "output_stream", "kernel::create", "connect<", "class ", "aie::", "chess_prepare_for_pipelining", "window_readincr", "window_writeincr")
INTRINSICS = (r"\breadincr(?:_v\d+)?\b", r"\bwriteincr(?:_v\d+)?\b", r"\bupd_v\b", r"\bsrs\b", r"\bmul4\b", r"\bmac4\b", r"\bconnect(?:<[^>]+>)?", r"\bdimensions\b", r"\bruntime\b", r"\blocation\b", r"\bbank\b", r"\btile\b", r"\binitialization_function\b")
VECTOR_MARKERS = ("aie::vector", "aie::accum", "load_v", "store_v", "to_vector", "shuffle_")
SYSTEM_HEADERS = ("asm/", "bits/", "gnu/", "linux/", "sys/")
MISSING_HEADER = r"fatal error: '?([^\s':]+\.h(?:pp)?)'?(?::|:?\s+file not found|:?\s+No such file or directory)"
STANDARD_HEADER = r"(?i)^(?:adf|aie_api|aie|hls|ap_)"
INTERFACES = {"Window": ("input_buffer", "output_buffer", "window<", "window_"), "Stream": ("input_stream", "output_stream", "connect<stream>"), "Cascade": ("connect<cascade>",), "PLIO": ("input_plio", "output_plio", "plio_")}
SUFFIXES = (".cc", ".cpp", ".h", ".hpp")


def any_of(column: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(column, F.lit(w))
    return out


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"(?s)\A.*/", ""), r"(?<=.)\.[^.]*\z", "")


def artifact_type(code: Column, path: Column) -> Column:
    return F.when(code.rlike("|".join(f"(?:{p})" for p in GRAPH_PATTERNS)) | F.contains(F.lower(stem(path)), F.lit("graph")), "graph_type").otherwise("kernel_type")


def is_relevant(code: Column, path: Column) -> Column:
    return any_of(F.lower(code), RELEVANT) | F.lower(stem(path)).rlike("graph|kernel")


def cpp_type(column: Column) -> Column:
    """Single spaces, none inside the brackets' ends, one after a comma."""
    c = strip(one_space(column))
    c = F.regexp_replace(F.regexp_replace(c, r"\s*<\s*", "<"), r"\s*>", ">")
    return F.regexp_replace(c, r"\s*,\s*", ", ")


def _found(code: Column, pattern: str) -> Column:
    return F.regexp_extract_all(code, F.lit(pattern), F.lit(0))


def listed(header_value: Column) -> Column:
    """A header's list, cut at commas outside <> and () (one level of them)."""
    parts = F.regexp_extract_all(F.coalesce(header_value, F.lit("")), F.lit(r"(?:<[^<>]*(?:<[^<>]*>[^<>]*)*>|\([^()]*\)|[^,<(])+"), F.lit(0))
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def vector_types(code: Column, header_value: Column) -> Column:
    found = F.concat(listed(header_value), _found(code, r"aie::vector<\s*[^>]+>"), _found(code, r"aie::accum<\s*[^>]+>"), _found(code, r"\bv\d+[A-Za-z0-9_]+\b"))
    return F.array_distinct(F.transform(found, cpp_type))


def _word(pattern: str) -> str:
    """The word that a pattern of INTRINSICS begins with, so that all its matches hold it."""
    return re.match(r"\\b(\w+?)(?:\\b|\(\?:)", pattern)[1]


def intrinsics(code: Column, header_value: Column) -> Column:
    named = F.transform(all_said(code, ("aie::",), r"aie::([A-Za-z_][A-Za-z0-9_]*)", 1), lambda x: F.concat(F.lit("aie::"), x))
    return F.array_distinct(F.concat(listed(header_value), named, *[all_said(code, (_word(p),), p) for p in INTRINSICS]))


def interface_types(code: Column, header_value: Column) -> Column:
    said, text = F.lower(F.coalesce(header_value, F.lit(""))), F.lower(code)
    hits = [F.when(F.contains(said, F.lit(n.lower())), n) for n in INTERFACES] + [F.when(any_of(text, w), n) for n, w in INTERFACES.items()]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def _last_of_keys(entries: Column) -> Column:
    """map of k to the last v in an array of structs."""
    last = lambda e, keys: F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(e, lambda x: x["k"] == k), -1)["v"]))
    return once(entries, lambda e: once(F.array_distinct(F.transform(e, lambda x: x["k"])), lambda keys: last(e, keys)))


def header_fields(comment: Column) -> Column:
    """map of lower-cased KEY to value from `KEY: value` lines; the last of a key counts."""
    pairs = F.filter(F.transform(lines(comment), lambda x: F.regexp_replace(x, r"\A[\s/*]+|\s+\z", "")), lambda x: x.rlike(r"\A[A-Za-z][^:]*:"))
    entries = F.transform(pairs, lambda x: F.struct(F.lower(strip(F.regexp_extract(x, r"\A([^:]*):", 1))).alias("k"), strip(F.regexp_extract(x, r"(?s)\A[^:]*:(.*)\z", 1)).alias("v")))
    return _last_of_keys(entries)


def leading_comment(code: Column) -> Column:
    """A block comment at the start; or a run of // lines at the start, if it says SOURCE:."""
    block = F.regexp_extract(code, r"(?s)\A\s*(/\*.*?\*/)", 1)
    run = F.regexp_extract(code, r"(?s)\A\s*((?://[^\n]*(?:\n|\z)\s*)+)", 1)
    return F.when(block != "", block).when(F.contains(run, F.lit("SOURCE:")), run).otherwise("")


def body(code: Column) -> Column:
    """The code after its leading comments."""
    return F.regexp_replace(code, r"(?s)\A(?:\s*(?:/\*.*?\*/|//[^\n]*(?:\n|\z)))+\s*", "")


def repo_and_branch(text: Column) -> tuple[Column, Column]:
    """owner/repo and x of `owner/repo, branch x`."""
    return F.regexp_extract(text, r"([\w.-]+/[\w.-]+)", 1), F.regexp_extract(text, r"branch\s+([\w./-]+)", 1)


def canonical_stem(path: Column) -> Column:
    return F.regexp_replace(stem(path), r"_(?:CORRECT|BUGGY\w*)\z", "")


def source_group(repo: Column, path: Column) -> Column:
    """repo:path without _CORRECT and _BUGGY... before a dot."""
    return F.concat(or_text(repo, F.lit("local")), F.lit(":"), F.regexp_replace(path, r"_(?:CORRECT|BUGGY\w*)(?=\.)", ""))


def parent_key(repo: Column, path: Column) -> Column:
    return F.concat(or_text(repo, F.lit("local")), F.lit(":"), F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, r"/[^/]*\z", "")).otherwise("."))


# ---- fences and sections


def fence(code: Column) -> Column:
    """A code block: lines without trailing space, no blank lines at the end."""
    return F.concat(F.lit("```cpp\n"), strip_right(F.regexp_replace(code, r"(?m)[ \t\r]+$", "")), F.lit("\n```"))


def strip_whole_fence(text: Column) -> Column:
    """The inside, if the whole text is one fenced block; else the text without outer space."""
    return F.regexp_replace(strip(text), r"(?s)\A```[A-Za-z+]*\s*\n(.*?)\n?```\z", "$1")


def first_fenced(text: Column) -> Column:
    """The first fenced block's inside, null without one."""
    return F.nullif(F.regexp_extract(text, r"(?s)```[A-Za-z+]*[ \t]*\n(.*?)```", 1), F.lit(""))


def last_fenced(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"(?s)```[A-Za-z+]*[ \t]*\n(.*?)```"), F.lit(1))
    return F.try_element_at(found, F.lit(-1))


def edge_fences(text: Column) -> Column:
    """Without a first and a last line that are fences."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"\A```[^\n]*\n", ""), r"\n```\s*\z", "")


def section(context: Column, start: str, ends: tuple[str, ...]) -> Column:
    """What stands after a marker and before the next of the ends, without outer space; null without the marker."""
    stop = "|".join(rf"\Q{e}\E" for e in ends)
    found = F.regexp_extract(context, rf"(?s)\Q{start}\E[ \t]*\n?(.*?)(?:{stop}|\z)" if stop else rf"(?s)\Q{start}\E[ \t]*\n?(.*)\z", 1)
    return F.when(F.contains(context, F.lit(start)), strip(found))


def buggy_code(context: Column) -> Column:
    return section(context, "Buggy version:", ("Correct version:",))


def correct_code(context: Column) -> Column:
    return section(context, "Correct version:", ())


ERROR_SEPARATOR = "\n\n--- Error Log ---\n"


def code_and_log(context: Column) -> tuple[Column, Column]:
    """Before and after the error separator; without one, the text and ''."""
    at = F.instr(context, ERROR_SEPARATOR)
    loose = F.regexp_instr(context, F.lit(r"\n?-{2,}\s*Error Log\s*-{2,}\n?"))
    exact = F.substring(context, F.lit(1), F.greatest(at - 1, F.lit(0))), F.substring(context, at + len(ERROR_SEPARATOR), F.length(context))
    parts = F.split(context, r"\n?-{2,}\s*Error Log\s*-{2,}\n?", 2)
    return F.when(at > 0, exact[0]).when(loose > 0, parts[0]).otherwise(context), F.when(at > 0, exact[1]).when(loose > 0, F.try_element_at(parts, F.lit(2))).otherwise("")


def without_hints(code: Column) -> Column:
    """Without // case:, // intent:, // BUG and // ORIGINAL: lines."""
    return F.regexp_replace(code, r"(?mid)^[ \t]*//\s*(?:case:|intent:|BUG|ORIGINAL:)[^\n]*(?:\n|\z)", "")


def project_files(text: Column) -> Column:
    """map of path to body for `// FILE: path` sections; a repeated path keeps its last body."""
    cut = F.split(F.concat(F.lit("\n"), text), r"\n[ \t]*//\s*FILE:[ \t]*", -1)
    parts = F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0)))
    entry = F.transform(parts, lambda x: F.struct(strip(F.regexp_extract(x, r"\A([^\n]*)", 1)).alias("k"), strip(F.regexp_replace(x, r"\A[^\n]*\n?", "")).alias("v")))
    return _last_of_keys(entry)


# ---- logs


def missing_headers(log: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(log, F.lit("")), F.lit(MISSING_HEADER), F.lit(1))
    unsafe = lambda h: F.startswith(h, F.lit("/")) | F.contains(F.replace(h, F.lit("\\"), F.lit("/")), F.lit(".."))
    system = lambda h: h.rlike("^(?:" + "|".join(SYSTEM_HEADERS) + ")")
    return F.array_distinct(F.filter(found, lambda h: ~unsafe(h) & ~system(h) & (h != "")))


def error_class(log: Column, scalar_types: tuple[str, ...] = ("int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "cint16", "cint32", "cfloat", "bfloat16", "acc48", "acc80")) -> Column:
    missing = F.regexp_extract(log, MISSING_HEADER, 1)
    undeclared = F.regexp_replace(F.regexp_extract(log, r"use of undeclared identifier '([^']+)'", 1), r"v\d+$", "")
    return (
        F.when(log.isNull() | (log == ""), "ok").when((missing != "") & ~missing.rlike(STANDARD_HEADER), "missing_dependency")
        .when(undeclared.isin(*scalar_types), "missing_aie_types").when(log.rlike("no member named '[^']+' in namespace 'aie'"), "aie_api_compile_error").otherwise("compile_error")
    )


def first_error_line(log: Column) -> Column:
    kept = F.filter(F.transform(lines(log), strip), lambda x: x != "")
    return F.coalesce(F.get(F.filter(kept, lambda x: F.contains(x, F.lit("error:"))), F.lit(0)), F.get(kept, F.lit(0)), F.lit(""))


def told_lines(log: Column) -> Column:
    """The lines that are not blank."""
    return F.filter(lines(log), lambda x: x.rlike(r"(?U)[^\s\x1c-\x1f]"))


def error_lines(log: Column, most: int = 8) -> Column:
    """Lines with error words, `most` of them; else the first lines. Only those that stay are trimmed."""
    kept = told_lines(log)
    joined = lambda x: F.array_join(F.transform(F.slice(x, 1, most), strip_right), "\n")
    hits = F.filter(kept, lambda x: x.rlike(r"(?i)\b(?:error|fatal|undefined|undeclared)\b"))
    return F.coalesce(F.nullif(joined(hits), F.lit("")), joined(kept))


def error_excerpt(log: Column, most_lines: int = 12, most_chars: int = 1500) -> Column:
    """Without include chains and notes; at most so many lines and characters."""
    kept = F.filter(F.transform(lines(log), strip_right), lambda x: (strip(x) != "") & ~x.rlike(r"^\s*(?:In file included from|from )") & ~F.contains(x, F.lit("note:")))
    return F.substring(F.array_join(F.slice(kept, 1, most_lines), "\n"), 1, most_chars)


def coarse_cause(compile_ok: Column, label: Column, text: Column, return_code: Column) -> Column:
    """A named cause, by the first rule that holds."""
    has = lambda *words: any_of(text, words)
    return (
        F.when(F.coalesce(compile_ok, F.lit(False)), "ok")
        .when(label.isin("missing_dependency", "missing_dependency_after_stub"), "missing project/local header")
        .when(has("No such device") & ~text.rlike("error:|fatal error:"), "toolchain/device failure")
        .when(has("TIMEOUT") | (return_code == -9), "timeout")
        .when(has("no member named") & has("namespace 'aie'"), "invalid/unsupported AIE API call")
        .when(has("no matching function for call"), "invalid API signature/types")
        .when(has("undeclared identifier", "was not declared"), "missing symbol/context")
        .when(has("undefined template", "constraints not satisfied"), "unsupported vector/accum type or lane count")
        .when(label == "aie_api_compile_error", "invalid/unsupported AIE API call")
        .when(label == "compile_error", "general compile error").otherwise(or_text(label, F.lit("<missing>")))
    )


# ---- predicates


def balanced(code: Column) -> Column:
    """Whether (), [] and {} nest; an empty or null text does not count as balanced.

    Brackets only, innermost pairs removed again and again: each pass is one regex, and
    passes stop changing the text when depth is used up.
    """
    left = F.regexp_replace(F.coalesce(code, F.lit("")), r"[^()\[\]{}]+", "")
    step = lambda acc, _: F.when(acc.rlike(r"\(\)|\[\]|\{\}"), F.regexp_replace(acc, r"(?:\(\)|\[\]|\{\})+", "")).otherwise(acc)
    passes = F.sequence(F.lit(1), F.greatest(F.lit(1), (F.length(left) / 2).cast("int")))
    return (F.coalesce(code, F.lit("")) != "") & (F.aggregate(passes, left, step) == "")


def whole_code_reasons(buggy: Column, correct: Column, least: int = 80) -> Column:
    """Why a pair is no whole code; an empty list keeps it."""
    out = []
    for name, c in (("buggy", buggy), ("correct", correct)):
        there = F.coalesce(c, F.lit("")) != ""
        out += [F.when(~there, f"missing_{name}"), F.when(there & (F.length(c) < least), f"{name}_too_short"), F.when(there & ~balanced(c), f"{name}_unbalanced_delimiters"), F.when(there & F.contains(c, F.lit("...existing code...")), f"{name}_placeholder_text")]
    order = [0, 4, 1, 5, 2, 6, 3, 7]
    return F.array_compact(F.array(*[out[i] for i in order]))


def vector_sizes_disjoint(code: Column, log: Column, in_code: str = r"vector<\s*\w+\s*,\s*(\d+)", in_log: str = r"vector<\s*\w+\s*,\s*(\d+)") -> Column:
    a, b = F.regexp_extract_all(code, F.lit(in_code), F.lit(1)), F.regexp_extract_all(log, F.lit(in_log), F.lit(1))
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def is_scalar_code(code: Column) -> Column:
    return ~any_of(code, VECTOR_MARKERS)


def api_mismatch(code: Column, log: Column, names: tuple[str, ...]) -> Column:
    """Whether the log names at least two of the APIs and the code has none of those."""
    said = F.array_compact(F.array(*[F.when(log.rlike(rf"\b\Q{n}\E\b"), n) for n in names]))
    used = F.array_compact(F.array(*[F.when(code.rlike(rf"\b\Q{n}\E\b"), n) for n in names]))
    return (F.size(said) >= 2) & ~F.arrays_overlap(said, used)


def clean_log(log: Column) -> Column:
    """Without blank lines and template internals; a stock line if nothing is left."""
    kept = F.filter(F.transform(lines(log), strip_right), lambda x: (strip(x) != "") & ~any_of(x, ("native_vector_type<", "vector_storage<")))
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n")).otherwise("Compile error: AIE vector type instantiation failed.")


def stock_log(log: Column) -> Column:
    """One line from the first line that says error; a stock line without one."""
    hit = F.get(F.filter(F.transform(lines(log), strip_right), lambda x: x.rlike(r"(?i)\berror\b")), F.lit(0))
    said = strip(F.regexp_replace(hit, r"\A.*?:\d+:\d+:\s*error:\s*", ""))
    return F.when(F.coalesce(said, F.lit("")) != "", F.concat(F.lit("Compile error: "), said)).otherwise("Compile error: AIE compilation failed for this source.")


#: Words of a slug that say nothing about its topic.
TOPIC_STOP = tuple(
    dict.fromkeys(
        """a an the of in on at to for from is are has have be by as or and with not no do does vs via per its it where when that this which than after before
        between due used using can would but only each all one two both same wrong incorrect missing wrong bad causes cause caused into out too instead because already never then
        does did should also over under up down so more less if even just gets gets""".split()
    )
)


def topic_tokens(slug: Column) -> Column:
    """The words of a slug that say what it is about, each once, in their order."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(slug), F.lit("[a-z][a-z0-9]*"), F.lit(0)))
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*TOPIC_STOP))


def topic_hits(code: Column, slug: Column) -> Column:
    """How many of a slug's words the code has; a row without any is off topic."""
    return F.size(F.filter(topic_tokens(slug), lambda w: F.contains(F.lower(code), w)))


def has_diff_format(context: Column, response: Column) -> Column:
    return F.contains(context, F.lit("--- Error Log ---")) & F.startswith(response, F.lit("--- a/aie_source\n+++ b/aie_source\n"))
