"""What artifacts are for, where they come from, and answers about them, as native expressions.

Sentences of answers are templates: dictionaries that a caller may replace. Null texts give
what an empty text gives unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions import screens as S
from tidewater.functions.code import any_of, stem
from tidewater.functions.text import once, one_space, or_text, strip

# Labels that results depend on, with the words of the file name or path (and of the code) that give them, the first that fits.
OPERATIONS = (
    ("Peak detection and derived feature generation: compute a vector maximum, compute a vector minimum, scale each lane by PI, and emit both pass-through data and transformed floating-point output.", ("peak_detect",), ()),
    ("Threshold-based scaling: consume a floating-point vector and a scalar stream, then scale the vector by either 1 or 2 depending on the streamed maximum value.", ("upscale",), ()),
    ("Vector rearrangement: broadcast a scalar control value from a stream and use shuffle_up_fill to inject that value into an int32 vector stream.", ("data_shuffle",), ()),
    ("Finite impulse response filtering using complex multiply-accumulate across streamed samples and tap coefficients.", ("fir",), ("fir",)),
    ("Beamforming accumulation across multiple antenna or layer streams using cascaded kernels and complex MAC operations.", ("beamforming",), ("bfcascadechain", "bf8x8")),
    ("ADF graph orchestration that wires kernels, interfaces, and buffer dimensions into a complete AIE dataflow pipeline.", ("graph", "converter"), ()),
)
OTHER_OPERATION = "AIE dataflow computation over vectorized kernels and graph connections."
DOMAINS = (
    ("Debug / AIE", ("debug",)),
    ("DSP — Beamforming", ("beamform",)),
    ("DSP — FIR / Filtering", ("fir", "filter")),
    ("DSP — FFT / Channelizer", ("fft", "channelizer")),
    ("Matrix Operations / Linear Algebra", ("gemm", "blas", "matmul")),
    ("Packet Switching / Dataflow", ("packet",)),
    ("GMIO / Data Movement", ("gmio",)),
    ("Runtime Parameter Reconfiguration", ("rtp",)),
    ("Simulation / N-Body", ("n-body",)),
    ("DSP — Soft Demodulation", ("softdemod",)),
    ("Vision / Imaging", ("vision", "resize", "filter2d")),
    ("Scientific Computing", ("registration", "phylogenetic")),
)
OTHER_DOMAIN = "AIE Source"
HEADER_INTERFACES = {
    "Window": ("input_buffer", "output_buffer", "input_window", "output_window", "connect<window"),
    "Stream": ("input_stream", "output_stream", "connect<stream>"),
    "Cascade": ("connect<cascade>", "input_cascade", "output_cascade"),
    "PLIO/GMIO": ("input_plio", "output_plio", "plio_", "input_gmio", "output_gmio"),
}
HEADER_INTRINSICS = (
    r"aie::[A-Za-z_][A-Za-z0-9_]*", r"\breadincr(?:_v\d+)?\b", r"\bwriteincr(?:_v\d+)?\b", r"\bwindow_readincr(?:_v<\d+>)?\b", r"\bwindow_writeincr\b", r"\bmul4\b", r"\bmac4\b", r"\bupd_v\b", r"\bsrs\b",
    r"\bconnect(?:<[^>]+>)?\b", r"\bdimensions\b", r"\bruntime\b", r"\blocation\b", r"\bbank\b", r"\btile\b", r"\bwindow_acquire\b", r"\bwindow_release\b",
)
HEADER_VECTORS = (r"aie::vector<\s*[^>]+>", r"aie::accum<\s*[^>]+>", r"\bv\d+[A-Za-z0-9_]+\b")
SYNTHETIC_REPO, SYNTHETIC_PATH, SYNTHETIC_CATEGORY, REAL_PATH = "synthetic_taxonomy:", "synthetic/", "synthetic_taxonomy", "aie_dataset/"

#: Templates of answers; a name in braces is a part that the functions fill in.
ANSWERS = {
    "summary": "Summary: {purpose}.\n\nArtifact classification: {kind}. {ports}\n\nInterfaces: {interfaces}.\nVector types: {vectors}.\nIntrinsics and AIE APIs: {intrinsics}.\n\nBuffer requirements: {buffers}\n\nMathematical or architectural role: {operation}\n\nAIE-specific constraints: {limits}",
    "feature": "Classification: {kind}. {ports}\n\nInterfaces: {interfaces}.\nVector types: {vectors}.\nAIE intrinsics and APIs: {intrinsics}.\nPrimary operation: {operation}",
    "dataflow": "Dataflow role: {operation}\n\nI/O structure: {ports}\n\nBuffering and transfer requirements: {buffers}\n\nDeployment constraints: {limits}",
}
LIMITS = {
    "cascade": "Cascade neighbours must sit on adjacent tiles.", "placement": "Fixed locations and banks must be free.", "runtime_ratio": "Runtime ratios of kernels on one tile must fit together.", "plio": "Port widths must suit the fabric side.",
    "simd": "Lane counts must suit the vector unit.", "pipelining": "Loop hints must stay true.", "stream_balance": "Reads and writes of streams must balance.", "window_alignment": "Window sizes must divide into whole vectors.", "default": "No particular limits are visible.",
}
DEBUG_STEPS = {
    "typed": "1. The declared failure is `{bug}`: find the assumption it breaks.", "untyped": "1. Find the first assumption that the interfaces and loops rest on.",
    "Stream": "2. Count reads and writes on each stream edge; the first that is missing blocks its neighbours.", "Window": "2. Compare window extents, strides and trip counts; the first that differs moves the access boundary.", "": "2. Compare the declared interfaces with the schedule; the first that differs shows where data moves.",
    "graph_type": "3. In the graph, unequal dimensions, ratios or connections build up until a kernel starves or tokens queue.", "kernel_type": "3. In the kernel, unequal widths, accumulators or iterators distort lanes before anything is written.",
    "end": "4. What is seen outside is {symptom}, as nothing on the way absorbs it.", "symptom": "stalls, deadlock, corrupted outputs, or memory faults",
}


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = otherwise
    for test, value in reversed(cases):
        out = F.when(test, value).otherwise(out)
    return out


def math_operation(path: Column, code: Column) -> Column:
    """What an artifact computes: the first operation named in its file name, or in its code where that counts."""
    name, text = F.lower(stem(path)), F.lower(F.coalesce(code, F.lit("")))
    return _first([(any_of(name, words) | any_of(text, said), F.lit(label)) for label, words, said in OPERATIONS], F.lit(OTHER_OPERATION))


#: What stands for a list without entries.
NONE_FOUND = {"interfaces": "No explicit interface type detected", "vectors": "No explicit vector types detected", "intrinsics": "No explicit AIE intrinsics detected"}


def _listed(values: Column, none: str, most: int | None = None) -> Column:
    some = F.slice(values, 1, most) if most else values
    return once(some, lambda v: F.when(F.size(v) > 0, F.array_join(v, ", ")).otherwise(none))


def purpose(artifact_type: Column, interfaces: Column, vector_types: Column, operation: Column) -> Column:
    """One sentence without its stop."""
    kind = F.when(artifact_type == "graph_type", "ADF graph").otherwise("AIE kernel")
    return F.concat(F.lit("This "), kind, F.lit(" uses "), _listed(interfaces, "AIE interfaces"), F.lit(" interfaces and "), _listed(vector_types, "scalar and vector AIE data types", 3), F.lit(" to implement "), F.regexp_replace(operation, r"\.+\z", ""))


def ports_text(code: Column, artifact_type: Column) -> Column:
    graph, kernel = S.graph_ports(code), S.kernel_ports(code)
    of_graph = F.concat(F.lit("Ports: "), _listed(graph["declarations"], "none"), F.lit("; kernels made: "), graph["n_kernels"].cast("string"), F.lit("."))
    return F.when(artifact_type == "graph_type", of_graph).otherwise(F.concat(F.lit("Parameters: "), _listed(F.coalesce(kernel, F.array().cast("array<string>")), "none"), F.lit(".")))


def buffers_text(code: Column) -> Column:
    b = S.buffers(code)
    part = lambda title, c: F.concat(F.lit(f"{title} "), _listed(c, "none"))
    return F.concat(part("Dimensions:", b["dimensions"]), F.lit("; "), part("window sizes:", b["windows"]), F.lit("; "), part("vector lanes:", b["lanes"]), F.lit("."))


def _filled(template: str, parts: dict[str, Column]) -> Column:
    pieces: list[Column] = []
    for chunk in template.replace("}", "{").split("{"):
        pieces.append(parts[chunk] if len(pieces) % 2 else F.lit(chunk))
    return F.concat(*pieces)


def answers(code: Column, artifact_type: Column, interfaces: Column, vector_types: Column, intrinsics: Column, operation: Column, templates: dict[str, str] | None = None, limits: dict[str, str] | None = None) -> Column:
    """struct of one answer for each template, from an artifact's features."""
    parts = {
        "purpose": purpose(artifact_type, interfaces, vector_types, operation), "kind": F.when(artifact_type == "graph_type", "ADF graph").otherwise("AIE kernel"), "ports": ports_text(code, artifact_type),
        "interfaces": _listed(interfaces, NONE_FOUND["interfaces"]), "vectors": _listed(vector_types, NONE_FOUND["vectors"]), "intrinsics": _listed(intrinsics, NONE_FOUND["intrinsics"], 12),
        "buffers": buffers_text(code), "operation": operation, "limits": S.worded(S.constraint_flags(code, artifact_type, interfaces, intrinsics), limits or LIMITS),
    }
    said = F.struct(*[v.alias(k) for k, v in parts.items()])
    return once(said, lambda x: F.struct(*[_filled(t, {k: x[k] for k in parts}).alias(name) for name, t in (templates or ANSWERS).items()]))


def debug_answer(artifact_type: Column, interfaces: Column, bug_type: Column, symptom: Column, steps: dict[str, str] = DEBUG_STEPS) -> Column:
    """Four steps from the broken assumption to what is seen; streams count before windows."""
    known = F.nullif(bug_type, F.lit(""))
    first = F.when(known.isNull(), steps["untyped"]).otherwise(_filled(steps["typed"], {"bug": F.coalesce(known, F.lit(""))}))
    second = F.when(F.array_contains(interfaces, "Stream"), steps["Stream"]).when(F.array_contains(interfaces, "Window"), steps["Window"]).otherwise(steps[""])
    third = F.when(artifact_type == "graph_type", steps["graph_type"]).otherwise(steps["kernel_type"])
    return F.concat_ws("\n", first, second, third, _filled(steps["end"], {"symptom": or_text(symptom, F.lit(steps["symptom"]))}))


# ---- provenance


def human_label(label: Column, bug_type: Column) -> Column:
    """A bug's label, else its type, in words; `bug` where both are missing."""
    some = F.coalesce(F.nullif(label, F.lit("")), F.nullif(bug_type, F.lit("")), F.lit("bug"))
    return one_space(strip(F.replace(some, F.lit("_"), F.lit(" "))))


def is_real(source: Column, repo: Column, source_path: Column, relative_path: Column, category: Column, seed_folders: tuple[str, ...] = ()) -> Column:
    """Whether a row comes from real code: never a synthetic one; a web source, or a path in the data set or a seed folder."""
    text = lambda c: F.coalesce(c, F.lit(""))
    made = F.startswith(text(repo), F.lit(SYNTHETIC_REPO)) | F.startswith(text(source_path), F.lit(SYNTHETIC_PATH)) | F.startswith(text(source), F.lit(SYNTHETIC_PATH)) | (text(category) == SYNTHETIC_CATEGORY)
    web = text(source).rlike(r"\Ahttps?://")
    inside = F.startswith(text(source_path), F.lit(REAL_PATH)) | F.startswith(text(relative_path), F.lit(REAL_PATH))
    for folder in seed_folders:
        inside = inside | F.startswith(text(relative_path), F.lit(f"{folder}/"))
    return ~made & (web | inside)


def domain(path: Column) -> Column:
    name = F.lower(path)
    return _first([(any_of(name, words), F.lit(label)) for label, words in DOMAINS], F.lit(OTHER_DOMAIN))


def header_interfaces(code: Column) -> Column:
    """Interfaces of a file as its header names them, `Unknown` without any."""
    return F.coalesce(F.nullif(F.array_join(S.labels(code, HEADER_INTERFACES), ", "), F.lit("")), F.lit("Unknown"))


def _header_list(code: Column, patterns: tuple[str, ...], most: int, spaces: bool) -> Column:
    found = F.concat(*[F.regexp_extract_all(code, F.lit(p), F.lit(0)) for p in patterns])
    found = F.array_distinct(found if spaces else F.transform(found, lambda x: F.regexp_replace(x, r"\s+", "")))
    return _listed(found, "Unknown", most)


def source_header(owner: Column, repo: Column, ref: Column, path: Column, code: Column) -> Column:
    """The comment that goes before a downloaded file: where it is from and what it uses."""
    said = [
        ("SOURCE", F.concat(owner, F.lit("/"), repo, F.lit(", branch "), ref)), ("PATH", path), ("DOMAIN", domain(path)), ("INTERFACE", header_interfaces(code)),
        ("KEY INTRINSICS", _header_list(code, HEADER_INTRINSICS, 12, True)), ("VECTOR TYPES", _header_list(code, HEADER_VECTORS, 10, False)),
    ]
    return F.concat(F.lit("/*\n"), *[x for k, v in said for x in (F.lit(f"{k}: "), v, F.lit("\n"))], F.lit("*/\n\n"))


def blob_url(repo: Column, branch: Column, path: Column) -> Column:
    """Null unless all three are known."""
    known = [F.nullif(c, F.lit("")) for c in (repo, branch, path)]
    return F.concat(F.lit("https://github.com/"), known[0], F.lit("/blob/"), known[1], F.lit("/"), known[2])
