"""Row generators and the staged data-set builds, on tables in and tables out.

The builds take everything that varies (templates, weights, quotas, shares) as parameters.
Selection works on slim keys; texts are joined back last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions import diffs
from tidewater.functions.text import choose, content_hash, fingerprint, hex_mod, or_text, row_key, slug
from tidewater.operators import merge, patterns, product, selection
from tidewater.operators.lineage import held, settle

# Shares and caps that results depend on.
TIER_SHARES = {"easy": 0.20, "normal": 0.30, "medium": 0.25, "hard": 0.15, "extra_hard": 0.10}
POOLS = {"easy": [("none", 6), ("human", 3), ("symptom", 1)], "normal": [("none", 4), ("symptom", 4), ("human", 2)], "medium": [("none", 4), ("symptom", 4), ("human", 2)], "hard": [("none", 5), ("symptom", 4), ("human", 1)], "extra_hard": [("none", 6), ("symptom", 3), ("human", 1)]}
BUG_SHARE, MOST_PER_BUG_TYPE, MOST_PER_SOURCE_GROUP, REPO_SHARE = 0.80, 1200, 22, 0.15


def file_info(files: DataFrame) -> DataFrame:
    """Features of (path, repo, code): comments split off, types, interfaces, groups; one row of each content, the first path."""
    head = C.leading_comment(F.col("code"))
    d = files.withColumn("header", C.header_fields(head)).withColumn("context", C.body(F.col("code")))
    d = d.withColumn("artifact_type", C.artifact_type(F.col("context"), F.col("path")))
    d = d.where(C.is_relevant(F.col("context"), F.col("path")))
    named = lambda key: F.try_element_at("header", F.lit(key))
    d = d.select(
        "path", "repo", "context", "artifact_type", named("bug type").alias("bug_type"), named("symptom").alias("symptom"),
        C.vector_types(F.col("context"), named("vector types")).alias("vector_types"), C.intrinsics(F.col("context"), named("key intrinsics")).alias("intrinsics"),
        C.interface_types(F.col("context"), named("interface")).alias("interfaces"), C.source_group(F.col("repo"), F.col("path")).alias("source_group"),
        C.parent_key(F.col("repo"), F.col("path")).alias("parent_key"), C.canonical_stem(F.col("path")).alias("stem"), F.sha2("context", 256).alias("content"),
    )
    return selection.first_of(d, ["content"], ["repo", "path"]).withColumn("split", selection.split_fifth(F.col("source_group")))


def variants(info: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """A row for each file and variant, its instruction chosen by the hash of path and variant."""
    options = F.array(*[F.struct(F.lit(v).alias("variant"), choose(F.concat(F.col("path"), F.lit(f":{v}")), t).alias("instruction")) for v, t in templates.items()])
    return info.withColumn("__v", F.explode(options)).select(*info.columns, "__v.variant", "__v.instruction")


def tier_of(slug_: Column, known: Column, rules: list[tuple[str, tuple[str, ...]]]) -> Column:
    """The known tier; else the first rule with a word in the slug; else medium; normal without a slug."""
    out = F.when(slug_.isNull(), "normal").when(known.isNotNull(), known)
    for tier, words in rules:
        out = out.when(C.any_of(slug_, words), tier)
    return out.otherwise("medium")


def canonical_bug_type(df: DataFrame, column: str, taxonomy: DataFrame) -> DataFrame:
    """df with bug_slug: the slug of an equal label, else the slug it already is, else one made of it."""
    labels = selection.first_of(taxonomy.select(F.lower("label").alias("__label"), F.col("slug").alias("__of_label")), ["__label"], ["__of_label"])
    slugs = taxonomy.select(F.col("slug").alias("__slug")).distinct()
    d = df.join(labels, F.lower(F.col(column)) == F.col("__label"), "left").join(slugs, F.col(column) == F.col("__slug"), "left")
    return d.withColumn("bug_slug", F.coalesce("__of_label", "__slug", slug(F.col(column)))).drop("__label", "__of_label", "__slug")


def pair_rows(pairs: DataFrame, instruction: Column) -> DataFrame:
    """Instruction rows of (buggy, correct, bug_type, ...): the buggy text as context, the fenced correct one as response; equal pairs are left out."""
    d = pairs.where(F.col("buggy").isNotNull() & F.col("correct").isNotNull() & (F.col("buggy") != F.col("correct")))
    return d.withColumn("instruction", instruction).withColumn("context", F.concat(F.lit("Buggy version:\n"), "buggy")).withColumn("response", C.fence(F.col("correct")))


def quota_rows(pool: DataFrame, slug_: str, quota: str, order: list[str], ok: Column) -> DataFrame:
    """The first `quota` successes of each slug from a bounded pool that was tried beforehand."""
    return selection.ranked(pool.where(ok), [slug_], order, "__k").where(F.col("__k") <= F.col(quota)).drop("__k")


#: Variants that are about bugs whatever their bug_type, and that of taxonomy rows.
BUG_VARIANTS, TAXONOMY_VARIANT = ("causal_debugging", "bug_fix_pair", "multi_file_bug_fix_pair"), "synthetic_taxonomy_bug_fix"


def bug_focused(variant: Column, bug_type: Column) -> Column:
    """Whether a row is about a bug: it has a bug type, or its variant says so."""
    v = F.coalesce(variant, F.lit(""))
    return (F.coalesce(bug_type, F.lit("")) != "") | v.isin(*BUG_VARIANTS) | F.contains(v, F.lit("debug"))


def balanced_rows(rows: DataFrame, tiers: dict[str, float] = TIER_SHARES, bug_share: float = BUG_SHARE, most_type: int = MOST_PER_BUG_TYPE, most_group: int = MOST_PER_SOURCE_GROUP, repo_share: float = REPO_SHARE) -> DataFrame:
    """Ids that stay of (id, key, context, variant, bug_type, source_group, repo, tier, split).

    In each split bugs are diversified (caps of a split count its rows alone) and other rows cut
    to the share; then bugs are cut to their tiers' shares, and all rows to the repositories'.
    Taxonomy rows of different bug types never count as equal. Missing bug types and groups are
    `unknown`, missing tiers `normal`, missing repositories `local`, missing splits `train`.
    """
    named = lambda c, v: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)).alias(c)
    kind = F.coalesce(F.nullif("bug_type", F.lit("")), F.lit("unknown"))
    text = F.when(F.col("variant") == TAXONOMY_VARIANT, F.concat(F.lit("synth:"), kind, F.lit("::"), "context")).otherwise(F.col("context"))
    slim = rows.select(
        "id", "key", bug_focused(F.col("variant"), F.col("bug_type")).alias("bug"), named("bug_type", "unknown"), named("source_group", "unknown"),
        F.coalesce("repo", F.lit("local")).alias("repo"), named("tier", "normal"), F.coalesce("split", F.lit("train")).alias("split"), fingerprint(text).alias("print"),
    )
    slim = settle(slim)
    in_split = lambda c: F.concat_ws("\x01", "split", c).alias(c)
    bugs = slim.where("bug").select("id", "key", in_split("print"), in_split("bug_type"), in_split("source_group"))
    kept = selection.greedy_caps(bugs, "id", "print", "bug_type", "source_group", ["key", "id"], most_type, most_group).withColumn("kept", F.lit(True))
    d = slim.drop("print").join(kept, "id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    d = settle(selection.rebalance(settle(d), "bug", "kept", "split", "source_group", "key", bug_share))
    bugs = d.where("bug")
    if n_bugs := bugs.count():
        capped = bugs.where(F.col("tier").isin(*tiers))
        d = d.where(F.coalesce(~F.col("bug") | ~F.col("tier").isin(*tiers), F.lit(True))).unionByName(selection.round_robin(capped, "tier", "bug_type", ["key", "id"], tiers, total=n_bugs))
    return selection.cap_share(d, ["repo"], ["key", "id"], repo_share).select("id")


def keyed(rows: DataFrame) -> DataFrame:
    """rows with `key`, the hash that orders them."""
    return rows.withColumn("key", row_key(F.col("instruction"), F.col("variant"), F.col("source"), F.col("bug_type")))


# ---- v4: validated rows


def verified_rows(rows: DataFrame, results: DataFrame, replacements: DataFrame, negatives_per_type: int = 80) -> DataFrame:
    """Rows with v4_bucket from (path, row_index, group_id, instruction, context, response, bug_type, compile_ok of results).

    compile_proven: rows whose result is ok; validated_replacement: replaced rows; real_negative:
    other rows, so many of each bug type (rows without one are dropped by the cap); equal
    triples count once, in this order; the split is by group.
    """
    met = merge.first_hit(rows, results, "path", "input_path", "row_index")
    proven = met.where("result_compile_ok").select(*rows.columns).withColumn("v4_bucket", F.lit("compile_proven")).withColumn("__rank", F.lit(0))
    new = replacements.select(*rows.columns).withColumn("v4_bucket", F.lit("validated_replacement")).withColumn("__rank", F.lit(1))
    keys = ["group_id", "instruction", "context"]
    other = merge.without(met.where(~F.coalesce("result_compile_ok", F.lit(False))).select(*rows.columns), proven.unionByName(new).select(*keys), keys)
    negative = selection.first_n(other.where("bug_type is not null"), ["bug_type"], ["path", "row_index"], negatives_per_type).withColumn("v4_bucket", F.lit("real_negative")).withColumn("__rank", F.lit(2))
    d = proven.unionByName(new).unionByName(negative)
    d = selection.first_of(d, ["instruction", "context", "response"], ["__rank", "path", "row_index"]).drop("__rank")
    return d.withColumn("split", selection.split_percent(F.col("group_id")))


def accepted_mutations(log: DataFrame) -> DataFrame:
    """The last accepted mutation of each source."""
    return selection.last_of(log.where(F.coalesce("parse_ok", F.lit(False)) & F.coalesce("quality_ok", F.lit(False)) & (F.col("buggy") != F.col("correct"))), ["source_id"], ["at"])


def audit_flags(audits: DataFrame) -> DataFrame:
    """(row_id, present, confidence, error) of raw verdicts: JSON booleans only; what cannot be read is null."""
    v = F.from_json(C.strip_whole_fence(F.col("raw_verdict")), "bug_present boolean, confidence string, explanation string")
    return audits.select("row_id", v["bug_present"].alias("present"), or_text(v["confidence"], F.lit("unknown")).alias("confidence"), F.coalesce(F.col("error"), F.lit(False)).alias("error"))


# ---- v5: compile failures to diffs


def v5_rows(failures: DataFrame, instructions: list[str], percent: int = 13) -> DataFrame:
    """Rows of (source_id, buggy, correct, log): code and log as context, a unified diff as response; the split is stored in the row."""
    d = held(failures.where("buggy <> correct"), response=diffs.unified_diff("buggy", "correct"))
    d = d.withColumn("context", F.concat("buggy", F.lit(C.ERROR_SEPARATOR), C.error_lines(F.col("log"))))
    at = hex_mod(F.col("source_id"), 8, len(instructions)).cast("int")
    d = d.withColumn("instruction", F.element_at(F.array(*[F.lit(i) for i in instructions]), at + 1))
    return d.where(C.has_diff_format(F.col("context"), F.col("response"))).withColumn("split", selection.split_hex_id(F.col("source_id"), percent)).withColumn("v5_bucket", F.lit("compile_failure"))


def sanitized(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows with logs cleaned: template internals dropped from scalar code, logs that cannot be about the code made generic."""
    code, log = C.code_and_log(F.replace(F.col("context"), F.lit("\\n"), F.lit("\n")))
    d = rows.withColumn("__code", code).withColumn("__log", log)
    c, g = F.col("__code"), F.col("__log")
    new = F.when(C.api_mismatch(c, g, names) | C.vector_sizes_disjoint(c, g), C.stock_log(g)).when(C.is_scalar_code(c), C.clean_log(g)).otherwise(g)
    return d.withColumn("context", F.when(g == "", F.col("context")).otherwise(F.concat(c, F.lit(C.ERROR_SEPARATOR), new))).drop("__code", "__log")


def screened(pairs: DataFrame) -> DataFrame:
    """Pairs with similarity and band: equal, unrelated (< 0.50), distant (< 0.75), close."""
    d = pairs.withColumn("similarity", diffs.similarity_ratio("buggy", "correct"))
    return d.withColumn("band", F.when(F.col("buggy").eqNullSafe(F.col("correct")), "equal").when(F.col("similarity") < 0.50, "unrelated").when(F.col("similarity") < 0.75, "distant").otherwise("close"))


def new_sources(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files of unknown content, one each, by the hash of the text with \\n line ends."""
    d = files.withColumn("content", content_hash(F.col("code")))
    return selection.first_of(merge.without(d, seen, "content"), ["content"], ["source_rank", "path"])


# ---- synthetic sources


def spec_grid(patterns: DataFrame, types: DataFrame, interfaces: DataFrame, levels: DataFrame, counts: dict[str, DataFrame], limit: int) -> DataFrame:
    return product.coverage_grid({"pattern": patterns, "type": types, "interface": interfaces, "complexity": levels}, counts, limit)


def render_kernel(specs: DataFrame) -> DataFrame:
    """specs with filename and code of a kernel: a signature for the interface, a body for the pattern."""
    lanes = F.when(F.col("type").isin("int8", "uint8"), 32).when(F.col("type").isin("int16", "bfloat16", "cint16"), 16).otherwise(8)
    name = F.concat_ws("_", F.lit("syn"), slug(F.col("pattern")), slug(F.col("type")), slug(F.col("interface")), slug(F.col("complexity")))
    stream = F.lower("interface").rlike("stream|cascade")
    port = lambda way: F.when(stream, F.concat(F.lit(f"{way}_stream<"), "type", F.lit(">* __restrict "))).otherwise(F.concat(F.lit(f"adf::{way}_buffer<"), "type", F.lit(">& __restrict ")))
    vector = F.concat(F.lit("aie::vector<"), "type", F.lit(", "), lanes.cast("string"), F.lit(">"))
    steps = F.when(F.col("complexity") == "simple", 1).when(F.col("complexity") == "moderate", 2).otherwise(3)
    work = F.array_join(F.transform(F.sequence(F.lit(1), steps), lambda k: F.concat(F.lit("        v = aie::"), slug(F.col("pattern")), F.lit("(v, "), k.cast("string"), F.lit(");"))), "\n")
    read = F.when(stream, F.concat(F.lit("readincr_v<"), lanes.cast("string"), F.lit(">(in)"))).otherwise(F.lit("*it++"))
    write = F.when(stream, F.lit("writeincr(out, v)")).otherwise(F.lit("*ot++ = v"))
    setup = F.when(stream, F.lit("")).otherwise(F.concat(F.lit("    auto it = aie::begin_vector<"), lanes.cast("string"), F.lit(">(in);\n    auto ot = aie::begin_vector<"), lanes.cast("string"), F.lit(">(out);\n")))
    code = F.concat(
        F.lit("#include <aie_api/aie.hpp>\n\nvoid "), name, F.lit("("), port("input"), F.lit("in, "), port("output"), F.lit("out) {\n"), setup,
        F.lit("    for (int i = 0; i < 32; i++) chess_prepare_for_pipelining {\n        "), vector, F.lit(" v = "), read, F.lit(";\n"), work, F.lit("\n        "), write, F.lit(";\n    }\n}\n"),
    )
    return specs.withColumn("filename", F.concat(name, F.lit(".cc"))).withColumn("code", code)


def render_graph(specs: DataFrame) -> DataFrame:
    """specs with filename and code of a graph that runs the kernel of each spec."""
    name = F.concat_ws("_", F.lit("syn_graph"), slug(F.col("pattern")), slug(F.col("type")), slug(F.col("interface")))
    link = F.when(F.lower("interface").rlike("stream"), "stream").when(F.lower("interface").rlike("cascade"), "cascade").otherwise("window<256>")
    code = F.concat(
        F.lit("#include <adf.h>\n\nclass "), name, F.lit(" : public adf::graph {\npublic:\n    adf::kernel k;\n    adf::input_plio in;\n    adf::output_plio out;\n    "), name,
        F.lit("() {\n        k = adf::kernel::create(run);\n        in = adf::input_plio::create(adf::plio_32_bits, \"in.txt\");\n        out = adf::output_plio::create(adf::plio_32_bits, \"out.txt\");\n        adf::connect<"),
        link, F.lit(">(in.out[0], k.in[0]);\n        adf::connect<"), link, F.lit(">(k.out[0], out.in[0]);\n        adf::source(k) = \"run.cc\";\n        adf::runtime<ratio>(k) = 0.9;\n    }\n};\n"),
    )
    return specs.withColumn("filename", F.concat(name, F.lit(".h"))).withColumn("code", code)


# ---- companions of the builds


def taxonomy_entries(labels: DataFrame) -> DataFrame:
    """(slug, label, tier, group) of (tier, group, label, at): slugs of labels, repeated ones numbered in order."""
    from tidewater.sources.files import suffixed

    d = labels.withColumn("base", slug(F.col("label"))).where("base <> ''")
    return suffixed(d, "base", "at", "slug").select("slug", "label", "tier", "group")


def holdout_fill(taxonomy: DataFrame, covered: DataFrame) -> DataFrame:
    """A synthetic case for each slug that no real case covers."""
    from tidewater.functions.recipes import synthesize_all

    return synthesize_all(merge.without(taxonomy, covered, "slug")).where("buggy <> correct").withColumn("synthetic", F.lit(True))


def error_rows(df: DataFrame, slug_: str, table: DataFrame, key: str, message: str, place: str, id_: str) -> DataFrame:
    """Rows with one of the messages whose key is part of their slug, chosen by the hash of the id; rows without a match are left out, repeated rows stay."""
    found = patterns.theta_contains(df, slug_, table.select(F.col(key).alias("__key"), F.col(place).alias("__order"), F.col(message).alias("error_message")), "__key", "__order", place="__place", count="__count")
    digits, at = F.md5(F.col(id_).cast("string")), F.lit(0).cast("long")
    for start in range(1, 33, 8):
        at = (at * (1 << 32) + F.conv(F.substring(digits, start, 8), 16, 10).cast("long")) % F.col("__count")
    return found.where(F.col("__place") == at + 1).select(*df.columns, "error_message")


def clean_rows(files_: DataFrame, path: str, code: str, most: int = 500, most_chars: int = 12_000) -> DataFrame:
    """Correct files as rows of their own: every k-th by path of those that are short enough, `most` of them, one a path."""
    short = files_.where(F.length(code) < most_chars)
    return selection.stride(selection.first_of(short, [path], [F.md5(code)]), [path], most)


def chat_example(examples: DataFrame) -> DataFrame:
    """messages of (system, user struct<prompt, goal, context, artifacts, constraints>, assistant): sections under headings, artifacts fenced by their suffix."""
    u = F.col("user")
    kind = lambda name: F.when(name.rlike(r"\.(?:cc|cpp|h|hpp)\z"), "cpp").when(name.rlike(r"\.py\z"), "python").when(name.rlike(r"\.json\z"), "json").otherwise("text")
    artifact = lambda e: F.concat(e["key"], F.lit(":\n```"), kind(e["key"]), F.lit("\n"), e["value"], F.lit("\n```"))
    given = lambda title, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{title}:\n"), c))
    files_ = F.array_join(F.transform(F.array_sort(F.map_entries(F.coalesce(u["artifacts"], F.create_map().cast("map<string,string>")))), artifact), "\n\n")
    rules = F.array_join(F.transform(F.coalesce(u["constraints"], F.array().cast("array<string>")), lambda c: F.concat(F.lit("- "), c)), "\n")
    parts = F.array_compact(F.array(F.nullif(u["prompt"], F.lit("")), given("Goal", u["goal"]), given("Context", u["context"]), given("Artifacts", files_), given("Constraints", rules)))
    role = lambda name, c: F.struct(F.lit(name).alias("role"), c.alias("content"))
    return examples.withColumn("messages", F.array(role("system", F.col("system")), role("user", F.array_join(parts, "\n\n")), role("assistant", F.col("assistant.response"))))


def combined_verdict(results: DataFrame) -> DataFrame:
    """results with verdict and passed from (proven, compiled, structure_ok, dsl_only, has_compiler)."""
    verdict = (
        F.when(~F.col("structure_ok"), "structure_broken").when(~F.col("has_compiler"), "structure_only_no_compiler").when(F.col("compiled"), "logical_likely")
        .when(F.col("dsl_only"), "dsl_unresolved_but_plausible").otherwise("syntax_error")
    )
    d = results.withColumn("verdict", verdict)
    return d.withColumn("passed", F.coalesce(F.col("proven"), F.lit(False)) & ~F.col("verdict").isin("structure_broken", "syntax_error"))
