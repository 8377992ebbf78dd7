"""Conversions of instruction rows from one form into another, and rows made of logs.

Rows have instruction, context, response and whatever columns come with them. Where a form
says that one of several phrasings is taken, the hash of the row's instruction and context
takes it, so reruns agree. Null texts are empty texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions import diffs
from tidewater.functions.text import canonical_json, choose, hash_hex, lines, or_text, strip
from tidewater.operators import merge, selection
from tidewater.operators.lineage import held

# Words that tell forms of rows apart, formats, and limits.
KNOWN_GOOD, COMPILE_READY, YES_NO = "known-good", "compile-ready", "Does this AIE"
LEAST_CODE, MOST_CHANGED, MOST_EXCERPT = 50, 0.70, 900
LOOKS_LIKE_CODE = r"#include|void\s+\w|class\s+\w"
DIFF_HEAD = "--- a/aie_source\n+++ b/aie_source\n"
NEGATIVE_BUG, NEGATIVE_VARIANT, NEGATIVE_BUCKET = "bedrock_compile_failed_candidate", "v4_bedrock_compile_failure_negative", "bedrock_compile_failure_negative"
SLUG_IN_TICKS = r"`[a-z][a-z0-9_]{4,}`"

#: Phrasings, as templates.
REVIEW = ["Review this source for bugs and return the complete corrected file.", "Check this source for defects. Return the corrected version.", "Find and fix any bugs in this code. Return the whole file.", "Debug this source and return the full file."]
DIFF = ["Fix the bug in this source. Answer with a unified diff.", "The build failed as logged. Give the smallest patch as a unified diff.", "Repair this source; return only a unified diff."]


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_form(instruction: Column) -> Column:
    """known_good, compile_ready, yes_no, or fix."""
    said = F.coalesce(instruction, F.lit(""))
    return F.when(F.contains(said, F.lit(KNOWN_GOOD)), "known_good").when(F.contains(said, F.lit(COMPILE_READY)), "compile_ready").when(F.startswith(said, F.lit(YES_NO)), "yes_no").otherwise("fix")


def edges_off(text: Column) -> Column:
    """A text without a fence's first and last mark, whatever stands between."""
    inner = F.regexp_replace(strip(text), r"\A```(?:cpp|c\+\+|c)?", "")
    return strip(F.regexp_replace(strip(inner), r"```\z", ""))


def passthrough(rows: DataFrame, instructions: list[str] = REVIEW) -> DataFrame:
    """Rows for which no fix is known, as rows whose code comes back unchanged.

    known_good rows give their response's code, yes_no rows their context's; below 50
    characters of code they go. compile_ready rows go. fix rows stay as they are. New columns:
    original_form (null for rows that stay) and converted.
    """
    form = row_form(F.col("instruction"))
    code = F.when(form == "known_good", edges_off(_text("response"))).when(form == "yes_no", strip(_text("context")))
    d = rows.withColumn("__form", form).withColumn("__code", code).where((F.col("__form") == "fix") | (F.length("__code") >= LEAST_CODE))
    new = F.col("__form") != "fix"
    key = F.concat_ws("\x01", "instruction", "context")
    changed = {"instruction": choose(key, instructions), "context": F.col("__code"), "response": F.concat(F.lit("```cpp\n"), "__code", F.lit("\n```"))}
    d = d.withColumns({"__new": new, **{f"__{c}": v for c, v in changed.items()}})
    for c in changed:
        d = d.withColumn(c, F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)))
    return d.withColumn("original_form", F.when(F.col("__new"), F.col("__form"))).withColumn("converted", F.col("__new")).drop("__new", "__form", "__code", *[f"__{c}" for c in changed])


def buggy_and_correct(context: Column, response: Column) -> tuple[Column, Column]:
    """The two codes of a fix row without fences and hint comments; null where either is missing or does not look like code."""
    text = strip(context)
    after = strip(F.regexp_replace(text, r"(?s)\A.*?Buggy version:", ""))
    told = strip(F.regexp_replace(after, r"(?s)Correct version:.*\z", ""))
    sectioned = F.startswith(text, F.lit("Buggy version:")) | (F.startswith(text, F.lit("Scenario bug pattern:")) & F.contains(text, F.lit("Buggy version:")))
    buggy = F.when(sectioned, told).when(~F.startswith(text, F.lit("Scenario bug pattern:")), edges_off(text))
    fixed = edges_off(response)
    both = [C.without_hints(buggy), C.without_hints(fixed)]
    ok = F.coalesce(buggy != "", F.lit(False)) & (fixed != "") & both[0].rlike(LOOKS_LIKE_CODE) & both[1].rlike(LOOKS_LIKE_CODE)
    return F.when(ok, both[0]), F.when(ok, both[1])


def diff_rows(rows: DataFrame, log: Column, instructions: list[str] = DIFF, has_real_log: Column | None = None) -> DataFrame:
    """Fix rows as (code and log, unified diff): converted rows, rows without two codes, equal codes and diffs that change over 70 % of the lines go.

    log: the error log of a row; has_real_log: whether it was measured (false, if not given).
    """
    buggy, fixed = buggy_and_correct(_text("context"), _text("response"))
    d = rows.where(~F.coalesce(F.col("converted"), F.lit(False))) if "converted" in rows.columns else rows
    d = held(d.withColumn("__log", log), __buggy=buggy, __fixed=fixed).where("__buggy is not null and __buggy <> __fixed")
    d = held(d, __diff=diffs.unified_diff("__buggy", "__fixed"))  # else once for the condition and once for the column, each with workers of its own
    marks = F.filter(lines(F.col("__diff")), lambda x: x.rlike(r"\A[+-]") & ~x.rlike(r"\A(?:---|\+\+\+)"))
    longest = F.greatest(F.size(lines(F.col("__buggy"))), F.size(lines(F.col("__fixed"))), F.lit(1))
    d = d.where((F.col("__diff") != "") & (F.size(marks) / longest <= MOST_CHANGED))
    d = d.withColumn("instruction", choose(F.concat_ws("\x01", "instruction", "context"), instructions)).withColumn("context", F.concat("__buggy", F.lit(C.ERROR_SEPARATOR), F.coalesce("__log", F.lit(""))))
    d = d.withColumn("response", F.col("__diff")).withColumn("response_format", F.lit("unified_diff")).withColumn("has_real_error_log", F.lit(False) if has_real_log is None else has_real_log)
    return d.drop("__log", "__buggy", "__fixed", "__diff")


def needing_logs(rows: DataFrame, order: list[str]) -> DataFrame:
    """(position, code and the order's columns) of diff rows without a measured log: what a compiler is asked, by position from 0."""
    wanted = rows.where(~F.coalesce(F.col("has_real_error_log"), F.lit(False)) & (F.col("response_format") == "unified_diff")).withColumn("code", C.code_and_log(_text("context"))[0]).where("code <> ''")
    return selection.numbered(wanted.select(*order, "code"), order, "position").withColumn("position", F.col("position") - 1)


def logs_patched(rows: DataFrame, results: DataFrame, order: list[str]) -> DataFrame:
    """rows with the measured logs of results (row_index, compile_ok, stderr_tail, error_class) in place of theirs.

    row_index is the position that needing_logs gave; a result that compiled, or says nothing,
    changes nothing. Of several results of a position the last by log counts.
    """
    plain = C.error_lines(F.col("stderr_tail"))
    label = F.nullif(strip(_text("error_class")), F.lit("ok"))
    log = F.coalesce(F.nullif(plain, F.lit("")), F.when(F.coalesce(label, F.lit("")) != "", F.concat(F.lit("Compile error: "), label)))
    told = results.where(~F.coalesce("compile_ok", F.lit(False))).select(F.col("row_index").alias("position"), log.alias("__log")).where("__log is not null")
    met = needing_logs(rows, order).join(selection.last_of(told, ["position"], ["__log"]), "position").select(*[F.col(c).alias(f"__of_{c}") for c in order], "__log")
    d = rows.join(met, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in order], "left").drop(*[f"__of_{c}" for c in order])
    new = F.col("__log").isNotNull()
    code = F.regexp_replace(_text("context"), r"(?s)\Q" + C.ERROR_SEPARATOR + r"\E.*\z", "")
    d = d.withColumn("context", F.when(new, F.concat(code, F.lit(C.ERROR_SEPARATOR), "__log")).otherwise(F.col("context")))
    return d.withColumn("has_real_error_log", F.when(new, True).otherwise(F.col("has_real_error_log"))).drop("__log")


def compile_failures(rows: DataFrame) -> DataFrame:
    """Rows that are not known to compile."""
    return rows.where(~F.coalesce(F.col("wsl_compile_ok"), F.lit(False)))


def short_excerpt(log: Column, otherwise: str = "compile failed") -> Column:
    """The first line that is not blank, then the lines with errors, 900 characters at most."""
    told = F.filter(F.transform(lines(F.coalesce(log, F.lit(""))), strip), lambda x: x != "")
    kept = F.filter(told, lambda x, i: (i == 0) | C.any_of(x, ("error:", "ERROR:", "fatal error:")))
    return F.substring(F.when(F.size(kept) > 0, F.array_join(kept, "\n")).otherwise(or_text(strip(log), F.lit(otherwise))), 1, MOST_EXCERPT)


def compile_negatives(attempts: DataFrame, order: list[str], most: int | None = None) -> DataFrame:
    """Rows that say why a generated source does not compile, from attempts (candidate_code, compile_ok, validation_error_class, validation_error_excerpt, prompt_error_excerpt).

    One row for each candidate, its first failed attempt in order; attempts that compiled or
    have no code give none; the split goes by the candidate. most: a limit, if one is wanted.
    """
    d = attempts.where(~F.coalesce(F.col("compile_ok"), F.lit(False))).withColumn("context", strip(_text("candidate_code"))).where("context <> ''")
    d = selection.first_of(d.withColumn("candidate_sha1", hash_hex(F.col("context"), "sha1")), ["candidate_sha1"], order)
    label = or_text(F.col("validation_error_class"), F.lit("compile_error"))
    excerpt = short_excerpt(or_text(F.col("validation_error_excerpt"), or_text(F.col("prompt_error_excerpt"), label)))
    d = d.withColumns({"error_class": label, "error_reason": excerpt, "group_id": F.concat(F.lit("bedrock_failed_candidate:"), "candidate_sha1")})
    d = d.withColumns({
        "instruction": F.lit("Inspect this AI-generated AIE source and say whether it is compile-ready."),
        "response": F.concat(F.lit("No - this AI-generated AIE source is not compile-ready. The validator reported "), "error_class", F.lit(": "), "error_reason"),
        "split": selection.split_percent(F.col("group_id")), "bug_type": F.lit(NEGATIVE_BUG), "variant": F.lit(NEGATIVE_VARIANT), "v4_bucket": F.lit(NEGATIVE_BUCKET), "verdict": F.lit("compile_failed"),
    })
    return selection.numbered(d, order, "__at").where(F.col("__at") <= most).drop("__at") if most else d


def id_or_triple(source_id: Column) -> Column:
    """What v5 rows are told apart by: their source id, else the hash of their three texts."""
    texts = canonical_json(context=F.col("context"), instruction=F.col("instruction"), response=F.col("response"))
    return F.when(F.coalesce(source_id, F.lit("")) != "", F.concat(F.lit("source_id:"), source_id)).otherwise(F.concat(F.lit("sha1:"), hash_hex(texts, "sha1")))


def merged_v5(rows: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """rows and those new ones that are complete v5 rows, one of each id or triple: the first, rows before new."""
    whole = F.contains(_text("context"), F.lit("--- Error Log ---")) & F.startswith(_text("response"), F.lit(DIFF_HEAD)) & F.coalesce("has_real_error_log", F.lit(False)) & (F.col("response_format") == "unified_diff")
    d = rows.withColumn("__late", F.lit(0)).unionByName(new.where(whole).select(*rows.columns).withColumn("__late", F.lit(1)))
    return selection.first_of(d.withColumn("__key", id_or_triple(F.col("source_id"))), ["__key"], ["__late", *order]).drop("__late", "__key")


def given_split(rows: DataFrame, split: Column) -> DataFrame:
    """Rows that go where their metadata says; those that say nothing, or something else, train."""
    return rows.withColumn("split", F.when(split == "validation", "validation").otherwise("train"))


def repaired_rows(results: DataFrame, originals: DataFrame, fixes: DataFrame, keys: list[str]) -> DataFrame:
    """Original rows with the fixed code as response and what the fix was about as `fix`: results and fixes meet on keys, originals too."""
    told = ["error_class", "file_type", "target", "compiler"]
    d = results.select(*keys, *told).join(fixes.select(*keys, "fixed_code", "model"), keys).join(originals, keys)
    about = F.struct("model", F.lit(False).alias("original_compile_ok"), F.col("error_class").alias("original_error_class"), "file_type", "target", "compiler", *keys)
    return d.withColumn("response", F.col("fixed_code")).withColumn("fix", about).select(*originals.columns, "fix")


def inspection_negatives(files: DataFrame, bugs: DataFrame, scenarios: int, instruction: str, verdict: str) -> DataFrame:
    """Rows that ask for a bug which a file does not have: `scenarios` files for each bug, from where its slug's hash points in the files' order.

    files: (path, context, place from 0, source_group, split); bugs: (slug, label, tier); in the
    templates {label}, {n} and {anchors} stand for the bug, the scenario and the file's anchors.
    """
    from tidewater.functions.describe import _filled
    from tidewater.functions.screens import anchor_phrase, code_anchors
    from tidewater.functions.text import hex_mod

    n = files.count()
    if not n:
        return files.select(F.lit("").alias("instruction"), "context", F.lit("").alias("response"), F.lit("").alias("bug_type"), F.lit("").alias("tier"), "source_group", "split").where("false")
    asked = bugs.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(scenarios))))
    asked = asked.withColumn("place", (hex_mod(F.md5("slug"), 32, n) + F.col("n") - 1) % n)
    d = asked.join(files, "place")
    parts = {"label": F.col("label"), "n": F.col("n").cast("string"), "anchors": anchor_phrase(code_anchors(F.col("context")))}
    text = F.concat(F.lit("Candidate bug pattern to check: "), "label", F.lit("\nSource: "), "path", F.lit("\n\n"), "context")
    return d.select(_filled(instruction, parts).alias("instruction"), text.alias("context"), _filled(verdict, parts).alias("response"), F.col("slug").alias("bug_type"), "tier", "source_group", "split")


def curated_pairs(infos: DataFrame, named: list[tuple[str, str]], path: str) -> DataFrame:
    """(buggy row as b_..., correct row as c_...) of the named pairs of paths of which both are there."""
    wanted = F.broadcast(infos.sparkSession.createDataFrame(named, "__b string, __c string"))  # as many rows as are named
    side = lambda p: infos.select(*[F.col(c).alias(f"{p}_{c}") for c in infos.columns])
    met = side("b").join(wanted, F.col(f"b_{path}") == F.col("__b")).join(side("c"), F.col(f"c_{path}") == F.col("__c"))
    return met.drop("__b", "__c")


def retried_with_code(retries: DataFrame, sources: DataFrame, done: DataFrame, order: list[str]) -> DataFrame:
    """Retries that are not done, with the correct code of their source: the first in order that has one; without one they are left out."""
    some = sources.where((_text("source_id") != "") & (_text("correct") != ""))
    code = selection.first_of(some.select("source_id", "correct", *[c for c in order if c not in ("source_id", "correct")]), ["source_id"], order).select("source_id", "correct")
    finished = done.where(F.coalesce("parse_ok", F.lit(False)) & (_text("buggy") != "") & (_text("correct") != ""))
    return merge.without(retries, finished, "source_id").join(code, "source_id")


def failure_inspection(results: DataFrame, rows: DataFrame, path: str, index: str, n: int, order: list[str]) -> DataFrame:
    """The first n failed results with their first error line and their row's columns (null where there is none)."""
    failed = results.where(~F.coalesce(F.col("compile_ok"), F.lit(False))).withColumn("first_error", C.first_error_line(F.concat_ws("\n", "stderr_tail", "stdout_tail")))
    some = failed.orderBy(*order).limit(n)  # a report of n rows
    of = rows.select(*[F.col(c).alias(f"row_{c}") for c in rows.columns])
    return some.join(of, (merge.normal_path(F.col(path)) == merge.normal_path(F.col(f"row_{path}"))) & (F.col(index) == F.col(f"row_{index}")), "left")


def slug_leaks(rows: DataFrame) -> DataFrame:
    """One row (n, leaks): rows, and those whose instruction names a slug in backticks."""
    return rows.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("instruction").rlike(SLUG_IN_TICKS), F.lit(False))).alias("leaks"))


def gate_hits(reasons: Column, wanted: list[str]) -> Column:
    """Those of the wanted reasons that are among a row's, in the row's order; a null list has none."""
    return F.array_intersect(F.coalesce(reasons, F.array().cast("array<string>")), F.array(*[F.lit(w) for w in wanted]).cast("array<string>"))


def in_file_order(entries: DataFrame) -> DataFrame:
    """Entries by repository, branch and file name, missing ones first as empty texts; ties by the code."""
    return entries.orderBy(_text("repo"), _text("branch"), "filename", F.md5("code"))
