"""Quality rules by cross-document line frequency, with DataFrame functions only.

A line is normalised (lower case, runs of white space as one space, none at its ends) and
hashed. For each source (the host), the distinct texts that hold a line are counted; a line in
more than `most_docs` of them is boilerplate and removed, however many texts the host has. A
text that keeps less than `least_left` of its words is depleted and rejected. Copies of one
text count once, so they do not make each other boilerplate.

Edge cases: a null or blank text has no words and fails the base rules; a null source is a
host; repeated rows each get a row and the same verdict; very long texts are handled within
their row; an empty table gives no rows; only doc_id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, durable, table


def _repeat_words(words: str) -> tuple[list[tuple[str, object]], object]:
    """Columns to add one after another, and the count of words in 3-word windows that are found twice or more.

    A window is one long: the upper bits of its hash, and its place in the lower bits, as many
    as the text needs. Sorted, equal windows are neighbours.
    """
    n = F.size(words)
    place_bits = F.length(F.bin(n))
    windows = F.expr(
        f"case when size({words}) >= 4 then sort_array(transform(sequence(0, size({words}) - 3), i -> "
        f"(xxhash64(get({words}, i), get({words}, i + 1), get({words}, i + 2)) & ~(shiftleft(1L, place_bits) - 1L)) | cast(i as long))) else cast(array() as array<long>) end"
    )
    place = lambda x: f"cast({x} & (shiftleft(1L, place_bits) - 1L) as int)"
    # Equal hashes are neighbours; the words themselves are compared, as a long text leaves few bits to the hash.
    same = lambda x, y: f"coalesce(shiftright({x}, place_bits) = shiftright({y}, place_bits) and " + " and ".join(f"get({words}, {place(x)} + {k}) = get({words}, {place(y)} + {k})" for k in range(3)) + ", false)"
    twins = F.expr(f"transform(filter(windows, (x, i) -> {same('x', 'get(windows, i - 1)')} or {same('x', 'get(windows, i + 1)')}), x -> x & (shiftleft(1L, place_bits) - 1L))")
    covered = F.expr(
        "aggregate(sort_array(twins), named_struct('n', 0L, 'end', 0L), (a, p) -> named_struct('n', a.n + p + 3L - greatest(a.end, p), 'end', p + 3L), a -> a.n)"
    )
    return [("place_bits", place_bits.cast("int")), ("windows", windows), ("twins", twins)], covered


def _key(line):
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))))


def measures(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, host, text_key, the base measures, and lines (key, n words each) of each row, and its body if wanted."""
    d = docs.select("doc_id", F.col("source").alias("host"), F.coalesce("text", F.lit("")).alias("body"))
    d = d.withColumn("words", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)))
    d = d.withColumn("told", F.filter(F.split("body", "\n", -1), lambda x: x.rlike(WORD)))
    steps, covered = _repeat_words("words")
    for name, column in steps:
        d = d.withColumn(name, column)
    line = lambda x: F.struct(
        _key(x).alias("key"), F.regexp_count(x, F.lit(WORD)).alias("n")
    )
    return d.select(
        "doc_id", "host", F.xxhash64("body", F.length("body")).alias("text_key"), F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("told") - F.size(F.array_distinct("told"))).cast("long").alias("n_dup_lines"), covered.alias("n_repeat_words"), F.transform("told", line).alias("lines"), *(["body"] if with_text else []),
    )


def boilerplate(measured: DataFrame, most_docs: int) -> DataFrame:
    """(host, key) of lines that too many distinct texts of a host hold."""
    held = measured.select("host", "text_key", F.explode(F.array_distinct("lines.key")).alias("key")).distinct()
    return held.groupBy("host", "key").agg(F.count("*").alias("docs")).where(F.col("docs") > most_docs).select("host", "key")


def judge(docs: DataFrame, most_docs: int = 20, least_left: float = 0.3, with_text: bool = False) -> DataFrame:
    """doc_id, base measures, n_left (words outside boilerplate), base_failed, kept of each row, and cleaned (its text without boilerplate lines) if wanted."""
    measured = durable(measures(docs, with_text).withColumn("row", F.monotonically_increasing_id()), "line-measures")  # the ids stay as written
    common = boilerplate(measured, most_docs).select(F.col("host").alias("h"), F.col("key").alias("k"))
    lines = measured.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.key", "x.n")
    gone = lines.join(common, F.col("host").eqNullSafe(F.col("h")) & (F.col("key") == F.col("k"))).groupBy("row").agg(F.sum("n").alias("gone"), *([F.collect_set("key").alias("keys")] if with_text else []))
    out = measured.drop("lines").join(gone, "row", "left").withColumn("n_left", F.col("n_words") - F.coalesce("gone", F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.filter(F.split("body", "\n", -1), lambda x: ~(x.rlike(WORD) & F.array_contains(F.coalesce("keys", F.array().cast("array<long>")), _key(x))))
    cleaned = [F.array_join(left, "\n").alias("cleaned")] if with_text else []
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_left", failed.alias("base_failed"), (~failed & (F.col("n_left") >= least_left * F.col("n_words"))).alias("kept"), *cleaned)


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
