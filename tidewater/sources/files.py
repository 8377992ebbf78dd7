"""Readers and writers for source trees, JSON lines, JSON arrays, topic lists and repository caches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import content_hash, strip
from tidewater.operators.selection import first_of, numbered, ranked

#: A row of the instruction data set; keys outside it are kept in `extras`.
INSTRUCTION = (
    "instruction string, context string, response string, metadata struct<split:string,variant:string,group_id:string,source_group:string,source:string,"
    "source_repo:string,source_path:string,type:string,category:string,bug_type:string,bug_label:string,difficulty_tier:string,synthetic:boolean,slug:string,"
    "variant_idx:int,source_id:string,v4_bucket:string,v5_bucket:string,compile_ok:boolean,wsl_compile_ok:boolean,error_class:string,response_format:string>"
)


def source_tree(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".cc", ".cpp", ".h", ".hpp")) -> DataFrame:
    """(path, code) of every file below path with one of the suffixes; the files' names are filtered before they are read."""
    glob = "*{" + ",".join(suffixes) + "}"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return found.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("code"))


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_index, raw): every physical line with its number from 0 in its file, blank ones counted.

    Lines of a file that Spark reads in several splits are numbered by their order in the
    file: splits are ordered, and so are the ids that Spark gives within them.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))
    sizes = raw.groupBy("file", "block").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranked(raw, ["file", "block"], ["at"], "place").join(sizes.select("file", "block", before.alias("before")), ["file", "block"])
    return placed.select("file", (F.col("place") + F.col("before") - 1).cast("long").alias("row_index"), "raw")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, mode: str = "strict") -> DataFrame:
    """Rows of JSON lines.

    strict: a broken line fails the read. tolerant: broken and blank lines are skipped, and
    `row_index` says where each row stood. A missing path is an empty table.
    """
    try:
        if mode == "strict":
            return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        parsed = _text_lines(spark, path).withColumn("row", F.from_json("raw", kind)).where(F.try_parse_json("raw").isNotNull())
        return parsed.select("row_index", "row.*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        return spark.createDataFrame([], kind if mode == "strict" else T.StructType([T.StructField("row_index", T.LongType()), *kind]))


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(row_index, raw) of the lines that are neither blank nor JSON."""
    return _text_lines(spark, path).where((strip(F.col("raw")) != "") & F.try_parse_json("raw").isNull()).select("row_index", "raw")


def with_extras(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows with every key outside the schema kept in `extras` (variant)."""
    raw = spark.read.text(path).where(strip(F.col("value")) != "")
    return raw.select(F.from_json("value", schema).alias("row"), F.try_parse_json("value").alias("extras")).select("row.*", "extras")


def as_list(value: Column) -> Column:
    """An array of texts from a variant that is an array or one text."""
    return F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.array_compact(F.array(F.try_variant_get(value, "$", "string"))))


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files of one pretty object or one array each, with the file they come from."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, row_index, row's columns) of files that hold one array each, in the arrays' order; what is no array fails the read. A file is read by one task."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))
    rows = F.from_json("raw", f"array<struct<{', '.join(c.strip().replace(' ', ':', 1) for c in schema.split(','))}>>", {"mode": "FAILFAST"})
    return whole.select("file", F.posexplode(rows).alias("row_index", "r")).select("file", "row_index", "r.*")


#: An entry of the source corpus.
ENTRY = "filename string, code string, source string, category string, source_url string, repo string, branch string, bug_type string, bug_explanation string, metadata struct<path:string,compute_pattern:variant,data_types:variant,interfaces:variant,complexity:string,origin:string>"


def corpus_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a corpus file: those with code, missing texts empty but for the bug's, lists that were written as text or as arrays as arrays, and `content`, the code's hash."""
    d = json_lines(spark, path, ENTRY, "tolerant").where(F.coalesce("code", F.lit("")) != "")
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("filename", "code", "source", "category")]
    return d.select("row_index", *text, "source_url", "repo", "branch", "bug_type", "bug_explanation", *[as_list(F.col(f"metadata.{c}")).alias(c) for c in ("compute_pattern", "data_types", "interfaces")], F.col("metadata.complexity").alias("complexity"), content_hash(F.col("code")).alias("content"))


def predictions(found: DataFrame, order: str) -> DataFrame:
    """(id, answer): id from id or case_id, answer from prediction or response; the last of an id counts."""
    d = found.select(F.coalesce("id", "case_id").alias("id"), F.coalesce("prediction", "response").alias("answer"), order).where("id is not null")
    return d.groupBy("id").agg(F.max_by("answer", order).alias("answer"))


def topics(lines: DataFrame, index: str, text: str, slug: Column) -> DataFrame:
    """(group, label, slug) of a topic list: lines in capitals are headings; a repeated slug gets _2, _3."""
    from pyspark.sql import Window

    d = lines.withColumn("label", strip(F.col(text))).where("label <> ''")
    heading = (F.upper("label") == F.col("label")) & F.col("label").rlike(r"(?U)\p{L}")
    upto = Window.orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a topic list is a lookup file
    d = d.withColumn("group", F.last(F.when(heading, F.col("label")), True).over(upto)).where(~heading).withColumn("base", slug)
    return suffixed(d, "base", index, "slug").select("group", "label", "slug", index)


def suffixed(df: DataFrame, base: str, order: str, name: str) -> DataFrame:
    """df with the base name made unique: the second of a name gets _2, and so on."""
    d = ranked(df, [base], [order], "__k")
    return d.withColumn(name, F.when(F.col("__k") == 1, F.col(base)).otherwise(F.concat(base, F.lit("_"), "__k"))).drop("__k")


def repository_blobs(trees: DataFrame, blobs: DataFrame, suffixes: tuple[str, ...], most_bytes: int = 200_000) -> DataFrame:
    """(repo, branch, path, sha, code) of the wanted files of cached repository trees.

    trees (repo, branch, tree array<struct<path,type,sha,size,url>>) join blobs (key, content in
    base64) on the sha256 of the blob's address; paths are filtered before the join.
    """
    entry = trees.select("repo", "branch", F.explode("tree").alias("e")).select("repo", "branch", "e.*").where((F.col("type") == "blob") & (F.coalesce("size", F.lit(0)) <= most_bytes))
    entry = entry.where(F.lower("path").rlike("(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + r")\z"))
    met = entry.withColumn("key", F.sha2("url", 256)).join(blobs, "key")
    return met.select("repo", "branch", "path", "sha", F.make_valid_utf8(F.unbase64("content").cast("string")).alias("code"))


def vetted_repositories(files: DataFrame, least: int = 3) -> DataFrame:
    """Repositories with at least so many valid files."""
    return files.groupBy("repo").agg(F.count("*").alias("n_files")).where(F.col("n_files") >= least)


def new_files(files: DataFrame, seen: DataFrame, content_key: Column, order: list[str]) -> DataFrame:
    """Files whose content and address are both unknown, one of each content."""
    from tidewater.operators.merge import without

    d = without(files.withColumn("content_key", content_key), seen, "content_key", "url")
    return first_of(d, ["content_key"], order)


# ---- sinks: every write goes to a new version, so inputs are never overwritten while they are read


def write_json_lines(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """JSON lines with nulls written; an order makes one sorted file (for exports that must match byte for byte)."""
    out = df.orderBy(*order).coalesce(1) if order else df
    out.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str, most: int = 1000) -> None:
    """Files of one pretty array each, of `most` rows at most, so that files are far fewer than rows; for `json_documents`."""
    piece = F.expr(f"monotonically_increasing_id() div {most}")
    pieces = df.select(F.struct("*").alias("row"), piece.alias("piece")).groupBy("piece").agg(F.collect_list("row").alias("rows"))
    pieces.select(F.to_json("rows", {"pretty": "true"}).alias("value")).write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One table partitioned by split, from which each split is read by pruning."""
    df.write.mode("errorifexists").partitionBy(split).parquet(path)


def write_kept_and_dropped(df: DataFrame, path: str, reasons: str) -> None:
    """One table partitioned by whether a row is kept (it has no reasons), in one pass."""
    df.withColumn("kept", F.size(F.col(reasons)) == 0).write.mode("errorifexists").partitionBy("kept").parquet(path)


def resolve_input(spark: SparkSession, all_rows: DataFrame, train: DataFrame, validation: DataFrame) -> DataFrame:
    """The complete table, unless it has no more rows than the training split: then both splits together."""
    return all_rows if all_rows.count() > train.count() else train.unionByName(validation, allowMissingColumns=True)


def union_in_order(*frames: DataFrame) -> DataFrame:
    """All rows, with `source_rank` saying which frame they came from."""
    out = None
    for rank, frame in enumerate(frames):
        frame = frame.withColumn("source_rank", F.lit(rank))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def positions(df: DataFrame, order: list[str]) -> DataFrame:
    """df with row_index from 0 in the given order."""
    return numbered(df, order, "row_index").withColumn("row_index", F.col("row_index") - 1)
