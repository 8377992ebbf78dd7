"""Appends that happen once: data first, then one entry in a list of commits.

A table is a folder with data in `data/<name>/` and commits in `commits/<number>.json`. An append
writes its rows to a new data folder and then takes the next number by renaming a finished file
to it, which fails if the number is taken: the commit is what makes rows visible, all at once.
Several writers so come into one order, as each number is taken once; who comes second takes the
next one. An append is known by its writer and batch. If the list has it already it does nothing,
so a batch that is repeated after a failure leaves no double row; what a failed append wrote is in
no commit, so no reader sees it, and `vacuum` removes it.

The lists of commits are read by the driver: a row for each batch. `compact` puts the rows of all
commits so far into one, which names those that it stands for. Renames must be atomic and must
not replace a file, as on HDFS; a store without such a rename needs its own `claim`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Commit:
    """An append as the list has it. replaces: the numbers of commits whose rows are in this one."""

    number: int
    writer: str
    batch: int
    folder: str
    rows: int
    replaces: list[int] = field(default_factory=list)


class Files:
    """The few calls on files of a shared folder that commits need, by Hadoop's interface."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway, self.root = spark._jvm, spark.sparkContext._gateway, root
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        top = self.path("")
        self.system, self.context = top.getFileSystem(self.conf), self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(top.toUri(), self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.system.listStatus(at)) if self.system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def claim(self, name: str, content: str) -> bool:
        """Writes a file as a whole, unless it is there."""
        draft = self.path(f"drafts/{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        stream.write(content.encode())
        stream.close()
        target = self.path(name)
        self.system.mkdirs(target.getParent())
        kinds = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(kinds, 1)
        how[0] = kinds.NONE  # that is, not over a file
        try:
            self.context.rename(draft, target, how)
            return True
        except Exception as e:
            self.system.delete(draft, False)
            if "AlreadyExists" in str(e):
                return False
            raise

    def remove(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """All commits of a table, in their order."""
    files = Files(spark, path)
    return [Commit(**json.loads(files.read(f"commits/{name}"))) for name in files.names("commits") if name.endswith(".json")]


def _live(found: list[Commit]) -> list[Commit]:
    gone = {n for c in found for n in c.replaces}
    return [c for c in found if c.number not in gone]


def append(df: DataFrame, path: str, writer: str, batch: int, replaces: list[int] | None = None) -> Commit:
    """Appends the rows of one batch of a writer, once however often it is called; the commit that holds them."""
    spark = df.sparkSession
    files, known = Files(spark, path), commits(spark, path)
    if done := next((c for c in known if (c.writer, c.batch) == (writer, batch)), None):
        return done
    folder = f"data/{batch:08d}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{path}/{folder}")
    rows = spark.read.schema(df.schema).parquet(f"{path}/{folder}").count()  # of the footers
    number = known[-1].number + 1 if known else 0
    while True:
        made = Commit(number, writer, batch, folder, rows, replaces or [])
        if files.claim(f"commits/{number:012d}.json", json.dumps(asdict(made))):
            return made
        taken = Commit(**json.loads(files.read(f"commits/{number:012d}.json")))
        if (taken.writer, taken.batch) == (writer, batch):  # this batch ran twice at once
            files.remove(folder)
            return taken
        number += 1


def committed(spark: SparkSession, path: str, schema: str, until: int | None = None) -> DataFrame:
    """The rows of all commits, or of those up to a number, with `commit`, the number of theirs."""
    found = _live([c for c in commits(spark, path) if until is None or c.number <= until])
    if not found:
        return spark.createDataFrame([], schema).withColumn("commit", F.lit(None).cast("long"))
    rows = spark.read.schema(schema).parquet(*[f"{path}/{c.folder}" for c in found])
    of = spark.createDataFrame([(c.folder.rpartition("/")[2], c.number) for c in found], "__folder string, commit long")
    named = rows.withColumn("__folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return named.join(F.broadcast(of), "__folder").drop("__folder")  # a row for each batch that was not compacted


def compact(spark: SparkSession, path: str, schema: str) -> Commit | None:
    """One commit with the rows of all so far, in its place in the order; None if there are fewer than two. Run by one process at a time."""
    found = _live(commits(spark, path))
    if len(found) < 2:
        return None
    rows = committed(spark, path, schema, found[-1].number).drop("commit")
    return append(rows, path, "compact", found[-1].number, [c.number for c in found])


def vacuum(spark: SparkSession, path: str) -> int:
    """Removes the data of failed appends and of commits that were compacted; how many folders. Only while no append runs."""
    files, live = Files(spark, path), {c.folder for c in _live(commits(spark, path))}
    gone = [f"data/{name}" for name in files.names("data") if f"data/{name}" not in live]
    for name in gone:
        files.remove(name)
    files.remove("drafts")
    return len(gone)


def append_stream(stream: DataFrame, path: str, writer: str, checkpoint: str) -> StreamingQuery:
    """Everything a stream has now, in appends of its batches: a batch that Spark repeats after a failure is not appended again."""
    return stream.writeStream.foreachBatch(lambda df, batch: append(df, path, writer, batch) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
