"""What the corpus operators share: tables, durable intermediate results, byte-level text helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.lineage import shared_dir

#: Words of the contracts that say `[^\x20\x09-\x0D]+`, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


#: Where this package lies; Python workers look there too, wherever the driver was started.
_HOME = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    env = spark.sparkContext.environment
    if _HOME not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), _HOME]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; it is deleted when this driver ends."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of ours; quiet if the session has gone."""
    with contextlib.suppress(Exception):
        sc = spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of so many rows to Python in what is written meanwhile: texts are long, and executors hold a batch on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def durable(df: DataFrame, what: str, path: str | None = None) -> DataFrame:
    """df written once to the shared folder and read again: cuts the lineage and survives lost executors. path: where, if it is to be removed before the driver ends."""
    spark = df.sparkSession
    path = path or fresh_path(spark, what)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for the small tables of iterations."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def split_bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo a number; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[tuple[int, list]]:
    """(first row, values) of runs of rows of about `most` bytes at most; single longer values come alone."""
    values, first, size, run = batch.column(column), 0, 0, []
    for i in range(len(values)):
        value = values[i].as_py()
        n = len(value) if value is not None else 0
        if run and size + n > most:
            yield first, run
            first, size, run = i, 0, []
        run.append(value)
        size += n
    if run:
        yield first, run


def tidy() -> None:
    """Gives memory that Arrow keeps for later back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
