"""Cutting lineage where a result is used several times, so that its inputs are read once."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: For sessions of one machine that name no folder, as in tests.
LOCAL = "file:///tmp/checkpoints/tidewater"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own in a session of one machine; ValueError on a cluster, as no machine's folder would do."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return LOCAL


def settle(df: DataFrame) -> DataFrame:
    """df in a reliable checkpoint below spark.checkpoint.dir; meant for slim tables, as rows are written as they are."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as Parquet below spark.checkpoint.dir, read again; for tables with texts. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over some tasks for each core, for slim rows that take long work; else a small file is one task, however many rows it has."""
    return df.repartition(max(32, 4 * df.sparkSession.sparkContext.defaultParallelism))


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are worked out once a row, before what uses them: Spark would else put their expressions in every place where they are named."""
    made = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], made.alias("__held")).select(*[c for c in df.columns if c not in columns], "__held.*")


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        sc = spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
