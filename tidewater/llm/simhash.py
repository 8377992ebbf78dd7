"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint of 64 bits emits every variant within half the radius. Two fingerprints within
the radius share a variant in the middle, so a shuffle on variants brings them together. Only
distinct fingerprints are spread, so a variant has at most as many members as its ball has
points (65 for radius 2), however many copies a text has.

Edge cases: a null or blank text has fingerprint 0 and links like any other; repeated rows
share a fingerprint and each stays a row; a null doc_id is kept and never names a component
unless all of its ids are null (then component_id is null); an empty table gives no rows;
only doc_id and text are read, so extra columns may have any name.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import durable, table
from tidewater.llm.components import components


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint, unsigned: a bit is 1 if set in over half of the shingles' hashes."""
    words = (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if n == 1:
        hashes = np.array([digest(join(words), 42)], np.uint64)
    else:
        hashes = np.fromiter((digest(join(x), 42) for x in zip(*(words[i : i + n] for i in range(shingle)))), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        votes += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns named in carry, and fp (as a signed long) of each row."""
    own = ["doc_id", *carry]

    def run(batches):
        for batch in batches:
            texts = batch.column(len(own))
            found = np.fromiter((fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], pa.array(found.view(np.int64))], [*own, "fp"])

    kind = T.StructType([*(docs.schema[c] for c in own), T.StructField("fp", T.LongType())])
    return docs.select(*own, F.col("text").cast("binary").alias("__text")).mapInArrow(run, kind)


def ball(radius: int) -> list[int]:
    """All masks of at most `radius` bits, as signed longs, the smaller first."""
    masks = [sum(1 << i for i in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) among distinct fingerprints `fp`, enough to connect all that are within `radius` bits.

    The points within half the radius of a variant are its centres; the smallest of them is
    linked with all others there. An odd radius spreads one half further than the other.
    """
    outer = radius - radius // 2
    inner = len(ball(radius // 2))
    # Each row becomes many, so the rows are dealt to as many tasks as a shuffle has; small partitions would be merged otherwise.
    dealt = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    spread = dealt.select("fp", F.posexplode(F.array(*[F.lit(m) for m in ball(outer)])).alias("k", "mask"))
    met = spread.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), (F.col("k") < inner).alias("near"))
    centre = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("variant"))
    pairs = met.select("fp", centre.alias("centre")).where("centre is not null and centre <> fp")
    return pairs.select(F.col("centre").alias("a"), F.col("fp").alias("b")).distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def classes(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint; root names its component, component_id is the smallest doc_id in it."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row of docs."""
    prints = durable(fingerprints(docs, shingle), "fingerprints")
    named = prints.join(classes(prints, radius), "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
