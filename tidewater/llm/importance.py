"""Importance resampling: documents are drawn by how much their words are like those of a target.

Equal texts are grouped by the whole text first. Each text's hashed features are made once and
its counts are multiplied by the number of its copies; a feature's gain is the logarithm of how
much more often the target has its bucket, a text's weight is the mean gain of its features.
Weights are joined back to the rows, which then get noise of their own (Gumbel's, from a hash of
the id), and the highest scores are drawn.

Both models are `buckets` counts, so they are collected and broadcast (80 kB). Scores are whole
thousandths of a logarithm, some 100,000 values at most whatever the input: ranks come from a
histogram of scores and, among rows of one score, their ids.

Edge cases: a null text has no words; a text without features weighs 0; repeated rows are copies,
each with its own row and, having equal ids, equal noise; rows that are the same in all returned
columns are ranked in any order; a null doc_id counts as an empty text in the hash and comes
last among ties; an empty table gives no rows and an empty target gains from counts of 0; only
doc_id and text are read.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut, durable, pieces, table, tidy
from tidewater.llm.decontaminate import words

_FEATURES = "key binary, copies long, n_words long, n_features long, buckets binary, counts binary"


def hashed(sequence: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of each run of 1 to `longest` words: the crc32 of the words with a space between them."""
    spaced, now, out = [b" " + w for w in sequence], list(map(crc32, sequence)), []
    for n in range(1, longest + 1):
        out.append(np.fromiter(now, np.int64, len(now)))
        now = list(map(crc32, spaced[n:], now))  # goes on from the run without its last word
    return np.concatenate(out) % buckets


def features(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """key (of the whole text), copies, n_words, n_features and packed bucket counts of each distinct text."""

    def run(batches):
        for batch in batches:
            for at, texts in pieces(batch, "body"):
                counted = []
                for text in texts:
                    sequence = words(text)
                    found = hashed(sequence, longest, buckets)
                    own, times = np.unique(found, return_counts=True)
                    counted.append((len(sequence), len(found), own.astype("<u4").tobytes(), times.astype("<u4").tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                arrays = [pa.array([c[k] for c in counted], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(texts)) for c in batch.columns[:2]), *arrays], ["key", "copies", "n_words", "n_features", "buckets", "counts"])
            tidy()

    texts = docs.select(F.coalesce("text", F.lit("")).alias("body")).groupBy("body").agg(F.count("*").alias("copies"))
    return texts.select(_key("body").alias("key"), "copies", F.col("body").cast("binary").alias("body")).mapInArrow(run, _FEATURES)


def _key(text):
    return F.unhex(F.sha2(text, 256))


def totals(found: DataFrame, buckets: int) -> np.ndarray:
    """How often the rows hold each bucket, copies included; each task sums its texts and gives a row for each bucket."""

    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for copies, own, times in zip(*(c.to_pylist() for c in batch.columns)):
                sums[np.frombuffer(own, "<u4")] += copies * np.frombuffer(times, "<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(sums)], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in found.select("copies", "buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # `buckets` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, both smoothed by 1."""
    n, m, k = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (n + k) / ((s + 1.0) * (m + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """key, n_words, n_features and weight (the floored mean gain of its features) of each distinct text."""
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        for batch in batches:
            sums = [int((gain[np.frombuffer(own, "<u4")] * np.frombuffer(times, "<u4").astype(np.int64)).sum()) for own, times in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            mean = [s // n if n else 0 for s, n in zip(sums, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(mean, pa.int64())], ["key", "n_words", "n_features", "weight"])

    return found.select("key", "n_words", "n_features", "buckets", "counts").mapInArrow(run, "key binary, n_words long, n_features long, weight long")


def noise(seed: int):
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def draw(scored: DataFrame, percent: int, least_words: int, block: int = 1024) -> DataFrame:
    """scored with rank: 1, 2, 3... down the highest scores, for `percent` of the rows of at least `least_words` words, else null."""
    able = F.col("n_words") >= least_words
    counts = cut(scored.where(able).groupBy("score").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("score") / block)))
    wanted = percent * (counts.agg(F.sum("n")).first()[0] or 0) // 100
    zero = F.lit(0).cast("long")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), zero)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n")).select("block", before(Window.orderBy(F.desc("block"))).alias("outer"))  # a hundred rows or so
    above = counts.select("score", "block", before(Window.partitionBy("block").orderBy(F.desc("score"))).alias("inner")).join(F.broadcast(blocks), "block")
    above = above.select("score", (F.col("inner") + F.col("outer")).alias("above")).where(F.col("above") < wanted)
    met = scored.join(F.broadcast(above), "score", "left")  # bounded by the values that a score can have
    out = [*scored.columns]
    places = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "weight", "n_features")
    place = F.col("above") + F.row_number().over(places)
    drawn = met.where(able & F.col("above").isNotNull()).select(*out, place.alias("rank"))
    rest = met.where(~(able & F.col("above").isNotNull())).select(*out, F.lit(None).cast("long").alias("rank"))
    return drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10000, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row of docs, drawn towards the texts of target."""
    own = durable(features(docs, longest, buckets), "text-features")
    gain = gains(totals(own, buckets), totals(features(target, longest, buckets), buckets))
    rows = docs.select("doc_id", _key(F.coalesce("text", F.lit(""))).alias("key")).join(weights(own, gain), "key").drop("key")
    scored = durable(rows.withColumn("score", F.col("weight") + noise(seed)), "scores")
    return draw(scored, percent, least_words)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
