"""Benchmark decontamination by winnowing.

Documents and items are word sequences. Each sliding window of `window - k + 1` k-grams keeps
its smallest hash, so any shared span of `window` words shares a kept k-gram at the same place
on both sides. Kept k-grams of documents that pass a filter (built from the items' kept k-grams) are extended to the full windows around them; those windows' hashes join
the items' windows. Items shorter than `window` words are one window; their lengths are few
(below `window`), so documents hash every span of such a length that occurs and pass it
through the same kind of filter. Filters grow with the items up to a bound and only save traffic: joins decide.

Edge cases: null texts have no words; items without words have no window; repeated rows each
get their row; repeated item_ids count once; an empty benchmark hits nothing; a null item_id
never occurs in items_sha256 but its windows are hit; only doc_id, item_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import durable, table

#: Lower-cases A-Z; all ASCII but letters and digits separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Hasher:
    """64-bit hashes of words, remembered for up to `most` words."""

    def __init__(self, most: int = 300_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, sequence: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(sequence).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, 7)
        return np.fromiter(map(known.__getitem__, sequence), np.uint64, len(sequence))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ hashes[i : len(hashes) - n + 1 + i]) * _STEP
            out ^= out >> np.uint64(29)
        return out * _MIX


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Whether each hash is the smallest of some window of `width` neighbours; ties all stay."""
    if len(hashes) < width:
        return np.zeros(len(hashes), bool)
    low = np.lib.stride_tricks.sliding_window_view(hashes, width).min(axis=1)
    kept = np.zeros(len(hashes), bool)
    for i in range(width):
        kept[i : i + len(low)] |= hashes[i : i + len(low)] == low
    return kept


class Filter:
    """A Bloom filter of 2 ** bits bits, three probes."""

    def __init__(self, bits: int = 24):
        self.bits, self.cells = bits, np.zeros(1 << (bits - 3), np.uint8)

    def _probes(self, keys: np.ndarray):
        for shift in (0, 20, 40):
            at = (keys >> np.uint64(shift)) & np.uint64((1 << self.bits) - 1)
            yield at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    def add(self, keys: np.ndarray) -> None:
        for cell, bit in self._probes(keys):
            np.bitwise_or.at(self.cells, cell, bit)

    def has(self, keys: np.ndarray) -> np.ndarray:
        ok = np.ones(len(keys), bool)
        for cell, bit in self._probes(keys):
            ok &= (self.cells[cell] & bit) != 0
        return ok


def _item_windows(items: DataFrame, window: int, k: int) -> DataFrame:
    """(item_id, n, key, kept): the windows of items, and with n = 0 their kept k-grams."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                h = hasher(words(batch.column(1)[i].as_py()))
                if not len(h):
                    continue
                n = min(window, len(h))
                keys = [(n, np.unique(grams(h, n)))]
                if n == window:
                    g = grams(h, k)
                    keys.append((0, np.unique(g[winnow(g, window - k + 1)])))
                for size, found in keys:
                    ids = pa.array([batch.column(0)[i].as_py()] * len(found), batch.column(0).type)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(found), size, np.int32)), pa.array(found.view(np.int64))], ["item_id", "n", "key"])

    kind = T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("n", T.IntegerType()), T.StructField("key", T.LongType())])
    return items.select("item_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, kind)


def _filters(windows: DataFrame, bits: int) -> tuple[Filter, Filter]:
    """Of kept k-grams, and of windows. Each task fills filters of fixed size; they are joined by OR."""

    def run(batches):
        grown = (Filter(bits), Filter(bits))
        for batch in batches:
            n, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            grown[0].add(keys[n == 0])
            grown[1].add(keys[n > 0])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([f.cells.tobytes() for f in grown], pa.binary())], ["which", "cells"])

    out = (Filter(bits), Filter(bits))
    for row in windows.select("n", "key").coalesce(8).mapInArrow(run, "which int, cells binary").toLocalIterator():
        out[row["which"]].cells |= np.frombuffer(bytes(row["cells"]), np.uint8)
    return out


def candidate_windows(h: np.ndarray, window: int, k: int, short: list[int], kept: Filter, whole: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, n, key) of a document's windows that may be an item's."""
    starts, sizes, keys = [], [], []
    if len(h) >= window:
        g = grams(h, k)
        at = np.flatnonzero(winnow(g, window - k + 1))
        at = at[kept.has(g[at])]
        if len(at):
            around = np.unique((at[:, None] - np.arange(window - k + 1)[None, :]).ravel())
            around = around[(around >= 0) & (around <= len(h) - window)]
            full = grams(h, window)[around]
            ok = whole.has(full)
            starts.append(around[ok]), keys.append(full[ok]), sizes.append(np.full(int(ok.sum()), window, np.int32))
    for n in short:
        g = grams(h, n)
        at = np.flatnonzero(whole.has(g))
        starts.append(at), keys.append(g[at]), sizes.append(np.full(len(at), n, np.int32))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(keys)


def hits(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 7, filter_bits: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, spans (hit windows as start and end, in words), items (ids as text, sorted) of each row, and the columns named in carry."""
    spark = docs.sparkSession
    windows = durable(_item_windows(items, window, k), "item-windows")
    short = sorted(r["n"] for r in windows.where(f"n > 0 and n < {window}").select("n").distinct().collect())  # below `window`, so a few at most
    bits = filter_bits or min(27, max(16, (16 * windows.count()).bit_length()))  # some 16 bits a window; beyond 2^27 (16 MB) more windows pass, and the join decides
    shared = spark.sparkContext.broadcast(_filters(windows, bits))

    def run(batches):
        hasher = Hasher()
        kept, whole = shared.value
        hit = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int32()), ("key", pa.int64())]))
        for batch in batches:
            texts, counts, ends, parts = batch.column("__text"), [], [0], []
            for i in range(len(texts)):
                sequence = words(texts[i].as_py())
                counts.append(len(sequence))
                parts.append(candidate_windows(hasher(sequence), window, k, short, kept, whole))
                ends.append(ends[-1] + len(parts[-1][0]))
            rows = pa.StructArray.from_arrays([pa.array(np.concatenate([p[0] for p in parts]).astype(np.int64)), pa.array(np.concatenate([p[1] for p in parts])), pa.array(np.concatenate([p[2] for p in parts]).view(np.int64))], ["start", "n", "key"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows).cast(hit)], [*batch.schema.names[:-1], "n_words", "hits"])

    own = ["doc_id", *carry]
    kind = T.StructType([*(docs.schema[c] for c in own), T.StructField("n_words", T.LongType()), T.StructField("hits", T._parse_datatype_string("array<struct<start:bigint,n:int,key:bigint>>"))])
    seen = docs.select(*own, F.col("text").cast("binary").alias("__text")).mapInArrow(run, kind)
    seen = durable(seen.withColumn("row", F.monotonically_increasing_id()), "doc-windows")  # the ids stay as written
    met = seen.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.start", "h.n", "h.key")
    met = met.join(windows.where("n > 0"), ["n", "key"]).select("row", "start", "n", "item_id")
    spans = met.select("row", "start", "n").distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans"))
    names = met.where("item_id is not null").select("row", F.col("item_id").cast("string").alias("item")).distinct()
    names = names.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = seen.drop("hits").join(spans, "row", "left").join(names, "row", "left")
    none = lambda kind: F.array().cast(kind)
    return out.select(*own, "n_words", F.coalesce("spans", none("array<struct<start:bigint,end:bigint>>")).alias("spans"), F.coalesce("items", none("array<string>")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 7, filter_bits: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row, and the columns named in carry."""
    step = lambda acc, x: F.struct(
        (acc["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(acc["end"], x["start"]))).alias("hit"), F.greatest(acc["end"], x["end"]).alias("end")
    )
    total = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end")), step)["hit"]
    found = hits(docs, items, window, k, filter_bits, carry)
    return found.select(
        "doc_id", *carry, "n_words", total.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
