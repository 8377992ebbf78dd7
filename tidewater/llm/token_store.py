"""A content-addressed store of token ids.

A rolling hash over the last `_SPAN` ids cuts each document's id stream into chunks, so equal
passages give equal chunks wherever they stand. A chunk is stored once, under the digest of
its ids. A document's recipe lists its chunks' digests; documents lie in ascending doc_id
order in range-partitioned parts. A document's root is that over its fields (doc_id, start,
n_tokens, sizes) and its chunks, a part's root that over its documents and its totals, the
head's that over the parts: so nothing that is returned can change without a root's.

Files below one path: chunks/ (digest, n, ids), recipes/kind=doc (part, place, doc_id, start,
n_tokens, digests, root) and kind=part (part, n_docs, n_tokens, root), head/. Ids are
little-endian, 2 bytes wide if the vocabulary has at most 65,536 entries, else 4.

Edge cases: a null or empty text is the end id alone; null doc_ids come first and equal
doc_ids by their n_tokens and digests, so repeated rows each get their place; an empty table
gives a store of no documents; only doc_id and text are read. A chunk or root that does not
match what it stands for raises an error when it is read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import fresh_path, remove, small_batches, table, tidy
from tidewater.llm.tokens import Encoder, default_tokenizer, parts

#: Fixed values of the format: ids the rolling hash sees, least and most ids of a chunk, bits that are zero at a cut.
_SPAN, _LEAST, _MOST, _BITS = 16, 128, 2048, 9


def _gear(n: int) -> np.ndarray:
    """A 64-bit value for each id, from a counter through a mixer."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))


def cut_points(ids: np.ndarray, gear: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream; they depend on nothing but nearby ids and the end before."""
    if len(ids) <= _LEAST:
        return [len(ids)] if len(ids) else []
    h, width = gear[ids], 1
    with np.errstate(over="ignore"):
        while width < _SPAN:
            h[width:] += h[:-width] << np.uint64(width)
            width *= 2
    marks = np.flatnonzero((h >> np.uint64(64 - _BITS)) == 0) + 1
    ends, start, n = [], 0, len(ids)
    while n - start > _LEAST:
        at = int(np.searchsorted(marks, start + _LEAST))
        end = min(int(marks[at]) if at < len(marks) else n, start + _MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def digest_of(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary tree over the leaves; an odd one moves up as it is."""
    level = leaves or [b""]
    while len(level) > 1:
        level = [digest_of(b"\x01" + b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return digest_of(b"\x02" + level[0])


def recipe_root(doc_id: object, start: int, n_tokens: int, sizes: bytes, digests: list[bytes]) -> bytes:
    """sizes: as 32-bit integers."""
    return digest_of(merkle(digests) + f"{doc_id} {start} {n_tokens} ".encode() + sizes)


def _spread(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of lists one after another, and where each list begins, with the end of the last."""
    at = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), at - at[0]


def _size_bytes(sizes: pa.ListArray) -> list[bytes]:
    flat, at = _spread(sizes)
    data, at = flat.to_numpy(zero_copy_only=False).astype("<i4").tobytes(), (4 * at).tolist()
    return [data[x:y] for x, y in zip(at, at[1:])]


def part_root(docs: bytes, n_docs: int, n_tokens: int) -> bytes:
    return digest_of(b"\x03" + docs + f"{n_docs} {n_tokens}".encode())


class RunningMerkle:
    """The root of leaves that come one by one, in memory of the tree's height."""

    def __init__(self) -> None:
        self.peaks: list[tuple[int, bytes]] = []

    def add(self, leaf: bytes) -> None:
        height = 0
        while self.peaks and self.peaks[-1][0] == height:
            leaf = digest_of(b"\x01" + self.peaks.pop()[1] + leaf)
            height += 1
        self.peaks.append((height, leaf))

    def root(self) -> bytes:
        return digest_of(b"\x02" + b"".join(p for _, p in self.peaks))


def _streams(texts: pa.Array, encoder: Encoder, end_id: int) -> Iterator[tuple[range, list[np.ndarray]]]:
    """(rows, their ids with the end id) of runs of whole texts."""
    end, late = np.array([end_id], encoder.kind), []
    for segments, rows in parts(texts):
        ids, sizes = encoder.encode(segments)
        if len(rows) == 1:  # perhaps a segment of a longer text
            if late and late[0] != rows[0]:
                yield range(late[0], late[0] + 1), [np.concatenate([*late[1:], end])]
                late = []
            late = late or [int(rows[0])]
            late.append(ids)
            continue
        if late:
            yield range(late[0], late[0] + 1), [np.concatenate([*late[1:], end])]
            late = []
        stops = np.cumsum(sizes)
        yield range(int(rows[0]), int(rows[-1]) + 1), [np.concatenate([ids[a:b], end]) for a, b in zip(stops - sizes, stops)]
    if late:
        yield range(late[0], late[0] + 1), [np.concatenate([*late[1:], end])]


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, sizes and digests of its chunks, and those chunks that its task met for the first time."""

    fresh_kind = pa.list_(pa.struct([("digest", pa.binary()), ("n", pa.int32()), ("ids", pa.binary())]))

    def run(batches):
        met: set[bytes] = set()
        encoder = Encoder.of(tokenizer)
        gear = _gear(max(encoder.tokenizer.get_vocab_size(), end_id + 1))
        for batch in batches:
            for rows, streams in _streams(batch.column(1), encoder, end_id):
                n_tokens, sizes, digests, ends, new = [], [], [], [0], ([], [], [])
                for ids in streams:
                    data, start, own_sizes, own = memoryview(ids).cast("B"), 0, [], []
                    for stop in cut_points(ids, gear):
                        chunk = data[start * ids.itemsize : stop * ids.itemsize]
                        d = digest_of(chunk)
                        own.append(d), own_sizes.append(stop - start)
                        if d not in met:
                            if len(met) > 200_000:  # a chunk that is met again is written again, and stored once all the same
                                met.clear()
                            met.add(d)
                            for column, value in zip(new, (d, stop - start, chunk)):
                                column.append(value)
                        start = stop
                    n_tokens.append(len(ids)), sizes.append(own_sizes), digests.append(own), ends.append(len(new[0]))
                fresh = pa.StructArray.from_arrays([pa.array(new[0], pa.binary()), pa.array(new[1], pa.int32()), pa.array(new[2], pa.binary())], ["digest", "n", "ids"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(rows.start, len(rows)), pa.array(n_tokens, pa.int64()), pa.array(sizes, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.binary())), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fresh).cast(fresh_kind)],
                    ["doc_id", "n_tokens", "sizes", "digests", "fresh"],
                )
            tidy()

    kind = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n_tokens long, sizes array<int>, digests array<binary>, fresh array<struct<digest:binary,n:int,ids:binary>>").fields])
    return docs.select("doc_id", "text").mapInArrow(run, kind)


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0) -> str:
    """Writes the store of docs below path and returns the head's root in hex."""
    spark = docs.sparkSession
    staged_at = fresh_path(spark, "encoded")
    with small_batches(spark):
        _encoded(docs, tokenizer or default_tokenizer(), end_id).write.option("compression", "zstd").parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    chunks = staged.where(F.size("fresh") > 0).select(F.explode("fresh").alias("c")).select("c.digest", "c.n", "c.ids")
    chunks.repartition("digest").dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{path}/chunks")

    def ordered(batches):
        part, place, start, tree = TaskContext.get().partitionId(), 0, 0, RunningMerkle()
        names = ["kind", "part", "place", "doc_id", "start", "n_tokens", "sizes", "digests", "root"]
        ids = None
        for batch in batches:
            n, ids = batch.num_rows, batch.column(0)
            counts = batch.column(1).to_numpy()
            starts = start + np.cumsum(counts) - counts
            roots = list(map(recipe_root, ids.to_pylist(), starts.tolist(), counts.tolist(), _size_bytes(batch.column(2)), batch.column(3).to_pylist()))
            for r in roots:
                tree.add(r)
            yield pa.RecordBatch.from_arrays([pa.array(["doc"] * n), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), ids, pa.array(starts), batch.column(1), batch.column(2), batch.column(3), pa.array(roots, pa.binary())], names)
            place, start = place + n, start + int(counts.sum())
        if ids is not None:
            none = lambda kind: pa.nulls(1, kind)
            yield pa.RecordBatch.from_arrays([pa.array(["part"]), pa.array([part], pa.int32()), pa.array([place]), none(ids.type), none(pa.int64()), pa.array([start]), none(pa.list_(pa.int32())), none(pa.list_(pa.binary())), pa.array([part_root(tree.root(), place, start)], pa.binary())], names)

    kind = T.StructType([*T._parse_datatype_string("kind string, part int, place long").fields, docs.schema["doc_id"], *T._parse_datatype_string("start long, n_tokens long, sizes array<int>, digests array<binary>, root binary").fields])
    slim = staged.select("doc_id", "n_tokens", "sizes", "digests")
    slim = slim.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "n_tokens", "digests")
    slim.mapInArrow(ordered, kind).write.option("compression", "zstd").partitionBy("kind").parquet(f"{path}/recipes")
    remove(spark, staged_at)
    head = merkle([bytes(r["root"]) for r in _parts(spark, path).orderBy("part").select("root").collect()])  # a row for each part
    spark.createDataFrame([(head.hex(),)], "root string").coalesce(1).write.parquet(f"{path}/head")
    return head.hex()


def _recipes(spark: SparkSession, path: str, kind: str) -> DataFrame:
    shape = "part int, place long, doc_id long, start long, n_tokens long, sizes array<int>, digests array<binary>, root binary, kind string"
    found = spark.read.option("basePath", f"{path}/recipes").parquet(f"{path}/recipes") if _any(spark, path) else spark.createDataFrame([], shape)
    return found.where(F.col("kind") == kind)


def _any(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/recipes/kind=part")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """part, n_docs, n_tokens, offset (ids of all parts before it), root: as many rows as range partitions were written."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = _recipes(spark, path, "part").select("part", F.col("place").alias("n_docs"), "n_tokens", "root")
    return parts.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def _checked_chunks(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(digest, n, crc), and ids if wanted, of each stored chunk, after its ids were hashed anew; crc: of them as 32-bit ids."""
    chunks = spark.read.parquet(f"{path}/chunks")

    def run(batches):
        for batch in batches:
            crcs = []
            for d, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if digest_of(ids) != d:
                    raise ValueError(f"chunk {d.hex()} does not match its digest")
                crcs.append(zlib.crc32(np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crcs, pa.int64()), *more(batch)], names)

    more = lambda batch: [batch.column(2)] if with_ids else []
    names = ["digest", "n", "crc", "ids"] if with_ids else ["digest", "n", "crc"]
    return chunks.select("digest", "n", "ids").mapInArrow(run, "digest binary, n int, crc long" + (", ids binary" if with_ids else ""))


#: What a recipe's root is made of.
_FIELDS = ("doc_id", "start", "n_tokens", "sizes", "digests")


def _refuse_changed(batch: pa.RecordBatch) -> None:
    """ValueError if the root of a recipe is not that of its fields and digests, or its sizes are not its ids'."""
    column = lambda name: batch.column(name).to_pylist()
    flat, at = _spread(batch.column("sizes"))
    upto = np.concatenate([[0], np.cumsum(flat.to_numpy(zero_copy_only=False))])
    right = (upto[at[1:]] - upto[at[:-1]]) == batch.column("n_tokens").to_numpy(zero_copy_only=False)
    again = map(recipe_root, column("doc_id"), column("start"), column("n_tokens"), _size_bytes(batch.column("sizes")), column("digests"))
    for i, (root, found) in enumerate(zip(column("root"), again)):
        if found != root or not right[i]:
            raise ValueError(f"recipe {batch.column('place')[i]} of part {batch.column('part')[i]} does not match its root")


def _checked_recipes(recipes: DataFrame) -> DataFrame:
    """recipes, after the root of each was computed anew."""

    def run(batches):
        for batch in batches:
            _refuse_changed(batch)
            yield batch

    return recipes.mapInArrow(run, recipes.schema)


def _check_roots(spark: SparkSession, path: str) -> None:
    if not verify(spark, path):
        raise ValueError(f"the recipes of {path} do not match the roots of their parts and the head")


def _times(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 32 x 32 bit matrix, by its columns, times each value."""
    out = np.zeros(values.shape, np.uint32)
    for bit in range(32):
        out ^= np.where((values >> np.uint32(bit)) & np.uint32(1), operator[bit], np.uint32(0))
    return out


def crc_shift(crcs: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What each crc32 adds to that of a longer text in which so many bytes follow it."""
    one = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint32)  # one zero bit more
    for _ in range(3):
        one = _times(one, one)
    out, left = crcs.astype(np.uint32), zeros.astype(np.int64)
    while left.any():
        out = np.where(left & 1, _times(one, out), out)
        one, left = _times(one, one), left >> 1
    return out


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document from the files.

    Each chunk is hashed once where it is stored; a document's checksum is put together from
    its chunks' by their places (crc32 is linear), so no ids are shuffled. Roots of parts and
    the head are checked first, those of documents on the way.
    """
    _check_roots(spark, path)

    def spread(batches):
        names = ["part", "place", "digest", "n", "after"]
        for batch in batches:
            _refuse_changed(batch)
            sizes, at = _spread(batch.column("sizes"))
            n = sizes.to_numpy(zero_copy_only=False).astype(np.int64)
            upto, times = np.concatenate([[0], np.cumsum(n)]), np.diff(at)
            part, place = (np.repeat(batch.column(c).to_numpy(), times) for c in ("part", "place"))
            after = np.repeat(upto[at[1:]], times) - upto[1:]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(place, pa.int64()), batch.column("digests").flatten(), sizes, pa.array(after)], names)

    @F.pandas_udf("long")
    def shifted(crc, after):
        import pandas as pd

        return pd.Series(crc_shift(crc.to_numpy(), 4 * after.to_numpy()).astype(np.int64))

    recipes = _recipes(spark, path, "doc").select("part", "place", "doc_id", "start", "n_tokens", "sizes", "digests", "root")
    uses = recipes.mapInArrow(spread, "part int, place long, digest binary, n int, after long")
    found = uses.join(_checked_chunks(spark, path).withColumnRenamed("n", "stored"), "digest", "left")
    whole = F.when((F.col("stored") != F.col("n")) | F.col("crc").isNull(), F.raise_error(F.lit("a chunk is missing or has another length"))).otherwise(shifted(F.coalesce("crc", F.lit(0)), "after"))
    sums = found.select("part", "place", "n", whole.cast("long").alias("x")).groupBy("part", "place").agg(F.bit_xor("x").alias("ids_crc32"), F.sum("n").alias("stored"))
    out = recipes.select("part", "place", "doc_id", "start", "n_tokens").join(sums, ["part", "place"]).join(_parts(spark, path).select("part", "offset"), "part")
    return out.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def verify(spark: SparkSession, path: str) -> bool:
    """Whether each part's root and totals, and the head's root, follow from the documents' roots."""

    def run(batches):
        tree = {}
        for batch in batches:
            for part, root, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = tree.setdefault(part, [RunningMerkle(), 0, 0])
                own[0].add(root)
                own[1], own[2] = own[1] + 1, own[2] + n
        columns = [list(tree), [part_root(t.root(), n, total) for t, n, total in tree.values()], [n for _, n, _ in tree.values()], [total for _, _, total in tree.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.binary(), pa.int64(), pa.int64()))], ["part", "again", "docs", "tokens"])

    docs = _recipes(spark, path, "doc").select("part", "root", "n_tokens", "place").repartition("part").sortWithinPartitions("part", "place")
    again = docs.select("part", "root", "n_tokens").mapInArrow(run, "part int, again binary, docs long, tokens long")
    parts = _parts(spark, path)
    bad = parts.join(again, "part", "left").where("not (root <=> again and n_docs <=> docs and n_tokens <=> tokens)").count()
    head = merkle([bytes(r["root"]) for r in parts.orderBy("part").select("root").collect()]).hex()
    return bad == 0 and spark.read.parquet(f"{path}/head").first()["root"] == head


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (array of int) of each document, its chunks joined in order; all roots and digests are checked."""
    _check_roots(spark, path)
    recipes = _recipes(spark, path, "doc")
    uses = _checked_recipes(recipes.select("part", "place", "root", *_FIELDS)).select("part", "place", F.posexplode("digests").alias("at", "digest"))
    chunks = _checked_chunks(spark, path, with_ids=True).select("digest", "n", "ids")
    found = F.when(F.col("ids").isNull(), F.raise_error(F.lit("a chunk is missing"))).otherwise(F.col("ids"))
    met = uses.join(chunks, "digest", "left").groupBy("part", "place").agg(F.sort_array(F.collect_list(F.struct("at", "n", found.cast("binary").alias("ids")))).alias("c"))

    @F.pandas_udf("array<int>")
    def unpack(c):
        return c.map(lambda x: np.concatenate([np.frombuffer(y["ids"], "<u2" if len(y["ids"]) == 2 * y["n"] else "<u4").astype(np.int32) for y in x]))

    out = recipes.select("part", "place", "doc_id", "start").join(met, ["part", "place"]).join(_parts(spark, path).select("part", "offset"), "part")
    return out.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), unpack("c").alias("ids"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
