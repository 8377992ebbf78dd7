"""Many keys searched for in many texts at once, over a key table of any size: by hashes of windows or by an Aho-Corasick automaton.

Keys that have `LEAST` bytes or more are searched for by hashes of windows (`windows`), which take some
5 bytes for a byte of keys; shorter ones by an automaton, which takes some 40, and so are all keys of a
table that has short ones and fits `part_bytes` (of UTF-8). A table that outgrows its part (`WIDER` times as
large for windows) is searched for in parts, by key hash, so neither the driver nor a worker ever
holds more than one part's keys. A part's keys are broadcast, texts are dealt over tasks and read once for
each part; they are not tested key by key. Where no key of a part has a space, a key lies between
two spaces of a text or at its ends, so each distinct piece between spaces is searched once for a slice of texts.

Keys are told apart by their whole text. A null text holds no key, a null key is in no text,
an empty key is in every text that is not null.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import windows
from tidewater.operators.lineage import settle, spread, written

#: UTF-8 bytes of the keys of one automaton.
PART_BYTES = 2 << 20
#: Bytes from which on a key is searched for by windows, and how much larger parts are then.
LEAST, WIDER = 6, 32
#: Bytes of texts whose distinct pieces are searched at once.
PIECED = 8 << 20
#: The automaton's keys that a worker used last, ready to search.
_BUILT: dict[str, _Keys] = {}


@dataclass(frozen=True)
class _Keys:
    """One part's keys: a search that meets them in texts (as `windows.met`), their names by place, the bytes of the least, whether one has a space, whether the first is empty."""

    met: Callable[[pa.Array], tuple]
    names: Callable[[np.ndarray], pa.Array]
    least: int
    spaced: bool
    always: bool


def automaton(keys: list[str]) -> ahocorasick.Automaton:
    """Of keys that are not empty; its values are (place in keys, length)."""
    made = ahocorasick.Automaton()
    for at, key in enumerate(keys):
        made.add_word(key, (at, len(key)))
    made.make_automaton()
    return made


def found_in(text: str, made: ahocorasick.Automaton) -> dict[int, list[int]]:
    """For each key of the text, by its place: how often it occurs, overlaps included, and where first, in characters from 0."""
    out: dict[int, list[int]] = {}
    for end, (at, size) in made.iter(text):
        if at in out:
            out[at][0] += 1
        else:
            out[at] = [1, end - size + 1]
    return out


def hits(df: DataFrame, ids: list[str], text: str, keys: DataFrame, key: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(ids, key, n, first): for each row and each distinct key that is part of its text, how often it occurs and where first (in characters from 0)."""
    kind = T.StructType([*(df.schema[c] for c in ids), T.StructField(key, T.StringType()), T.StructField("n", T.LongType()), T.StructField("first", T.LongType())])
    parts = _parts(keys, key, part_bytes)
    slim = _dealt(df.select(*ids, F.col(text).alias("__text")), len(parts))

    def rows(own, keys, at, places, times, firsts):
        return [*(c.take(pa.array(at)) for c in own), keys.names(places), pa.array(times), pa.array(firsts)]

    return reduce(DataFrame.unionByName, [_scan(slim, part, kind, rows) for part in parts])


def lists(df: DataFrame, ids: list[str], text: str, keys: DataFrame, key: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(ids, key, firsts): for each row whose text has a key, its distinct keys as an array in their order and where each is first (in characters from 0).

    A text's keys are put together where they are found; only those of a table of several parts are shuffled.
    """
    parts = _parts(keys, key, part_bytes)
    slim = df.select(*ids, F.col(text).alias("__text"))
    slim, own = (slim, ids) if len(parts) == 1 else (slim.select(F.monotonically_increasing_id().alias("__row"), *slim.columns), ["__row", *ids])
    slim = _dealt(slim, len(parts))
    kind = T.StructType([*(slim.schema[c] for c in own), T.StructField(key, T.ArrayType(T.StringType())), T.StructField("firsts", T.ArrayType(T.LongType()))])

    def rows(own, keys, at, places, times, firsts):
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        ends = pa.array(np.append(starts, len(at)), pa.int32())
        return [*(c.take(pa.array(at[starts])) for c in own), pa.ListArray.from_arrays(ends, keys.names(places)), pa.ListArray.from_arrays(ends, pa.array(firsts))]

    found = reduce(DataFrame.unionByName, [_scan(slim, part, kind, rows) for part in parts])
    if len(parts) == 1:
        return found
    met = F.sort_array(F.flatten(F.collect_list(F.arrays_zip(F.col(key).alias("key"), F.col("firsts").alias("first")))))
    found = found.groupBy("__row").agg(*(F.first(c).alias(c) for c in ids), met.alias("__met"))
    return found.select(*ids, F.col("__met.key").alias(key), F.col("__met.first").alias("firsts"))


def _parts(keys: DataFrame, key: str, part_bytes: int) -> list:
    """The distinct keys in parts, as broadcasts of a table of windows or of an automaton's keys; one at least."""
    sc = keys.sparkSession.sparkContext
    distinct = settle(keys.select(F.col(key).alias("__key")).where("__key is not null").distinct())
    size = F.octet_length("__key")
    least, whole, short = distinct.agg(F.min(size), F.sum(size), F.sum(F.when(size < LEAST, F.greatest(size, F.lit(1))))).first()

    def dealt(keys: DataFrame, size: int, most: int) -> list[DataFrame]:
        n = -(-size // most)
        return [keys.where(F.pmod(F.xxhash64("__key"), F.lit(n)) == part) for part in range(n)]

    if least is None or (least < LEAST and whole <= part_bytes):
        short, long = [distinct], []
    else:
        short, long = dealt(distinct.where(size < LEAST), short or 0, part_bytes), dealt(distinct.where(size >= LEAST), whole, part_bytes * WIDER)
    made = [sc.broadcast(pickle.dumps(sorted(r["__key"] for r in part.toLocalIterator()))) for part in short]
    return made + [sc.broadcast(windows.table(part.toArrow().column(0))) for part in long]


def _dealt(slim: DataFrame, parts: int) -> DataFrame:
    """Texts that are not null over tasks, as files may have few row groups; written once where they are read several times."""
    slim = spread(slim.where("__text is not null"))
    return slim if parts == 1 else written(slim)


def _ready(shared, token: str) -> _Keys:
    """A part's keys in a worker, which builds an automaton once."""
    t = shared.value
    if isinstance(t, windows.Table):
        return _Keys(lambda texts: windows.met(texts, t), t.names, min(t.sizes, default=1), bool((t.data == ord(" ")).any()), False)
    if token not in _BUILT:
        _BUILT.clear()
        keys = pickle.loads(t)
        always = keys[:1] == [""]  # they are sorted
        made, names = automaton(keys[always:]), pa.array(keys, pa.string())

        def met(texts: pa.Array) -> tuple:
            found = [(row, at + always, n, first) for row, value in enumerate(texts.to_pylist() if len(keys) > always else []) for at, (n, first) in found_in(value, made).items()]
            return tuple(np.array(found, np.int64).reshape(-1, 4).T)

        _BUILT[token] = _Keys(met, lambda places: names.take(pa.array(places)), min((len(k.encode()) for k in keys[always:]), default=1), any(" " in k for k in keys), always)
    return _BUILT[token]


def _met(texts: pa.Array, keys: _Keys) -> Iterator[tuple]:
    """Slices that cover all texts, where each begins and stops, with (row of the slice, place of the key, n, first), in the order of rows and keys."""
    for start, stop in windows.slices(texts, None if keys.spaced else PIECED):
        some = texts.slice(start, stop - start)
        found = keys.met(some) if keys.spaced else windows.in_pieces(some, keys.least, keys.met)
        if keys.always:
            every = np.arange(len(some)), np.zeros(len(some), np.int64), pc.utf8_length(some).to_numpy().astype(np.int64) + 1, np.zeros(len(some), np.int64)
            found = tuple(np.concatenate(both) for both in zip(every, found))
        yield start, stop, windows.merged(*found)


def _scan(slim: DataFrame, shared, kind: T.StructType, rows: Callable[..., list[pa.Array]]) -> DataFrame:
    """What `rows` makes of all texts (the last column) and one part's keys, which are broadcast."""
    token = uuid.uuid4().hex

    def run(batches):
        keys = _ready(shared, token)
        for batch in batches:
            *own, texts = batch.columns
            for start, stop, found in _met(texts, keys):
                yield pa.RecordBatch.from_arrays(rows([c.slice(start, stop - start) for c in own], keys, *found), kind.names)

    return slim.mapInArrow(run, kind)


def theta_contains(df: DataFrame, column: str, table: DataFrame, key: str, order: str, place: str = "place", count: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows with each table row whose key is part of the column, its place from 1 among them in the table's order and, if named, how many they are.

    Repeated rows each get their own, a null column none; the table's columns come after the row's.
    """
    numbered = written(df.withColumn("__row", F.monotonically_increasing_id()))
    met = hits(numbered, ["__row"], column, table, key, part_bytes).select("__row", F.col(key).alias("__met")).join(table, F.col("__met") == F.col(key)).drop("__met")
    own = Window.partitionBy("__row")  # as many rows as the table has at most
    met = met.withColumn(place, F.row_number().over(own.orderBy(order, key)))
    met = met.withColumn(count, F.count("*").over(own)) if count else met
    return numbered.join(met, "__row").drop("__row")
