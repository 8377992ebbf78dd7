"""Periodic runs of words, found by bit-parallel lags, and texts without the repeats.

A run is a stretch of words with a smallest period q that is long enough and that no neighbour
extends. The ids of a text's words are laid out as bit planes, each one big integer; a plane
XOR itself shifted by a lag has the mismatches of that lag, and their OR over all planes is
zero where words a lag apart are the same. An AND with shifts that double isolates the zero
stretches that are long enough. A stretch that a smaller lag has found already is a multiple
of that period.

Two exact steps save lags. Each word of a run occurs as often as the run has periods, so only
stretches of such words are laid out. In a run of period p, a window of p to 2p words comes
again p words on and not before (a smaller step would be a period of the run, by the theorem
of Fine and Wilf), so lags above 8 are tried only if some window's next occurrence is that far
away; so texts of millions of words need no lag for each of their words.

Edge cases: a null or blank text has no words and no runs; a null doc_id is carried like any
other; repeated rows each get their row; a very long text is one row of one task and takes
n log n steps; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import pieces, table, tidy

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Lags up to this one are tried on every stretch.
_SHORT = 8


def numbers(words: list[bytes]) -> np.ndarray:
    """The same number for the same word, from 0 in the order of first occurrence."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def planes(ids: np.ndarray) -> list[int]:
    """Bit b of all ids as one integer, whose bit i is that of word i, for each b."""
    return [int.from_bytes(np.packbits((ids >> b & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for b in range(max(1, int(ids.max()).bit_length()))]


def matches(bits: list[int], n: int, lag: int) -> int:
    """Bit i is set if words i and i + lag of n are the same."""
    differ = 0
    for plane in bits:
        differ |= plane ^ (plane >> lag)
    return ~differ & ((1 << (n - lag)) - 1)


def stretches(ones: int, least: int) -> Iterator[tuple[int, int]]:
    """(first, end) of each stretch of at least `least` set bits that is as long as it can be."""
    begins, have = ones, 1
    while begins and have < least:  # a bit stays if `have` bits from it on are set
        step = min(have, least - have)
        begins &= begins >> step
        have += step
    if begins:
        marks = np.unpackbits(np.frombuffer(begins.to_bytes(begins.bit_length() // 8 + 1, "little"), np.uint8), bitorder="little")
        turns = np.flatnonzero(np.diff(marks, prepend=0, append=0)).tolist()
        for first, last in zip(turns[::2], turns[1::2]):
            yield first, last + have - 1


def lags(ids: np.ndarray) -> list[int]:
    """In ascending order, all lags that may be the period of a run of three periods or more."""
    n, width = len(ids), 1
    found = set(range(1, min(_SHORT, n // 3) + 1))
    while 3 * width // 2 < n:  # windows of `width` words, for periods above half of it
        if width > _SHORT:
            order = np.argsort(ids, kind="stable")
            gaps = np.diff(order)[np.diff(ids[order]) == 0]
            found.update(np.unique(gaps[(2 * gaps > width) & (gaps <= min(width, n // 3))]).tolist())
        if len(ids) <= width:
            break
        ids = np.unique(ids[:-width] * (int(ids.max()) + 1) + ids[width:], return_inverse=True)[1]
        width *= 2
    return sorted(found)


def worth(ids: np.ndarray, least: int, periods: int, rounds: int = 4) -> list[tuple[int, int]]:
    """Stretches that hold all runs: each of their words occurs `periods` times there, or nearly so after `rounds` cuts."""
    left = [(0, len(ids))]
    for _ in range(rounds):
        now = []
        for first, end in left:
            _, at, times = np.unique(ids[first:end], return_inverse=True, return_counts=True)
            turns = np.flatnonzero(np.diff((times[at] >= periods).astype(np.int8), prepend=0, append=0)).tolist()
            now += [(first + a, first + b) for a, b in zip(turns[::2], turns[1::2]) if b - a >= least]
        if now == left:
            break
        left = now
    return left


def runs(ids: np.ndarray, least: int = 24, periods: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` words and `periods` periods, by start and period."""
    found = []
    for first, end in worth(ids, least, periods):
        own = np.unique(ids[first:end], return_inverse=True)[1]
        bits, n, seen = planes(own), end - first, set()
        for lag in lags(own):
            for start, stop in stretches(matches(bits, n, lag), max(1, least - lag, (periods - 1) * lag)):
                if (start, stop + lag) not in seen:
                    seen.add((start, stop + lag))
                    found.append((first + start, stop - start + lag, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeats(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words lies in a run, after that run's first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps)[:n] > 0


def periodic_runs(docs: DataFrame, least: int = 24, periods: int = 3, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and collapsed (the text's words without the repeats, a space between two) of each row.

    change: gives the words to take instead of a row's own, from its doc_id and them.
    """
    if periods < 3:
        raise ValueError("runs of fewer than three periods need other lags")

    def run(batches):
        for batch in batches:
            for at, texts in pieces(batch, "text"):
                ids, counts, flat, ends, collapsed = batch.column(0).slice(at, len(texts)), [], [], [0], []
                for doc_id, text in zip(ids.to_pylist(), texts):
                    words = (text or b"").split()
                    words = change(doc_id, words) if change else words
                    found = runs(numbers(words), least, periods) if len(words) >= least else []
                    gone = repeats(len(words), found).tolist() if found else []
                    counts.append(len(words))
                    flat += found
                    ends.append(len(flat))
                    collapsed.append(b" ".join(w for w, x in zip(words, gone) if not x) if found else b" ".join(words))
                columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
            tidy()

    kind = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T._parse_datatype_string("array<struct<start:bigint,length:bigint,period:bigint>>")), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, kind)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the query's contract puts in place of a row's own: one in ten ids gets a periodic tail."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    period = words[a : a + 1 + (n - a) // (3 + h // 10 % 8)]
    return words[:a] + (period * ((n - a) // len(period) + 1))[: n - a]


def op11_bit_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), change=planted)
    best = F.expr("aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (a, x) -> if(x.length * a.period > a.length * x.period, x, a))")
    line = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
