"""Language-model scores from a probabilistic suffix tree over words.

A text is a start, its words in lower case and an end; each symbol (a word or the end) is
predicted from the longest suffix of its past, of up to two symbols, that is a state of the
tree. The root gives (c + 1) / (N + V + 1). A context seen N times gives a symbol that it was
followed by n >= 2 times (n + (smoothing + N - M) p) / (N + smoothing), p being the
probability in the longest shorter state and M the occurrences of all such symbols; a symbol
that followed once counts as unseen there, and its mass goes to p. A context is a state if its
distribution diverges from that of its parent by more than chance gives: twice the
log-likelihood gain exceeds the number u of its symbols by `tests` times sqrt(2 u). The gain is
that of n + smoothing * p for symbols seen twice, and of their mass for the others. Nothing
is bounded by the size of the corpus: every context of it is counted and tested.

How: texts are packed into chunks of some MB. In three rounds (words, contexts
of one symbol, contexts of two) each chunk asks for what it needs, sorted and packed, a row
for each chunk and bucket of keys; a bucket's task sums the counts of all chunks, tests its
contexts and answers each chunk. A context with more than a 1024th of all symbols is spread
over all buckets and its sums are added up by the chunks; there are fewer than 256 of those.
Context totals need no round: a context occurs as often as the run that it is. No row is ever
made for each symbol, and nothing is broadcast or collected.

Edge cases: a null or blank text is the end alone; without training rows N = V = 0 and every
probability is 1; repeated rows count and are scored each; a very long text lies in several
chunks, each with the two symbols before it; an empty table gives no rows; only doc_id and
text (and what says which rows to learn from) are read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import split_bucket, table, tidy
from tidewater.llm.tokens import spans

#: The marks at the start and end of a text, as the hashes that words have; white space is part of no word.
_START, _END = (xxhash.xxh64_intdigest(x, 11) for x in (b" ", b"\n"))
_GAP = re.compile(r"[ \t\n\x0b\x0c\r]")
#: What a probability is rounded to in the tests of contexts: so many steps for each halving.
_STEPS = 8
#: A context is hot if it has more than this part of all symbols; there are fewer such contexts than that.
_HOT = 256


# ---- packed arrays


def packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers from 0 in few bytes: differences if they ascend, byte by byte, compressed."""
    v = np.ascontiguousarray(values).astype(np.uint64)
    if ascending and len(v):
        v = np.concatenate([v[:1], np.diff(v)])
    width = (int(v.max()).bit_length() + 7) // 8 if len(v) else 0
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<IB", len(v), width) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    n, width = struct.unpack_from("<IB", data)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[5:]), np.uint8).reshape(width, n)
    v = np.zeros((n, 8), np.uint8)
    v[:, :width] = planes.T
    v = v.reshape(-1).view(np.uint64)
    return np.cumsum(v, dtype=np.uint64) if ascending else v


def mixed(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of numbers side by side."""
    out = np.uint64(0)
    with np.errstate(over="ignore"):
        for x in parts:
            out = (out ^ x) * np.uint64(0x9E3779B97F4A7C15)
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out = out ^ (out >> np.uint64(32))
    return out


# ---- chunks of texts


def _segments(texts: pa.Array, most: int) -> Iterator[tuple[pa.Array, np.ndarray, bool, bool]]:
    """(texts, their rows, begins, ends): runs of about `most` bytes; a longer text comes in segments cut at white space."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(texts):
        run = int(np.searchsorted(np.cumsum(sizes[at:]), most, "right"))
        if run:
            yield texts.slice(at, run), np.arange(at, at + run), True, True
            at += run
            continue
        text, start = texts[at].as_py(), 0
        while start < len(text):
            gap = _GAP.search(text, start + most // 4)
            stop = gap.start() + 1 if gap else len(text)
            yield pa.array([text[start:stop]], pa.string()), np.array([at]), start == 0, stop == len(text)
            start = stop
        at += 1


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes of the words, place of each word among them, words of each text)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    words, at = coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 11) for w in words), np.uint64, len(words))
    there = np.array([len(w) > 0 for w in words], bool)[at] if len(words) else np.zeros(0, bool)
    of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    return hashes, at[there], np.bincount(of[there], minlength=len(texts))


_CHUNK = "chunk long, uids array<long>, learned array<boolean>, leads array<int>, sizes array<int>, vocabulary binary, met binary, codes binary"


def _by_count(met: np.ndarray) -> np.ndarray:
    return np.argsort(-met.astype(np.int64), kind="stable")


def chunks(docs: DataFrame, learn: Column, piece: int) -> DataFrame:
    """Texts in chunks: vocabulary (ascending hashes), met (how often each occurs), codes of each segment's leading symbols and its own, sizes (own symbols).

    Codes are places in the vocabulary by how often its words occur, so that most are small.
    """
    own = [f.name for f in docs.schema.fields if f.name == "doc_id"]

    def run(batches):
        part, n_chunks, row = TaskContext.get().partitionId(), 0, 0
        tail = np.zeros(0, np.uint64)
        for batch in batches:
            for texts, rows, begins, ends in _segments(batch.column(2).fill_null(""), piece):
                hashes, at, counts = _hashed(texts)
                n_lead = 1 if begins else len(tail)
                wide = counts + n_lead + ends
                first = np.cumsum(wide) - wide
                out = np.empty(int(wide.sum()), np.uint64)
                out[spans(first + n_lead, counts)] = hashes[at]
                out[spans(first, np.full(len(first), n_lead))] = np.tile(np.array([_START], np.uint64) if begins else tail, len(first))
                if ends:
                    out[first + wide - 1] = np.uint64(_END)
                tail = out[-2:]
                vocabulary, codes, met = np.unique(out, return_inverse=True, return_counts=True)
                rank = np.empty(len(met), np.int64)
                rank[_by_count(met)] = np.arange(len(met))
                learned = batch.column(1).take(pa.array(rows))
                ids = batch.column(0).take(pa.array(rows))
                one = lambda x, kind: pa.array([x], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), ids), pa.array([(part << 33) + n_chunks]), one((part << 33) + row + rows, pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), learned), one(np.full(len(rows), n_lead), pa.int32()), one(wide - n_lead, pa.int32()),
                        pa.array([packed(vocabulary, True)], pa.binary()), pa.array([packed(met)], pa.binary()), pa.array([packed(rank[codes])], pa.binary()),
                    ],
                    ["doc_ids", "chunk", "uids", "learned", "leads", "sizes", "vocabulary", "met", "codes"],
                )
                n_chunks += 1
            row += batch.num_rows
            tidy()

    kind = T.StructType([T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), *T._parse_datatype_string(_CHUNK).fields])
    return docs.select(*own, F.coalesce(learn, F.lit(False)).alias("__learn"), F.col("text").alias("__text")).mapInArrow(run, kind)


class Chunk:
    """A chunk and, round by round, what it has asked and been told."""

    def __init__(self, row: dict, buckets: int, smoothing: float):
        self.buckets, self.smoothing = buckets, smoothing
        self.hashes = unpacked(row["vocabulary"], True)
        codes = _by_count(unpacked(row["met"])).astype(np.int32)[unpacked(row["codes"]).astype(np.int32)]
        leads, sizes = np.array(row["leads"], np.int64), np.array(row["sizes"], np.int64)
        first = np.cumsum(leads + sizes) - leads - sizes
        after = np.ones(len(codes), bool)
        after[first[sizes + leads > 0]] = False
        lead = np.zeros(len(codes), bool)
        lead[spans(first, leads)] = True
        at = np.flatnonzero(after)  # places with a symbol before them, the leading ones included
        self.word, self.before = codes[at], codes[at - 1]
        self.own = ~lead[at]
        self.learned = np.repeat(np.array(row["learned"], bool), leads + sizes)[at] & self.own
        self.has_two = after[at - 1]  # the symbol before has one before it
        self.sizes = sizes

    # words

    def ask_words(self) -> Iterator[tuple]:
        asked = np.bincount(self.word, self.learned, len(self.hashes))
        bits = self.buckets.bit_length() - 1
        edges = np.searchsorted(self.hashes, np.arange(1, self.buckets, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.int64)
        edges = np.concatenate([[0], edges, [len(self.hashes)]])
        for b, (i, j) in enumerate(zip(edges, edges[1:])):
            yield b, packed(self.hashes[i:j], True), packed(asked[i:j])

    def told_words(self, replies: list[dict]) -> None:
        """Ids and counts of the words, and the totals; a word's id tells its bucket and its rank there."""
        ids = np.concatenate([unpacked(r["ids"]) for r in replies]).astype(np.int64)
        self.seen = np.concatenate([unpacked(r["seen"]) for r in replies]).astype(np.float64)
        self.tokens, self.types = sum(r["tokens"] for r in replies), sum(r["types"] for r in replies)
        self.limit = max(1, self.tokens // _HOT)
        self.root = (self.seen + 1.0) / (self.tokens + self.types + 1.0)
        self.total = self.seen.copy()  # occurrences as a context
        self.total[self.hashes == np.uint64(_START)] = max(r["texts"] for r in replies)
        self.ids = ids
        self.p = self.root[self.word]

    # contexts

    def _ask(self, places: np.ndarray, context: np.ndarray, whole: np.ndarray, spread: Callable, names: Callable) -> Iterator[tuple]:
        """Rows for the buckets about the symbols at `places` after contexts (numbers of this chunk), which occur `whole` times.

        spread: buckets of contexts; names: the columns that name contexts to the other chunks.
        """
        key, some, gram, times = np.unique(context.astype(np.int64) * len(self.ids) + self.word[places], return_index=True, return_inverse=True, return_counts=True)
        if not self.learned.all():
            times = np.bincount(gram, self.learned[places], len(key)).astype(np.int64)
        context, word, whole = context[some], self.ids[self.word[places[some]]], whole[some]
        bucket = spread(context)
        hot = whole > self.limit
        bucket[hot] = (mixed(bucket[hot].astype(np.uint64), word[hot].astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16 if self.buckets <= 1 << 16 else np.uint32), kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.places, self.gram = places, back[gram].astype(np.int32)
        context, word, whole, times, bucket = context[order], word[order], whole[order], times[order], bucket[order]
        cost = np.rint(-np.log2(self.p[places[some]]) * _STEPS)[order]
        new = np.ones(len(context), bool)
        new[1:] = (context[1:] != context[:-1]) | (bucket[1:] != bucket[:-1])
        begin = np.flatnonzero(new)
        self.of = (np.cumsum(new) - 1).astype(np.int32)
        self.whole = whole[begin]
        reps = np.diff(np.append(begin, len(context)))
        columns = names(context[begin])
        edges = np.searchsorted(bucket, np.arange(self.buckets + 1))
        own = np.searchsorted(begin, edges)
        for b in range(self.buckets):
            i, j, k, m = edges[b], edges[b + 1], own[b], own[b + 1]
            yield b, *(packed(c[k:m]) for c in columns), packed(reps[k:m]), packed(self.whole[k:m]), packed(word[i:j]), packed(times[i:j]), packed(cost[i:j]), self.limit

    def _told(self, replies: list[dict], tests: float) -> np.ndarray:
        """Counts of the symbols at all places; moves the probabilities there to the states that were told of."""
        held = np.concatenate([unpacked(r["held"]) for r in replies]).astype(np.float64)
        state = np.concatenate([unpacked(r["states"]) for r in replies]) > 0
        times = np.concatenate([unpacked(r["times"]) for r in replies]).astype(np.float64)
        if (spread := self.whole > self.limit).any():
            # Of a hot context each bucket told its own sums, under the context's names.
            told = [np.concatenate([np.frombuffer(r[c], np.float64) for r in replies]) for c in ("hot_held", "hot_gain", "hot_symbols")]
            keys, at = np.unique(np.concatenate([np.frombuffer(r["hot"], np.uint64) for r in replies]), return_inverse=True)
            sums = [np.bincount(at, x, len(keys)) for x in told]
            mine = np.searchsorted(keys, self.names[spread])
            there = np.append(keys, np.uint64(0))[mine] == self.names[spread]  # none told of contexts without a repeated symbol
            of_hot = [np.where(there, np.append(x, 0.0)[mine], 0.0) for x in sums]
            held[spread] = of_hot[0]
            state[spread] = diverges(self.whole[spread], *of_hot, self.smoothing, tests)
        n, times = np.zeros(len(self.word)), times[self.gram]
        n[self.places] = times
        of = self.of[self.gram]
        held, state, whole, p = held[of], state[of], self.whole[of], self.p[self.places]
        some = np.where(times > 1, times, 0.0)
        self.p[self.places] = np.where(state, (some + (self.smoothing + whole - held) * p) / (whole + self.smoothing), p)
        return n

    def ask_one(self) -> Iterator[tuple]:
        whole = self.total[self.before]
        places = np.flatnonzero(whole >= 2)

        def names(context):
            first = self.ids[context]
            self.names = mixed(first.astype(np.uint64), np.zeros(len(first), np.uint64))
            return first, np.zeros(len(first), np.uint64)

        return self._ask(places, self.before[places], whole[places], lambda c: (self.ids[c] - 1) % self.buckets, names)

    def told_one(self, replies: list[dict], tests: float) -> None:
        self.runs = self._told(replies, tests)  # occurrences of each symbol with the one before it

    def ask_two(self) -> Iterator[tuple]:
        whole = np.zeros(len(self.word))
        whole[1:] = self.runs[:-1]
        places = np.flatnonzero(self.has_two & (whole >= 2))
        pair = self.before[places - 1].astype(np.int64) * len(self.ids) + self.before[places]
        pairs, context = np.unique(pair, return_inverse=True)
        first, second = self.ids[pairs // max(1, len(self.ids))], self.ids[pairs % max(1, len(self.ids))]
        hashed = mixed(first.astype(np.uint64), second.astype(np.uint64))

        def names(context):
            self.names = hashed[context]
            return first[context], second[context]

        return self._ask(places, context, whole[places], lambda c: (hashed[c] % np.uint64(self.buckets)).astype(np.int64), names)

    def told_two(self, replies: list[dict], tests: float) -> None:
        self._told(replies, tests)


def diverges(whole: np.ndarray, held: np.ndarray, gain: np.ndarray, symbols: np.ndarray, smoothing: float, tests: float) -> np.ndarray:
    """Whether contexts that occur `whole` times are states; gain: over their parents, of the `held` occurrences of their `symbols` repeated symbols."""
    once = whole - held
    gain = gain + np.where(once > 0, once * np.log((smoothing + once) / (whole + smoothing)), 0.0)
    return (symbols > 0) & (2 * gain > symbols + tests * np.sqrt(2 * symbols))


# ---- rounds


def _answers(asked: DataFrame, buckets: int, answer: Callable, shape: str) -> DataFrame:
    """What `answer` gives for the rows of each bucket, one bucket after another."""

    def run(batches):
        bucket, rows = None, []
        for batch in batches:
            for row in _rows(batch):
                if rows and row["bucket"] != bucket:
                    yield answer(bucket, rows)
                    rows = []
                bucket = row["bucket"]
                rows.append(row)
        if rows:
            yield answer(bucket, rows)

    return asked.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, f"chunk long, bucket int, {shape}")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dictionaries, one at a time: their packed arrays are large."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sum of each, place of each key among them)."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, values, len(distinct)), at


_WORDS = "ids binary, seen binary, tokens long, types long, texts long"


def _answer_words(buckets: int) -> Callable:
    def answer(bucket, rows):
        keys = [unpacked(r["keys"], True) for r in rows]
        distinct, seen, at = _summed(np.concatenate(keys), np.concatenate([unpacked(r["times"]) for r in rows]).astype(np.float64))
        ids = np.empty(len(distinct), np.uint64)
        ids[np.argsort(-seen, kind="stable")] = np.arange(len(distinct), dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket + 1)
        stops = np.cumsum([len(k) for k in keys])
        texts = int(seen[distinct == np.uint64(_END)].sum())
        totals = [int(seen.sum()), int((seen > 0).sum()), texts]
        out = [[r["chunk"] for r in rows], [bucket] * len(rows), [packed(ids[at[j - len(k) : j]]) for k, j in zip(keys, stops)], [packed(seen[at[j - len(k) : j]].astype(np.uint64)) for k, j in zip(keys, stops)]]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([*(pa.array(x, k) for x, k in zip(out, kinds)), *(pa.array([t] * len(rows), pa.int64()) for t in totals)], ["chunk", "bucket", "ids", "seen", "tokens", "types", "texts"])

    return answer


_GRAMS = "times binary, held binary, states binary, hot binary, hot_held binary, hot_gain binary, hot_symbols binary"


def _answer_grams(smoothing: float, tests: float) -> Callable:
    def answer(bucket, rows):
        firsts = [unpacked(r["firsts"]) for r in rows]
        own = np.concatenate(firsts)
        names = mixed(own, np.concatenate([unpacked(r["seconds"]) for r in rows]))
        reps = [unpacked(r["reps"]).astype(np.int64) for r in rows]
        contexts, whole_at, at = np.unique(names, return_index=True, return_inverse=True)
        whole = np.concatenate([unpacked(r["whole"]) for r in rows]).astype(np.float64)[whole_at]
        gram = mixed(np.repeat(names, np.concatenate(reps)), np.concatenate([unpacked(r["words"]) for r in rows]))
        distinct, index, gram_at = np.unique(gram, return_index=True, return_inverse=True)
        times = np.bincount(gram_at, np.concatenate([unpacked(r["times"]) for r in rows]).astype(np.float64), len(distinct))
        twice = np.flatnonzero(times > 1)
        of = np.repeat(at, np.concatenate(reps))[index[twice]]
        p = np.exp2(np.concatenate([unpacked(r["costs"]) for r in rows])[index[twice]].astype(np.float64) / -_STEPS)
        n, total = times[twice], whole[of]
        held = np.bincount(of, n, len(contexts))
        symbols = np.bincount(of, minlength=len(contexts)).astype(np.float64)
        # Without what singles leave to the parent, so that a hot context's gain is the sum of its buckets'.
        gain = np.bincount(of, n * np.log((n + smoothing * p) / ((total + smoothing) * p)), len(contexts))
        state = diverges(whole, held, gain, symbols, smoothing, tests)
        hot = (whole > rows[0]["limit"]) & (symbols > 0)
        told = times.astype(np.uint64)[gram_at]
        grams, ends = np.cumsum([int(x.sum()) for x in reps]), np.cumsum([len(x) for x in firsts])
        arrays = [
            [r["chunk"] for r in rows], [bucket] * len(rows), [packed(told[j - int(x.sum()) : j]) for x, j in zip(reps, grams)],
            [packed(held[at[j - len(x) : j]]) for x, j in zip(firsts, ends)], [packed(state[at[j - len(x) : j]]) for x, j in zip(firsts, ends)],
            *([x[hot].tobytes()] * len(rows) for x in (contexts, held, gain, symbols)),
        ]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 7]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(arrays, kinds)], ["chunk", "bucket", "times", "held", "states", "hot", "hot_held", "hot_gain", "hot_symbols"])

    return answer


def _with(held: DataFrame, answers: DataFrame, name: str, parts: int) -> DataFrame:
    """held with the answers that each chunk got, in the order of the buckets."""
    values = [c for c in answers.columns if c != "chunk"]
    listed = answers.repartition(parts, "chunk").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct(*values))).alias(name))
    return held.join(listed.withColumnRenamed("chunk", f"chunk_{name}"), F.col("chunk") == F.col(f"chunk_{name}"), "left").drop(f"chunk_{name}")  # all have answers; a left join adds no filter below the shuffle


def score(docs: DataFrame, learn: Column | None = None, smoothing: float = 32.0, tests: float = 2.0, piece: int = 6 << 20) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of docs, by a model of those rows for which `learn` holds (all, if not given)."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = 1 + n_bytes // piece  # more if partitions are smaller
    buckets = 1 << ((n_chunks + 3) // 4 - 1).bit_length()
    parts = max(min(n_chunks, int(spark.conf.get("spark.sql.shuffle.partitions"))), n_chunks // 8)
    held = chunks(docs, F.lit(True) if learn is None else learn, piece).repartition(parts, "chunk")
    keyed = "bucket int, chunk long, "

    def known(row: dict, rounds: int) -> Chunk:
        c = Chunk(row, buckets, smoothing)
        steps = ((c.ask_words, lambda r: c.told_words(r)), (c.ask_one, lambda r: c.told_one(r, tests)), (c.ask_two, lambda r: c.told_two(r, tests)))
        for i, (ask, told) in enumerate(steps[:rounds]):
            if i:
                for _ in ask():
                    pass
            told(row[f"told_{i}"])
        return c

    def asking(frame: DataFrame, rounds: int, names: list[str], shape: str) -> DataFrame:
        def run(batches):
            for batch in batches:
                for row in _rows(batch):
                    c = known(row, rounds)
                    columns = list(zip(*((c.ask_words, c.ask_one, c.ask_two)[rounds]())))
                    arrays = [pa.array(columns[0], pa.int32()), pa.array([row["chunk"]] * len(columns[0]), pa.int64())]
                    arrays += [pa.array(x, pa.int64() if name == "limit" else pa.binary()) for x, name in zip(columns[1:], names)]
                    yield pa.RecordBatch.from_arrays(arrays, ["bucket", "chunk", *names])
                    del c, columns, arrays
                    tidy()

        return frame.mapInArrow(run, keyed + shape)  # of all columns, so that all rounds read one shuffle of the chunks

    grams = ["firsts", "seconds", "reps", "whole", "words", "times", "costs", "limit"]
    gram_shape = "firsts binary, seconds binary, reps binary, whole binary, words binary, times binary, costs binary, limit long"
    now = held
    now = _with(now, _answers(asking(now, 0, ["keys", "times"], "keys binary, times binary"), buckets, _answer_words(buckets), _WORDS), "told_0", parts)
    for i in (1, 2):
        now = _with(now, _answers(asking(now, i, grams, gram_shape), buckets, _answer_grams(smoothing, tests), _GRAMS), f"told_{i}", parts)

    def run(batches):
        for batch in batches:
            for k, row in enumerate(_rows(batch)):
                c = known(row, 3)
                of = np.repeat(np.arange(len(c.sizes)), c.sizes)
                word, p = c.word[c.own], c.p[c.own]
                total = lambda x: pa.array(np.bincount(of, x, len(c.sizes)))
                n_known = total((c.seen[word] > 0).astype(np.float64)).cast(pa.int64())
                ids = batch.column(0).slice(k, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(row["uids"], pa.int64()), pa.array(c.sizes), n_known, pa.array([c.tokens] * len(c.sizes), pa.int64()), total(np.log10(c.root[word])), total(np.log10(p))],
                    ["doc_id", "uid", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
                del c, of, word, p
                tidy()

    kind = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("uid long, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])
    each = now.select("doc_ids", *[c for c in now.columns if c != "doc_ids"]).mapInArrow(run, kind)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    out = each.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("train_tokens").alias("train_tokens"), *sums)
    return out.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = split_bucket("doc_id", 7) == 2
    out = score(table(spark, sf_dir, "documents"), ~held_out)
    return out.withColumn("held_out", held_out).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
