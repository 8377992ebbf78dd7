"""Encoding of texts with a public tokenizer, and an exact histogram of encoded lengths.

A space between two characters that are no white space always starts a new pre-token of a
byte-level BPE, so a text is cut there, each distinct piece of a run of texts is encoded by the
tokenizers library once, and its ids are gathered; a bounded number of pieces is remembered.

Edge cases: a null or empty text has no ids, and counts as length 0 in the histogram; very
long texts are handled in segments; repeated rows count each; an empty table gives no rows;
only doc_id and text are read.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut, table, tidy

#: The character that byte-level vocabularies write for a space.
_SPACE = "\u0120"
#: Pieces between spaces that whitespace next to those spaces may tie to their neighbours, and pieces of Latin letters with or without a mark, as RE2 patterns.
_UNCUT = r"^$|^\n|\n$|[\t\r\x0b\x0c\x1c-\x1f\x{85}]|\p{Z}"
_WORD = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+[.,]?$"
#: Letters as the characters that byte-level vocabularies write for their UTF-8 bytes: printable bytes as themselves, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_AS_BYTES = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(0xC0, 0x250)}
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Tokenizers by path, so that a worker loads each once.
_ENCODERS: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, two bytes wide if the vocabulary allows it, else four.

    Pieces are found, told apart and looked up in Arrow; only those that are not remembered
    become Python strings. At most `most` pieces of at most `longest` bytes are remembered; of
    more, the half that was asked for most often stays.
    """

    def __init__(self, path: str, most: int = 400_000, longest: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.width = self.kind.itemsize
        self.most, self.longest = most, longest
        # Only a byte-level model whose words begin with the space's stand-in takes the short way.
        self.by_piece = "ByteLevel" in type(self.tokenizer.pre_tokenizer).__name__ and type(self.tokenizer.model).__name__ == "BPE" and self.tokenizer.normalizer is None
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(_SPACE)]] = True
        self.marks = {m: self._whole([m])[0] for m in ".,"}
        self.forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The one encoder of a worker for this path; what it remembers, some 20 MB, serves its next tasks too."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.start, self.size, self.asked = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, words: list[str]) -> list[list[int]]:
        merge, collecting = self.tokenizer.model.tokenize, gc.isenabled()
        gc.disable()  # a token is an object, and none of them refers to another
        try:
            return [[t.id for t in merge(_SPACE + (w if w.isascii() else w.translate(_AS_BYTES)))] for w in words]
        finally:
            if collecting:
                gc.enable()

    def _learned(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that follow a space, one after another, and how many each has; -1 for pieces that a space does not cut."""
        size = np.full(len(new), -1, np.int64)
        odd = pc.match_substring_regex(new, _UNCUT).to_numpy(zero_copy_only=False)
        word = pc.match_substring_regex(new, _WORD).to_numpy(zero_copy_only=False) & ~odd
        rest = np.flatnonzero(~word & ~odd)
        ids_of: dict[bool, tuple[np.ndarray, np.ndarray]] = {}
        # Letters are one pre-token, whose ids the library's model alone gives; a mark at the end is one of its own.
        words = new.filter(pa.array(word))
        bare = pc.utf8_rtrim(words, ".,").dictionary_encode()
        found = self._merged(bare.dictionary.to_pylist())
        length = np.array([len(f) for f in found], np.int64)
        at = bare.indices.to_numpy()
        marked = (pc.binary_length(words).to_numpy() > pc.binary_length(bare.dictionary.take(bare.indices)).to_numpy()).astype(np.int64)
        stop = pc.ends_with(words, ".").to_numpy(zero_copy_only=False)
        table = np.concatenate([np.array([i for f in found for i in f], self.kind), self.marks["."], self.marks[","]])
        total = int(length.sum())
        pairs = np.stack([(np.cumsum(length) - length)[at], np.where(stop, total, total + len(self.marks["."]))], axis=1)
        counts = np.stack([length[at], marked * np.where(stop, len(self.marks["."]), len(self.marks[","]))], axis=1)
        ids_of[True] = table[spans(pairs.ravel(), counts.ravel())], counts.sum(axis=1)
        # The others are encoded many at once; an id that begins with a space begins a piece.
        others = new.take(pa.array(rest)).to_pylist()
        found = self._whole([" " + " ".join(others[at : at + 200]) for at in range(0, len(others), 200)])
        together = np.concatenate(found) if found else np.zeros(0, self.kind)
        starts = np.flatnonzero(self.begins[together])
        if len(starts) != len(others):
            raise ValueError("the tokenizer does not begin each piece with a space")
        ids_of[False] = together, np.diff(np.append(starts, len(together)))
        size[word], size[rest] = ids_of[True][1], ids_of[False][1]
        out = np.zeros(int(size[size > 0].sum()), self.kind)
        start = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
        for which, places in ((True, np.flatnonzero(word)), (False, rest)):
            out[spans(start[places], size[places])] = ids_of[which][0]
        return out, size

    def _places(self, pieces: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start in them, size) of distinct pieces that follow a space, where times says how often each was met."""
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        there = at >= 0
        self.asked[at[there]] += times[there]
        new = pieces.filter(pa.array(~there))
        ids, size = self._learned(new)
        start = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0) + len(self.ids)
        all_ids = np.concatenate([self.ids, ids])
        out_start, out_size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        out_start[there], out_size[there] = self.start[at[there]], self.size[at[there]]
        out_start[~there], out_size[~there] = start, size
        short = pc.binary_length(new).to_numpy(zero_copy_only=False) <= self.longest
        self._remember(new.filter(pa.array(short)), all_ids, start[short], size[short], times[~there][short])
        return all_ids, out_start, out_size

    def _remember(self, new: pa.Array, ids: np.ndarray, start: np.ndarray, size: np.ndarray, times: np.ndarray) -> None:
        known, start = pa.concat_arrays([self.known, new]), np.concatenate([self.start, start])
        size, asked = np.concatenate([self.size, size]), np.concatenate([self.asked, times])
        if len(known) > self.most:
            stay = np.sort(np.argsort(-asked, kind="stable")[: self.most // 2])
            known, start, size, asked = known.take(pa.array(stay)), start[stay], size[stay], asked[stay]
        length = np.maximum(size, 0)
        self.ids = ids[spans(start, length)]
        self.known, self.start, self.size, self.asked = known, np.cumsum(length) - length, size, asked

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start in them and size of each piece of the texts, first piece of each text)."""
        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy()[:-1].astype(np.int64) - lists.offsets[0].as_py()
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        at, pieces = coded.indices.to_numpy(), coded.dictionary
        ids, start, size = self._places(pieces, np.bincount(at, minlength=len(pieces)))
        start, size = start[at], size[at]
        odd = size < 0
        odd[first] &= pc.binary_length(flat.take(pa.array(first))).to_numpy(zero_copy_only=False) > 0
        odd = np.logical_or.reduceat(odd, first)
        # The first piece follows no space; a text that spaces do not cut is encoded whole in its place.
        size[np.repeat(odd, np.diff(np.append(first, len(at))))] = 0
        heads = self._whole(pc.if_else(pa.array(odd), texts, flat.take(pa.array(first))).to_pylist())
        size[first] = [len(h) for h in heads]
        start[first] = len(ids) + np.cumsum(size[first]) - size[first]
        return np.concatenate([ids, *heads]), start, size, first

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has; texts of a call should be some MB together."""
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        texts = texts.fill_null("")
        if not self.by_piece:
            found = self._whole(texts.to_pylist())
            return np.concatenate(found), np.array([len(f) for f in found], np.int64)
        ids, start, size, first = self._pieces(texts)
        return ids[spans(start, size)], np.add.reduceat(size, first)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        if not self.by_piece or not len(texts):
            return self.encode(texts)[1]
        _, _, size, first = self._pieces(texts.fill_null(""))
        return np.add.reduceat(size, first)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each span, one after another."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def parts(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(segments, row of each): runs of rows of about `most` bytes. A longer text comes in several segments, cut where a space starts a new pre-token."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(texts):
        run = int(np.searchsorted(np.cumsum(sizes[at:]), most, "right"))
        if run:
            yield texts.slice(at, run), np.arange(at, at + run)
            at += run
            continue
        text, start = texts[at].as_py(), 0
        while start < len(text):
            space = _CUT.search(text, start + most // 4)
            stop = space.start() if space else len(text)
            yield pa.array([text[start:stop]], pa.string()), np.array([at])
            start = stop
        at += 1


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(length, n_docs): how many rows have each encoded length, summed in every task before the shuffle."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        counts: dict[int, int] = {}
        encoder = Encoder.of(path)
        for batch in batches:
            lengths = np.zeros(batch.num_rows, np.int64)
            for texts, rows in parts(batch.column(0)):
                np.add.at(lengths, rows, encoder.lengths(texts))
            tidy()
            for length, n in zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))):
                counts[length] = counts.get(length, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(np.array(list(counts), np.int64)), pa.array(np.array(list(counts.values()), np.int64))], ["length", "n_docs"])

    return docs.select("text").mapInArrow(run, "length long, n_docs long").groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def length_histogram(counts: DataFrame, block: int = 128) -> DataFrame:
    """What every context limit L among the lengths gives, from (length, n_docs).

    docs_at_least, tokens_at_least: rows of length >= L and their tokens (suffix sums);
    truncated_total: tokens left when each row is cut at L; share_at_most: the part of the rows
    of length <= L, so the q-quantile is the first L with share_at_most >= q; total_docs and
    total_tokens: of all rows. Sums run within blocks of lengths and over block totals.
    """
    counts = cut(counts)  # read more than once below
    h = counts.withColumn("block", F.floor(F.col("length") / block)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    totals = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    totals = totals.select("block", F.coalesce(F.sum("d").over(above), zero).alias("d_above"), F.coalesce(F.sum("t").over(above), zero).alias("t_above"), F.sum("d").over(everything).alias("total_docs"), F.sum("t").over(everything).alias("total_tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.join(totals, "block").withColumn("docs_at_least", F.sum("n_docs").over(within) + F.col("d_above")).withColumn("tokens_at_least", F.sum("tokens").over(within) + F.col("t_above"))
    return h.select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")).alias("truncated_total"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("share_at_most"), "total_docs", "total_tokens",
    )


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row (length): the smallest length that at least a share q of the rows do not exceed."""
    return histogram.where(F.col("share_at_most") >= q).agg(F.min("length").alias("length"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row (truncated_total): tokens left when each row is cut at any limit, whether a row has that length or not."""
    above = F.col("length") > limit
    return histogram.agg(F.coalesce(F.sum(F.when(above, F.col("n_docs") * limit).otherwise(F.col("n_docs") * F.col("length"))), F.lit(0)).cast("long").alias("truncated_total"))


def op4_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(token_counts(table(spark, sf_dir, "documents")))
