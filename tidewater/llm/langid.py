"""Language identification by rank-order profiles.

A text's letters, lower-cased, with each run of other characters turned into one mark, give
runs of one to three characters. The most frequent of them, by rank, are a text's profile;
those of all training texts of a language are the language's. A text gets the language whose
profile is least out of place: the sum over its runs of the difference of the two ranks, or
the profile's size where the language lacks the run.

Edge cases: `und` with score 0 for null texts, texts without a letter, and where nothing was
learned; ties go to the smaller language by code point; a null lang is not learned from, an
empty one is a language like any other; very long texts are counted piece by piece; repeated
rows each get a row; an empty table gives no rows; only doc_id, text and lang are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import pieces, split_bucket, table, tidy

_MARK = ord("_")
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def marked(text: str | None, most: int = 1 << 20) -> np.ndarray:
    """The letters of a text in lower case, between single marks; empty if it has none. Worked out over `most` characters at a time."""
    if not text:
        return np.zeros(0, np.uint32)
    text, parts, before = text.lower(), [np.array([_MARK], np.uint32)], False
    for at in range(0, len(text), most):
        points = np.frombuffer(text[at : at + most].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        keep = letter.copy()
        keep[0] |= before
        keep[1:] |= letter[:-1]  # of a run of others only the first, which follows a letter
        parts.append(np.where(letter, points, np.uint32(_MARK))[keep])
        before = bool(letter[-1])
    out = np.concatenate([*parts, np.array([_MARK] * before, np.uint32)])
    return out if len(out) > 1 else out[:0]


def runs(m: np.ndarray, most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of 1 to 3 characters, 21 bits each, ascending, and their counts; a lone mark is none, and none reaches across two marks."""
    parts = []
    for at in range(0, len(m), most):
        x = m[at : at + most + 2].astype(np.int64)
        n = min(most, len(x))
        one = x[:n]
        split = (x[:-1] == _MARK) & (x[1:] == _MARK)  # two marks side by side: one text's end and the next one's start
        pair, three = ~split[:n], ~(split[:-1] | split[1:])[:n]
        found = [one[one != _MARK], ((x[:-1] << 21) | x[1:])[:n][pair], ((x[:-2] << 42) | (x[1:-1] << 21) | x[2:])[:n][three]]
        parts.append(np.unique(np.concatenate(found), return_counts=True))
    return merged(parts)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(m: np.ndarray, size: int) -> np.ndarray:
    """The most frequent runs, the most frequent first, ties by code points."""
    keys, counts = runs(m)
    return keys[np.argsort(-counts, kind="stable")[:size]]


def profiles(docs: DataFrame, size: int = 400) -> DataFrame:
    """(lang, run, rank from 0) of the languages of docs, from all their texts; counts are summed in tasks first."""

    def run(batches):
        held: dict[str, list] = {}

        def out():
            for lang, parts in held.items():
                keys, counts = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))], ["lang", "run", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for at, texts in pieces(batch, "text", 2 << 20):
                by: dict[str, list] = {}
                for lang, text in zip(langs[at : at + len(texts)], texts):
                    by.setdefault(lang, []).append(marked(text))
                for lang, found in by.items():
                    counted = runs(np.concatenate(found))
                    held[lang] = [merged([*held.get(lang, []), counted])]
                if sum(len(p[0]) for parts in held.values() for p in parts) > 1_000_000:
                    yield from out()
        yield from out()

    counts = docs.where("lang is not null").select("text", "lang").mapInArrow(run, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "run")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).select("lang", "run", "rank")


class Model:
    """Profiles of languages as one table of ranks."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.keys = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int32)  # the last row: a run that no language has
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.ranks[np.searchsorted(self.keys, [r[1] for r in rows]), [place[r[0]] for r in rows]] = [r[2] for r in rows]

    def predict(self, text: str | None) -> tuple[str, float]:
        m = marked(text)
        if not len(m) or not self.langs:
            return "und", 0.0
        own = ranked(m, self.size)
        at = np.searchsorted(self.keys, own)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != own] = len(self.keys)
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own), dtype=np.int32)[:, None])).sum(axis=0)
        best = int(away.argmin())
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(own))


def learn(docs: DataFrame, size: int = 400, most_langs: int = 1000) -> Model:
    """A model of at most size runs for each language; raises ValueError for more languages than most_langs."""
    found = profiles(docs, size)
    rows = found.limit(size * most_langs + 1).collect()
    if len(rows) > size * most_langs or len({r["lang"] for r in rows}) > most_langs:
        raise ValueError(f"lang has more than {most_langs} values")
    return Model([(r["lang"], r["run"], r["rank"]) for r in rows], size)


def identify(docs: DataFrame, model: Model, carry: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns named in carry, then language and score of each row under the given names; nothing but the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by size * most_langs
    place = carry.index("text") if "text" in carry else len(carry)

    def run(batches):
        predict = shared.value.predict
        for batch in batches:
            texts = batch.column(place)
            found = [predict(texts[i].as_py()) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*batch.schema.names[: len(carry)], *names])
            tidy()

    kind = T.StructType([*(docs.schema[c] for c in carry), T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.select(*carry, *([] if "text" in carry else [F.col("text").alias("__text")])).mapInArrow(run, kind)


def train_rows(docs: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    return docs.where(split_bucket("doc_id", modulus) != held_out)


def op3_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(train_rows(docs)), ["doc_id"])
    return found.select("doc_id", (split_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
