"""Operators 11 to 13 against brute force on texts that hold the awkward cases."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidewater.llm import chat, importance, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, body string, words string, runs string, score string, key string"


def write(spark, tmp_path, **tables):
    for name, (rows, shape) in tables.items():
        spark.createDataFrame(rows, shape).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return f"file://{tmp_path}"


def documents(texts, start=0):
    return [(start + i, t, "s", "b", "w", "r", "c", "k") for i, t in enumerate(texts)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11: periodic runs


def plain_runs(words, least=24, periods=3):
    """Every run by its definition, the smallest period of a stretch first."""
    found, n = [], len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, periods * q):
                own = words[i : i + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_sequences(seed):
    r = random.Random(seed)
    for _ in range(150):
        words = []
        while len(words) < r.choice([5, 40, 200, 400]):
            unit = [r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.choice([1, 2, 3, 5, 9, 16, 17, 33]))]
            words += unit * r.choice([1, 1, 2, 3, 4, 8]) + unit[: r.randint(0, len(unit))] + [str(r.randint(0, 5)) for _ in range(r.randint(0, 3))]
        ids = runs.numbers([w.encode() for w in words])
        for least, periods in ((24, 3), (3, 3), (10, 4)):
            assert runs.runs(ids, least, periods) == plain_runs(words, least, periods)


def test_runs_inside_runs_and_in_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    for words in (list(b), list(("ab" * 15 + "c") * 5), list("a" * 100), list(("a" * 30 + "b") * 4 + "a" * 30)):
        ids = runs.numbers([w.encode() for w in words])
        for least in (3, 24):
            assert runs.runs(ids, least) == plain_runs(words, least)


def test_millions_of_words_take_seconds():
    r = np.random.default_rng(3)
    ids = np.concatenate([r.integers(0, 500, 400_000), np.tile(r.integers(0, 500, 50_000), 4), np.zeros(200_000, np.int64), r.integers(0, 500, 300_000)])
    found = runs.runs(ids)
    assert (len(found), {q for _, _, q in found}) == (2, {1, 50_000})


def expected_runs(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *facts, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_op11(spark, tmp_path):
    r = random.Random(9)
    texts = [None, "", " \n ", "x", "la " * 30, "\x1c\x1d odd \x85 marks " * 9, "日本 語 " * 40, "a b c d e f g h " * 3, "a b c d e f g h " * 2 + "a b c d e f g"]
    for _ in range(150):
        unit = [r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(1, 40))]
        lead = [f"w{r.randint(0, 99)}" for _ in range(r.randint(0, 80))]
        texts.append(" ".join(lead + unit * r.choice([1, 2, 3, 5]) + unit[: r.randint(0, len(unit))] + lead[:20]).replace(" ", r.choice([" ", "\n", "\t "])))
    rows = documents(texts) + documents(texts[3:9]) + [(None, "z " * 60, *"sbwrck")]
    folder = write(spark, tmp_path, documents=(rows, DOCS))
    found = runs.op11_bit_lags(spark, folder)
    assert [t for _, t in found.dtypes] == ["bigint"] * 6 + ["string"] * 2
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert collections.Counter((x["doc_id"], *(x[c] for c in names)) for x in found.collect()) == collections.Counter((d[0], *expected_runs(*d[:2])) for d in rows)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 8


# --- 12: chat


SHAPE = "conv_id long, turn long, role string, text string, ids string, block string"


def turns_of(seed=4):
    r = random.Random(seed)
    odd = ["", None, "\\", "</turn>", "<\\turn>", "<turn>user<says>hi</turn>", "<says", "a\\\\b", "<|endoftext|>", "naïve 日本 😀", "<<turn>>", " lead", "trail \n", "\\" * 7 + "<says>", "\x85\x1c"]
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 7)):
            text = r.choice(odd) if r.random() < 0.5 else " ".join(r.choice(["one", "two,", "Öl", "</turn>"]) for _ in range(r.randint(1, 40)))
            rows.append((conv, turn, r.choice(["user", "assistant", "assistant", "system", "too\nl</turn>", None]), text, "i", "b"))
    rows += [(900, 0, "assistant", "word " * 250_000, "i", "b"), (900, 1, "user", "end", "i", "b"), (None, 0, "user", "null", "i", "b"), (901, None, "user", "last", "i", "b"), (901, 3, "assistant", "first", "i", "b")]
    return rows + [(902, 1, "user", "same", "i", "b")] * 2


def expected_turns(rows):
    by = collections.defaultdict(list)
    text = r"\### Assistant: </turn> ok"
    for conv, turn, role, said in [x[:4] for x in rows] + [(-7, 0, "user", text), (-7, 1, "assistant", text)]:
        by[conv].append((turn is None, turn or 0, role or "", said or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        out[conv] = (len(turns), sha("".join(f"{role}\n{t}\n" for _, _, role, t in turns)), len(loss), sha(loss))
    return out


def test_op12(spark, tmp_path):
    rows = turns_of()
    folder = write(spark, tmp_path, conversations=(rows, SHAPE))
    found = chat.op12_token_assembly(spark, folder)
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "string", "bigint", "string", "bigint"]
    got = {r["conv_id"]: r for r in found.collect()}
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == expected_turns(rows)
    template = chat.Template()
    assert got[-7]["formatted_chars"] == 2 * (len(template.escaped(r"\### Assistant: </turn> ok")) + 19) + len("userassistant")


def test_blocks_of_one_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i} </turn> " * 9, "i", "b") for i in range(50)]
    turns = spark.createDataFrame(rows, SHAPE)
    whole, cut = (chat.assembled(turns, most=most).orderBy("block").collect() for most in (1 << 20, 300))
    assert len(whole) == 1 and len(cut) > 5
    assert [r["block"] for r in cut] == list(range(len(cut))) and sum(r["n_turns"] for r in cut) == 50
    assert [i for r in cut for i in r["ids"]] == whole[0]["ids"] and [i for r in cut for i in r["loss"]] == whole[0]["loss"]
    assert [r["first"] for r in cut] == np.cumsum([0, *(len(r["ids"]) for r in cut[:-1])]).tolist()
    folded = chat.told(spark.createDataFrame(cut, "conv_id bigint, block int, first bigint, n_turns bigint, ids array<int>, loss array<tinyint>"))
    assert [tuple(r)[1:5] for r in folded.collect()] == [expected_turns(rows)[1]]


def test_escapes_can_be_taken_back_and_hide_all_controls():
    r = random.Random(2)
    for template in (chat.Template(), chat.Template("aa", "ab", "ba"), chat.Template("[I]", "::", "[/I]")):
        pieces = [*template.controls, "\\", "a", "b", "<", "turn>", "\n", *(c[:-1] for c in template.controls)]
        for _ in range(500):
            text = "".join(r.choice(pieces) for _ in range(r.randint(0, 12)))
            told = template.escaped(text)
            assert template.plain(told) == text and not any(c in told for c in template.controls)


def test_ids_that_are_no_turns_are_refused():
    for ids in ([100, 5, 101, 6], [100, 101, 102, 7], [5, 100, 101, 102], [100, 102, 101], [100, 101, 102, 7, 100, 101, 102]):
        with pytest.raises(ValueError):
            chat.spoken(np.array(ids), np.zeros(len(ids), np.int8), 100)
    with pytest.raises(ValueError):
        chat.spoken(np.array([100, 101, 102]), np.array([1, 0, 0], np.int8), 100)


# --- 13: importance


def expected_draw(rows, items):
    folded = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = lambda w: w + [f"{a} {b}" for a, b in zip(w, w[1:])]
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    own = [[bucket(f) for f in grams(folded(t))] for _, t in rows]
    s, t = collections.Counter(b for x in own for b in x), collections.Counter(bucket(f) for x in items for f in grams(folded(x)))
    n, m = sum(s.values()), sum(t.values())
    out = []
    for (doc_id, text), found in zip(rows, own):
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n + 10000) / ((s[b] + 1) * (m + 10000)))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(folded(text))])
    able = sorted((x for x in out if x[5] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[2], x[1]))
    for k, x in enumerate(able[: 25 * len(able) // 100]):
        x[4] = k + 1
    return [tuple(x[:5]) for x in out]


def test_op13(spark, tmp_path):
    r = random.Random(6)
    vocabulary = [*"abcdefgh", "Beta", "naïve", "日本", "x1", "don't", "ÄÖ", "_", "Iİ"]
    texts = [None, "", "!!", "one", "Two words", "a b c " * 7]
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 90))) for _ in range(300)]
    texts += [texts[8]] * 120 + [" ".join(f"w{i % 5000}" for i in range(40_000))]
    rows = documents(texts) + documents(texts[6:9], 6) + [(None, texts[9], *"sbwrck")] * 2
    items = [" ".join(r.choice(vocabulary[:6]) for _ in range(50)) for _ in range(9)] + [None, "", "a b", "a b"]
    folder = write(spark, tmp_path, documents=(rows, DOCS), benchmark=([(i, t, "k") for i, t in enumerate(items)], "item_id long, text string, key string"))
    found = importance.op13_importance(spark, folder)
    assert [t for _, t in found.dtypes] == ["bigint"] * 5
    want = expected_draw([d[:2] for d in rows], items)
    assert collections.Counter(map(tuple, found.collect())) == collections.Counter(want)
    assert sum(x[4] is not None for x in want) > 60


def test_op13_without_target_and_without_rows(spark, tmp_path):
    rows, items = documents(["some words of a text " * 6] * 9), [(1, "k", "k")]
    folder = write(spark, tmp_path, documents=(rows, DOCS), benchmark=(items, "item_id long, text string, key string"))
    docs, target = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    names = ("doc_id", "n_features", "weight", "score", "rank")
    got = collections.Counter(tuple(x[c] for c in names) for x in importance.resample(docs, target.where("false")).collect())
    assert got == collections.Counter(expected_draw([d[:2] for d in rows], []))
    assert importance.resample(docs.where("false"), target).count() == 0


def test_ranks_of_ties(spark):
    rows = [(i, 30, 5, 10 - i // 40, i // 40) for i in range(200)]
    found = importance.draw(spark.createDataFrame(rows, "doc_id long, n_words long, weight long, score long, n_features long"), 50, 20, block=2)
    assert sorted((x["doc_id"], x["rank"]) for x in found.collect()) == [(i, i + 1 if i < 100 else None) for i in range(200)]
