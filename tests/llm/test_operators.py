"""The ten operators against brute force on texts that hold the awkward cases."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, html_text, langid, mixing, quality, sharding, simhash, suffix_tree, token_store, tokens
from tidewater.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, fp long, row string, size string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def some_texts(seed=5, n=60):
    r = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma.", "the", "of", "naïve", "straße", "日本", "x1", "||", "$$", "é", "I", "don't"]
    texts = [None, "", " \t\n ", "one", "two words", "!!! ???", "a b c", "line\n\nline\nline\n", "same same same same same", "tab\tsep\x0bvt\x0cff", "emoji 😀 text", "x" * 3000]
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 120))) + r.choice(["", "\n", "  end", "\n\n tail"]) for _ in range(n)]
    base = [r.choice(vocabulary) + str(r.randint(0, 99)) for _ in range(400)]
    for _ in range(6):
        changed = list(base)
        changed[r.randrange(400)] = "changed"
        texts.append(" ".join(changed))
    texts += [" ".join(base)] * 3 + [" ".join(r.choice(vocabulary) + str(i % 700) for i in range(6000))]
    return texts


def frame(spark, texts, start=0):
    r = random.Random(1)
    rows = [(start + i, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s10", None]), 0, 7, "r", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, some_texts()).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_simhash(spark, docs, none):
    found = by_id(simhash.near_duplicates(docs))
    prints = {}
    for d in docs.collect():
        w = WORD.findall(lower(d["text"] or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert {d: r["fingerprint"] for d, r in found.items()} == {d: f"{f:016x}" for d, f in prints.items()}
    label = {d: d for d in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if bin(prints[a] ^ prints[b]).count("1") <= 2:
                    label[a] = label[b] = min(label[a], label[b])
    assert {d: r["component_id"] for d, r in found.items()} == label
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_simhash_links_every_pair_within_any_radius(spark, radius):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(4)]
    points = {b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(12)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in points)
    found = components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), radius)).collect()
    label = {p: p for p in signed}
    for _ in signed:
        for a in signed:
            for b in signed:
                if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius:
                    label[a] = label[b] = min(label[a], label[b])
    assert {p: label[p] for p in signed} == {p: p for p in signed} | {r["node"]: r["root"] for r in found}


def test_components_of_long_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (900, 901), (901, 900), (900, 901)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {900: 900, 901: 900}


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d", None, None, 0, 0, "", ""), (None, "a b c d", None, None, 0, 0, "", ""), (4, "a b c d", None, None, 0, 0, "", ""), (4, "a b c d", None, None, 0, 0, "", "")]
    df = spark.createDataFrame(rows, SHAPE)
    assert [r["component_id"] for r in simhash.near_duplicates(df).collect()] == [4] * 4
    assert sorted(r["slot"] for r in sharding.assign(df, sharding.balanced(1, 1, 1)).collect()) == [0, 1, 2, 3]
    assert sum(r["size"] for r in mixing.mix(df).collect()) == 16
    assert quality.judge(df).count() == 4
    assert suffix_tree.score(df).count() == 4
    assert langid.identify(df, langid.learn(df), ["doc_id"]).where("lang_pred = 'und' and score = 0").count() == 4
    assert decontaminate.contamination(df, spark.createDataFrame([(None, "b c")], "item_id long, text string")).where("n_hit = 2 and n_items = 0 and contaminated").count() == 4


def test_encoder_gives_the_librarys_ids():
    from tokenizers import Tokenizer

    path = tokens.default_tokenizer()
    whole, own = Tokenizer.from_file(path), tokens.Encoder(path, most=50)
    texts = [t or "" for t in some_texts()] + ["a  b", " lead", "trail ", "a \n b", "a\n  b", "x   y  z", "<|endoftext|> a <|endoftext|>", "don't  we'll\t \tx", "　wide  em"]
    for t in texts:
        ids, sizes = own.encode(pa.array([t, None], pa.string()))
        assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids and sizes.tolist() == [len(ids), 0], t


def test_long_texts_are_encoded_in_segments():
    whole = tokens.Encoder.of(tokens.default_tokenizer())
    texts = ["a b", None, "word. " * 40 + "end", "", "x  y \t z " * 30, "no-space" * 50, "c"]
    for most in (8, 64, 1 << 20):
        found = {i: [] for i in range(len(texts))}
        for segments, rows in tokens.parts(pa.array(texts, pa.string()), most):
            ids, sizes = whole.encode(segments)
            for row, own in zip(rows.tolist(), np.split(ids, np.cumsum(sizes)[:-1])):
                found[row] += own.tolist()
        assert list(found.values()) == [whole.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        streams = [s for _, run in token_store._streams(pa.array(texts, pa.string()), whole, 0) for s in run]
        assert [s.tolist() for s in streams] == [f + [0] for f in found.values()]


def test_token_store(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.default_tokenizer())
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs, path)
    found, ids, start = by_id(token_store.read_documents(spark, path)), by_id(token_store.reconstruct(spark, path)), 0
    for d in sorted(docs.collect(), key=lambda d: d["doc_id"]):
        expected = whole.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        row = found[d["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(expected), zlib.crc32(np.array(expected, "<u4").tobytes()))
        assert ids[d["doc_id"]]["ids"] == expected and ids[d["doc_id"]]["start"] == start
        start += len(expected)
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    assert token_store.verify(spark, path)
    token_store.write_store(none, f"{path}-none")
    assert token_store.read_documents(spark, f"{path}-none").count() == 0


def test_token_store_refuses_changed_chunks(spark, docs, tmp_path):
    path = f"file://{tmp_path}/bad"
    token_store.write_store(docs.limit(5), path)
    good = spark.read.parquet(f"{path}/chunks").toPandas()
    good.at[0, "ids"] = bytes(b ^ 1 for b in good.at[0, "ids"])
    spark.createDataFrame(good, "digest binary, n int, ids binary").write.mode("overwrite").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="does not match its digest"):
        token_store.read_documents(spark, path).collect()


def test_token_store_refuses_lost_recipes_and_chunks(spark, docs, tmp_path):
    for lost in ("recipes/kind=doc", "recipes/kind=part"):
        path = tmp_path / lost.replace("/", "-")
        token_store.write_store(docs, f"file://{path}")
        next((path / lost).glob("part-*.parquet")).unlink()
        for read in (token_store.read_documents, token_store.reconstruct):
            with pytest.raises(Exception, match="roots of their parts"):
                read(spark, f"file://{path}").collect()
    path = f"file://{tmp_path}/changed"
    token_store.write_store(docs.limit(5), path)
    bad = spark.read.parquet(f"{path}/chunks").toPandas()
    bad.at[0, "ids"] = bytes(b ^ 1 for b in bad.at[0, "ids"])
    spark.createDataFrame(bad, "digest binary, n int, ids binary").write.mode("overwrite").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="does not match its digest"):
        token_store.reconstruct(spark, path).collect()
    spark.createDataFrame(bad[1:], "digest binary, n int, ids binary").write.mode("overwrite").parquet(f"{path}/chunks")
    for read in (token_store.read_documents, token_store.reconstruct):
        with pytest.raises(Exception, match="chunk is missing"):
            read(spark, path).collect()


def test_token_store_refuses_changed_fields(spark, docs, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs, path)
    recipes = spark.read.parquet(f"{path}/recipes").cache()
    recipes.count()
    first = (F.col("kind") == "doc") & (F.col("place") == 1)
    part = F.col("kind") == "part"
    longer = F.concat(F.array(F.get("sizes", F.lit(0)) + 1), F.slice("sizes", 2, 9999))
    changes = [("doc_id", first, F.lit(1234)), ("start", first, F.col("start") + 5), ("n_tokens", first, F.col("n_tokens") + 1), ("sizes", first, longer), ("digests", first, F.reverse(F.concat("digests", "digests"))), ("n_tokens", part, F.col("n_tokens") + 1), ("place", part, F.col("place") + 1)]
    for k, (name, where, value) in enumerate(changes):
        bad = f"{path}-{k}"
        recipes.withColumn(name, F.when(where, value.cast(recipes.schema[name].dataType)).otherwise(F.col(name))).write.partitionBy("kind").parquet(f"{bad}/recipes")
        for other in ("chunks", "head"):
            spark.read.parquet(f"{path}/{other}").coalesce(1).write.parquet(f"{bad}/{other}")
        for read in (token_store.read_documents, token_store.reconstruct):
            with pytest.raises(Exception, match="does not match its root|do not match the roots|another length"):
                read(spark, bad).collect()
    recipes.unpersist()


def test_crc_shift_is_what_following_bytes_do():
    for a, b in ((b"abc", b"defgh"), (b"", b"x"), (b"long" * 50, b"tail" * 999)):
        moved = int(token_store.crc_shift(np.array([zlib.crc32(a)]), np.array([len(b)]))[0])
        assert moved ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_cut_points_find_the_same_chunks_after_an_insertion():
    r = np.random.default_rng(1)
    ids, gear = r.integers(0, 50_000, 30_000), token_store._gear(50_001)
    cut = lambda x: {x[a:b].tobytes() for a, b in zip([0, *token_store.cut_points(x, gear)], token_store.cut_points(x, gear))}
    assert len(cut(ids) & cut(np.insert(ids, 5000, [7, 7, 7]))) > 0.8 * len(cut(ids))
    assert token_store.cut_points(np.zeros(5000, np.int64), gear)[-1] == 5000


def test_lengths(spark, docs, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.default_tokenizer())
    n = np.array([len(whole.encode(d["text"] or "", add_special_tokens=False).ids) for d in docs.collect()])
    h = tokens.length_histogram(tokens.token_counts(docs), block=16).cache()
    for r in h.collect():
        at = r["length"]
        assert (r["n_docs"], r["docs_at_least"], r["tokens_at_least"], r["truncated_total"]) == ((n == at).sum(), (n >= at).sum(), n[n >= at].sum(), np.minimum(n, at).sum())
        assert (r["total_docs"], r["total_tokens"]) == (len(n), n.sum()) and r["share_at_most"] == pytest.approx((n <= at).mean())
    assert tokens.quantile(h, 0.5).first()[0] == sorted(n)[math.ceil(len(n) / 2) - 1]
    assert tokens.truncated_total(h, 37).first()[0] == np.minimum(n, 37).sum()
    assert tokens.length_histogram(tokens.token_counts(none)).count() == 0


def test_language_profiles(spark, none):
    r = random.Random(2)
    sounds = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ei", "er"], "ćć": ["ção", "lh", "ar", "os"]}
    rows = [(i, " ".join("".join(r.choices(sounds[lang], k=3)) for _ in range(40)), lang, "s", 0, 0, "", "") for i, lang in enumerate(list(sounds) * 30)]
    rows += [(1000, None, "aa", "s", 0, 0, "", ""), (1001, "12 34 !", None, "s", 0, 0, "", ""), (1002, "", "bb", None, 0, 0, "", ""), (1003, "²½ 7", "aa", None, 0, 0, "", "")]
    df = spark.createDataFrame(rows, SHAPE)
    found = by_id(langid.identify(df, langid.learn(langid.train_rows(df)), ["doc_id"]))
    assert all(found[i]["lang_pred"] == row[2] and 0 <= found[i]["score"] <= 1 for i, row in enumerate(rows) if i < 90)
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und"] * 4
    assert langid.learn(none).predict("anything") == ("und", 0.0)
    with pytest.raises(ValueError, match="more than 2"):
        langid.learn(df, most_langs=2)


def test_profile_is_the_most_frequent_runs():
    text = "Ab ba--ab!"
    counts = collections.Counter()
    m = "_ab_ba_ab_"
    for n in (1, 2, 3):
        counts.update(m[i : i + n] for i in range(len(m) - n + 1))
    del counts["_"]
    code = lambda s: sum(ord(c) << (21 * (len(s) - 1 - i)) for i, c in enumerate(s))
    expected = sorted(counts, key=lambda s: (-counts[s], code(s)))
    assert langid.ranked(langid.marked(text), 99).tolist() == [code(s) for s in expected]
    assert [x.tolist() for x in langid.runs(langid.marked(text * 50), most=7)] == [x.tolist() for x in langid.runs(langid.marked(text * 50))]


def test_mix(spark, docs, none):
    found = mixing.mix(docs, run_rows=5).collect()
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(3), run_rows=5).collect()}
    sources = {d["doc_id"]: (d["source"], len(WORD.findall(d["text"] or ""))) for d in docs.collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found} and len(found) == len(sources)
    sums, got, goal = collections.Counter(), collections.Counter(), {}
    for r in found:
        source, size = sources[r["doc_id"]]
        assert r["size"] == size and 0 <= r["taken"] <= 2 * size and r["taken"] == r["copies"] * size
        sums[source] += size
        got[source] += r["taken"]
        goal[source] = r["target"]
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, free, expected = 1.5 * sum(sums.values()), set(order), {}
    while True:
        level = (total - sum(expected.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sums[s]}
        if not over:
            break
        expected |= {s: 2.0 * sums[s] for s in over}
        free -= over
    expected |= {s: level * weight[s] for s in free}
    for s in order:
        assert goal[s] == pytest.approx(expected[s]) and abs(got[s] - goal[s]) <= max(60, 0.02 * goal[s])
    assert mixing.mix(none).count() == 0


def test_multipliers_solve_the_dual(spark):
    rows = [("a", s, 3) for s in range(1, 200)] + [(None, s, 2) for s in (1, 5, 5000)]
    h = spark.createDataFrame(rows, "source string, size long, n long")
    sums = {"a": 3 * sum(range(1, 200)), None: 2 * 5006}
    goals = spark.createDataFrame([(k, v, v * f, False) for (k, v), f in zip(sums.items(), (0.3, 1.7))], "source string, source_size long, target double, full boolean")
    for r in mixing.multipliers(h, goals, 2.0).collect():
        taken = sum(n * s * min(2.0, math.exp(r["multiplier"] * s)) for k, s, n in rows if k == r["source"])
        assert taken == pytest.approx(sums[r["source"]] * (0.3 if r["source"] == "a" else 1.7), rel=1e-8)


def test_shards(spark, docs, none):
    tree = sharding.balanced()
    found = by_id(sharding.assign(docs, tree, run_rows=2))
    slots = collections.defaultdict(list)
    for d in docs.collect():
        r, raw = found[d["doc_id"]], (d["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key") and 0 <= r["shard"] < 16
        assert r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.assign(none, tree).count() == 0


def test_shard_weights(spark):
    leaf = lambda i, w=1.0: sharding.Node(f"shard{i}", shard=i, own_weight=w)
    before = sharding.Node("root", (sharding.Node("a", (leaf(0), leaf(1))), sharding.Node("b", (leaf(2), leaf(3, 3.0)))))
    after = sharding.Node("root", (sharding.Node("a", (leaf(0), leaf(1))), sharding.Node("b", (leaf(2), leaf(3, 5.0)))))
    from pyspark.sql import functions as F

    key = F.col("id").cast("string")
    pairs = spark.range(20_000).select(sharding.shard_of(key, before).alias("x"), sharding.shard_of(key, after).alias("y")).groupBy("x", "y").count().collect()
    counts = collections.Counter()
    for r in pairs:
        counts[r["x"]] += r["count"]
        assert r["x"] == r["y"] or r["y"] in (2, 3), "rows move only into the subtree that grew"
    assert all(abs(counts[i] / 20_000 - w / 6) < 0.015 for i, w in enumerate((1, 1, 1, 3)))


def test_quality(spark, docs, none):
    found = by_id(quality.judge(docs))
    for d in docs.collect():
        t, r, seen, dup = d["text"] or "", found[d["doc_id"]], set(), 0
        w = WORD.findall(t)
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = list(zip(w, w[1:], w[2:]))
        often = collections.Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)), d
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert quality.judge(none).count() == 0


def test_boilerplate_lines(spark):
    r = random.Random(4)
    body = lambda n: " ".join("".join(r.choices("abcdefg", k=6)) for _ in range(n))
    menu = body(60)
    rows = [(i, f"{menu.upper() if i % 2 else menu}\n{body(10)}", None, "h1") for i in range(30)]  # depleted without the shared line
    rows += [(100 + i, f"{menu}\n{body(80)}", None, "h2") for i in range(5)]  # too few texts of that host
    rows += [(200 + i, f"All rights reserved.\n{body(80)}", None, None) for i in range(40)]  # little is lost
    rows += [(300 + i, "copy " + menu, None, "h1") for i in range(50)]  # copies of one text count once
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(df).collect()}
    assert kept == {row[0]: row[0] >= 100 for row in rows}


def test_cleaned_text_has_no_boilerplate_lines(spark):
    rows = [(i, f" All  Rights reserved.\n\nbody {i} of words\nall rights RESERVED.\n", None, "h") for i in range(30)] + [(99, None, None, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = by_id(quality.judge(df, with_text=True))
    assert all(found[i]["cleaned"] == f"\nbody {i} of words\n" and found[i]["n_left"] == 4 for i in range(30)) and found[99]["cleaned"] == ""


@pytest.mark.parametrize("times", [21, 50, 400])
def test_boilerplate_of_a_hot_host(spark, times):
    r = random.Random(14)
    body = lambda n: " ".join("".join(r.choices("abcdefg", k=6)) for _ in range(n))
    passage = body(60)
    rows = [(i, f"{passage}\n{body(10)}", None, "hot") for i in range(times)]
    rows += [(1000 + i, body(55), None, "hot") for i in range(200 * times)]  # the passage is in under 0.5 % of the host's texts
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert quality.judge(df.repartition(8)).where("kept <> (doc_id >= 1000)").count() == 0


def plain_tree(train, smoothing=32.0, tests=2.0):
    """The tree by dictionaries of whole contexts; gives (probability of a symbol after a past, counts of symbols)."""
    runs = [collections.Counter() for _ in range(4)]
    for symbols in train:
        for n in (1, 2, 3):
            runs[n].update(zip(*(symbols[i:] for i in range(n))))
    counts = {k[0]: n for k, n in runs[1].items() if k[0] != "<"}
    total = sum(counts.values())
    root = lambda w: (counts.get(w, 0) + 1) / (total + len(counts) + 1)
    held, states = collections.Counter(), set()

    def p(past, w, most):
        for n in range(min(most, len(past)), 0, -1):
            c = past[-n:]
            if c in states:
                k = runs[n + 1][(*c, w)]
                return ((k if k > 1 else 0) + (smoothing + runs[n][c] - held[c]) * p(past, w, n - 1)) / (runs[n][c] + smoothing)
        return root(w)

    for n in (1, 2):
        gain, symbols = collections.Counter(), collections.Counter()
        for k, times in runs[n + 1].items():
            c, w = k[:-1], k[-1]
            if times > 1:
                q = 2 ** (-round(-math.log2(p(c[1:], w, n - 1)) * 8) / 8)
                held[c] += times
                symbols[c] += 1
                gain[c] += times * math.log((times + smoothing * q) / ((runs[n][c] + smoothing) * q))
        for c, u in symbols.items():
            once = runs[n][c] - held[c]
            gain[c] += once * math.log((smoothing + once) / (runs[n][c] + smoothing)) if once else 0
            if 2 * gain[c] > u + tests * math.sqrt(2 * u):
                states.add(c)
    return lambda past, w: p(tuple(past), w, 2), counts, states


def symbols_of(text):
    return ["<", *WORD.findall(lower(text or "")), ">"]


def check_scores(rows, learned, found):
    probability, counts, states = plain_tree([symbols_of(t) for i, t in rows if learned(i)])
    total = sum(counts.values())
    for i, text in rows:
        s, r = symbols_of(text), found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(s) - 1, sum(w in counts for w in s[1:]), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in s[1:]))
        assert r["score"] == pytest.approx(sum(math.log10(probability(s[max(0, k - 2) : k], s[k])) for k in range(1, len(s))))
    return states


@pytest.mark.parametrize("piece", [300, 5000, 4 << 20])
def test_suffix_tree_scores(spark, docs, piece):
    rows = [(d["doc_id"], d["text"]) for d in docs.collect()]
    found = by_id(suffix_tree.score(docs, F.col("doc_id") % 3 != 0, piece=piece))
    states = check_scores(rows, lambda i: i % 3 != 0, found)
    assert {len(c) for c in states} == {1, 2}


def test_suffix_tree_query(spark, tmp_path):
    r = random.Random(12)
    body = lambda: " ".join(r.choice(["the", "of", "a", *(f"w{k}" for k in range(200))]) for _ in range(r.randint(0, 150)))
    texts = [body() for _ in range(60)]
    texts += texts[:10]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = by_id(suffix_tree.op8_suffix_tree(spark, f"file://{tmp_path}"))
    held = {i for i in range(70) if zlib.crc32(str(i).encode()) % 7 == 2}
    assert held and {i for i in found if found[i]["held_out"]} == held
    check_scores(list(enumerate(texts)), lambda i: i not in held, found)
    twice = [i for i in range(10) if i not in held and 60 + i not in held and len(texts[i]) > 200]
    mean = lambda i: found[i]["score"] / found[i]["n_tokens"]
    assert min(mean(i) for i in twice) > max(mean(i) for i in range(10, 60) if len(texts[i]) > 200)


def test_suffix_tree_without_rows(spark, docs, none):
    assert suffix_tree.score(none).count() == 0
    empty = by_id(suffix_tree.score(docs, F.lit(False)))
    assert all(r["n_known"] == 0 and r["base_score"] == 0 and r["score"] == 0 for r in empty.values())


def test_packed_numbers():
    r = random.Random(2)
    for n in (0, 1, 5, 300):
        for most in (0, 1, 255, 256, (1 << 64) - 1):
            x = np.array(sorted(r.randint(0, most) for _ in range(n)), np.uint64)
            assert suffix_tree.unpacked(suffix_tree.packed(x)).tolist() == x.tolist() == suffix_tree.unpacked(suffix_tree.packed(x, True), True).tolist()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- c <p>no</p> -->
<main><article><h1>Big &amp; bold</h1><script>var s="</p><p>no</p>";</script><p>First <b>par<i>a</i>
 graph&nbsp;here<br>next<p>Second &lt;one&gt;</p><div class="ad banner">Buy</div><ul><li>item a<li>item b</ul>
<form><input><p>mail</p></form><table><tr><td>c1<td>c2</table><section id="comments"><article class="comment"><p>I think</p></article></section></article></main>
<aside><p>related</p></aside><footer>&copy; x</footer></body>"""


def test_html(spark):
    assert html_text.main_text(PAGE).split("\n") == ["Big & bold", "First para graph here next", "Second <one>", "item a", "item b", "c1", "c2"]
    plain = "<body><div id=menu><a href=a>A</a></div><div>" + "<p>word " * 30 + "</div><p></p><p></p><p></p><p><a href=q>link link</a></p>"
    assert html_text.main_text(plain) == "\n".join(["word"] * 30)
    for odd in (None, "", "   ", "<", "<p", "<p title=\"x", "</p></div>", "plain text", "<!-- open", "<script>x", "&#xZZ; &bogus; &#128512;", "<p>" * 3000):
        assert isinstance(html_text.main_text(odd), str)
    assert html_text.main_text("plain text") == "plain text" and html_text.main_text("a &lt; b") == "a < b"
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (None, None, None, "y"), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    found = html_text.extract(df).collect()
    assert [r["n_chars"] for r in found if r["page_id"] is None] == [0] and len(found) == 3
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_html_is_read_once_whatever_is_left_open():
    import time

    pages = ["<a " * 350_000, '<a x="y <b> ' * 90_000, '<a href="' * 110_000 + ">", "<script>" + "</script " * 110_000, "<div>" * 90_000 + "</b>" * 120_000, "<b><table>" + "<i>" * 150_000 + "</b>" * 120_000]
    pages += ["<nav>" + "<i>" * 100_000 + "<article>" * 60_000, "<!x " * 250_000, "<![CDATA[" * 100_000 + ">", "<!--" * 200_000, "<p><li>" * 100_000, "<a " + "class='" * 100_000 + ">"]
    for page in pages:
        began = time.process_time()
        html_text.main_text(page)
        assert time.process_time() - began < 8, page[:20]
    assert html_text.main_text('<article><p title="a>b">one</p><p title="c>two</p></article>').split("\n")[0] == "one"


def test_html_keeps_text_in_parts_of_an_article_that_only_sound_like_others():
    inner = '<p class="social-history">History of social life.</p><div id="alert-level">At level two.</div><p class="search-and-rescue">They searched.</p>'
    gone = '<div class="ad-banner">Buy</div><div class="related-articles">More</div><div class="share">S</div><ul id="comments-list"><li>I think</ul><div class="notice">Note</div>'
    assert html_text.main_text(f"<article><h1>T</h1>{inner}{gone}<p>End.</p></article>").split("\n") == ["T", "History of social life.", "At level two.", "They searched.", "End."]


def test_html_detects_text_on_pages_with_articles():
    body = [f"paragraph {i} of the body " + "word " * 30 for i in range(6)]
    said = [" ".join(b.split()) for b in body]
    inner = "".join(f"<p>{b}</p>" for b in body)
    teaser = "<article><h3>Other story</h3></article>"
    assert html_text.main_text(f"<nav><a>menu</a></nav><div>{inner}</div>{teaser}<div>short tail</div>").split("\n") == [*said, "Other story"]
    assert html_text.main_text(f"{teaser}<div>a</div><div>{inner}</div>").split("\n")[-6:] == said
    ads = "<div class=ad>Buy</div>" * 4
    assert html_text.main_text(f"<div><p>{body[0]}</p>{ads}<p>And so on.</p></div>").split("\n") == [said[0], "And so on."]
    assert html_text.main_text(f"<p>Site</p>{ads}<div>{inner}</div>").split("\n") == said


def test_html_keeps_random_articles():
    r = random.Random(8)
    for _ in range(50):
        blocks = [" ".join("w" * r.randint(1, 9) for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 12))]
        page = f"<nav>{'<a>menu</a>' * 9}</nav><article>{''.join(f'<p>{html.escape(b)}</p>' for b in blocks)}</article><footer>{'foot ' * 40}</footer>"
        assert html_text.main_text(page) == "\n".join(blocks)


def test_decontamination(spark, docs, none):
    r, fold = random.Random(9), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = [d["text"] or "" for d in docs.collect()]
    longer = [t for t in texts if len(fold.findall(lower(t))) > 40]
    items = [(i, " ".join(fold.findall(lower(r.choice(longer)))[k : k + r.choice([1, 3, 9, 10, 11, 30])])) for i, k in enumerate(r.choices(range(30), k=25))]
    items += [(100, None), (101, ""), (102, "..."), (5, "never seen words at all in any of the texts here"), (None, "two words"), (11, items[11][1])]
    found = by_id(decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), filter_bits=12))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = fold.findall(lower(t or ""))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    for d in docs.collect():
        w, hit, names = fold.findall(lower(d["text"] or "")), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    names |= ids - {None}
        row = found[d["doc_id"]]
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"], row["contaminated"]) == (len(w), len(hit), len(names), digest, bool(hit))
    assert decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string")).where("contaminated").count() == 0
    assert decontaminate.contamination(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_winnowing_keeps_one_of_every_window():
    hashes = np.random.default_rng(1).integers(0, 6, 500).astype(np.uint64)
    kept = decontaminate.winnow(hashes, 4)
    assert all(kept[i : i + 4].any() for i in range(497)) and not kept.all()


def test_hit_spans_and_items(spark):
    item = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(1, " ".join(["a", "b", *item, "c"])), (2, "nothing here"), (3, "x two words y")], "doc_id long, text string")
    found = by_id(decontaminate.hits(docs, spark.createDataFrame([(7, " ".join(item)), (8, "two words")], "item_id long, text string")))
    assert [tuple(x) for x in found[1]["spans"]] == [(2, 12), (3, 13), (4, 14)] and found[1]["items"] == ["7"]
    assert found[2]["spans"] == [] and found[2]["items"] == []
    assert [tuple(x) for x in found[3]["spans"]] == [(1, 3)] and found[3]["items"] == ["8"]


def scanned(page, width=3, threshold=86, prior=8):
    """Surges and dives by brute force: every block summed anew."""
    found = html_text.lines_of(page)
    own = [(prior * len(t) if inside else n) if t else 0 for t, n, inside in found]
    if not any(own):
        own = [len(t) for t, _, _ in found]
    side = []
    for t, _, inside in found:
        side.append(inside if t else bool(side) and side[-1])
    def block(places, k):
        total = 0
        for j in places[k : k + width]:
            if side[j] != side[places[k]]:
                break
            total += own[j]
        return total
    every, told = list(range(len(found))), [i for i, f in enumerate(found) if f[0]]
    surge = min(threshold, max((block(every, k) for k in every), default=0) - 1)
    kept, on, last = [], False, None
    for k, i in enumerate(told):
        on = block(told, k) > 0 if on and side[i] == last else block(every, i) > surge
        last = side[i]
        if on and own[i]:
            kept.append(found[i][0])
    return "\n".join(kept)


def test_blocks_decide_on_any_page():
    r = random.Random(8)
    tags = ["p", "div", "li", "h2", "nav", "article", "aside", "footer", "section", "a"]
    for _ in range(400):
        page = ""
        for _ in range(r.randint(0, 14)):
            tag, words = r.choice(tags), " ".join(r.choice(["ab", "cde", "<a href=x>link text</a>", "&amp;"]) for _ in range(r.choice([0, 1, 3, 12, 40])))
            page += r.choice(["<{0}>{1}</{0}>", "<{0}>{1}", "{1}<br>", "<{0} class=ad>{1}</{0}>"]).format(tag, words)
        assert html_text.main_text(page) == scanned(page)


def test_articles_are_found_without_names():
    r = random.Random(9)
    say = lambda n: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(n))
    for _ in range(50):
        body = [say(5), *(say(r.randint(12, 90)) for _ in range(r.randint(2, 6)))]
        menu = "".join(f"<li><a href=/{i}>{say(1)}</a></li>" for i in range(6))
        article = "".join(f"<p>{x}</p>" for x in body)
        named = f'<nav id="menu"><ul>{menu}</ul></nav><div class="ad">{say(4)}</div><article class="post"><h1>{say(3)}</h1>{article}</article><footer>{say(9)}</footer>'
        plain = re.sub(r"<(/?)(article|nav|footer)", r"<\1div", re.sub(r' (?:class|id|role)="[^"]*"', "", named))
        assert html_text.main_text(named).split("\n")[1:] == body
        assert set(body) <= set(html_text.main_text(plain).split("\n"))
    assert html_text.main_text("<p><a href=x>nothing but a link</a></p>") == "nothing but a link"
    assert html_text.main_text("<article><p>so <math><mi>x</mi></math> is</p></article>") == "so x is"


def runs_of(text):
    """Runs of one to three characters of a text's letters between marks."""
    marked, last = "_", "_"
    for c in (text or "").lower():
        now = c if c.isalpha() else "_"
        if now != "_" or last != "_":
            marked += now
        last = now
    marked += "" if last == "_" else "_"
    out = collections.Counter()
    for n in (1, 2, 3):
        out.update(x for i in range(len(marked) - n + 1) if (x := marked[i : i + n]) != "_")
    return out if any(c != "_" for c in marked) else collections.Counter()


def profile_of(counts, size=400):
    return [k for k, _ in sorted(counts.items(), key=lambda x: (-x[1], [ord(c) for c in x[0].rjust(3, "\0")]))][:size]


def test_language_query(spark, tmp_path):
    r = random.Random(15)
    tongues = {"en": "the of and to in is that it was for", "de": "der die und in den von zu das mit sich", "fr": "le de la et les des en un du une", None: "lorem ipsum dolor sit amet"}
    rows = [(i, None if i == 7 else " ".join(r.choice(tongues[lang].split()) + r.choice(["", "s", ",", ".\n"]) for _ in range(r.randint(1, 60))), lang, "s", 0, 0, "", "") for i, lang in ((i, r.choice(list(tongues))) for i in range(120))]
    rows += [(200, "", "en", "s", 0, 0, "", ""), (201, "123 -- !", "en", "s", 0, 0, "", ""), (202, "Ünïcode ñandú Ça", "fr", "s", 0, 0, "", ""), (203, "x" * 70, None, "s", 0, 0, "", "")]
    spark.createDataFrame(rows, SHAPE).write.parquet(f"{tmp_path}/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    learned = collections.defaultdict(collections.Counter)
    for i, text, lang, *_ in rows:
        if lang is not None and not held(i):
            learned[lang].update(runs_of(text))
    ranks = {lang: {k: n for n, k in enumerate(profile_of(c))} for lang, c in learned.items()}
    found = by_id(langid.op3_rank_order(spark, f"file://{tmp_path}"))
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        own = profile_of(runs_of(text))
        away = {lang: sum(abs(table[k] - n) if k in table else 400 for n, k in enumerate(own)) for lang, table in ranks.items()}
        best = min(sorted(away), key=away.get) if own else "und"
        assert (found[i]["held_out"], found[i]["lang_pred"]) == (held(i), best), text
        assert found[i]["score"] == pytest.approx(1 - away[best] / (400 * len(own)) if own else 0.0)


def test_shards_descend_as_said(spark, docs):
    tree = sharding.balanced()
    grown = sharding.grown(tree)

    def descend(key, node, path=""):
        if not node.children:
            return node.shard
        best = None
        for child in node.children:
            own = f"{path}/{child.name}"
            h = xxhash.xxh64_intdigest(own.encode(), xxhash.xxh64_intdigest(key.encode(), 42))
            draw = -math.log(((h >> 11) + 0.5) / (1 << 53)) / child.weight
            if best is None or draw < best[0]:
                best = (draw, child, own)
        return descend(key, best[1], best[2])

    found = sharding.assign(docs, tree).collect()
    assert {r["shard"] for r in found} <= set(range(16))
    for r in found:
        assert (r["shard"], r["grown_shard"]) == (descend(str(r["doc_id"]), tree), descend(str(r["doc_id"]), grown))


def test_boilerplate_with_other_line_ends(spark):
    body = lambda i: f"\tMenu  home\r\n{' '.join(f'w{i}x{k}' for k in range(60))}\n"
    rows = [(i, body(i) if i % 2 else body(i).replace("\tMenu  home\r", "menu home"), "en", "s1", 0, 0, "", "") for i in range(40)]
    found = quality.judge(spark.createDataFrame(rows, SHAPE), with_text=True).collect()
    assert all(r["n_left"] == 60 and r["kept"] and "enu" not in r["cleaned"] for r in found)


def test_rare_members_find_all_similar_sets(spark):
    from tidewater.llm import minhash

    r = random.Random(21)
    sets, common = {}, [r.getrandbits(60) for _ in range(60)]
    for i in range(60):
        if i % 3 == 0 or not sets:
            sets[i] = {r.getrandbits(60) for _ in range(r.randint(1, 80))}
        else:
            old = sorted(sets[r.choice(list(sets))])
            sets[i] = set(r.sample(old, max(1, int(len(old) * r.uniform(0.7, 1))))) | {r.getrandbits(60) for _ in range(r.randint(0, 8))}
    passage = range(100, 140)
    for i in passage:
        sets[i] = {*common, *(r.getrandbits(60) for _ in range(30))}
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "copy long, hashes array<long>").repartition(4)
    found = {frozenset(p) for p in minhash.candidates(frame, 0.8).collect()}
    near = {frozenset((i, j)) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    assert near and near <= found and not any(p <= set(passage) for p in found)
    assert minhash.candidates(frame.where("false"), 0.8).count() == 0
