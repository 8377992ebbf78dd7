"""Many keys against many texts: automata in parts give what testing key by key gives."""

import random
import time
from pathlib import Path

import duckdb
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.operators import patterns, windows
from tidewater.plans import catalog

DATA = Path("/root/testdata/sf0.01")


def plain_hits(rows, keys):
    out = []
    for i, text in rows:
        for k in {k for k in keys if k is not None}:
            at = [] if text is None else [j for j in range(len(text) - len(k) + 1) if text.startswith(k, j)]
            if at:
                out.append((i, k, len(at), at[0]))
    return sorted(out)


@pytest.mark.parametrize("part_bytes", [4, 60, 1 << 20])
def test_hits_of_awkward_keys(spark, part_bytes):
    r = random.Random(8)
    texts = [None, "", "aaaa", "日本語日本", "a\nb", *("".join(r.choice("ab日 ") for _ in range(r.randint(0, 40))) for _ in range(60))]
    rows = list(enumerate(texts)) + [(2, "aaaa")]
    keys = [None, "", "a", "a", "aa", "日本", "b ", "nowhere", *("".join(r.choice("ab日 ") for _ in range(r.randint(1, 6))) for _ in range(40))]
    frame, table = spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(k,) for k in keys], "word string")
    found = patterns.hits(frame.repartition(3), ["id"], "text", table, "word", part_bytes)
    assert sorted(map(tuple, found.collect())) == plain_hits(rows, keys)
    assert patterns.hits(frame, ["id"], "text", table.where("false"), "word", part_bytes).count() == 0
    assert patterns.hits(frame.where("false"), ["id"], "text", table, "word", part_bytes).count() == 0


def test_theta_rows_repeat_keep_their_order_and_count(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, "zz")], "id long, text string")
    table = spark.createDataFrame([(2, "b", "B"), (1, "a", "A"), (1, "a", "A2"), (0, " ", "S")], "at int, word string, message string")
    found = patterns.theta_contains(frame, "text", table, "word", "at", place="p", count="of").orderBy("p").collect()
    assert [(r["id"], r["p"], r["of"]) for r in found] == [(1, k, 4) for k in (1, 1, 2, 2, 3, 3, 4, 4)]
    assert [r["message"] for r in found][::2][0] == "S" and {r["message"] for r in found[2:6]} == {"A", "A2"}


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
def test_two_hundred_thousand_keys(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    w = F.split("text", " ")
    pairs = docs.select(F.explode(F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))).alias("word")).where("length(word) > 8").distinct().orderBy(F.md5("word")).limit(200_000)
    keys = [r["word"] for r in pairs.collect()]
    assert len(keys) == 200_000
    table = spark.createDataFrame([(k,) for k in keys], "word string")
    began = time.time()
    found = patterns.hits(docs, ["doc_id"], "text", table, "word", 1 << 20)
    got = {tuple(r) for r in found.select("doc_id", "word").collect()}
    took = time.time() - began
    con = duckdb.connect()
    con.register("k", pd.DataFrame({"word": keys}))
    some = con.execute(f"select doc_id, word from read_parquet('{DATA}/documents.parquet') join k on contains(text, word) where doc_id % 20 = 0").fetchall()  # every 20th document, as SQL tests each key
    assert set(some) == {x for x in got if x[0] % 20 == 0} and len(some) > 10_000
    assert took < 120


@pytest.mark.parametrize("at_once", [1, 70, 1 << 19])
def test_windows_find_what_automata_find(monkeypatch, at_once):
    monkeypatch.setattr(windows, "BYTES", at_once)
    r = random.Random(at_once)
    made = lambda most: "".join(r.choice("ab日é ") for _ in range(r.randint(0, most)))
    for n_keys in (0, 1, 30, 120):
        texts, keys = ["", *(made(60) for _ in range(25)), "aaaaaaaaaaaa"], sorted({k for k in (made(14) for _ in range(n_keys)) if k})
        t, column, found = windows.table(pa.array(keys, pa.string())), pa.array(["before", *texts]).slice(1), []
        for start, stop in windows.slices(column):
            rows, names, times, firsts = windows.hits(column.slice(start, stop - start), t)
            found += zip((rows + start).tolist(), names.to_pylist(), times.tolist(), firsts.tolist())
        assert sorted(found) == plain_hits(list(enumerate(texts)), keys)


def test_windows_compare_bytes_where_hashes_agree(monkeypatch):
    monkeypatch.setattr(windows._Sums, "hashes", lambda self, at, size, salt=0: at.astype("uint64") * 0 + 7)
    keys, texts = ["aa", "ab", "abc", "b"], ["abcab", "xaa", ""]
    rows, names, times, firsts = windows.hits(pa.array(texts), windows.table(pa.array(keys)))
    assert sorted(zip(rows.tolist(), names.to_pylist(), times.tolist(), firsts.tolist())) == plain_hits(list(enumerate(texts)), keys)


def test_passes_do_not_grow_with_the_parts_of_automata(spark):
    table = spark.range(20_000).selectExpr("concat('word', id) as word").union(spark.sql("select 'w'"))
    texts = spark.range(300).selectExpr("id", "concat('a word', id * 70, '8 word', id) as text")
    found = patterns.hits(texts, ["id"], "text", table, "word", 16 << 10)  # 170 kB: eleven automata before
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    want = plain_hits([tuple(r) for r in texts.where("id < 4").collect()], [r["word"] for r in table.collect()])
    assert sorted(map(tuple, found.where("id < 4").collect())) == want


@pytest.mark.parametrize("part_bytes", [20, 1 << 20])
def test_lists_hold_a_texts_keys_in_order(spark, part_bytes):
    r = random.Random(5)
    made = lambda most: "".join(r.choice("ab日é  ") for _ in range(most))
    for least, spaced in ((0, True), (1, False), (6, False)):
        keys = [None, *(made(r.randint(least, 12)) for _ in range(100))]
        keys = [k for k in keys if k is None or (len(k) >= least and (spaced or " " not in k))]
        rows = [*enumerate([None, "", " ", "  a", *(made(r.randint(0, 90)) for _ in range(60)), *(f"x{k} {k} {k}" for k in keys[1:20])]), (5, " ".join(k for k in keys if k))]
        frame, table = spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(k,) for k in keys], "word string")
        found = patterns.lists(frame, ["id"], "text", table, "word", part_bytes).collect()
        want = {}
        for at, (i, text) in enumerate(rows):
            for _, k, _, first in sorted(plain_hits([(i, text)], keys), key=lambda h: h[1].encode()):
                want.setdefault((at, i), []).append((k, first))
        assert sorted((x["id"], list(zip(x["word"], x["firsts"]))) for x in found) == sorted((i, met) for (_, i), met in want.items())
        assert sorted(map(tuple, patterns.hits(frame, ["id"], "text", table, "word", part_bytes).collect())) == plain_hits(rows, keys)


def test_a_piece_of_many_texts_is_searched_once():
    seen = []
    t = windows.table(pa.array(["abcdef", "cdefgh"]))
    search = lambda texts: seen.extend(texts.to_pylist()) or windows.met(texts, t)
    texts = ["abcdefgh abc", "", "é abcdefgh abcdefgh", "abcdef"] * 40
    rows, keys, times, firsts = windows.merged(*windows.in_pieces(pa.array(texts), 6, search))
    assert sorted(seen) == ["abcdef", "abcdefgh"]
    assert sorted(zip(rows.tolist(), t.names(keys).to_pylist(), times.tolist(), firsts.tolist())) == plain_hits(list(enumerate(texts)), ["abcdef", "cdefgh"])


def test_texts_of_one_row_group_are_dealt_over_tasks(spark):
    frame, table = spark.range(300).selectExpr("id", "concat('a word', id) as text").coalesce(1), spark.createDataFrame([("word7",)], "word string")
    for found in (patterns.hits(frame, ["id"], "text", table, "word"), patterns.lists(frame, ["id"], "text", table, "word")):
        assert found.selectExpr("spark_partition_id() as part").distinct().count() > 8


@pytest.mark.parametrize("ids", [[1, 2, 3, None, 5, 6], [1, 2, 2, None, None, 2]])
def test_words_in_texts_read_whole_tables_and_join_no_hits(spark, tmp_path, ids):
    texts = ["eins zweidrei vierfünf zweidrei", "xzweidreixx", "vierfünf und zweidrei", "nothing", None, "ünfsechs\nsieben vierfünfsechs\nsiebenacht"]
    said = ["zweidrei vierfünf eins", None, "fünfsechs\nsieben xzweidreix", "dreivier zweidrei"]
    texts, ids = texts + [f"nr{i}zweidrei vierfünf" for i in range(3000)], ids + list(range(10, 3010))
    said += [f"word nr{i}zwei" for i in range(0, 3000, 7)]
    con = duckdb.connect()
    for name, frame in (("documents", pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "text": texts})), ("conversations", pd.DataFrame({"conv_id": range(len(said)), "text": said}))):
        con.register("f", frame)
        con.execute(f"copy f to '{tmp_path}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")
    got = catalog.words_in_texts(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(catalog.ORACLES["words_in_texts"]).fetchall(), key=str)
    if len(set(ids)) == len(ids):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Aggregate" not in plan and "Join" not in plan
