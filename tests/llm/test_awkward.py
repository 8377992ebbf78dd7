"""Every registered query on tables with nulls, repeats, a text of several MB, clashing columns, and on empty tables."""

import random

import pytest

from tidewater.llm import registry

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, draw string, chunk string, score string, copy string, bucket string, words string, body string"
PAGES = "page_id long, url string, html string, text string, n_chars string, at string"
TURNS = "conv_id long, turn long, role string, text string, ids string, loss string, block string"
ITEMS = "item_id long, text string, n string, key string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("awkward")
    r = random.Random(31)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 9)))
    long = " ".join(word() for _ in range(450_000))
    body = " ".join(word() for _ in range(80))
    texts = [None, "", " \n\t ", body, body, body + " tail", long, "x" * 200_000, "one", "\x1c\x1d odd \x85 marks", "日本語 テキスト", "a a a a a a", "!!"]
    more = ["r", "1", "d", "c", "9", "k", "b", "w", "y"]
    rows = [(None if i == 3 else i // 2, t, r.choice(["en", "de", None]), r.choice(["s1", None, ""]), 0, *more) for i, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{at}/some/documents.parquet")
    page = f"<article><h1>{body}</h1><p>{body}</p></article>"
    spark.createDataFrame([(1, "u", page, "t", "n", "a"), (1, "u", page, "t", "n", "a"), (None, None, None, None, None, None), (2, "v", "", "", "", ""), (3, "w", f"<p>{long}</p>", "", "", "")], PAGES).write.parquet(f"{at}/some/pages.parquet")
    spark.createDataFrame([(1, body, "n", "k"), (1, body, "n", "k"), (None, "a a", "n", "k"), (2, None, None, None), (3, "", "", "")], ITEMS).write.parquet(f"{at}/some/benchmark.parquet")
    said = [(1, 0, "user", body), (1, 0, "user", body), (None, None, None, None), (2, 1, "assistant", long), (2, 0, "user", "</turn>"), (None, 1, "assistant", "")]
    spark.createDataFrame([(*t, "i", "l", "b") for t in said], TURNS).write.parquet(f"{at}/some/conversations.parquet")
    for name in ("documents", "pages", "benchmark", "conversations"):
        spark.read.parquet(f"{at}/some/{name}.parquet").where("false").write.parquet(f"{at}/none/{name}.parquet")
    return f"file://{at}", len(rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, folder, name):
    at, n = folder
    found = registry.QUERIES[name](spark, f"{at}/some")
    n_rows = found.count()
    assert n_rows == {"op4_lengths": n_rows, "op9_line_blocks": 5, "op12_token_assembly": 4}.get(name, n) and n_rows > 0
    empty = registry.QUERIES[name](spark, f"{at}/none")
    assert empty.columns == found.columns and empty.count() == (name == "op12_token_assembly")  # a conversation of its own is always there
