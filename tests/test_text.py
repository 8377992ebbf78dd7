"""Hashes, keys and text rules against Python's own."""

import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from tidewater.functions import text as X

TEXTS = ["", "plain", "0", "a\r\nb\rc\n", "x\x0by\x0cz", "nel\x85ls ps end", "\xa0 em space ", "naïve 😀 \U0001f409", "é", 'quo"te\\back\tslash\x01\x1f\x7f', "// c http://x\nlive /* // */ tail */ 12 345", "A\n\n B   C\t"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").cache()


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(("algorithm", "k"), [("md5", 5), ("md5", 27), ("sha1", 100), ("sha1", 7919)])
def test_hash_mod(texts, algorithm, k):
    assert values(texts, X.hash_mod(F.col("t"), k, algorithm)) == [int(hashlib.new(algorithm, t.encode()).hexdigest(), 16) % k for t in TEXTS]


def test_strip_lines_and_spaces(texts):
    assert values(texts, X.strip(F.col("t"))) == [t.strip() for t in TEXTS]
    assert values(texts, X.lines(F.col("t"))) == [t.splitlines() for t in TEXTS]
    assert values(texts, X.one_space(F.col("t")))[-1] == "A B C "


@pytest.mark.parametrize("ascii_only", [False, True])
def test_json_text(texts, ascii_only):
    assert values(texts, X.json_text(F.col("t"), ascii_only)) == [json.dumps(t, ensure_ascii=ascii_only) for t in TEXTS]


def test_canonical_json_and_keys(texts):
    found = values(texts, X.canonical_json(True, slug=F.col("t"), a=F.lit("x"), n=F.lit(None).cast("string")))
    assert found == [json.dumps({"slug": t, "a": "x", "n": None}, sort_keys=True) for t in TEXTS]
    keys = values(texts, X.row_key(F.col("t"), F.lit("v"), F.lit(None).cast("string"), F.lit("b")))
    assert keys == [hashlib.md5(json.dumps({"instruction": t, "variant": "v", "source": "", "bug_type": "b"}, sort_keys=True).encode()).hexdigest() for t in TEXTS]
    ids = values(texts, X.row_id(F.lit("s"), F.col("t"), F.lit("r")))
    assert ids == [hashlib.sha1(json.dumps({"slug": "s", "context": t, "response": "r"}, ensure_ascii=False, sort_keys=True).encode()).hexdigest() for t in TEXTS]


def test_fingerprint_follows_the_order_of_its_rules(texts):
    def expected(t):
        t = re.sub(r"//.*", "", t.lower())
        t = re.sub(r"/\*.*?\*/", "", t, flags=re.S)
        return re.sub(r"\s+", " ", re.sub(r"\d+", "<n>", t)).strip()

    assert values(texts, X.normalized(F.col("t"))) == [expected(t) for t in TEXTS]
    assert values(texts, X.fingerprint(F.col("t"), 5)) == [hashlib.md5(expected(t)[:5].encode()).hexdigest() for t in TEXTS]


def test_content_hash(texts):
    assert values(texts, X.content_hash(F.col("t"))) == [hashlib.sha256(t.replace("\r\n", "\n").strip().encode()).hexdigest() for t in TEXTS]


def test_defaults_take_empty_for_missing(spark):
    df = spark.createDataFrame([(0, None, None), (1, "", 0), (2, "0", 5)], "i int, t string, n int")
    assert values(df, X.or_text(F.col("t"), F.lit("d"))) == ["d", "d", "0"]
    assert values(df, X.or_number(F.col("n"), F.lit(9))) == [9, 9, 5]


def test_replace_first_slug_and_choices(spark):
    df = spark.createDataFrame([(0, "a-b-c 8×4 Lanes!", "k1"), (1, "none", "k2")], "i int, t string, k string")
    assert values(df, X.replace_first(F.col("t"), "-", "+")) == ["a+b-c 8×4 Lanes!", "none"]
    assert values(df, X.slug(F.col("t"))) == ["a_b_c_8x4_lanes", "none"]
    pick = lambda k, n: int(hashlib.md5(k.encode()).hexdigest(), 16) % n
    assert values(df, X.choose(F.col("k"), ["x", "y", "z"])) == ["xyz"[pick(k, 3)] for k in ("k1", "k2")]
    pools = ["n"] * 4 + ["s"] * 4 + ["h"] * 2
    assert values(df, X.weighted_choice(F.col("k"), [("n", 4), ("s", 4), ("h", 2)])) == [pools[pick(k, 10)] for k in ("k1", "k2")]
