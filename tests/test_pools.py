"""Picks from pools that are tables."""

import hashlib

from pyspark.sql import functions as F

from tidewater.operators import pools

MIX = [("m", "normal", 1, "a", 2, None, None), ("m", "normal", 2, "b", 3, "what", "a"), ("m", "hard", 1, "b", 1, "what", "a"), ("n", "hard", 1, "a", 1, None, None), ("m", "hard", 2, "never", 0, None, None)]
SAID = [("m", "a", "sa", 2, "second {no} {{odd}"), ("m", "a", "sa", 1, "first"), ("m", "b", "sb", 1, "saw {what}, {what}!"), ("n", "a", "x", 1, "n")]


def place(key, size):
    return int(hashlib.md5(key.encode()).hexdigest(), 16) % size


def test_pools_and_templates(spark):
    mix = spark.createDataFrame(MIX, "mode string, tier string, place int, pool string, weight int, needs string, otherwise string")
    said = spark.createDataFrame(SAID, "mode string, pool string, seed string, place int, template string")
    rows = [(f"k{i}", m, t, w) for i in range(40) for m in ("m", "n", "o") for t in ("normal", "hard", "new", None) for w in ("it {x}", "", None)]
    frame = spark.createDataFrame(rows, "key string, mode string, tier string, what string")
    found = {(r["key"], r["mode"], r["tier"], r["what"]): (r["pool"], r["instruction"]) for r in pools.instructions(frame, mix, said, "mode", "tier", "key", {"what": F.col("what")}).collect()}
    expected = {}
    for key, mode, tier, what in rows:
        if mode == "o" or mode == "n" and tier != "hard":
            continue  # no mix, and none for normal
        if mode == "n":
            expected[key, mode, tier, what] = ("a", "n")
            continue
        pool = "b" if tier == "hard" or place(f"pool:{key}", 5) >= 2 else "a"
        pool = pool if what else "a"
        text = f"saw {what}, {what}!" if pool == "b" else ["first", "second odd"][place(f"sa:{key}", 2)]
        expected[key, mode, tier, what] = (pool, text)
    plain = lambda x: (x[0], x[1].replace("  ", " ").strip()) if x[0] == "a" else x
    assert {k: plain(v) for k, v in found.items()} == expected
