"""A diff put to the old text gives the new one."""

import random

from pyspark.sql import functions as F

from tidewater.functions import diffs


def test_patches_give_the_new_text(spark):
    r = random.Random(12)
    some = lambda: [r.choice(["a", "b", "", "@@ -1 +1 @@", "--- x", "+y", " z", "same", "same"]) for _ in range(r.randint(0, 40))]
    pairs = [("", ""), ("", "a"), ("a", ""), ("a\n", "a"), (None, "x\ny"), ("a\nb\nc", "c\nb\na")]
    for _ in range(300):
        old = some()
        new = list(old)
        for _ in range(r.randint(0, 6)):
            at = r.randint(0, len(new))
            new[at : at + r.randint(0, 3)] = some()[: r.randint(0, 3)]
        pairs.append(("\n".join(old), "\n".join(new)))
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id int, a string, b string").withColumn("diff", diffs.unified_diff("a", "b"))
    found = {x["id"]: x["p"] for x in frame.select("id", diffs.patched(F.coalesce("a", F.lit("")), F.col("diff")).alias("p")).collect()}
    assert {i: p for i, p in found.items()} == {i: "\n".join((b or "").splitlines()) for i, (a, b) in enumerate(pairs)}


def test_patches_that_do_not_fit_give_null(spark):
    diff = diffs.unified("a\nb\nc", "a\nx\nc")
    frame = spark.createDataFrame([("a\nb\nc", diff), ("a\nb\nd", diff), ("b\nc", diff), ("a\nb\nc", None), (None, diff)], "old string, diff string")
    assert [x[0] for x in frame.select(diffs.patched(F.col("old"), F.col("diff"))).collect()] == ["a\nx\nc", None, None, "a\nb\nc", None]


def test_the_edit_without_an_artifact_and_what_stays_as_it_is():
    from tidewater.functions import mutators
    from tidewater.plans import edits

    assert mutators.UNDISPATCHED["acc48_for_acc80_reverse"]("aie::accum<acc48, 8> a;") == "aie::accum<acc80, 8> a;"
    assert {s for s, _, _ in edits.RECORDED} == set(mutators.REGISTRY)
    assert all(edit("// nothing here\n") is None for edit in mutators.REGISTRY.values())
