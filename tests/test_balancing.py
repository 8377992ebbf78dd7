"""The balanced build against a plain loop over random rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions.text import fingerprint
from tidewater.operators import rows

SHAPE = "id long, key string, context string, variant string, bug_type string, source_group string, repo string, tier string, split string"
TIERS = {"easy": 0.3, "normal": 0.2, "hard": 0.25}


def some_rows(seed, n=160, bugs=0.5):
    r = random.Random(seed)
    out = []
    for i in range(n):
        bug = r.choice(["b1", "b2", "b3"]) if r.random() < bugs else r.choice([None, ""])
        variant = r.choice([rows.TAXONOMY_VARIANT, "bug_fix_pair_cropped"]) if bug else r.choice(["generation", "explain", None, "bug_fix_pair", "debug_hint"] if r.random() < 0.3 and bugs else ["generation", None])
        out.append((i, f"k{r.randrange(n):03}", f"code {'abcdefgh'[r.randrange(8)] * r.randint(1, 3)}", variant, bug, r.choice(["g1", "g2", "g3", "", None]), r.choice(["r1", "r2", None]), r.choice(["easy", "normal", "hard", "odd", None]), r.choice(["train", "validation"])))
    return out


def loop(data, prints, target, most_type, most_group, repo_share):
    """The same rules one row after another."""
    data = sorted(({"id": i, "key": k, "variant": v or "", "bug": b or "", "group": g or "unknown", "repo": "local" if repo is None else repo, "tier": t or "normal", "split": s} for i, k, _, v, b, g, repo, t, s in data), key=lambda x: (x["key"], x["id"]))
    for x in data:
        x["about"] = bool(x["bug"]) or x["variant"] in rows.BUG_VARIANTS or "debug" in x["variant"]
    stay = []
    for split in ("train", "validation"):
        own = [x for x in data if x["split"] == split]
        bugs, other = [x for x in own if x["about"]], [x for x in own if not x["about"]]
        if not bugs:
            stay += own
            continue
        seen, types, groups, kept = set(), {}, {}, []
        for x in bugs:
            kind = x["bug"] or "unknown"
            if prints[x["id"]] not in seen and types.get(kind, 0) < most_type and groups.get(x["group"], 0) < most_group:
                seen.add(prints[x["id"]])
                types[kind], groups[x["group"]] = types.get(kind, 0) + 1, groups.get(x["group"], 0) + 1
                kept.append(x)
        if len(kept) / len(own) < target:
            few, picked = int(len(kept) * (1 - target) / target), []
            for g in sorted({x["group"] for x in other}):
                picked.append(next(x for x in other if x["group"] == g))
            picked = picked[:few]
            keys = {x["key"] for x in picked}
            for x in other:
                if len(picked) < few and x["key"] not in keys:
                    picked.append(x)
                    keys.add(x["key"])
            other = picked
        stay += kept + other
    bugs = [x for x in stay if x["about"]]
    if bugs:
        rest = [x for x in stay if not x["about"] or x["tier"] not in TIERS]
        for tier, share in TIERS.items():
            cap, by = int(len(bugs) * share), {}
            for x in sorted((x for x in bugs if x["tier"] == tier), key=lambda x: (x["key"], x["id"])):
                by.setdefault(x["bug"] or "unknown", []).append(x)
            turns = [v[k] for k in range(max(map(len, by.values()), default=0)) for v in by.values() if k < len(v)]
            rest += turns[:cap] + [v[0] for v in by.values() if v[0] not in turns[:cap]]
        stay = rest
    cap, by = max(1, int(len(stay) * repo_share)), {}
    for x in sorted(stay, key=lambda x: (x["key"], x["id"])):
        by.setdefault(x["repo"], []).append(x)
    return sorted(x["id"] for v in by.values() for x in v[:cap])


@pytest.mark.parametrize(("seed", "bugs", "target", "most_type", "most_group", "repo_share"), [(1, 0.5, 0.5, 6, 5, 0.4), (2, 0.1, 0.8, 99, 99, 0.2), (3, 0.0, 0.8, 5, 5, 0.3), (4, 0.9, 0.2, 4, 99, 0.9)])
def test_balanced_rows(spark, seed, bugs, target, most_type, most_group, repo_share):
    data = some_rows(seed, bugs=bugs)
    frame = spark.createDataFrame(data, SHAPE)
    text = F.when(F.col("variant") == rows.TAXONOMY_VARIANT, F.concat(F.lit("synth:"), "bug_type", F.lit("::"), "context")).otherwise(F.col("context"))
    prints = {r["id"]: r["p"] for r in frame.select("id", fingerprint(text).alias("p")).collect()}
    found = rows.balanced_rows(frame, TIERS, target, most_type, most_group, repo_share)
    assert sorted(r["id"] for r in found.collect()) == loop(data, prints, target, most_type, most_group, repo_share)


def test_no_rows(spark):
    assert rows.balanced_rows(spark.createDataFrame([], SHAPE)).count() == 0
