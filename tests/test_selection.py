"""Selection rules against direct loops over literal rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import merge, patterns, quantiles, reports, selection


def rows_of(n=120, seed=3):
    r = random.Random(seed)
    return [(i, r.choice(["en", "de", "fr", None]), r.choice(["s1", "s2", "s3", None]), r.randint(0, 40), hashlib.md5(str(i).encode()).hexdigest()) for i in range(n)]


SHAPE = "id long, tier string, kind string, fp long, key string"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows_of(), SHAPE).repartition(5).cache()


def ids(frame):
    return sorted(r["id"] for r in frame.select("id").collect())


def test_first_and_last(df):
    first, last = {}, {}
    for row in rows_of():
        first.setdefault((row[1], row[3]), row[0])
        last[(row[1], row[3])] = row[0]
    assert ids(selection.first_of(df, ["tier", "fp"], ["id"])) == sorted(first.values())
    assert ids(selection.last_of(df, ["tier", "fp"], ["id"])) == sorted(last.values())


def test_first_n_and_cap(df):
    taken, seen = [], {}
    for row in rows_of():
        seen[row[2]] = seen.get(row[2], 0) + 1
        if seen[row[2]] <= 7:
            taken.append(row[0])
    assert ids(selection.first_n(df, ["kind"], ["id"], 7)) == taken
    assert len(ids(selection.cap_share(df, ["kind"], ["id"], 0.001))) == 4


@pytest.mark.parametrize("shares", [{"en": 0.1, "de": 0.2}, {"en": 0.0}, {}])
def test_round_robin(df, shares):
    kept = []
    for tier in ("en", "de", "fr", None):
        by = {}
        for row in rows_of():
            if row[1] == tier:
                by.setdefault(row[2], []).append(row[0])
        cap, turns = int(120 * shares.get(tier, 0.05)), []
        for k in range(max(map(len, by.values()))):
            turns += [(k, v[k]) for v in sorted(by.values()) if k < len(v)]
        kept += [i for n, (k, i) in enumerate(turns) if n < cap or k == 0]
    assert ids(selection.round_robin(df, "tier", "kind", ["id"], shares, 0.05)) == sorted(kept)


@pytest.mark.parametrize("allowed", [0, 1, 7, 50, 500])
def test_stride(df, allowed):
    step = max(1, 120 // max(1, allowed))
    assert ids(selection.stride(df, ["id"], allowed)) == list(range(120))[::step][:allowed]


def test_numbered_is_one_order(spark):
    r = random.Random(1)
    values = [r.choice([None, 5, 5, 5, 6, r.randint(-99, 99)]) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    expected = sorted(range(500), key=lambda i: (values[i] is not None, values[i] or 0, i))
    found = selection.numbered(frame.repartition(5), ["v", "id"], "at").orderBy("at").collect()
    assert [x["at"] for x in found] == list(range(1, 501)) and [x["id"] for x in found] == expected
    words = [r.choice(["", "a", "ab", "abc", "zebra", "é", None]) + "" if r.random() < 0.9 else "q" * 40 for _ in range(0)] or ["b", "", "é", "ab", "a", "abc" * 9, "zz", "abcabcx"]
    named = selection.numbered(spark.createDataFrame([(w,) for w in words], "w string"), ["w"], "at").orderBy("at").collect()
    assert [x["w"] for x in named] == sorted(words)


def test_greedy_caps_keep_more_than_windows_would(df):
    kept, seen, kinds, groups = [], set(), {}, {}
    for i, tier, kind, fp, _ in rows_of():
        if fp not in seen and kinds.get(tier, 0) < 6 and groups.get(kind, 0) < 7:
            seen.add(fp)
            kinds[tier], groups[kind] = kinds.get(tier, 0) + 1, groups.get(kind, 0) + 1
            kept.append(i)
    assert ids(selection.greedy_caps(df, "id", "fp", "tier", "kind", ["id"], 6, 7)) == kept
    unbound = {}
    for row in rows_of():
        unbound.setdefault(row[3], row[0])
    assert ids(selection.greedy_caps(df, "id", "fp", "tier", "kind", ["id"], 999, 999)) == sorted(unbound.values())


def greedy_loop(rows, most_kind, most_group):
    """Keys of (key, fingerprint, kind, group, place) that one pass in the order of place and key keeps."""
    kept, seen, kinds, groups = [], set(), {}, {}
    for k, f, a, b, _ in sorted(rows, key=lambda r: (r[4] is not None, r[4] or 0, r[0])):
        if f not in seen and kinds.get(a, 0) < most_kind and groups.get(b, 0) < most_group:
            seen.add(f)
            kinds[a], groups[b] = kinds.get(a, 0) + 1, groups.get(b, 0) + 1
            kept.append(k)
    return sorted(kept)


@pytest.mark.parametrize("seed", range(6))
def test_greedy_caps_equal_the_loop_where_caps_bind(spark, seed):
    r = random.Random(seed)
    n, prints, kinds, groups = r.choice([(300, 40, 3, 9), (300, 250, 4, 6), (200, 900, 2, 30), (250, 12, 12, 12)])
    some = lambda k, name: r.choice([None, *(f"{name}{i}" for i in range(k))])
    rows = [(i, some(prints, "f"), some(kinds, "k") if r.random() < 0.5 else "k0", some(groups, "g"), r.choice([None, r.randint(0, 50)])) for i in range(n)]
    frame = spark.createDataFrame(rows, "id long, f string, k string, g string, at long").repartition(5)
    for caps in ((2, 3), (20, 4), (9, 30)):
        assert ids(selection.greedy_caps(frame, "id", "f", "k", "g", ["at"], *caps)) == greedy_loop(rows, *caps), caps


def test_greedy_caps_on_a_chain_and_on_nothing(spark):
    rows = [(i, f"f{i}", f"k{(i + 1) // 2}", f"g{i // 2}", i) for i in range(12)]  # each row's room hangs on the row before it
    frame = spark.createDataFrame(rows, "id long, f string, k string, g string, at long")
    assert ids(selection.greedy_caps(frame, "id", "f", "k", "g", ["at"], 1, 1)) == greedy_loop(rows, 1, 1) == list(range(0, 12, 2))
    assert ids(selection.greedy_caps(frame.where("false"), "id", "f", "k", "g", ["at"], 1, 1)) == []
    assert ids(selection.greedy_caps(frame, "id", "f", "k", "g", ["at"], 0, 1)) == []


def test_greedy_caps_put_no_rows_into_one_task(spark, monkeypatch):
    plans = []
    settle = selection.settle
    monkeypatch.setattr(selection, "settle", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or settle(d))
    rows = [(i, f"f{i % 90}", f"k{i % 3}", f"g{i % 7}", i) for i in range(200)]
    selection.greedy_caps(spark.createDataFrame(rows, "id long, f string, k string, g string, at long"), "id", "f", "k", "g", ["at"], 9, 5)
    assert len(plans) > 3 and not any("SinglePartition" in p or "Python" in p or "Pandas" in p for p in plans)
    assert any("WindowGroupLimit" in p for p in plans)


def turns_of(rows, n, group, key):
    """A plain loop: one row of each group in the groups' order, then the rest by key, a key once."""
    by_group = {}
    for r in sorted(rows, key=key):
        by_group.setdefault(r[group], []).append(r)
    out = [by_group[g][0] for g in sorted(by_group)][:n]
    seen = {key(r)[0] for r in out}
    for r in sorted(rows, key=key):
        if len(out) < n and key(r)[0] not in seen:
            out.append(r)
            seen.add(key(r)[0])
    return out


@pytest.mark.parametrize("target", [0.2, 0.5, 0.9])
def test_rebalance(spark, target):
    r = random.Random(target)
    data = [(i, f"k{r.randrange(70):02}", r.choice("ab"), r.choice(["g1", "g2", "g3", "g4"]), r.random() < 0.2, r.random() < 0.7) for i in range(90)]
    data += [(100 + i, f"z{i}", "c", "g1", False, False) for i in range(5)]
    frame = spark.createDataFrame(data, "id long, key string, split string, grp string, pos boolean, kept boolean")
    expected = []
    for split in "abc":
        own = [x for x in data if x[2] == split]
        good, other = [x for x in own if x[4] and x[5]], [x for x in own if not x[4]]
        if any(x[4] for x in own) and len(good) / len(own) < target:
            other = turns_of(other, int(len(good) * (1 - target) / target), 3, lambda x: (x[1], x[0]))
        expected += [x[0] for x in good + other]
    assert ids(selection.rebalance(frame, "pos", "kept", "split", "grp", "key", target)) == sorted(expected)


def test_diverse_and_contexts(df):
    found = [r["id"] for r in selection.diverse(df, "kind", "key", 30).collect()]
    by_key = sorted(rows_of(), key=lambda r: r[4])
    first = {}
    for r in by_key:
        first.setdefault(r[2], r[0])
    lead = [first[k] for k in sorted(first, key=lambda k: (k is None, k or ""))]
    assert found == (lead + [r[0] for r in by_key if r[0] not in lead])[:30]
    picked = selection.pick_contexts(df.withColumn("turn", F.col("id")), "turn", "tier", "kind", "fp", 200).orderBy("pass", "turn").collect()
    order, seen = [], [set(), set(), set()]
    rest = rows_of()
    for n, column in enumerate((1, 2, 3)):
        for r in list(rest):
            if all(r[c] not in seen[k] or k < n for k, c in ((n, column),)):
                order.append(r[0])
                rest.remove(r)
                for k, c in enumerate((1, 2, 3)):
                    seen[k].add(r[c])
    assert [r["id"] for r in picked if r["pass"] == 1] == order[: sum(r["pass"] == 1 for r in picked)] and len(picked) == 120


def test_rotation(df):
    start = int(hashlib.md5(b"slug").hexdigest(), 16) % 120
    found = selection.rotated(df, F.col("id"), F.lit("slug"), F.lit(120)).collect()
    assert all(r["turn"] == (r["id"] - start + 120) % 120 for r in found)


def test_splits(spark):
    names = [f"g{i}" for i in range(300)]
    frame = spark.createDataFrame([(n, hashlib.sha1(n.encode()).hexdigest()) for n in names], "g string, h string")
    found = {r["g"]: r for r in frame.select("g", selection.split_fifth(F.col("g")).alias("a"), selection.split_percent(F.col("g")).alias("b"), selection.split_hex_id(F.col("h")).alias("c")).collect()}
    number = lambda algorithm, n: int(hashlib.new(algorithm, n.encode()).hexdigest(), 16)
    for n in names:
        assert (found[n]["a"] == "validation") == (number("md5", n) % 5 == 0)
        assert (found[n]["b"] == "validation") == (number("sha1", n) % 100 < 20)
        assert (found[n]["c"] == "train") == (int(hashlib.sha1(n.encode()).hexdigest()[:8], 16) % 100 >= 13)
    leaky = spark.createDataFrame([("a", "train"), ("a", "validation"), ("b", "train"), ("c", None)], "g string, split string")
    assert [r["g"] for r in selection.split_leaks(leaky, "g", "split").collect()] == ["a"]
    assert selection.split_missing(leaky, "split").count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stratified(spark, seed):
    r = random.Random(seed)
    tiers = ["easy", "normal", "hard"]
    data = [(i, r.choice(["k1", "k2", "", None]), r.choice([*tiers, None, "odd"]), r.choice([None, "", *"abcdefg"])) for i in range(80)]
    expected = []
    for kind in ("k1", "k2", "unknown"):
        waiting = {t: [x for x in data if (x[1] or "unknown") == kind and (x[2] or "normal") == t] for t in tiers}
        picked, seen, more = [], set(), True
        while more and len(picked) < 5:
            more = False
            for t in tiers:
                free = [x for x in waiting[t] if (x[3] or "") not in seen]
                if free and len(picked) < 5:
                    picked.append(free[0][0])
                    seen.add(free[0][3] or "")
                    more = True
        expected += list(enumerate(picked))
    frame = spark.createDataFrame(data, "id long, kind string, tier string, grp string").repartition(3)
    found = selection.stratified(frame, "kind", "tier", "grp", ["id"], 5, tiers, 13)
    assert sorted((x["pick"], x["id"]) for x in found.collect()) == sorted(expected[:13])
    assert selection.stratified(frame.where("false"), "kind", "tier", "grp", ["id"], 5, tiers, 13).count() == 0


def test_places_in_a_hot_group(spark):
    r = random.Random(4)
    data = [(i, r.choice(["hot", "hot", "hot", "b", None]), r.randint(0, 9)) for i in range(300)]
    found = {x["id"]: x["rank"] for x in selection.placed(spark.createDataFrame(data, "id long, g string, v long").repartition(7), ["g"], ["v", "id"]).collect()}
    for g in ("hot", "b", None):
        assert [found[i] for i, own, v in sorted(data, key=lambda x: (x[2], x[0])) if own == g] == list(range(1, sum(x[1] == g for x in data) + 1))


def test_contained_keys_on_repeated_rows(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c"), (3, None), (4, "b")], "id long, slug string")
    table = spark.createDataFrame([(2, "b", "B"), (1, "a", "A"), (3, None, "none")], "at int, word string, message string")
    found = sorted((x["id"], x["message"], x["place"]) for x in patterns.theta_contains(frame, "slug", table, "word", "at").collect())
    assert found == [(1, "A", 1), (1, "A", 1), (1, "B", 2), (1, "B", 2), (4, "B", 1)]
    from tidewater.operators import rows

    assert ids(rows.error_rows(frame, "slug", table, "word", "message", "at", "id")) == [1, 1, 4]


# ---- joins


def test_first_hit_prefers_the_path_and_the_first_result(spark):
    rows = spark.createDataFrame([("/mnt/c/D/a.jsonl", 0), ("D:\\e\\b.jsonl", 1), ("none", 2), (None, 0)], "path string, i int")
    results = spark.createDataFrame([("C:/D/a.jsonl", 0, "b-path"), ("C:/D/a.jsonl", 0, "a-path"), ("x/a.jsonl", 0, "name"), ("y/b.jsonl", 1, "by name")], "p string, i int, r string")
    first = {r["path"]: r["result_r"] for r in merge.first_hit(rows, results, "path", "p", "i").collect()}
    assert first == {"/mnt/c/D/a.jsonl": "a-path", "D:\\e\\b.jsonl": "by name", "none": None, None: None}
    last = {r["path"]: r["result_r"] for r in merge.first_hit(rows, results, "path", "p", "i", last_wins=True).collect()}
    assert last["/mnt/c/D/a.jsonl"] == "b-path"


def test_choose_result(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    results = spark.createDataFrame([(1, False, 0.1, "x"), (1, True, 9.0, "ok"), (2, False, 5.0, "b"), (2, None, 2.0, "z"), (2, False, 2.0, "a")], "k int, ok boolean, s double, c string")
    found = {r["k"]: (r["state"], r["chosen"]) for r in merge.choose_result(rows, results, ["k"], "ok", "s", "c").collect()}
    assert found == {1: ("working", "ok"), 2: ("not_working", "a"), 3: ("not_validated", None)}


def test_upsert_replaces_every_copy_and_null_keys(spark):
    base = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (1, "y"), (None, "m"), (9, "new"), (2, None)], "k int, v string")
    found = sorted(((r["k"], r["v"]) for r in merge.upsert(base, new, ["k"], ["v"]).collect()), key=str)
    assert found == sorted([(1, "y"), (1, "y"), (2, None), (None, "m"), (9, "new")], key=str)


def test_anti_joins_keep_null_keys(spark):
    rows = spark.createDataFrame([(1, "u1"), (2, "u2"), (None, "u3"), (4, None)], "h int, url string")
    seen = spark.createDataFrame([(1, "zz"), (None, "u2"), (7, None)], "h int, url string")
    assert sorted((r["h"] for r in merge.without(rows, seen, "h", "url").collect()), key=str) == [4, None]


def test_siblings_and_pairs(spark):
    r = random.Random(2)
    people = [(i, r.choice("pq"), r.choice(["graph", "kernel"])) for i in range(40)]
    found = {}
    for x in merge.siblings(spark.createDataFrame(people, "id long, parent string, kind string"), "parent", "id", "kind", 4).collect():
        found.setdefault(x["id"], []).append((x["place"], x["sibling"]))
    for i, parent, kind in people:
        others = sorted((o for o in people if o[1] == parent and o[0] != i), key=lambda o: (o[2] == kind, hashlib.md5(str(o[0]).encode()).hexdigest()))
        assert [s for _, s in sorted(found[i])] == [o[0] for o in others[:4]]


def test_siblings_of_many_kinds(spark):
    r = random.Random(5)
    people = [(i, r.choice("pq"), f"k{r.randrange(12):02}") for i in range(90)]
    found = {}
    for x in merge.siblings(spark.createDataFrame(people, "id long, parent string, kind string"), "parent", "id", "kind", 4).collect():
        found.setdefault(x["id"], []).append((x["place"], x["sibling"]))
    for i, parent, kind in people:
        others = sorted((o for o in people if o[1] == parent and o[0] != i), key=lambda o: (o[2] == kind, hashlib.md5(str(o[0]).encode()).hexdigest()))
        assert [s for _, s in sorted(found[i])] == [o[0] for o in others[:4]]


def test_open_retries_and_restricted_filter(spark):
    log = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, True), ("b", 2, False), ("c", 1, None)], "k string, at int, ok boolean")
    assert sorted(r["k"] for r in merge.last_event_open(log, ["k"], ["at"], F.col("ok")).collect()) == ["b", "c"]


def test_reports(spark):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate([5, 1, 4, 1, 3, 9, 2, 6, 5, 3])], "id long, v long")
    s = sorted([5, 1, 4, 1, 3, 9, 2, 6, 5, 3])
    found = {r["quantile"]: r["value"] for r in quantiles.index_percentiles(frame, "v", [0.1, 0.25, 0.5, 1.0]).collect()}
    assert found == {0.1: s[1], 0.25: s[2], 0.5: s[5], 1.0: 9}
    top = reports.most_common(frame, "v", 2, "id").collect()
    assert [(r["v"], r["n"]) for r in top] == [(5, 2), (1, 2)]
