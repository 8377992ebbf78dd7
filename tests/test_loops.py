"""Loops with state: what a stream brings about is what the plain loop does, however it arrives and wherever it stops."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidewater.sources import services
from tidewater.streaming import loops

SHAPE = "slug string, variant int, at timestamp, id long, ok boolean, told string, cost double"
START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def records_of(seed, n=400):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        slug = "hot" if r.random() < 0.4 else r.choice(["a", "b", None, *(f"s{k}" for k in range(30))])
        at = START + datetime.timedelta(milliseconds=r.choice([r.randint(0, 5_000_000), 1000 * r.randint(0, 5000)]))
        rows.append((slug, r.randint(0, 1), at, i, r.choice([None, False, False, True]), r.choice([None, f"wrong {i}"]), r.choice([None, 0.5, 2.0])))
    return rows


def expected(rows, limits, until):
    by = collections.defaultdict(list)
    ms = lambda t: round((t - START).total_seconds() * 1000)
    for slug, variant, at, *rest in rows:
        by[slug, variant].append((ms(at), *rest))
    return collections.Counter((*k, *o) for k, own in by.items() for o in loops.plain_loop(own, limits, until))


def outcome(spark, stream, at):
    rows = spark.read.schema(stream.schema).parquet(at).select("slug", "variant", "attempt", "what", (F.unix_millis("at") - int(START.timestamp() * 1000)).alias("at"), "feedback", "spent").collect()
    return collections.Counter(map(tuple, rows))


@pytest.mark.parametrize("limits", [loops.Limits(3, 600_000), loops.Limits(5, 200_000, 3.0)])
def test_a_restarted_stream_equals_the_loop(spark, tmp_path, limits):
    rows = sorted(records_of(3), key=lambda r: r[2])
    r = random.Random(1)
    halves = [rows[:220], rows[200:]]  # a file is out of order, and the second reaches back behind the first
    halves[1] = [x for x in halves[1] if x not in halves[0]]
    (tmp_path / "in").mkdir()
    stream = loops.loop(spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), ["slug", "variant"], limits, "20 minutes")
    for half in halves:
        r.shuffle(half)
        spark.createDataFrame(half, SHAPE).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        loops.run(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    last = max(round((x[2] - START).total_seconds() * 1000) for x in rows)
    want = expected(rows, limits, last - 1_200_000)
    got = outcome(spark, stream, f"{tmp_path}/out")
    assert got == want
    assert {x[3] for x in want} >= {"asked", "accepted", "failed"} and (limits.budget > 99 or any(x[3] == "budget" for x in want))
    assert max(collections.Counter(x[:2] for x in want.elements() if x[3] == "accepted").values()) == 1


def test_unanswered_jobs_are_asked_again_until_their_attempts_end():
    found = loops.plain_loop([(0, 0, None, None, None)], loops.Limits(3, 10), 100)
    assert [(a, w, t) for a, w, t, _, _ in found] == [(1, "asked", 0), (2, "asked", 10), (3, "asked", 20), (3, "failed", 30)]
    found = loops.plain_loop([(0, 0, None, None, None), (5, 1, False, "no", 1.0), (14, 2, True, None, 1.0), (15, 3, True, None, 1.0)], loops.Limits(3, 10), 100)
    assert [(a, w, t, f) for a, w, t, f, _ in found] == [(1, "asked", 0, ""), (2, "asked", 5, "no"), (2, "accepted", 14, "no")]


def test_rounds_ask_again_what_got_no_answer(spark):
    jobs = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ask = lambda d: d.where(~((F.col("attempt") == 1) & F.coalesce(F.col("k") == 2, F.lit(True))))  # noqa: E731  2 and null get none in the first round
    judge = lambda a: (F.coalesce(a["k"], F.lit(0)) + a["attempt"] > 3, F.concat(F.lit("bad "), a["attempt"].cast("string")))
    accepted, log = services.rounds(jobs, ["k"], ask, judge, 5)
    told = sorted(((r["k"] is None, r["k"] or 0, r["attempt"], r["feedback"], r["accepted"]) for r in log.collect()))
    assert told == [(False, 1, 1, "", False), (False, 1, 2, "bad 1", False), (False, 1, 3, "bad 2", True), (False, 2, 2, "", True), (True, 0, 2, "", False), (True, 0, 3, "bad 2", False), (True, 0, 4, "bad 3", True)]
    assert accepted.count() == 3


def test_a_key_takes_few_calls_to_its_state():
    """Each call goes from the worker to Spark and back; all of a key is one value, its timer included."""
    calls, timers, kept = collections.Counter(), set(), {}

    class Value:
        def __init__(self, name):
            self.name = name

        def __getattr__(self, what):
            def call(value=None):
                calls[what] += 1
                if what in ("update", "put"):
                    kept[self.name] = value
                return kept.pop(self.name, None) if what == "clear" else self.name in kept if what == "exists" else kept.get(self.name)

            return call

    class Handle:
        getValueState = getListState = lambda self, name, shape: Value(name)  # noqa: E731, N815

        def listTimers(self):  # noqa: N802
            calls["listTimers"] += 1
            return iter(timers)

        def registerTimer(self, at):  # noqa: N802
            calls["registerTimer"] += 1
            timers.add(at)

        def deleteTimer(self, at):  # noqa: N802
            calls["deleteTimer"] += 1
            timers.discard(at)

    class Now:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return self.at

    p, limits = loops.LoopProcessor(["k"], loops.Limits(3, 10), None), loops.Limits(3, 10)
    p.init(Handle())
    records = [(0, 1, None, None, None), (5, 2, False, "no", 1.0), (40, 3, True, None, 1.0)]
    assert not list(p.handleInputRows(("a",), [dict(zip(("__ms", "id", "ok", "told", "cost"), r)) for r in records], Now(0)))
    assert timers == {0} and sum(calls.values()) == 3  # read, write, timer
    out = [(r["attempt"], r["what"], r["__at"], r["feedback"], r["spent"]) for r in p.handleExpiredTimer(("a",), Now(6), None)]
    assert timers == {15} and sum(calls.values()) == 7
    out += [(r["attempt"], r["what"], r["__at"], r["feedback"], r["spent"]) for r in p.handleExpiredTimer(("a",), Now(50), None)]
    assert out == loops.plain_loop(records, limits, 50) and not timers and sum(calls.values()) == 10
