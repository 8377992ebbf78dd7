"""Generation, mutation and repair loops that keep state: one state for each job, fed by a stream of answers.

A job (a slug and its variant, say) is asked for, answered, judged and asked again with what was
wrong, until an answer is accepted, its attempts are used up or its budget is spent. An attempt
that gets no answer in time is asked again by a timer. All goes by event time: records are held
until the watermark has passed them and then taken in order, so what comes out hangs neither on
the order of arrival nor on the batches, and a query that was stopped goes on where it was.

A record is a row of the key columns and
    at (timestamp), id (breaks ties of at), ok (boolean), told (string), cost (double).
The first record of a key opens its job; each later one answers the attempt that is open, ok
saying whether it is accepted, told what the next attempt is told, cost what the answer cost. What
comes after a job's end is dropped, so a job is accepted once.

State is bounded: a job takes one record for each attempt at most, so only the first of those
that wait are held, whatever a hot key sends. Ended jobs keep their mark; `keep` forgets it some
time after the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming import StreamingQuery

#: What a loop gives for each event of a job: what is one of asked, accepted, failed (no attempt left), budget (nothing left to spend).
OUT = "attempt int, what string, at timestamp, feedback string, spent double"
_PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@dataclass(frozen=True)
class Limits:
    """Attempts a job has, milliseconds until an unanswered one is asked again, and what its answers may cost (no further attempt from there on)."""

    attempts: int
    wait_ms: int
    budget: float = float("inf")


@dataclass
class Job:
    """Where a job stands. asked: when its open attempt was asked, in milliseconds."""

    attempt: int = 0
    asked: int = 0
    spent: float = 0.0
    feedback: str = ""
    done: bool = False

    def deadline(self, limits: Limits) -> int:
        return self.asked + limits.wait_ms

    def _ask(self, limits: Limits, at: int, feedback: str) -> list[tuple]:
        """The next attempt, or the end."""
        what = "budget" if self.spent >= limits.budget else "failed" if self.attempt >= limits.attempts else "asked"
        self.feedback, self.done = feedback, what != "asked"
        if not self.done:
            self.attempt, self.asked = self.attempt + 1, at
        return [(self.attempt, what, at, self.feedback, self.spent)]

    def wait(self, limits: Limits, until: int) -> list[tuple]:
        """What deadlines up to a time bring about."""
        out = []
        while self.attempt and not self.done and self.deadline(limits) <= until:
            out += self._ask(limits, self.deadline(limits), self.feedback)
        return out

    def take(self, limits: Limits, at: int, ok: bool | None, told: str | None, cost: float | None) -> list[tuple]:
        """What a record brings about."""
        out = self.wait(limits, at)
        if self.done:
            return out
        if not self.attempt:
            return out + self._ask(limits, at, "")
        self.spent += cost or 0.0
        if ok:
            self.done = True
            return [*out, (self.attempt, "accepted", at, self.feedback, self.spent)]
        return out + self._ask(limits, at, told or "")


def plain_loop(records: list[tuple], limits: Limits, until: int) -> list[tuple]:
    """What a job's records (at in ms, id, ok, told, cost) up to a time bring about, one after another."""
    job, out = Job(), []
    for at, _, ok, told, cost in sorted((r for r in records if r[0] <= until), key=lambda r: r[:2]):
        out += job.take(limits, at, ok, told, cost)
    return out + job.wait(limits, until)


class LoopProcessor(StatefulProcessor):
    """A Job for each key, the records that wait for the watermark, and one timer: the next of them or the deadline.

    All of a key is one value, its timer included, as each read, write and timer is a call from the Python worker to Spark.
    """

    def __init__(self, keys: list[str], limits: Limits, keep_ms: int | None):
        self.keys, self.limits, self.keep_ms = keys, limits, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("loop", "attempt int, asked long, spent double, feedback string, done boolean, held array<struct<at:long,id:long,ok:boolean,told:string,cost:double>>, timer long")

    def _load(self) -> tuple[Job, list[tuple], int | None]:
        """The job, what it holds and its timer."""
        found = self.state.get()
        return (Job(), [], None) if found is None else (Job(*found[:5]), [tuple(h) for h in found[5]], found[6])

    def _store(self, job: Job, held: list[tuple], now: int, old: int | None) -> None:
        """Writes the state, and another timer in place of the old one if it is due at another time."""
        if job.done:
            held, timer = [], None if self.keep_ms is None else now + self.keep_ms
        else:
            timer = min([h[0] for h in held[:1]] + ([job.deadline(self.limits)] if job.attempt else []), default=None)
        self.state.update((job.attempt, job.asked, job.spent, job.feedback, job.done, held, timer))
        if timer != old:
            if old is not None:
                self.handle.deleteTimer(old)
            if timer is not None:
                self.handle.registerTimer(timer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        job, held, timer = self._load()
        if job.done:
            return iter(())
        most = self.limits.attempts + 1  # records beyond can only come after the end
        for r in rows:
            held.append((r["__ms"], r["id"], r["ok"], r["told"], r["cost"]))
            if len(held) >= 64 + most:
                held = sorted(held, key=lambda h: h[:2])[:most]
        held = sorted(held, key=lambda h: h[:2])[:most]
        self._store(job, held, timerValues.getCurrentWatermarkInMs(), timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now, (job, held, timer), out = timerValues.getCurrentWatermarkInMs(), self._load(), []
        if job.done:  # kept long enough
            self.state.clear()
            return iter(())
        for at, _, ok, told, cost in (h for h in held if h[0] <= now):
            out += job.take(self.limits, at, ok, told, cost)
        out += job.wait(self.limits, now)
        self._store(job, [h for h in held if h[0] > now], now, timer)
        names = [*self.keys, "attempt", "what", "__at", "feedback", "spent"]
        return iter([Row(**dict(zip(names, (*key, *o)))) for o in out])

    def close(self) -> None:
        pass


def loop(records: DataFrame, keys: list[str], limits: Limits, late: str, keep_ms: int | None = None) -> DataFrame:
    """The stream of (keys, OUT) that a stream of records brings about, each once and final."""
    slim = records.select(*keys, "at", F.unix_millis("at").alias("__ms"), F.col("id").cast("long").alias("id"), "ok", "told", "cost")
    shape = T.StructType([*(records.schema[k] for k in keys), *T._parse_datatype_string("attempt int, what string, __at long, feedback string, spent double").fields])
    met = slim.withWatermark("at", late).groupBy(*keys).transformWithState(LoopProcessor(keys, limits, keep_ms), shape, "append", "eventTime")
    return met.select(*keys, "attempt", "what", F.timestamp_millis("__at").alias("at"), "feedback", "spent")


def run(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """All records there are now, once, to Parquet; the next call goes on where this one ended. Timers and lists need the RocksDB store."""
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER[0])
    spark.conf.set(*_PROVIDER)
    try:
        return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    finally:
        spark.conf.set(_PROVIDER[0], before)
