"""Appends happen once, all at once and in one order."""

import threading

import pytest
from pyspark.sql import functions as F

from tidewater.streaming import appends

SHAPE = "id long, text string"


def rows_of(spark, path, until=None):
    return sorted((r["id"], r["commit"]) for r in appends.committed(spark, path, SHAPE, until).collect())


def test_repeated_and_failed_batches_leave_no_double_row(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    batch = lambda *ids: spark.createDataFrame([(i, f"t{i}") for i in ids], SHAPE)
    assert appends.committed(spark, path, SHAPE).count() == 0
    appends.append(batch(1, 2), path, "a", 0)
    claim = appends.Files.claim

    def failing(self, name, content):
        raise OSError("lost")

    monkeypatch.setattr(appends.Files, "claim", failing)
    with pytest.raises(OSError):
        appends.append(batch(3), path, "a", 1)  # its data is written, its commit is not
    monkeypatch.setattr(appends.Files, "claim", claim)
    assert rows_of(spark, path) == [(1, 0), (2, 0)]
    for _ in range(2):
        assert appends.append(batch(3), path, "a", 1).number == 1
    appends.append(batch(), path, "b", 1)
    assert rows_of(spark, path) == [(1, 0), (2, 0), (3, 1)] and rows_of(spark, path, 0) == [(1, 0), (2, 0)]
    assert [(c.writer, c.batch, c.rows) for c in appends.commits(spark, path)] == [("a", 0, 2), ("a", 1, 1), ("b", 1, 0)]
    assert appends.vacuum(spark, path) == 1 and rows_of(spark, path) == [(1, 0), (2, 0), (3, 1)]
    assert appends.compact(spark, path, SHAPE).number == 3 and appends.vacuum(spark, path) == 3
    assert appends.append(batch(3), path, "a", 1).number == 1  # still known
    assert rows_of(spark, path) == [(1, 3), (2, 3), (3, 3)] and appends.compact(spark, path, SHAPE) is None


def test_writers_at_once_come_into_one_order(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    failed = []

    def write(name):
        try:
            for batch in range(4):
                appends.append(spark.range(batch * 10, batch * 10 + 5).select("id", F.lit(name).alias("text")), path, name, batch)
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in ("a", "b", "c")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = appends.commits(spark, path)
    assert not failed and [c.number for c in found] == list(range(12))
    assert {(c.writer, c.batch) for c in found} == {(w, b) for w in "abc" for b in range(4)}
    assert appends.committed(spark, path, SHAPE).count() == 60


def test_a_stream_that_fails_after_its_commit_appends_once(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    for k in range(2):
        spark.createDataFrame([(k, "x")], SHAPE).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    append, calls = appends.append, []

    def breaking(df, where, writer, batch):
        append(df, where, writer, batch)
        calls.append(batch)
        if calls == [0, 1]:
            raise OSError("lost after the commit")

    monkeypatch.setattr(appends, "append", breaking)
    with pytest.raises(Exception, match="lost"):
        appends.append_stream(stream, path, "s", f"{tmp_path}/state").awaitTermination()
    appends.append_stream(stream, path, "s", f"{tmp_path}/state").awaitTermination()
    assert calls == [0, 1, 1] and [r[0] for r in rows_of(spark, path)] == [0, 1]
