"""Named sources open only what is asked for, and logs are read once however they grow."""

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidewater.sources import files, readers


@pytest.fixture(scope="module")
def cache(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("cache")
    rows = [(f"o/r{k % 3}", "main", f"src/d{k % 2}/f{k}.{'cc' if k % 4 else 'py'}", f"code {k} é\n") for k in range(40)] + [("o/r0", "main", "big.cc", "x" * 500), ("o/r0", "main", "empty.cc", None)]
    readers.register(spark)
    readers.write_cache(spark.createDataFrame(rows, "repo string, branch string, path string, code string"), f"file://{at}")
    return at, rows


def test_all_files_of_a_cache(spark, cache):
    at, rows = cache
    found = spark.read.format("repository_cache").option("most_bytes", 400).option("slice_bytes", 300).load(f"file://{at}")
    assert sorted((r["repo"], r["path"], r["code"], r["size"]) for r in found.collect()) == sorted((r, p, c or "", len((c or "").encode())) for r, _, p, c in rows if p != "big.cc")
    trees = spark.read.option("multiLine", True).schema("repo string, branch string, tree array<struct<path:string,type:string,sha:string,size:long,url:string>>").json(f"{at}/trees")
    blobs = spark.createDataFrame([(f.stem, json.loads(f.read_text())["content"]) for f in (at / "blobs").iterdir()], "key string, content string")
    joined = files.repository_blobs(trees, blobs, (".cc",), 400)
    assert sorted(joined.select("repo", "path", "sha", "code").collect()) == sorted(found.where(F.endswith("path", F.lit(".cc"))).select("repo", "path", "sha", "code").collect())


def test_filters_keep_other_files_closed(spark, cache, tmp_path):
    at, rows = cache
    for folder in ("trees", "blobs"):
        (tmp_path / folder).mkdir()
    wanted = {hashlib.sha256(f"https://example.org/o/r1/main/{p}".encode()).hexdigest() for r, _, p, _ in rows if r == "o/r1" and p.endswith(".cc") and p.startswith("src/d1")}
    for f in (at / "blobs").iterdir():  # whoever opens another blob fails to parse it
        (tmp_path / "blobs" / f.name).write_text(f.read_text() if f.stem in wanted else json.dumps({"content": [1]}))
    for f in (at / "trees").iterdir():
        (tmp_path / "trees" / f.name).write_text(f.read_text() if "r1" in f.name else "{ broken")
    read = spark.read.format("repository_cache").load(str(tmp_path))
    found = read.where("repo = 'o/r1' and path like 'src/d1%' and path like '%.cc' and size > 0")
    assert {r["path"] for r in found.collect()} == {p for r, _, p, _ in rows if r == "o/r1" and p.endswith(".cc") and p.startswith("src/d1")}
    assert read.where("repo = 'none'").count() == 0
    with pytest.raises(Exception, match="JSONDecodeError|Expecting"):
        read.where("repo in ('o/r0', 'o/r1')").collect()


def test_blobs_that_cannot_be_read_are_left_out(spark, tmp_path):
    for folder in ("trees", "blobs"):
        (tmp_path / folder).mkdir()
    entry = lambda p, url: {"path": p, "type": "blob", "sha": "s", "size": 1, "url": url}
    (tmp_path / "trees" / "a__b.json").write_text(json.dumps({"repo": "a/b", "branch": "x", "tree": [entry("one", "u1"), entry("two", "u2"), entry("three", None), {"path": "dir", "type": "tree"}, entry(None, "u1")]}))
    (tmp_path / "blobs" / f"{hashlib.sha256(b'u1').hexdigest()}.json").write_text(json.dumps({"content": base64.b64encode(b"\xffok").decode()}))
    assert [tuple(r) for r in spark.read.format("repository_cache").load(str(tmp_path)).collect()] == [("a/b", "x", "one", "s", 1, "�ok")]
    assert spark.read.format("repository_cache").load(str(tmp_path / "nowhere")).count() == 0


@pytest.mark.parametrize("step", [1, 3, 7, 1000])
def test_ranges_give_each_line_once(tmp_path, step):
    text = b"a\n\nlonger line\n\xc3\xa9\nlast without end"
    (tmp_path / "x.log").write_bytes(text)
    found = [r for part in readers.ranges("x.log", 0, len(text), step) for r in readers.lines_in(str(tmp_path), part)]
    assert [line for _, _, line in found] == text.decode().split("\n")
    assert [at for _, at, _ in found] == [0, 2, 3, 15, 18]
    system, _ = readers._opened(str(tmp_path))
    assert readers.whole_lines(system, str(tmp_path / "x.log"), len(text), step) == 18 and readers.whole_lines(system, str(tmp_path / "x.log"), 1, step) == 0


def test_a_growing_log_is_read_once(spark, tmp_path):
    readers.register(spark)
    log = tmp_path / "log"
    log.mkdir()
    stream = spark.readStream.format("line_log").option("range_bytes", 9).load(str(log))

    def drain():
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        return sorted((r["file"], r["line"]) for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect())

    (log / "a").write_text("one\ntwo\nthr")
    assert drain() == [("a", "one"), ("a", "two")]
    with (log / "a").open("a") as f:
        f.write("ee\nfour\n")
    (log / "b").write_text("five\n" * 20)
    assert drain() == sorted([("a", x) for x in ("one", "two", "three", "four")] + [("b", "five")] * 20)
    assert drain() == sorted([("a", x) for x in ("one", "two", "three", "four")] + [("b", "five")] * 20)
    assert spark.read.format("line_log").load(str(log)).count() == 24
