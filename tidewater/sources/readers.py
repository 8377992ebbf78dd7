"""Sources that one can name in spark.read.format and spark.readStream.format.

    register(spark)
    spark.read.format("repository_cache").load("file:///cache").where("repo = 'a/b' and path like '%.cc'")
    spark.readStream.format("line_log").load("file:///logs")

Paths are of any file system that Arrow opens, on the driver and on all executors alike.

repository_cache: files of cached repository trees. Below the path, trees/ has a JSON file for each
repository (named by it, with `__` for the `/`: repo, branch, tree of path, type, sha, size, url)
and blobs/ one for each blob (named by the sha256 of its url: content in base64). Filters on repo and path are
pushed down: trees of other repositories and blobs of other paths are never opened. A tree is read
by one task for each `slice_bytes` of it. Blobs that are missing, too large or no text in base64 are left out.

line_log: lines of files that only grow, as (file, at, line), `at` being a line's first byte. As a stream its
offset is the end of each file's last whole line, so a line is read once, whether files are
added or grow, and an unfinished line waits for its end; long files are read in ranges.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system, root.rstrip("/")


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _names(system: fs.FileSystem, folder: str, suffix: str = "") -> list[fs.FileInfo]:
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in found if f.is_file and f.base_name.endswith(suffix) and f.base_name[0] not in "._"), key=lambda f: f.path)  # others are writers' own


# ---- repositories


@dataclass
class Wanted:
    """Filters of a read: repositories (None: all) and tests that a path must pass."""

    repos: set[str] | None = None
    tests: list[tuple[str, object]] = field(default_factory=list)

    def take(self, what: Filter) -> bool:
        """Whether a filter is one of those that are done here."""
        column = ".".join(what.attribute) if hasattr(what, "attribute") else ""
        if column == "repo" and isinstance(what, (EqualTo, In)):
            values = {what.value} if isinstance(what, EqualTo) else set(what.value)
            self.repos = values if self.repos is None else self.repos & values
            return True
        kinds = {EqualTo: "is", In: "in", StringEndsWith: "ends", StringStartsWith: "starts", StringContains: "has"}
        if column == "path" and type(what) in kinds:
            self.tests.append((kinds[type(what)], what.value))
            return True
        return False

    def path(self, path: str) -> bool:
        rules = {"is": lambda v: path == v, "in": lambda v: path in v, "ends": path.endswith, "starts": path.startswith, "has": lambda v: v in path}
        return all(rules[kind](value) for kind, value in self.tests)


@dataclass
class Slice(InputPartition):
    """Every `of`-th entry of a tree, from the `at`-th on."""

    tree: str
    at: int
    of: int


class RepositoryReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.most, self.slice_bytes = int(options.get("most_bytes", 200_000)), int(options.get("slice_bytes", 1 << 20))
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return [f for f in filters if not self.wanted.take(f)]

    def partitions(self) -> list[InputPartition]:
        system, root = _opened(self.root)
        out: list[InputPartition] = []
        for info in _names(system, f"{root}/trees", ".json"):
            if self.wanted.repos is None or info.base_name[:-5].replace("__", "/", 1) in self.wanted.repos:
                n = max(1, -(-info.size // self.slice_bytes))
                out += [Slice(info.path, k, n) for k in range(n)]
        return out or [Slice("", 0, 1)]

    def read(self, part: Slice) -> Iterator[tuple]:
        if not part.tree:
            return
        system, root = _opened(self.root)
        with system.open_input_stream(part.tree) as stream:
            tree = json.loads(stream.read())
        for entry in (tree.get("tree") or [])[part.at :: part.of]:
            path, size = entry.get("path"), entry.get("size") or 0
            if entry.get("type") != "blob" or not path or size > self.most or not self.wanted.path(path):
                continue
            try:
                with system.open_input_stream(f"{root}/blobs/{hashlib.sha256((entry.get('url') or '').encode()).hexdigest()}.json") as stream:
                    content = base64.b64decode(json.loads(stream.read())["content"])
            except (FileNotFoundError, KeyError, TypeError, ValueError):
                continue
            yield tree.get("repo"), tree.get("branch"), path, entry.get("sha"), size, content.decode("utf-8", "replace")


class RepositoryCache(DataSource):
    @classmethod
    def name(cls) -> str:
        return "repository_cache"

    def schema(self) -> T.StructType:
        return T.StructType([*_text("repo", "branch", "path", "sha"), T.StructField("size", T.LongType()), *_text("code")])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RepositoryReader(dict(self.options))


# ---- logs


@dataclass
class Range(InputPartition):
    """The lines of a file that begin in [start, end)."""

    file: str
    start: int
    end: int


def lines_in(path: str, part: Range) -> Iterator[tuple[str, int, str]]:
    """(file, first byte, line) of a range; its start is a line's or lies within a line that is another's."""
    system, root = _opened(path)
    with io.BufferedReader(system.open_input_file(f"{root}/{part.file}"), 1 << 20) as stream:
        at = max(0, part.start - 1)  # a line begins at the start if the byte before ends one
        stream.seek(at)
        if part.start:
            at += len(stream.readline())
        while at < part.end and (line := stream.readline()):
            yield part.file, at, line.rstrip(b"\n").decode("utf-8", "replace")
            at += len(line)


def whole_lines(system: fs.FileSystem, path: str, size: int, step: int = 1 << 16) -> int:
    """The end of the last whole line among the first `size` bytes of a file."""
    with system.open_input_file(path) as stream:
        end = size
        while end > 0:
            start = max(0, end - step)
            stream.seek(start)
            if (found := stream.read(end - start).rfind(b"\n")) >= 0:
                return start + found + 1
            end = start
    return 0


def ranges(file: str, start: int, end: int, most: int) -> list[Range]:
    return [Range(file, at, min(at + most, end)) for at in range(start, end, most)]


class LogReader(DataSourceReader):
    """All lines there are, the last one too if it has no end."""

    def __init__(self, options: dict[str, str]):
        self.root, self.most = options["path"], int(options.get("range_bytes", 32 << 20))

    def partitions(self) -> list[InputPartition]:
        system, root = _opened(self.root)
        return [r for f in _names(system, root) for r in ranges(f.base_name, 0, f.size, self.most)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        return lines_in(self.root, part) if part.file else iter(())


class LogStream(LogReader, DataSourceStreamReader):
    """The offset of a stream: the bytes of whole lines of each file."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        system, root = _opened(self.root)
        return {f.base_name: whole_lines(system, f.path, f.size) for f in _names(system, root)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:  # type: ignore[override]
        return [r for name, stop in end.items() for r in ranges(name, start.get(name, 0), stop, self.most)] or [Range("", 0, 0)]

    def commit(self, end: dict) -> None:
        """Files stay; nothing is to be done."""


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> T.StructType:
        return T.StructType([*_text("file"), T.StructField("at", T.LongType()), *_text("line")])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return LogReader(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return LogStream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes both sources known to the session, and lets it push filters down to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (RepositoryCache, LineLog):
        spark.dataSource.register(source)


def write_cache(files, path: str) -> None:
    """Writes (repo, branch, path, code) as a cache that repository_cache reads, a repository's tree by one task."""
    import pandas as pd

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        system, root = _opened(path)
        for folder in ("trees", "blobs"):
            system.create_dir(f"{root}/{folder}")
        repo, entries = frame["repo"].iloc[0], []
        for branch, name, code in zip(frame["branch"], frame["path"], frame["code"]):
            data, url = (code or "").encode(), f"https://example.org/{repo}/{branch}/{name}"
            entries.append({"path": name, "type": "blob", "sha": hashlib.sha1(data).hexdigest(), "size": len(data), "url": url})
            with system.open_output_stream(f"{root}/blobs/{hashlib.sha256(url.encode()).hexdigest()}.json") as out:
                out.write(json.dumps({"content": base64.b64encode(data).decode()}).encode())
        with system.open_output_stream(f"{root}/trees/{repo.replace('/', '__', 1)}.json") as out:
            out.write(json.dumps({"repo": repo, "branch": frame["branch"].iloc[0], "tree": entries}).encode())
        return pd.DataFrame({"n": [len(entries)]})

    files.select("repo", "branch", "path", "code").groupBy("repo").applyInPandas(write, "n long").agg({"n": "sum"}).collect()
