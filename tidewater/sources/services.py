"""Compilers and generators as clients, and the loops that go back and forth between them.

A loop runs its rounds as whole DataFrames: every round asks for all that is still open,
judges the answers, writes accepted rows and all attempts to a log, and carries what was
wrong into the next round. A row is asked at most `most_rounds` times.
"""

from __future__ import annotations

import os
import re
import shutil
import subprocess
import tempfile
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.lineage import written

# Names of tools and folders, and patterns of messages.
KERNEL_COMPILERS, GRAPH_COMPILERS = ("bin/xchesscc", "tps/win64/xchesscc/bin/xchesscc", "bin/unwrapped/xchesscc"), ("bin/aiecompiler.bat", "bin/aiecompiler")
INCLUDES = ("include", "include/aie_api", "data/aie_runtime_lib/AIE", "data/aie_runtime_lib/AIE2")
CHESS_LIBRARIES = {"AIE": "data/versal_prod/lib", "AIE-ML": "data/aie_ml/lib"}
LOCAL_COMPILERS = ("g++", "clang++", "c++")
MISSING_HEADER = re.compile(r"fatal error: '?([^\s':]+\.h(?:pp)?)'?")
UNDECLARED = re.compile(r"'([A-Za-z_]\w*)' (?:was not declared|does not name a type|has not been declared)")
UNKNOWN_MEMBER = re.compile(r"'([A-Za-z_]\w*)' is not a member of '(aie|adf)'")
COMPILE_RESULT = "compile_ok boolean, return_code int, duration_s double, stderr_tail string, compiler string, attempts int, missing_includes int, undeclared int"


@dataclass(frozen=True)
class Toolchain:
    """What was found below a tool folder; a missing tool is None."""

    root: str | None = None
    kernel_compiler: str | None = None
    graph_compiler: str | None = None
    include_dirs: tuple[str, ...] = ()
    library_dirs: dict[str, str] = field(default_factory=dict)
    local: str | None = None


def toolchain(*candidates: str | None) -> Toolchain:
    """The tools of the first candidate folder that has a bin folder, and the local C++ compiler."""
    local = next((found for name in LOCAL_COMPILERS if (found := shutil.which(name))), None)
    for folder in candidates:
        if folder and (Path(folder) / "bin").is_dir():
            root = Path(folder)
            first = lambda names: next((str(root / n) for n in names if (root / n).exists()), None)  # noqa: B023, E731
            libraries = {target: str(root / sub) for target, sub in CHESS_LIBRARIES.items() if (root / sub).is_dir()}
            return Toolchain(str(root), first(KERNEL_COMPILERS), first(GRAPH_COMPILERS), tuple(str(root / i) for i in INCLUDES if (root / i).exists()), libraries, local)
    return Toolchain(local=local)


def stubs_for(log: str, known: dict[str, set[str]]) -> int:
    """Adds to `known` (headers, names, members) what a log misses; how many of them are new."""
    before = sum(map(len, known.values()))
    known.setdefault("headers", set()).update(MISSING_HEADER.findall(log))
    known.setdefault("members", set()).update(f"{space}::{name}" for name, space in UNKNOWN_MEMBER.findall(log))
    known.setdefault("names", set()).update(UNDECLARED.findall(log))
    return sum(map(len, known.values())) - before


def _prelude(known: dict[str, set[str]]) -> str:
    out = [f"struct {n} {{ template <class... A> {n}(A&&...) {{}} }};" for n in sorted(known.get("names", ()))]
    for space in ("aie", "adf"):
        own = sorted(m.split("::")[1] for m in known.get("members", ()) if m.startswith(f"{space}::"))
        out += [f"namespace {space} {{ template <class... A> int {m}(A&&...) {{ return 0; }} }}" for m in own]
    return "\n".join(out)


def syntax_check(job: dict, compiler: str | None = None, retries: int = 3, timeout: float = 30.0) -> dict:
    """A source through a C++ compiler that only reads it; what it does not know is stubbed and it is read again, while that teaches something."""
    compiler = compiler or toolchain().local
    began, known, log, attempts, code = time.time(), {}, "", 0, job.get("code") or ""
    out = {"compile_ok": False, "return_code": -1, "compiler": compiler or "none", "missing_includes": 0, "undeclared": 0}
    if compiler and len(code.strip()) >= 20:
        with tempfile.TemporaryDirectory() as folder:
            while attempts <= retries:
                attempts += 1
                for header in known.get("headers", ()):
                    target = (Path(folder) / header).resolve()
                    if Path(folder).resolve() in target.parents:  # a header's name may point anywhere
                        target.parent.mkdir(parents=True, exist_ok=True)
                        target.touch()
                (Path(folder) / "source.cc").write_text(f"{_prelude(known)}\n{code}", encoding="utf-8")
                try:
                    done = subprocess.run([compiler, "-std=c++17", "-fsyntax-only", "-w", f"-I{folder}", "source.cc"], cwd=folder, capture_output=True, text=True, timeout=timeout, check=False)
                except subprocess.TimeoutExpired:
                    log, out["return_code"] = "timeout", -2
                    break
                log, out["return_code"] = done.stderr or "", done.returncode
                out["missing_includes"] += len(MISSING_HEADER.findall(log))
                out["undeclared"] += len(UNDECLARED.findall(log))
                if not done.returncode:
                    out["compile_ok"] = True
                    break
                if not stubs_for(log, known):
                    break
    return out | {"duration_s": round(time.time() - began, 3), "stderr_tail": log[-3000:], "attempts": attempts}


def compile_with(command: Callable[[dict, str], list[str]], timeout: float = 60.0) -> Callable[[dict], dict]:
    """A client that compiles a job's code by a command (of the job and the source's path) in a folder of its own."""

    def call(job: dict) -> dict:
        began = time.time()
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "source.cc")
            Path(path).write_text(job.get("code") or "", encoding="utf-8")
            line = command(job, path)
            try:
                done = subprocess.run(line, cwd=folder, capture_output=True, text=True, timeout=timeout, check=False)
                code, log = done.returncode, (done.stderr or "").strip() or done.stdout or ""
            except subprocess.TimeoutExpired:
                code, log = -2, f"timeout after {timeout:g} s"
            except OSError as e:
                code, log = -3, str(e)
        return {"compile_ok": code == 0, "return_code": code, "duration_s": round(time.time() - began, 3), "stderr_tail": log[-4000:], "compiler": line[0], "attempts": 1, "missing_includes": 0, "undeclared": 0}

    return call


def rounds(jobs: DataFrame, keys: list[str], ask: Callable[[DataFrame], DataFrame], judge: Callable[[DataFrame], tuple[Column, Column]], most_rounds: int, budget: float | None = None, cost: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, attempts) of a loop with feedback.

    ask: answers for the open jobs, which have `feedback` (empty at first) and `attempt`; judge:
    whether an answer is accepted, and what to tell the next round. A job is open until one of
    its answers is accepted: one that got none is asked again with the feedback it had, one that
    got several is told that of any. budget: no further round once the attempts so far cost as
    much. Keys may be null. Attempts are never lost, as each round is written before the next one
    asks. (For answers that come as a stream, see streaming.loops.)
    """
    open_ = jobs.withColumn("feedback", F.lit(""))
    log, spent = None, 0.0
    for attempt in range(1, most_rounds + 1):
        asked = open_.withColumn("attempt", F.lit(attempt))
        answers = ask(asked)
        ok, told = judge(answers)
        done = written(answers.withColumn("accepted", F.coalesce(ok, F.lit(False))).withColumn("told", F.coalesce(told, F.lit(""))))
        log = done if log is None else log.unionByName(done)
        if cost is not None:
            spent += done.agg(F.sum(cost)).first()[0] or 0.0
        if budget is not None and spent >= budget:
            break
        heard = done.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys]).agg(F.max("accepted").alias("__ok"), F.max("told").alias("__told"))
        met = open_.join(heard, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys], "left").where(~F.coalesce("__ok", F.lit(False)))
        open_ = written(met.withColumn("feedback", F.coalesce("__told", "feedback")).select(*jobs.columns, "feedback"))
        if open_.isEmpty():
            break
    return log.where("accepted"), log
