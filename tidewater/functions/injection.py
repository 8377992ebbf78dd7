"""Bugs put into generated sources: fifteen kinds, which of them fit a source, and in what order they are tried.

An edit changes the first place that fits; where none does, the fallback of the source's kind
is tried. The order of the kinds that fit goes by the hash of the source's number and the
kind, so it differs from source to source and reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.code import any_of
from tidewater.functions.mutators import Edit, change, number
from tidewater.functions.text import content_hash, strip
from tidewater.operators.selection import first_of


def _narrower(n: int) -> int:
    return max(2, n // 2)


def _wider(n: int) -> int:
    return n + 64


def _appended(line: str) -> Edit:
    return lambda text: f"{text}\n{line}\n"


def _all(*edits: Edit) -> Edit:
    """One edit after another, each on what the one before gave."""

    def edit(text: str) -> str | None:
        now = text
        for e in edits:
            now = e(now) or now
        return None if now == text else now

    return edit


_LOOP = (r"for \(unsigned frame = 0; frame <(?!=)", "for (unsigned frame = 0; frame <=")

# The kinds of bugs, the code they change and what they put there.
EDITS: dict[str, Edit] = {
    "unconsumed_stream_deadlock": change(r"writeincr\([^\n]+\);", "// BUG: removed output token write to create a rate mismatch.", (r"adf::connect<[^\n]+;", "// BUG: removed a graph edge and introduced a token imbalance.")),
    "buffer_size_mismatch": change(r"(extents<)(\d+)(>)", number(_wider), (r"(adf::dimensions\([^\)]+\) = \{)(\d+)(\};)", number(_wider))),
    "wrong_vector_lane_width": change(r"(aie::vector<[^,]+,\s*)(\d+)(>)", number(_narrower), (r"(readincr_v<)(\d+)(>)", number(_narrower))),
    "missing_chess_prepare_for_pipelining": change(r"^        chess_prepare_for_pipelining\n", ""),
    "off_by_one_circular_buffer_index": change(*_LOOP),
    "incorrect_lock_ordering": change(r"auto lock_in = acquire\(\);", "release(lock_in);\n    auto lock_in = acquire();", (r"adf::connect<>\(coeff_rtp, adf::async\(k0\.in\[1\]\)\);", "adf::connect<>(adf::async(k0.in[1]), coeff_rtp);")),
    "stream_tlast_missing": _appended("// BUG: TLAST handling intentionally omitted on final packet."),
    "rtp_read_inside_loop": change(r"^    \{\n", "    {\n        auto dynamic_coeff = coeff;\n"),
    "mismatched_plio_width": change(r"plio_128_bits", "plio_32_bits", (r"plio_64_bits", "plio_32_bits"), (r"plio_32_bits", "plio_128_bits"), (r"(GMIO::create\([^,]+,\s*)(\d+)(,)", number(lambda n: 32))),
    "blocking_read_on_async_port": change(r"auto vin = \*in_port\+\+;", "auto vin = readincr_v<8>(&in);"),
    "double_free_buffer_iterator": change(r"release\(lock_in\);", "release(lock_in);\n        release(lock_in);"),
    "uninitialized_accumulator": change(r"aie::accum<[^\n]+ = aie::zeros<[^\n]+;", "aie::accum<acc48, 8> acc;"),
    "incorrect_shuffle_mode": change(r"0x32107654", "0x76543210"),
    "output_buffer_overrun": _all(change(r"\+\+frame\)", "++frame) // BUG: loop bound now overruns output budget"), change(*_LOOP)),
    "wrong_accumulator_mode": _all(change(r"acc80", "acc48"), change(r"cacc80", "cacc48")),
}
FALLBACKS: dict[str, Edit] = {"graph": change(r"    \}\n\};", "        adf::dimensions(k0.in[0]) = {1025};\n    }\n};"), "kernel": change(*_LOOP)}
#: Kinds that fit a source of each sort, with the words (in lower case) that call for them; no words: always.
FITTING: dict[str, list[tuple[str, tuple[str, ...]]]] = {
    "graph": [
        ("unconsumed_stream_deadlock", ()), ("buffer_size_mismatch", ()), ("mismatched_plio_width", ()), ("rtp_read_inside_loop", ("coeff_rtp",)), ("incorrect_lock_ordering", ("async(",)),
    ],
    "kernel": [
        ("unconsumed_stream_deadlock", ("writeincr", "connect<")), ("buffer_size_mismatch", ("extents<",)), ("wrong_vector_lane_width", ("aie::vector<", "readincr_v<")), ("missing_chess_prepare_for_pipelining", ("chess_prepare_for_pipelining",)),
        ("incorrect_lock_ordering", ("acquire()",)), ("double_free_buffer_iterator", ("acquire()",)), ("blocking_read_on_async_port", ("acquire()",)), ("uninitialized_accumulator", ("aie::accum<",)), ("wrong_accumulator_mode", ("aie::accum<",)),
        ("output_buffer_overrun", ()), ("off_by_one_circular_buffer_index", ()), ("incorrect_shuffle_mode", ()),
    ],
}


def inject(code: str | None, category: str, bug_type: str) -> str | None:
    """The code with the bug, or with its sort's fallback; null where neither changes it."""
    if not code:
        return None
    fallback: Callable[[str], str | None] = FALLBACKS.get(category, FALLBACKS["kernel"])
    return EDITS[bug_type](code) or fallback(code)


def bug_order(code: Column, category: Column, seed: Column) -> Column:
    """The kinds that fit a source, in its own order."""
    low = F.lower(code)
    fitting = {sort: F.array_compact(F.array(*[F.when(any_of(low, words) if words else F.lit(True), kind) for kind, words in table])) for sort, table in FITTING.items()}
    kinds = F.when(category == "graph", fitting["graph"]).otherwise(fitting["kernel"])
    by_hash = F.array_sort(F.transform(kinds, lambda k: F.struct(F.md5(F.concat(seed.cast("string"), F.lit(":"), k)).alias("at"), k.alias("kind"))))
    return F.transform(by_hash, lambda x: x["kind"])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("bug_type", T.StringType()), T.StructField("buggy", T.StringType())])))
def _injected(code: pd.Series, category: pd.Series, kinds: pd.Series) -> pd.Series:
    out = []
    for text, sort, order in zip(code, category, kinds):
        found = [(k, inject(text, sort, k)) for k in (order if order is not None else [])]
        out.append([{"bug_type": k, "buggy": b} for k, b in found if b is not None])
    return pd.Series(out)


def buggy_sources(sources: DataFrame, most: int = 3) -> DataFrame:
    """(filename, category, bug_type, buggy) of (filename, code, category, seed): `most` bugs for each source in its own order, results that are new.

    A result counts as new if no source and no earlier result, by file name and turn, has its content.
    """
    d = sources.withColumn("__order", bug_order(F.col("code"), F.col("category"), F.col("seed"))).withColumn("__found", _injected("code", "category", "__order"))
    d = d.select("filename", "category", F.posexplode("__found").alias("turn", "__b")).select("filename", "category", "turn", "__b.bug_type", "__b.buggy")
    d = d.withColumn("__content", content_hash(strip(F.col("buggy"))))
    clean = sources.select(content_hash(strip(F.col("code"))).alias("__content")).distinct()
    fresh = first_of(d.join(clean, "__content", "left_anti"), ["__content"], ["filename", "turn"])
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("filename").orderBy("turn"))  # a source has at most as many rows as there are kinds
    return fresh.withColumn("__place", place).where(F.col("__place") <= most).withColumn("category", F.concat(F.lit("buggy_"), "category")).drop("__place", "__content", "turn")
