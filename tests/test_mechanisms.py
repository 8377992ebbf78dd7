"""Selection without an order, products that are never built, sinks that count, and generators in SQL."""

import itertools
import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewater.functions import injection, recipes, tables
from tidewater.operators import product, quantiles, rows
from tidewater.sources import observed


@pytest.mark.parametrize("kind", ["double", "long", "float"])
def test_values_at_ranks(spark, kind):
    r = random.Random(2)
    values = [None, *(r.choice([7, 7, 7, r.randint(-50, 50), r.gauss(0, 1e9)]) for _ in range(3000)), *(float(2**60 + k) for k in range(40))]
    values = [v if v is None else int(v) if kind == "long" else float(v) for v in values]
    frame = spark.createDataFrame([(v,) for v in values], f"v {'double' if kind != 'long' else 'long'}").select(F.col("v").cast(kind)).repartition(4)
    told = sorted(x["v"] for x in frame.where("v is not null").collect())
    ranks = [1, 2, 30, len(told) // 2, len(told) - 5, len(told)]
    for few in (5, 300, 10_000):
        assert quantiles.at_ranks(frame, "v", ranks, few, accuracy=100) == [told[k - 1] for k in ranks]
    assert quantiles.index_percentiles(frame.where("v is null"), "v", [0.5]).count() == 0


def test_selection_orders_no_rows(spark, monkeypatch):
    plans, agg = [], type(spark.range(1)).agg
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda d, *c: (lambda out: plans.append(out._jdf.queryExecution().executedPlan().toString()) or out)(agg(d, *c)))
    frame = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    found = quantiles.at_ranks(frame, "v", [100_000], few=200)
    assert found == [sorted(i * 7919 % 200_003 for i in range(200_000))[99_999]]
    assert plans and not any("Sort [" in p or "rangepartitioning" in p for p in plans)


def test_first_of_product_equals_the_cross_join(spark):
    r = random.Random(5)
    for n in (1, 7, 40, 5000):
        axes = {a: [(v, r.randint(0, 3)) for v in range(size)] for a, size in (("a", 9), ("b", 14), ("c", 6))}
        frames = {a: spark.createDataFrame(v, f"{a} int, n_{a} long") for a, v in axes.items()}
        whole = sorted(itertools.product(*axes.values()), key=lambda x: ([n for _, n in x], [v for v, _ in x]))[:n]
        found = product.first_of_product(frames, n)
        assert [tuple(x[c] for a in axes for c in (a, f"n_{a}")) for x in found.collect()] == [tuple(y for x in w for y in x) for w in whole]
    frames["b"] = frames["b"].where("false")
    assert product.first_of_product(frames, 5).count() == 0


def test_a_product_of_a_million_millions_takes_seconds(spark):
    axes = {a: spark.range(1000).select(F.col("id").alias(a), (F.col("id") % 3).alias(f"n_{a}")) for a in "abcd"}
    began = time.time()
    found = product.first_of_product(axes, 500).collect()
    assert len(found) == 500 and time.time() - began < 60
    assert [tuple(found[k][a] for a in "abcd") for k in (0, 1, 333, 334)] == [(0, 0, 0, 0), (0, 0, 0, 3), (0, 0, 0, 999), (0, 0, 3, 0)]


def test_sinks_count_in_their_own_pass(spark, tmp_path):
    data = [(i, ["a", "b", "zz"][: i % 4] if i % 5 else None, i * 0.5) for i in range(100)]
    frame = spark.createDataFrame(data, "id long, why array<string>, price double")
    frame.write.parquet(f"{tmp_path}/in")
    reads = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        reads.add(1)
        return x

    told = observed.kept_and_dropped(spark.read.parquet(f"{tmp_path}/in").withColumn("id", seen.asNondeterministic()("id")), f"{tmp_path}/out", "why", ["a", "b"], F.col("price"))
    out = spark.read.parquet(f"{tmp_path}/out")
    of = lambda name: sum(name in (w or []) for _, w, _ in data)
    assert told == {"rows": 100, "kept": out.where("kept = 'true'").count(), "dropped": out.where("kept = 'false'").count(), "reason_a": of("a"), "reason_b": of("b"), "reason_other": of("zz"), "cost": sum(p for *_, p in data)}
    assert told["kept"] == sum(not w for _, w, _ in data) and reads.value == 100
    none = observed.kept_and_dropped(frame.where("false"), f"{tmp_path}/none", "why", ["a"], F.col("price"))
    assert none == {"rows": 0, "kept": 0, "dropped": 0, "reason_a": 0, "reason_other": 0, "cost": None}
    assert {r["name"]: r["value"] for r in observed.summary_rows(frame, told).collect()}["rows"] == 100.0


def test_generators_in_sql_equal_the_dataframe_forms(spark):
    tables.register(spark)
    templates = {"fix": ["Fix it", "Mend it"], "explain": ["Explain", "Say", "Tell"]}
    info = spark.createDataFrame([(f"dir/f{i}.cc", i) for i in range(30)], "path string, i int")
    options = ", ".join(f"'{k}', array({', '.join(repr(x) for x in v)})" for k, v in templates.items())
    found = spark.sql(f"select path, i, v.* from {{info}}, lateral variants(path, map({options})) v", info=info)
    assert sorted(found.collect()) == sorted(rows.variants(info, templates).collect())
    taxonomy = spark.createDataFrame([(f"bug_{i}", x) for i, x in enumerate(["Missing lock", "32 instead of 16 taps", "wrong port", None, ""])], "slug string, label string")
    found = spark.sql("select slug, label, t.* from {x}, lateral taxonomy_pairs(slug, label) t", x=taxonomy)
    assert sorted(found.collect(), key=str) == sorted(recipes.synthesize_all(taxonomy).collect(), key=str)
    kinds = sorted(injection.EDITS)
    source = spark.createDataFrame([(1, recipes.KERNEL, "kernel", kinds), (2, recipes.GRAPH, "graph", kinds), (3, None, "graph", kinds), (4, recipes.GRAPH, "graph", None)], "id int, code string, category string, kinds array<string>")
    found = spark.sql("select id, b.* from {x}, lateral injected_bugs(code, category, kinds) b", x=source)
    want = [(r["id"], k, kind, b) for r in source.collect() for k, kind in enumerate(r["kinds"] or []) if (b := injection.inject(r["code"], r["category"], kind)) is not None]
    assert sorted(map(tuple, found.collect())) == sorted(want) and want


def test_functions_of_groups_and_wrong_arguments(spark):
    tables.register(spark)
    names = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 5), ("a", 2)], "base string, at int")
    found = spark.sql("select * from numbered_names(table({x}))", x=names)
    assert sorted(map(tuple, found.where("base is not null").collect())) == [("a", 1, "a", 1), ("a", 2, "a_2", 2), ("a", 3, "a_3", 3), ("b", 2, "b", 1)]
    for bad in ("select * from variants(1, map('a', array('b')))", "select * from taxonomy_pairs('a')", "select * from numbered_names(table(select 1 as base))"):
        with pytest.raises(AnalysisException):
            spark.sql(bad).collect()
