"""Every registered query of the engine's own operators, with its SQL twin.

A query takes (spark, sf_dir) and runs over its whole tables. Twins are DuckDB SQL; those that
compare sequences or fold in order have none and are tested on fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import code as C
from tidewater.functions import diffs, mutators, recipes
from tidewater.functions import screens as S
from tidewater.functions import text as X
from tidewater.operators import merge, patterns, pools, product, quantiles, reports, rows, selection
from tidewater.operators.lineage import held, settle, spread
from tidewater.sources import clients, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SPACE = "[ \\t\\n\\r\\x0b\\x0c]"


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents")


_MD5 = lambda e, k: X.duck_hex_mod(f"md5({e})", 32, k)
_SHA1 = lambda e, k: X.duck_hex_mod(f"sha1({e})", 40, k)


# ---- deduplication, caps, splits


@query(
    f"""with d as (select doc_id, source, {X.duck_fingerprint('text')} as fp from documents),
    u as (select doc_id, source from d qualify row_number() over (partition by fp order by doc_id) = 1),
    c as (select *, row_number() over (partition by source order by md5(doc_id::varchar), doc_id) as r, greatest(1, floor((select count(*) from u) * 0.05)) as cap from u)
    select case when {_MD5('source', 5)} = 0 then 'validation' else 'train' end as split, source, count(*)::bigint as n from c where r <= cap group by 1, 2"""
)
def selection_report(spark, d):
    docs = _docs(spark, d).select("doc_id", "source", X.fingerprint(F.col("text")).alias("fp"))
    kept = settle(selection.first_of(docs, ["fp"], ["doc_id"]))
    kept = selection.cap_share(kept.withColumn("m", F.md5(F.col("doc_id").cast("string"))), ["source"], ["m", "doc_id"], 0.05)
    return reports.count_by(kept.withColumn("split", selection.split_fifth(F.col("source"))), "split", "source")


@query("select doc_id, source from documents qualify row_number() over (partition by sha256(text) order by doc_id) = 1")
def exact_dedupe(spark, d):
    return selection.first_of(_docs(spark, d).select("doc_id", "source", F.sha2("text", 256).alias("h")), ["h"], ["doc_id"]).select("doc_id", "source")


@query(f"select doc_id, {X.duck_fingerprint('text')} as fp from documents qualify row_number() over (partition by fp order by doc_id) = 1")
def fingerprint_dedupe(spark, d):
    return selection.first_of(_docs(spark, d).select("doc_id", X.fingerprint(F.col("text")).alias("fp")), ["fp"], ["doc_id"])


@query("select conv_id, turn, role from conversations qualify row_number() over (partition by role, text, conv_id order by turn) = 1")
def triple_dedupe(spark, d):
    return selection.first_of(_t(spark, d, "conversations"), ["role", "text", "conv_id"], ["turn"]).select("conv_id", "turn", "role")


@query(
    f"""with a as (select conv_id, turn, length(text) as n, substr(trim(regexp_replace(text, '{_SPACE}+', ' ', 'g')), 1, 400) as k from conversations where role = 'assistant')
    select conv_id, turn from a where n > 500 union all
    select conv_id, turn from (select * from a where n <= 500 qualify row_number() over (partition by k order by conv_id, turn) <= 2)"""
)
def short_response_cap(spark, d):
    a = _t(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.length("text").alias("n"), F.substring(X.strip(X.one_space(F.col("text"))), 1, 400).alias("k"))
    short = selection.first_n(a.where("n <= 500"), ["k"], ["conv_id", "turn"], 2)
    return a.where("n > 500").select("conv_id", "turn").unionByName(short.select("conv_id", "turn"))


@query("select event_id, event_type from events where event_type is not null qualify row_number() over (partition by event_type order by event_id) <= 80")
def cap_per_type(spark, d):
    return selection.first_n(_t(spark, d, "events").where("event_type is not null").select("event_id", "event_type"), ["event_type"], ["event_id"], 80)


@query("with c as (select doc_id, source, row_number() over (partition by source order by md5(doc_id::varchar), doc_id) as r, greatest(1, floor((select count(*) from documents) * 0.15)) as cap from documents) select doc_id, source from c where r <= cap")
def cap_per_source(spark, d):
    docs = _docs(spark, d).select("doc_id", "source", F.md5(F.col("doc_id").cast("string")).alias("m"))
    return selection.cap_share(docs, ["source"], ["m", "doc_id"], 0.15).select("doc_id", "source")


_TIER = {"en": 0.20, "de": 0.10, "fr": 0.05, "es": 0.02}


@query(
    """with s as (select *, (select count(*) from documents) as total, case lang when 'en' then 0.20 when 'de' then 0.10 when 'fr' then 0.05 else 0.02 end as share from documents),
    f as (select *, row_number() over (partition by lang, source order by doc_id) as q, min(doc_id) over (partition by lang, source) as first from s),
    a as (select *, row_number() over (partition by lang order by q, first) as nr from f)
    select doc_id, lang, source from a where nr <= floor(total * share) or q = 1"""
)
def tier_round_robin(spark, d):
    return selection.round_robin(_docs(spark, d).select("doc_id", "lang", "source"), "lang", "source", ["doc_id"], _TIER, 0.02)


@query(
    """with p as (select count(*) filter (quality = 1) as pos from labels), a as (select cast(floor(pos * 0.25 / 0.75) as bigint) as allowed from p),
    n as (select doc_id, row_number() over (order by doc_id) as r, count(*) over () as n, (select allowed from a) as allowed from labels where quality = 0),
    k as (select *, greatest(1, n // greatest(allowed, 1)) as step from n) select doc_id from k where (r - 1) % step = 0 and (r - 1) / step < allowed"""
)
def negative_stride(spark, d):
    labels = _t(spark, d, "labels")
    n = labels.agg(F.count_if(F.col("quality") == 1).alias("p")).first()["p"]
    return selection.stride(labels.where("quality = 0").select("doc_id"), ["doc_id"], int(n * 0.25 / 0.75))


@query(
    """with n as (select event_id, event_type, row_number() over (partition by event_type order by event_id) as r, count(*) over (partition by event_type) as n from events),
    k as (select *, greatest(1, n // 20) as step from n) select event_id, event_type from k where (r - 1) % step = 0 and (r - 1) / step < 20"""
)
def stride_per_type(spark, d):
    return selection.stride(_t(spark, d, "events").select("event_id", "event_type"), ["event_id"], 20, ["event_type"])


@query(
    f"""with m as (select d.doc_id, d.source, {_MD5('d.source', 5)} as s, coalesce(l.toxic, 0) = 1 as pos from documents d left join labels l using (doc_id)),
    r as (select *, count(*) over (partition by s) as n, count(*) filter (pos) over (partition by s) as p, count(*) filter (pos and doc_id % 4 <> 0) over (partition by s) as c, row_number() over (partition by s, pos, source order by doc_id) as q from m),
    t as (select *, row_number() over (partition by s, pos order by q > 1, case when q = 1 then source end nulls last, doc_id) as turn from r)
    select doc_id, s from t where case when pos then doc_id % 4 <> 0 else p = 0 or c / n >= 0.3::double or turn <= floor(c * (1 - 0.3::double) / 0.3::double) end"""
)
def bug_share_rebalance(spark, d):
    marked = _docs(spark, d).select("doc_id", "source", X.hash_mod(F.col("source"), 5).alias("s")).join(_t(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    marked = settle(marked.select("doc_id", "source", "s", (F.coalesce("toxic", F.lit(0)) == 1).alias("pos"), (F.col("doc_id") % 4 != 0).alias("kept")))
    return selection.rebalance(marked, "pos", "kept", "s", "source", "doc_id", 0.3).select("doc_id", "s")


@query(
    """with q as (select doc_id, source, md5(doc_id::varchar) as k, row_number() over (partition by source order by md5(doc_id::varchar)) as q from documents)
    select doc_id, source from q order by q > 1, case when q = 1 then source end nulls last, k limit 100"""
)
def diverse_pick(spark, d):
    docs = _docs(spark, d).select("doc_id", "source", F.md5(F.col("doc_id").cast("string")).alias("k"))
    return selection.diverse(docs, "source", "k", 100).select("doc_id", "source")


@query(
    f"""with p as (select p_partkey, p_brand, p_type, p_size, row_number() over (order by p_partkey) - 1 as pos, count(*) over () as n from part),
    t as (select *, (pos - {_MD5("'dma_stall'", 2147483647)} % n + n) % n as old, 0 as z from p),
    s as (select *, (((((0::hugeint * 4294967296 + ('0x' || substr(md5('dma_stall'), 1, 8))::bigint) % n) * 4294967296 + ('0x' || substr(md5('dma_stall'), 9, 8))::bigint) % n) * 4294967296 + ('0x' || substr(md5('dma_stall'), 17, 8))::bigint) % n as s3 from t),
    u as (select *, (pos - ((s3 * 4294967296 + ('0x' || substr(md5('dma_stall'), 25, 8))::bigint) % n) + n) % n as turn from s),
    a as (select *, row_number() over (partition by p_brand order by turn) = 1 as fr from u),
    b as (select *, row_number() over (partition by p_type order by fr desc, turn) = 1 as fp from a),
    c as (select *, row_number() over (partition by p_size order by fr desc, fp desc, turn) = 1 as fg from b)
    select p_partkey, turn::bigint as turn, case when fr then 1 when fp then 2 when fg then 3 else 4 end as pass from c order by pass, turn limit 120"""
)
def context_selection(spark, d):
    part = files.positions(_t(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size"), ["p_partkey"])
    part = part.withColumn("n", F.lit(part.count()))
    turned = selection.rotated(part, F.col("row_index"), F.lit("dma_stall"), F.col("n"))
    return selection.pick_contexts(turned, "turn", "p_brand", "p_type", "p_size", 120).select("p_partkey", "turn", "pass")


@query(
    f"""select doc_id, case when {_MD5('source', 5)} = 0 then 'validation' else 'train' end as fifth, case when {_MD5("concat('synth:', source)", 5)} = 0 then 'validation' else 'train' end as synthetic,
    case when {_SHA1('source', 100)} < 20 then 'validation' else 'train' end as percent, case when {X.duck_hex_mod('substr(sha1(text), 1, 8)', 8, 100)} >= 13 then 'train' else 'validation' end as hex_id,
    case when {_SHA1('text', 100)} >= 13 then 'train' else 'validation' end as whole_id, ({X.duck_hex_mod('substr(sha1(text), 1, 8)', 8, 8)})::bigint as choice from documents"""
)
def split_rules(spark, d):
    s, h = F.col("source"), F.sha1("text")
    whole = F.when(X.hex_mod(h, 40, 100) >= 13, "train").otherwise("validation")
    return _docs(spark, d).select(
        "doc_id", selection.split_fifth(s).alias("fifth"), selection.split_fifth(F.concat(F.lit("synth:"), s)).alias("synthetic"), selection.split_percent(s).alias("percent"),
        selection.split_hex_id(h).alias("hex_id"), whole.alias("whole_id"), X.hex_mod(h, 8, 8).alias("choice"),
    )


@query(f"select source, count(distinct case when {X.duck_hex_mod('substr(sha1(doc_id::varchar), 1, 8)', 8, 100)} >= 13 then 'train' else 'validation' end)::bigint as n_splits from documents group by 1 having n_splits > 1")
def split_leak_check(spark, d):
    docs = _docs(spark, d).select("source", selection.split_hex_id(F.sha1(F.col("doc_id").cast("string"))).alias("split"))
    return selection.split_leaks(docs, "source", "split")


@query(
    f"""with recursive d as materialized (select doc_id, {X.duck_fingerprint('text')} as fp, lang, source, row_number() over (order by doc_id) as r from documents),
    g as (select 0::bigint as r, null::bigint as took, []::varchar[] as fps, []::varchar[] as langs, []::varchar[] as sources union all
    select d.r, case when ok then doc_id end, case when ok then list_append(fps, fp) else fps end, case when ok then list_append(langs, lang) else langs end, case when ok then list_append(sources, source) else sources end
    from (select d.*, g.fps, g.langs, g.sources, not list_contains(fps, fp) and len(list_filter(langs, lambda x: x is not distinct from lang)) < 150 and len(list_filter(sources, lambda x: x is not distinct from source)) < 40 as ok from g join d on d.r = g.r + 1) as d)
    select took as doc_id from g where took is not null"""
)
def greedy_diversify(spark, d):
    docs = _docs(spark, d).select("doc_id", X.fingerprint(F.col("text")).alias("fp"), "lang", "source")
    return selection.greedy_caps(docs, "doc_id", "fp", "lang", "source", ["doc_id"], 150, 40)


@query()
def stratified_holdout(spark, d):
    docs = _docs(spark, d).select("doc_id", "lang", "source", F.md5("text").alias("g"))
    return selection.stratified(docs, "source", "lang", "g", ["doc_id"], 6, ["de", "en", "es", "fr"], 220)


@query("select doc_id from (select doc_id from documents order by md5(doc_id::varchar), doc_id limit 10)")
def review_sample(spark, d):
    return _docs(spark, d).select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(10)


# ---- joins


@query("select d.doc_id, coalesce(l.quality, d.n_chars % 2)::bigint as quality from (select doc_id, n_chars from documents where lang = 'en') d left join labels l using (doc_id) union all select doc_id, quality::bigint from labels where doc_id not in (select doc_id from documents where lang = 'en')")
def upsert_labels(spark, d):
    base = _docs(spark, d).where("lang = 'en'").select("doc_id", (F.col("n_chars") % 2).alias("quality"))
    new = _t(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return merge.upsert(base, new, ["doc_id"], ["quality"])


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def unvalidated_rows(spark, d):
    return merge.without(_docs(spark, d).select("doc_id"), _t(spark, d, "labels"), "doc_id")


@query("select doc_id from documents where sha256(text) not in (select sha256(text) from documents where lang = 'de') and source not in (select distinct source from documents where n_chars > 30000)")
def unseen_content_and_source(spark, d):
    docs = _docs(spark, d).select("doc_id", "source", F.sha2("text", 256).alias("h"), "lang", "n_chars")
    first = merge.without(docs, docs.where("lang = 'de'"), "h")
    return merge.without(first, docs.where("n_chars > 30000"), "source").select("doc_id")


@query(f"select doc_id from documents where {X.duck_normalized('text')} not in (select {X.duck_normalized('text')} from benchmark)")
def benchmark_leak_filter(spark, d):
    docs = _docs(spark, d).select("doc_id", F.md5(X.normalized(F.col("text"))).alias("h"))
    return merge.without(docs, _t(spark, d, "benchmark").select(F.md5(X.normalized(F.col("text"))).alias("h")), "h").select("doc_id")


@query("select event_id, event_type from events where not (event_type = 'error' and user_id in (select user_id from events where event_type = 'signup'))")
def flagged_error_filter(spark, d):
    e = _t(spark, d, "events").select("event_id", "event_type", "user_id")
    return merge.restricted_without(e, e.where("event_type = 'signup'"), "user_id", F.col("event_type") == "error").select("event_id", "event_type")


@query(
    """with r as (select doc_id, row_number() over (partition by source order by doc_id) - 1 as i, '/mnt/c/Data/' || source || '/rows.jsonl' as path, source from documents),
    v as (select 'C:/Data/' || source || '/rows.jsonl' as p, i, doc_id % 3 = 0 as ok from r where doc_id % 2 = 0 union all select 'x/rows.jsonl' as p, i, false as ok from r where source = 'src1'),
    a as (select lower(p) as p, i, arg_min(ok, (p, ok)) as ok from v group by 1, 2), b as (select 'rows.jsonl' as b, i, arg_min(ok, (p, ok)) as ok from v group by 1, 2)
    select r.doc_id, coalesce(a.ok, b.ok) as result_ok from r left join a on lower(replace(r.path, '/mnt/c/', 'c:/')) = a.p and r.i = a.i left join b on r.i = b.i"""
)
def result_by_path(spark, d):
    r = selection.ranked(_docs(spark, d).select("doc_id", "source"), ["source"], ["doc_id"], "i").withColumn("i", F.col("i") - 1)
    r = r.withColumn("path", F.concat(F.lit("/mnt/c/Data/"), "source", F.lit("/rows.jsonl")))
    v = r.where("doc_id % 2 = 0").select(F.concat(F.lit("C:/Data/"), "source", F.lit("/rows.jsonl")).alias("p"), "i", (F.col("doc_id") % 3 == 0).alias("ok"))
    v = v.unionByName(r.where("source = 'src1'").select(F.lit("x/rows.jsonl").alias("p"), "i", F.lit(False).alias("ok")))
    keyed = v.select(F.col("p"), F.col("i"), F.col("ok"))
    return merge.first_hit(r, keyed.select("p", "ok", "i"), "path", "p", "i").select("doc_id", "result_ok")


@query(
    """with b as (select user_id, arg_min((event_type = 'purchase', event_type), (event_type <> 'purchase', value, event_type)) as b from events where event_type in ('purchase', 'error', 'view') group by 1)
    select c_custkey, case when b is null then 'not_validated' when b[1] then 'working' else 'not_working' end as state, b[2] as chosen from customer left join b on user_id = c_custkey"""
)
def best_result_per_user(spark, d):
    e = _t(spark, d, "events").where("event_type in ('purchase', 'error', 'view')").select(F.col("user_id").alias("c_custkey"), (F.col("event_type") == "purchase").alias("ok"), "value", "event_type")
    return merge.choose_result(_t(spark, d, "customer").select("c_custkey"), e, ["c_custkey"], "ok", "value", "event_type")


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def last_write_per_user(spark, d):
    return selection.last_of(_t(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("select user_id from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1 and event_type <> 'purchase'")
def open_retries(spark, d):
    return merge.last_event_open(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase")


@query(
    """with m as (select a.p_partkey as k, b.p_partkey as s, a.p_type <> b.p_type as differs, md5(b.p_partkey::varchar) as m from part a join part b on a.p_brand = b.p_brand and a.p_partkey <> b.p_partkey)
    select k as p_partkey, s as sibling, place from (select *, row_number() over (partition by k order by differs desc, m, s) as place from m) where place <= 4"""
)
def sibling_parts(spark, d):
    return merge.siblings(_t(spark, d, "part").select("p_partkey", "p_brand", "p_type"), "p_brand", "p_partkey", "p_type", 4)


@query(
    """with o as (select o_orderkey, o_custkey, o_orderstatus from orders), m as (select c_custkey, c_mktsegment, o_orderkey, o_orderstatus, row_number() over (partition by c_custkey order by coalesce(o_orderstatus = left(c_mktsegment, 1), false) desc, o_orderkey nulls first) as r from customer left join o on c_custkey = o_custkey)
    select c_custkey, o_orderkey as of_o_orderkey from m where r = 1"""
)
def pair_by_customer(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", F.substring("c_mktsegment", 1, 1).alias("kind"))
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return merge.pair_by_name(c, o, "c_custkey", "o_custkey", "kind", "o_orderstatus", "c_custkey", ["o_orderkey"]).select("c_custkey", "of_o_orderkey")


@query(
    """with b as (select distinct p_brand as brand from part), t as (select distinct p_type as type from part), nb as (select p_brand as brand, count(*) as n from part where p_size > 25 group by 1), nt as (select p_type as type, count(*) as n from part where p_size > 25 group by 1)
    select brand, type, coalesce(nb.n, 0)::bigint as n_brand, coalesce(nt.n, 0)::bigint as n_type from b cross join t left join nb using (brand) left join nt using (type) order by n_brand, n_type, brand, type limit 40"""
)
def coverage_grid(spark, d):
    p = _t(spark, d, "part")
    count = lambda c: p.where("p_size > 25").groupBy(c).agg(F.count("*").alias("n"))
    axes = {"brand": p.select(F.col("p_brand").alias("brand")).distinct(), "type": p.select(F.col("p_type").alias("type")).distinct()}
    return product.coverage_grid(axes, {"brand": count("p_brand"), "type": count("p_type")}, 40)


@query(
    f"""with l as (select l_partkey as part, l_suppkey as supplier, o_custkey as customer, l_orderkey as "order" from lineitem join orders on l_orderkey = o_orderkey),
    {", ".join(f'{a} as (select "{a}", count(*)::bigint as n_{a} from l group by 1 order by 2, 1 limit 60)' for a in ("part", "supplier", "customer"))}, o as (select "order", count(*)::bigint as n_order from l group by 1 order by 2, 1 limit 60)
    select * from part cross join supplier cross join customer cross join o order by n_part, n_supplier, n_customer, n_order, part, supplier, customer, "order" limit 60"""
)
def wide_grid(spark, d):
    """The first rows of a product of all parts, suppliers, customers and orders, the rarest in the lines first."""
    l = _t(spark, d, "lineitem").join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("o_custkey").alias("customer"), F.col("l_orderkey").alias("order"))  # noqa: E741
    return product.first_of_product({a: l.groupBy(a).agg(F.count("*").alias(f"n_{a}")) for a in l.columns}, 60)


_MIX = [
    ("single", "normal", 1, "none", 4, None, None), ("single", "normal", 2, "symptom", 4, "symptom", "none"), ("single", "normal", 3, "human", 2, None, None),
    ("single", "hard", 1, "none", 5, None, None), ("single", "hard", 2, "symptom", 5, "symptom", "none"), ("multi", "normal", 1, "none", 1, None, None), ("multi", "normal", 2, "symptom", 3, "symptom", "none"),
]
_TEMPLATES = [
    ("single", "none", "none", 1, "Find what is wrong."), ("single", "none", "none", 2, "Repair this file."), ("single", "none", "none", 3, "What breaks here?"), ("single", "symptom", "sym", 1, "It shows {symptom}; mend it."),
    ("single", "symptom", "sym", 2, "Why {symptom} in {place}?"), ("single", "human", "hum", 1, "A colleague doubts {place}."), ("multi", "none", "mfnone", 1, "Two files, one bug."), ("multi", "symptom", "mfsym", 1, "{symptom} across files."), ("multi", "symptom", "mfsym", 2, "Both files: {symptom}."),
]


def _duck_place(key: str, size: str) -> str:
    out = "0::hugeint"
    for start in (1, 9, 17, 25):
        out = f"(({out} * 4294967296 + ('0x' || substr(md5({key}), {start}, 8))::bigint) % {size})"
    return f"({out})::bigint"


def _duck_rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("null::varchar" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@query(
    f"""with mix(mode, tier, place, pool, weight, needs, otherwise) as (values {_duck_rows(_MIX)}), said(mode, pool, seed, place, template) as (values {_duck_rows(_TEMPLATES)}),
    d as (select doc_id, case when doc_id % 3 = 0 then 'multi' else 'single' end as mode, case when lang = 'de' then 'hard' else 'normal' end as tier, case when n_chars % 2 = 0 then rtrim(source || ' stalls..', '.') else '' end as symptom, coalesce(lang, '') as place from documents),
    e as (select *, case when mode = 'multi' then 'normal' else tier end as used from d),
    r as (select *, sum(weight) over (partition by mode, tier order by place) as upto, sum(weight) over (partition by mode, tier) as size from mix),
    p as (select e.*, case when r.needs = 'symptom' and symptom = '' then r.otherwise else r.pool end as pool from e join r on e.mode = r.mode and e.used = r.tier and {_duck_place("'pool:' || doc_id", "r.size")} >= r.upto - r.weight and {_duck_place("'pool:' || doc_id", "r.size")} < r.upto),
    s as (select *, count(*) over (partition by mode, pool) as size from said)
    select doc_id, p.pool, replace(replace(template, '{{symptom}}', symptom), '{{place}}', p.place) as instruction from p join s on p.mode = s.mode and p.pool = s.pool and s.place - 1 = {_duck_place("s.seed || ':' || doc_id", "s.size")}"""
)
def pool_instructions(spark, d):
    """An instruction for each document by mode, tier and pool; a tier that a mode does not know is normal."""
    mix = spark.createDataFrame(_MIX, "mode string, tier string, place int, pool string, weight int, needs string, otherwise string")
    said = spark.createDataFrame(_TEMPLATES, "mode string, pool string, seed string, place int, template string")
    docs = _docs(spark, d).select(
        "doc_id", F.col("doc_id").cast("string").alias("key"), F.when(F.col("doc_id") % 3 == 0, "multi").otherwise("single").alias("mode"), F.when(F.col("lang") == "de", "hard").otherwise("normal").alias("tier"),
        F.when(F.col("n_chars") % 2 == 0, F.concat("source", F.lit(" stalls.."))).alias("seen"), "lang",
    )
    slots = {"symptom": F.regexp_replace("seen", r"\.+\z", ""), "place": F.col("lang")}
    return pools.instructions(docs, mix, said, "mode", "tier", "key", slots).select("doc_id", "pool", "instruction")


_ERRORS = [(1, "the", "no member named"), (2, "der", "undeclared identifier"), (3, "que", "no matching function"), (4, "reserved", "missing header")]


@query(
    f"""with e(place, word, message) as (values {", ".join(str(e) for e in _ERRORS)}), m as (select doc_id, message, row_number() over (partition by doc_id order by e.place) as place from documents join e on contains(text, word))
    select doc_id, message, place from m"""
)
def error_templates(spark, d):
    table = spark.createDataFrame(_ERRORS, "place int, word string, message string").withColumnRenamed("place", "nr")
    return patterns.theta_contains(_docs(spark, d).select("doc_id", "text"), "text", table, "word", "nr").select("doc_id", "message", "place")


@query(
    """with k as (select distinct unnest(string_split(text, ' ')) as word from conversations), m as (select doc_id, word, strpos(text, word) - 1 as first from documents join k on length(word) >= 6 and contains(text, word))
    select doc_id, count(*)::bigint as n_words, sum(first)::bigint as firsts, md5(string_agg(word, ' ' order by word)) as words_md5 from m group by 1"""
)
def words_in_texts(spark, d):
    """Which words of the conversations, of six characters or more, each document has as a part of its text, all rows of both tables."""
    words = spread(_t(spark, d, "conversations").select("text")).select(F.explode(F.split("text", " ")).alias("word")).where(F.length("word") >= 6)
    docs = _docs(spark, d).select("doc_id", "text")
    again = settle(docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again")))  # as SQL adds up the rows of one doc_id
    if again.isEmpty():
        met = patterns.lists(docs, ["doc_id"], "text", words, "word")
    else:
        same = F.col("doc_id").eqNullSafe(F.col("again"))
        once, often = (patterns.lists(docs.join(again, same, how), ["doc_id"], "text", words, "word") for how in ("left_anti", "left_semi"))
        flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
        met = once.unionByName(often.groupBy("doc_id").agg(F.sort_array(flat("word")).alias("word"), flat("firsts")))
    firsts = F.aggregate("firsts", F.lit(0).cast("long"), lambda so_far, x: so_far + x)
    return met.select("doc_id", F.size("word").cast("long").alias("n_words"), firsts.alias("firsts"), F.md5(F.array_join("word", " ")).alias("words_md5"))


@query(
    f"""with s as (select doc_id, text, lower(lang || '_' || source || '_' || array_to_string(string_split(text, ' ')[:4], '_')) as slug from documents),
    t as (select doc_id, lower(text) as text, list_distinct(list_filter(regexp_extract_all(slug, '[a-z][a-z0-9]*'), lambda w: length(w) >= 3 and w not in ({', '.join(f"'{w}'" for w in C.TOPIC_STOP)}))) as tokens from s)
    select doc_id, len(tokens)::integer as n_tokens, len(list_filter(tokens, lambda w: contains(text, w)))::integer as n_hits from t"""
)
def topic_screen(spark, d):
    """How many words of a slug of each document its text has; off topic without any."""
    slug = F.concat_ws("_", "lang", "source", F.array_join(F.slice(F.split("text", " "), 1, 4), "_"))
    return _docs(spark, d).select("doc_id", F.size(C.topic_tokens(slug)).alias("n_tokens"), C.topic_hits(F.col("text"), slug).alias("n_hits"))


# ---- aggregates


@query("select event_type, (user_id % 5)::bigint as bucket, count(*)::bigint as n from events group by 1, 2")
def count_by_keys(spark, d):
    return reports.count_by(_t(spark, d, "events").withColumn("bucket", F.col("user_id") % 5), "event_type", "bucket")


@query("select p_type, count(*)::bigint as n, min(p_partkey) as first_at from part group by 1 order by n desc, first_at limit 5")
def most_common_types(spark, d):
    return reports.most_common(_t(spark, d, "part"), "p_type", 5, "p_partkey")


@query(
    """select case when grouping(event_type) = 0 then 'event_type' when grouping(bucket) = 0 then 'bucket' else 'all' end as by, case when grouping(event_type) = 0 then event_type when grouping(bucket) = 0 then bucket end as value, count(*)::bigint as n
    from (select event_type, (user_id % 5)::varchar as bucket from events) group by grouping sets ((event_type), (bucket), ())"""
)
def several_summaries(spark, d):
    e = _t(spark, d, "events").withColumn("bucket", (F.col("user_id") % 5).cast("string"))
    return reports.summaries(e, "event_type", "bucket")


@query("select count(distinct source)::bigint as n_groups, count(distinct lang)::bigint as n_langs, count(distinct md5(text))::bigint as n_texts, count(*)::bigint as n from documents")
def distinct_counts(spark, d):
    return _docs(spark, d).agg(F.count_distinct("source").alias("n_groups"), F.count_distinct("lang").alias("n_langs"), F.count_distinct(F.md5("text")).alias("n_texts"), F.count("*").alias("n"))


@query(
    """with s as (select n_chars, row_number() over (order by n_chars, doc_id) as r, count(*) over () as n from documents), q(quantile) as (values (0.10::double), (0.25::double), (0.5::double))
    select quantile, n_chars::double as value from s, q where r = least(cast(floor(n * quantile) as bigint) + 1, n)"""
)
def index_percentiles(spark, d):
    return quantiles.index_percentiles(_docs(spark, d).select("n_chars"), "n_chars", [0.10, 0.25, 0.5])


@query(
    """with s as (select l_extendedprice::double as v, row_number() over (order by l_extendedprice) as r, count(*) over () as n from lineitem), q(quantile) as (values (0.01::double), (0.5::double), (0.9::double), (0.999::double))
    select quantile, v as value from s, q where r = least(cast(floor(n * quantile) as bigint) + 1, n)"""
)
def price_percentiles(spark, d):
    """Exact percentiles found by selection in rounds."""
    return quantiles.index_percentiles(_t(spark, d, "lineitem").select(F.col("l_extendedprice").cast("double").alias("v")), "v", [0.01, 0.5, 0.9, 0.999], few=500)


_LABELS = ("License", "reserved", "http", "@", "!!")


@query("select label, count(*)::bigint as n from (select unnest(list_filter(['License', 'reserved', 'http', '@', '!!'], lambda w: contains(text, w))) as label from documents) group by 1")
def label_coverage(spark, d):
    found = F.filter(F.array(*[F.lit(w) for w in _LABELS]), lambda w: F.contains("text", w))
    return reports.label_coverage(_docs(spark, d).withColumn("labels", found), "labels")


@query("with e as (select role, text, count(*) as c from conversations group by 1, 2) select role, sum(c)::bigint as n, count(text)::bigint as n_distinct, max(c)::bigint as most from e group by 1")
def repetition_by_role(spark, d):
    return reports.repetition(_t(spark, d, "conversations"), ["role"], "text")


@query(
    """with a as (select o_orderpriority, count(*)::bigint as attempts, count(*) filter (o_orderstatus = 'F')::bigint as rejects, count(*) filter (o_orderstatus = 'O')::bigint as accepted from orders group by 1)
    select *, rejects / greatest(attempts, 1) as reject_rate, rejects / greatest(attempts, 1) > 0.3 as above_low, rejects / greatest(attempts, 1) > 0.6 as above_high from a"""
)
def accept_rates(spark, d):
    return reports.accept_rates(_t(spark, d, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O", (0.3, 0.6))


@query(
    """select count(*)::bigint as n, count(*) filter (regexp_matches(text, 'th[a-z]+ing'))::bigint as thing_rows, count(*) filter (len(regexp_extract_all(text, 'th[a-z]+ing')) >= 2)::bigint as thing_twice,
    count(*) filter (regexp_matches(text, '[0-9]{4}'))::bigint as digits_rows, count(*) filter (len(regexp_extract_all(text, '[0-9]{4}')) >= 2)::bigint as digits_twice from documents"""
)
def pattern_coverage(spark, d):
    return reports.pattern_coverage(_docs(spark, d), "text", {"thing": "th[a-z]+ing", "digits": "[0-9]{4}"})


@query(
    """select cast(toxic as varchar) as confidence, count(*) filter (quality = 1 and doc_id % 7 <> 0)::bigint as present, count(*) filter (quality = 0 and doc_id % 7 <> 0)::bigint as absent, count(*) filter (quality is null and doc_id % 7 <> 0)::bigint as uncertain, count(*) filter (doc_id % 7 = 0)::bigint as errors from labels group by 1"""
)
def verdict_counts(spark, d):
    a = _t(spark, d, "labels").select(F.col("toxic").cast("string").alias("confidence"), (F.col("quality") == 1).alias("verdict"), (F.col("doc_id") % 7 == 0).alias("error"))
    return reports.verdict_counts(a, "verdict", "confidence", "error")


@query(
    """with l as (select o_orderpriority as model, count(*)::bigint as runs, sum(o_custkey)::bigint as tokens_in, sum(o_orderkey)::bigint as tokens_out from orders group by 1)
    select model, runs, tokens_in, tokens_out, (tokens_in * coalesce(case model when '1-URGENT' then 0.55::double end, 1.0::double) + tokens_out * coalesce(case model when '1-URGENT' then 1.10::double end, 5.0::double)) / 1e6 as usd from l"""
)
def cost_totals(spark, d):
    ledger = _t(spark, d, "orders").select(F.col("o_orderpriority").alias("model"), F.col("o_custkey").alias("tokens_in"), F.col("o_orderkey").alias("tokens_out"))
    prices = spark.createDataFrame([("1-URGENT", 0.55, 1.10)], "model string, price_in double, price_out double")
    return reports.cost_totals(ledger, prices, "model", "tokens_in", "tokens_out")


@query("select 'rows' as what, count(*)::bigint as n from documents union all select 'ratio_percent', (100 * count(*) filter (lang = 'en')) // greatest(count(*), 1) from documents")
def ratio_report(spark, d):
    a = _docs(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("e"))
    percent = F.floor(100 * F.col("e") / F.greatest("n", F.lit(1)))
    return a.select(F.explode(F.array(F.struct(F.lit("rows").alias("what"), F.col("n").alias("n")), F.struct(F.lit("ratio_percent").alias("what"), percent.alias("n")))).alias("x")).select("x.*")


# ---- projections, text rules, logs


@query("select doc_id, case when k = 1 then base else base || '_' || k end as slug from (select doc_id, base, row_number() over (partition by base order by doc_id) as k from (select doc_id, regexp_replace(regexp_replace(lower(source || ' ' || lang), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as base from documents))")
def suffixed_slugs(spark, d):
    base = _docs(spark, d).select("doc_id", X.slug(F.concat_ws(" ", "source", "lang")).alias("base"))
    return files.suffixed(base, "base", "doc_id", "slug").select("doc_id", "slug")


@query("select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as heading from conversations")
def running_heading(spark, d):
    from pyspark.sql import Window

    upto = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _t(spark, d, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), True).over(upto).alias("heading"))


@query("select event_id, json_extract_string(props, '$.' || k) as value, k as key from events, unnest(json_keys(props)) as t(k)")
def json_props(spark, d):
    keyed = _t(spark, d, "events").select("event_id", "props", F.explode(F.json_object_keys("props")).alias("key"))
    value = F.try_variant_get(F.try_parse_json("props"), "$", "map<string,string>")
    return keyed.withColumn("value", value[F.col("key")]).select("event_id", "value", "key")


@query("select page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, len(regexp_extract_all(html, '<p>'))::bigint as n_blocks from pages")
def page_headers(spark, d):
    return _t(spark, d, "pages").select("page_id", F.lower(F.regexp_extract("url", r"^https?://([^/?#]+)", 1)).alias("host"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p>")).cast("long").alias("n_blocks"))


@query(
    """with m as (select *, lead(text) over (partition by conv_id order by turn) as reply, lead(role) over (partition by conv_id order by turn) as next from conversations)
    select conv_id, turn, 'Buggy version:' || chr(10) || text as context, '```cpp' || chr(10) || regexp_replace(regexp_replace(reply, '[ \\t\\r]+(\\n|$)', '\\1', 'g'), '\\s+$', '') || chr(10) || '```' as response from m where role = 'user' and next = 'assistant' and text <> reply"""
)
def pair_rows(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    m = _t(spark, d, "conversations").withColumn("correct", F.lead("text").over(w)).withColumn("next", F.lead("role").over(w)).where("role = 'user' and next = 'assistant'")
    return rows.pair_rows(m.withColumnRenamed("text", "buggy"), F.lit("")).select("conv_id", "turn", "context", "response")


@query("select conv_id, list(role || ':' || text order by turn) as messages, count(*)::bigint as n from conversations group by 1")
def chat_messages(spark, d):
    return _t(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.concat(x["role"], F.lit(":"), x["text"])).alias("messages"), F.count("*").alias("n"))


_POOL = rows.POOLS["medium"]


@query(f"select doc_id, (['none', 'symptom', 'human'])[case when m < 4 then 1 when m < 8 then 2 else 3 end] as pool, (['a', 'b', 'c'])[{_MD5('doc_id::varchar', 3)} + 1] as template from (select doc_id, {_MD5('doc_id::varchar', 10)} as m from documents)")
def hash_choices(spark, d):
    key = F.col("doc_id").cast("string")
    return _docs(spark, d).select("doc_id", X.weighted_choice(key, _POOL).alias("pool"), X.choose(key, ["a", "b", "c"]).alias("template"))


@query(
    f"""select doc_id, sha256(trim(replace(text, chr(13) || chr(10), chr(10)), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) as content, sha256(text) as raw,
    sha1('{{"context": ' || to_json(source) || ', "response": ' || to_json(lang) || ', "slug": ' || to_json(source) || '}}') as row_id from documents"""
)
def identity_hashes(spark, d):
    return _docs(spark, d).select("doc_id", X.content_hash(F.col("text")).alias("content"), F.sha2("text", 256).alias("raw"), X.row_id(F.col("source"), F.col("source"), F.col("lang")).alias("row_id"))


@query(
    """with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: rtrim(x)), lambda x: trim(x) <> '') as ls from documents)
    select doc_id, len(ls)::bigint as n_lines, array_to_string(case when len(list_filter(ls, lambda x: regexp_matches(x, '(?i)\\b(error|fatal|undefined|undeclared)\\b'))) > 0 then list_filter(ls, lambda x: regexp_matches(x, '(?i)\\b(error|fatal|undefined|undeclared)\\b'))[1:3] else ls[1:3] end, chr(10)) as excerpt from l"""
)
def log_excerpts(spark, d):
    return _docs(spark, d).select("doc_id", F.size(C.told_lines(F.col("text"))).cast("long").alias("n_lines"), C.error_lines(F.col("text"), 3).alias("excerpt"))


@query(
    """with g as (select doc_id, '../tmp/' || source || '.cpp:3:1: fatal error: ''' || source || '.h'' file not found' as log, doc_id % 5 as k from documents), c as (select doc_id, case k when 0 then '' when 1 then log when 2 then 'error: use of undeclared identifier ''int16v8''' when 3 then 'error: no member named ''mac9'' in namespace ''aie''' else 'error: expected ;' end as log from g),
    e as (select doc_id, log, case when log = '' then 'ok' when log like '%fatal error%' then 'missing_dependency' when log like '%int16v8%' then 'missing_aie_types' when log like '%mac9%' then 'aie_api_compile_error' else 'compile_error' end as error_class from c)
    select doc_id, error_class, case when error_class = 'ok' then 'ok' when error_class = 'missing_dependency' then 'missing project/local header' when log like '%mac9%' then 'invalid/unsupported AIE API call' when log like '%undeclared%' then 'missing symbol/context' else 'general compile error' end as cause from (select doc_id, log, case when error_class = 'missing_aie_types' then 'missing_aie_types' else error_class end as error_class from e)"""
)
def error_classes(spark, d):
    log = F.expr(
        "case doc_id % 5 when 0 then '' when 1 then concat('../tmp/', source, '.cpp:3:1: fatal error: ''', source, '.h'' file not found') when 2 then 'error: use of undeclared identifier ''int16v8''' "
        "when 3 then 'error: no member named ''mac9'' in namespace ''aie''' else 'error: expected ;' end"
    )
    c = _docs(spark, d).select("doc_id", log.alias("log")).withColumn("error_class", C.error_class(F.col("log")))
    return c.select("doc_id", "error_class", C.coarse_cause(F.col("error_class") == "ok", F.col("error_class"), F.col("log"), F.lit(0)).alias("cause"))


def _duck_balanced(column: str) -> str:
    """Whether brackets nest, for depths of up to eight."""
    left = f"regexp_replace({column}, '[^\\[\\](){{}}]+', '', 'g')"
    for _ in range(8):
        left = f"regexp_replace({left}, '(\\(\\)|\\[\\]|\\{{\\}})+', '', 'g')"
    return f"({left} = '')"


@query(
    f"""with c as (select page_id, html as a, case page_id % 3 when 0 then html when 1 then regexp_replace(html, '[)]', '') else html || '...existing code...' end as b from pages)
    select page_id, list_filter([case when length(a) < 2000 then 'buggy_too_short' end, case when length(b) < 2000 then 'correct_too_short' end, case when not {_duck_balanced('a')} then 'buggy_unbalanced_delimiters' end, case when not {_duck_balanced('b')} then 'correct_unbalanced_delimiters' end,
    case when contains(a, '...existing code...') then 'buggy_placeholder_text' end, case when contains(b, '...existing code...') then 'correct_placeholder_text' end], lambda x: x is not null) as reasons from c"""
)
def whole_code_reasons(spark, d):
    k = F.col("page_id") % 3
    b = F.when(k == 0, F.col("html")).when(k == 1, X.replace_first(F.col("html"), r"[)]", "")).otherwise(F.concat("html", F.lit("...existing code...")))
    return _t(spark, d, "pages").select("page_id", C.whole_code_reasons(F.col("html"), b, 2000).alias("reasons"))


@query("select doc_id, list_sort(list_distinct(list_filter(string_split(lower(lang || ',' || source), ','), lambda w: contains(lower(text), w)))) as hits, contains(text, 'the') and contains(text, 'of') as both from documents")
def topic_relevance(spark, d):
    words = F.split(F.lower(F.concat_ws(",", "lang", "source")), ",")
    return _docs(spark, d).select("doc_id", F.sort_array(F.array_distinct(F.filter(words, lambda w: F.contains(F.lower("text"), w)))).alias("hits"), (F.contains("text", F.lit("the")) & F.contains("text", F.lit("of"))).alias("both"))


@query("select input_path, row_index, scope, target from (select source as input_path, doc_id as row_index, unnest(['buggy', 'correct']) as scope, text from documents), unnest(['AIE', 'AIE-ML']) as t(target) where length(text) >= 30 and row_index not in (select doc_id from labels)")
def compile_jobs(spark, d):
    r = _docs(spark, d).select(F.col("source").alias("input_path"), F.col("doc_id").alias("row_index"), "text")
    done = _t(spark, d, "labels").select(F.col("doc_id").alias("row_index")).join(r.select("row_index", "input_path"), "row_index")
    done = done.withColumn("scope", F.explode(F.array(F.lit("buggy"), F.lit("correct")))).withColumn("target", F.explode(F.array(F.lit("AIE"), F.lit("AIE-ML"))))
    return clients.compile_jobs(r, done, {"buggy": "text", "correct": "text"}, ["AIE", "AIE-ML"]).drop("code")


@query("select doc_id, rank from (select doc_id, 0 as rank from documents where lang = 'de' union all select doc_id, 1 as rank from labels)")
def ordered_union(spark, d):
    return files.union_in_order(_docs(spark, d).where("lang = 'de'").select("doc_id"), _t(spark, d, "labels").select("doc_id")).select("doc_id", F.col("source_rank").alias("rank"))


@query("select conv_id, list_sort(list_distinct(list(role))) = ['assistant', 'user'] as same_layout from conversations group by 1")
def layout_equality(spark, d):
    return _t(spark, d, "conversations").groupBy("conv_id").agg((F.array_sort(F.collect_set("role")) == F.array(F.lit("assistant"), F.lit("user"))).alias("same_layout"))


# ---- sequence comparison, edits and builds: tested on fixtures


def _turn_pairs(spark, d) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return _t(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("buggy"), F.lead("text").over(w).alias("correct")).where("correct is not null")


@query()
def turn_diffs(spark, d):
    p = _turn_pairs(spark, d)
    return p.select("conv_id", "turn", diffs.unified_diff("buggy", "correct").alias("diff"), diffs.n_changed_lines("buggy", "correct").alias("n_changed"), diffs.anchor_lines("buggy", "correct").alias("anchors"), diffs.cropped("buggy", "correct").alias("cropped"))


@query(
    r"""with t as (select conv_id, turn, text, lead(text) over (partition by conv_id order by turn) as next from conversations)
    select conv_id, turn, md5(regexp_replace(next, '\n$', '')) as after_md5, text = next as same from t where next is not null"""
)
def patched_turns(spark, d):
    """Each turn's text after the diff to the next one: what the diffs hold, put back by native functions."""
    p = _turn_pairs(spark, d).withColumn("diff", diffs.unified_diff("buggy", "correct"))
    return p.select("conv_id", "turn", F.md5(diffs.patched(F.col("buggy"), F.col("diff"))).alias("after_md5"), (F.col("diff") == "").alias("same"))


@query()
def fix_proofs(spark, d):
    p = _turn_pairs(spark, d)
    return p.select("conv_id", "turn", diffs.fix_is_proven("buggy", "correct", "correct").alias("proven"))


@query()
def pair_screen(spark, d):
    return rows.screened(_turn_pairs(spark, d)).select("conv_id", "turn", "similarity", "band")


def _specs(spark, d) -> DataFrame:
    """A specification of a source for each part, from its type, size and key."""
    of = lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), (F.col("p_size") % len(v) + 1).cast("int"))
    p = spread(_t(spark, d, "part"))
    return p.select("p_partkey", F.col("p_type").alias("pattern"), of("int16", "int32", "cfloat", "int8", "cint16").alias("type"), F.element_at(F.array(F.lit("stream"), F.lit("window"), F.lit("cascade")), (F.col("p_partkey") % 3 + 1).cast("int")).alias("interface"), of("simple", "moderate", "complex").alias("complexity"), "p_name")


def _rendered(spark, d) -> DataFrame:
    """(p_partkey, kind, interfaces, code): a kernel and a graph of each part, its name and number in them."""
    tail = F.concat(F.lit("// "), "p_name", F.lit(" "), "p_partkey", F.lit("\n"))
    specs = _specs(spark, d)
    once = lambda df: held(df, code=F.concat("code", tail)).select("p_partkey", "kind", "interfaces", "code")
    kernels = rows.render_kernel(specs).select("p_partkey", F.lit("kernel_type").alias("kind"), F.when(F.col("interface") == "stream", F.array(F.lit("Stream"))).otherwise(F.array(F.lit("Window"))).alias("interfaces"), "p_name", "code")
    return once(kernels).unionByName(once(rows.render_graph(specs).select("p_partkey", F.lit("graph_type").alias("kind"), F.array(F.lit("PLIO")).alias("interfaces"), "p_name", "code")))


@query()
def source_mutations(spark, d):
    """Every edit that fits, on a kernel and a graph of each part."""
    return mutators.mutations(_rendered(spark, d), "code", "kind", "interfaces").select("p_partkey", "kind", "bug_type", "buggy")


@query()
def taxonomy_pairs(spark, d):
    t = _t(spark, d, "part").select(F.concat(F.lit("bug_"), "p_partkey").alias("slug"), F.col("p_name").alias("label"))
    return recipes.synthesize_all(t)


@query()
def synthetic_kernels(spark, d):
    """Kernels and graphs for the least covered of all combinations of the parts' types and sizes."""
    p = _specs(spark, d)
    axes = {c: p.select(c).distinct() for c in ("pattern", "type", "interface", "complexity")}
    counts = {c: p.groupBy(c).agg(F.count("*").alias("n")) for c in axes}
    specs = settle(rows.spec_grid(*axes.values(), counts, 400))
    return rows.render_kernel(specs).select("filename", "code").unionByName(rows.render_graph(specs).select("filename", "code").distinct())


def _instruction_rows(spark, d) -> DataFrame:
    docs = _docs(spark, d).join(_t(spark, d, "labels"), "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("id"), F.lit("Fix it.").alias("instruction"), F.col("text").alias("context"), F.col("lang").alias("response"), F.lit("v").alias("variant"), "source",
        F.when(F.coalesce("toxic", F.lit(0)) == 1, F.col("lang")).alias("bug_type"), F.col("source").alias("source_group"), F.col("source").alias("repo"),
        F.element_at(F.array(*[F.lit(t) for t in rows.TIER_SHARES]), (F.col("doc_id") % 5 + 1).cast("int")).alias("tier"), selection.split_fifth(F.col("source")).alias("split"),
        F.concat(F.lit("c:/data/"), "source", F.lit(".jsonl")).alias("path"), F.col("doc_id").alias("row_index"), F.col("source").alias("group_id"),
    )


@query()
def balanced_build(spark, d):
    return rows.balanced_rows(rows.keyed(_instruction_rows(spark, d)))


@query(
    f"""with r as (select d.doc_id, d.source, d.lang, d.text, case when coalesce(toxic, 0) = 1 then d.lang end as bug, 'c:/data/' || d.source || '.jsonl' as path, quality = 1 as ok from documents d left join labels using (doc_id)),
    p as (select *, 'compile_proven' as b, 0 as k from r where ok), seen as (select distinct source, text from p),
    n as (select r.*, 'real_negative' as b, 2 as k from r where not coalesce(ok, false) and not exists (select 1 from seen where seen.source = r.source and seen.text = r.text) and bug is not null qualify row_number() over (partition by bug order by path, doc_id) <= 80),
    u as (select * from p union all select * from n)
    select doc_id as row_index, b as v4_bucket, case when {_SHA1('source', 100)} < 20 then 'validation' else 'train' end as split from u qualify row_number() over (partition by text, lang order by k, path, doc_id) = 1"""
)
def verified_build(spark, d):
    r = _instruction_rows(spark, d).select("path", "row_index", "group_id", "instruction", "context", "response", "bug_type")
    results = _t(spark, d, "labels").select(F.lit("unused").alias("input_path"), F.col("doc_id").alias("row_index"), (F.col("quality") == 1).alias("compile_ok"))
    by_path = results.join(r.select("path", "row_index"), "row_index").select(F.col("path").alias("input_path"), "row_index", "compile_ok")
    return rows.verified_rows(r, by_path, r.where("false")).select("row_index", "v4_bucket", "split")


@query()
def diff_build(spark, d):
    p = _turn_pairs(spark, d).select(F.sha1(F.concat_ws(":", "conv_id", "turn")).alias("source_id"), "buggy", "correct", F.lit("kernel.cc:3:1: error: no member named 'mac9' in namespace 'aie'").alias("log"))
    built = rows.v5_rows(p, ["Fix the build.", "Return a unified diff.", "Repair the kernel."])
    return rows.sanitized(built, ("mac9", "mul9")).select("source_id", "instruction", "context", "response", "split")


# ---- detectors, gates and descriptions

_WORDS = {"fir_filter": ("fir", "tap", "mac"), "sorting": ("sort", "order"), "legal": ("license", "reserved"), "doppler": ("doppler",)}
_HITS = ", ".join(f"case when {' or '.join(f'''contains(lower(text), '{w}')''' for w in ws)} then '{k}' end" for k, ws in _WORDS.items())


@query(f"select doc_id, case when len(f) > 0 then f else ['generic_aie'] end as patterns from (select doc_id, list_filter([{_HITS}], lambda x: x is not null) as f from documents)")
def detected_patterns(spark, d):
    return _docs(spark, d).select("doc_id", S.compute_patterns(F.col("text"), _WORDS).alias("patterns"))


@query("select label, count(*)::bigint as n from (select unnest(list_filter(['int8', 'int16', 'float', 'est', 'un'], lambda w: contains(lower(text), w))) as label from documents) group by 1")
def data_type_coverage(spark, d):
    found = S.data_types(F.col("text"), ("int8", "int16", "float", "est", "un"))
    return reports.label_coverage(_docs(spark, d).select(F.filter(found, lambda x: x != "unknown").alias("t")), "t")


@query(
    """with p as (select page_id, replace(lower(url), 'https://', '') as path from pages)
    select page_id, regexp_matches(path, '\\.(html|htm)$') as candidate, regexp_matches(path, '(^|/)tests?/') or contains(path, 'buggy') as skipped from p"""
)
def path_screens(spark, d):
    p = _t(spark, d, "pages").select("page_id", F.replace(F.lower("url"), F.lit("https://"), F.lit("")).alias("path"))
    skipped = F.col("path").rlike("(?:^|/)tests?/") | F.contains("path", F.lit("buggy"))
    return p.select("page_id", S.path_candidate(F.col("path"), suffixes=(".html", ".htm")).alias("candidate"), skipped.alias("skipped"))


@query("select source as repo, count(*)::bigint as n_files from documents where n_chars < 500 group by 1 having n_files >= 3")
def vetted_sources(spark, d):
    return files.vetted_repositories(_docs(spark, d).where("n_chars < 500").select(F.col("source").alias("repo")))


@query(
    """with p as (select doc_id, source || ' idiot' as bad, text from documents)
    select doc_id, not contains(text, 'AKIA') and not len(list_filter(string_split(lower(text), chr(10)), lambda x: contains(x, 'stupid') or contains(x, 'released under'))) > 0 as ok from p"""
)
def quality_gate(spark, d):
    return _docs(spark, d).select("doc_id", S.quality_gate(F.col("text"), F.lit(""), ("AKIA",), ("stupid", "Released under")).alias("ok"))


@query("select o_orderkey, (o_orderkey % 4)::bigint as a, (o_orderkey // 4 % 3)::bigint as b, (o_orderkey // 12 % 5)::bigint as c from orders")
def prompt_axes(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", S.axes(F.col("o_orderkey"), {"a": 4, "b": 3, "c": 5}).alias("x")).select("o_orderkey", "x.a", "x.b", "x.c")


_ANCHORED = "regexp_replace(text, '(?m)^\\s*#\\s*include\\b.*$', '', 'g')"


@query(
    f"""with c as (select doc_id, {_ANCHORED} as c, text from (select doc_id, case doc_id % 3 when 0 then '#include <acc_unit.h>' || chr(10) || 'class ' || source || '_x : y' when 1 then 'void ' || source || '(int a) acc_' || lang else '' end || chr(10) || text as text from documents))
    select doc_id, nullif(regexp_extract(c, '\\bclass\\s+([A-Za-z_][A-Za-z0-9_]*)', 1), '') as class, nullif(regexp_extract(c, '\\b(?:void|int|float|cint32|cint16|int16|int32|uint16|uint32|bfloat16|bool)\\s+([A-Za-z_][A-Za-z0-9_]*)\\s*\\(', 1), '') as function,
    nullif(regexp_extract(c, '\\b(?:in_iter|out_iter|in_stream|out_stream|buf|coeff|delay_line|acc|window|stream)[A-Za-z0-9_]*', 0), '') as identifier, len(string_split(text, chr(10)))::bigint as n_lines from c"""
)
def text_anchors(spark, d):
    k, nl = F.col("doc_id") % 3, F.lit("\n")
    head = F.when(k == 0, F.concat(F.lit("#include <acc_unit.h>\nclass "), "source", F.lit("_x : y"))).when(k == 1, F.concat(F.lit("void "), "source", F.lit("(int a) acc_"), "lang")).otherwise("")
    a = S.code_anchors(F.concat(head, nl, "text"))
    return _docs(spark, d).select("doc_id", a["class"].alias("class"), a["function"].alias("function"), a["identifier"].alias("identifier"), a["n_lines"].cast("long").alias("n_lines"))


_GATED = [[], ["missing_graph_instance"], ["missing_kernel_forward_declaration"], ["stream_connect_window_signature_mismatch"], ["missing_adf_include"], ["needs_at_least_two_files", "missing_graph_h", "missing_kernel_source_file", "missing_adf_include", "missing_graph_class", "missing_kernel_create", "missing_source_assignment", "missing_connect", "missing_runtime_ratio", "missing_kernel_function_body", "missing_aie_kernel_ops"]]


@query(f"select p_partkey, ({[r or ['-'] for r in _GATED]})[p_size % {len(_GATED)} + 1] as reasons from part")
def project_gates(spark, d):
    """A project of each part, whole or with one of five faults, through the structure gate; a project without reasons has ['-']."""
    graph = recipes.GRAPH.replace("using namespace adf;\n", "void run(int* x);\n").replace("public graph", "public adf::graph").replace("first_kernel", "run").replace("second_kernel", "run")
    for word in ("kernel::create", "input_plio::create", "output_plio::create", "connect<", "plio_32_bits", "stream>", "window<"):
        graph = graph.replace(word, f"adf::{word}")
    graph = graph.replace(" source(", " adf::source(").replace("runtime<ratio>", "adf::runtime<adf::ratio>").replace("adf::window<256, 64>", "adf::stream") + "demo_graph g;\n"
    parts = held(spread(_t(spark, d, "part").select("p_partkey", "p_name", "p_size")), name=F.concat(F.lit("demo_"), "p_partkey"))
    name = F.col("name")
    parts = held(parts, whole=F.replace(F.concat(F.lit(f"// FILE: graph.h\n{graph}// FILE: kernels/k.cc\nvoid run(input_stream<int16>* in) {{\n readincr(in);\n}}\n// "), "p_name", F.lit("\n")), F.lit("demo_graph"), name))
    without = lambda old, new="": F.replace("whole", F.lit(old) if isinstance(old, str) else old, F.lit(new))
    faults = [F.col("whole"), without(F.concat(name, F.lit(" g;"))), without("void run(int* x);\n"), without("input_stream", "input_window"), without("#include <adf.h>\n"), F.concat(F.lit("int x; // "), "p_name")]
    code = F.element_at(F.array(*faults), (F.col("p_size") % len(faults) + 1).cast("int"))
    reasons = F.col("reasons")
    return held(parts, reasons=S.project_gate(code)).select("p_partkey", F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("-"))).alias("reasons"))


@query()
def graph_descriptions(spark, d):
    """Ports, buffers and limits of a kernel and a graph of each part."""
    r = _rendered(spark, d)
    code = F.col("code")
    return r.select("p_partkey", "kind", S.graph_ports(code).alias("ports"), S.kernel_ports(code).alias("parameters"), S.buffers(code).alias("buffers"), S.constraint_flags(code, F.col("kind"), F.col("interfaces"), S.limiting_intrinsics(code)).alias("constraints"))


@query("select case when k = 1 then base else base || '_' || k end as slug, p_name as label from (select *, row_number() over (partition by base order by p_partkey) as k from (select p_partkey, p_name, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') as base from part) where base <> '')")
def taxonomy_entries(spark, d):
    labels = _t(spark, d, "part").select(F.col("p_type").alias("tier"), F.col("p_brand").alias("group"), F.col("p_name").alias("label"), F.col("p_partkey").alias("at"))
    return rows.taxonomy_entries(labels).select("slug", "label")


@query("select 'bug_' || p_partkey as slug, true as synthetic from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 45)")
def holdout_fill(spark, d):
    taxonomy = _t(spark, d, "part").select(F.concat(F.lit("bug_"), "p_partkey").alias("slug"), F.col("p_name").alias("label"))
    covered = _t(spark, d, "lineitem").where("l_quantity > 45").select(F.concat(F.lit("bug_"), "l_partkey").alias("slug"))
    return rows.holdout_fill(taxonomy, covered).select("slug", "synthetic")


@query("with s as (select doc_id, row_number() over (order by doc_id) as r, count(*) over () as n from documents where length(text) < 12000), k as (select *, greatest(1, n // 100) as step from s) select doc_id from k where (r - 1) % step = 0 and (r - 1) / step < 100")
def clean_rows(spark, d):
    return rows.clean_rows(_docs(spark, d).select("doc_id", "text"), "doc_id", "text", 100).select("doc_id")


@query(
    f"""with e(place, word, message) as (values {", ".join(str(e) for e in _ERRORS)}), m as (select doc_id, list(message order by place) as ms from documents join e on contains(text, word) group by 1)
    select doc_id, ms[((((((0::hugeint * 4294967296 + ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint) % len(ms)) * 4294967296 + ('0x' || substr(md5(doc_id::varchar), 9, 8))::bigint) % len(ms) * 4294967296 + ('0x' || substr(md5(doc_id::varchar), 17, 8))::bigint) % len(ms) * 4294967296 + ('0x' || substr(md5(doc_id::varchar), 25, 8))::bigint) % len(ms)::bigint + 1)::bigint] as error_message from m"""
)
def error_rows(spark, d):
    table = spark.createDataFrame(_ERRORS, "nr int, word string, message string")
    return rows.error_rows(_docs(spark, d).select("doc_id", "text"), "text", table, "word", "message", "nr", "doc_id").select("doc_id", "error_message")
