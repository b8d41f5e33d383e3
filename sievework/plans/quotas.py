"""Quota and allocation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import quotas as Q
from sievework.operators import ranking as R
from sievework.plans.registry import load, query

QUOTA_SQL = """with c as (select {key} as key, count(*) as n from {table} group by 1), a as (select *, sum(n) over () as s, least({total}, sum(n) over ())::bigint as t from c),
    b as (select *, (t * n) // s as base, (t * n) % s as rem from a), r as (select *, t - sum(base) over () as extra, row_number() over (order by rem desc, key::varchar) as r from b)"""


@query("q01_largest_remainder", QUOTA_SQL.format(key="source", table="documents", total=333) + " select key, n, least(base + case when r <= extra then 1 else 0 end, n)::bigint as quota from r")
def q01(spark, sf):
    c = load(spark, sf, "documents").groupBy(F.col("source").alias("key")).agg(F.count("*").alias("n"))
    return Q.largest_remainder(c, "key", "n", 333).select("key", "n", "quota")


Q02_SQL = """with m as (select l_returnflag = 'R' as f, count(*) as n from lineitem group by 1), w as (select (select n from m where f) as nf, (select n from m where not f) as nn),
  x as (select least(nf, 500 - least(nn, 500 - least(nf, 300))) as want, least(nn, 500 - least(nf, 300)) as rest from w),
  c as (select l_returnflag = 'R' as f, year(l_shipdate) as y, count(*) as n from lineitem group by 1, 2),
  a as (select c.*, sum(n) over (partition by f) as s, case when f then want else rest end as t from c, x),
  b as (select *, (t * n) // s as base, (t * n) % s as rem from a),
  q as (select f, y, least(base + case when row_number() over (partition by f order by rem desc, y::varchar) <= t - sum(base) over (partition by f) then 1 else 0 end, n) as quota from b),
  r as (select l_orderkey * 8 + l_linenumber as id, l_returnflag, year(l_shipdate) as y, l_returnflag = 'R' as f, row_number() over (partition by l_returnflag = 'R', year(l_shipdate) order by l_extendedprice desc, l_orderkey * 8 + l_linenumber, l_partkey) as k from lineitem)
  select id, l_returnflag, r.y from r join q on r.f = q.f and r.y = q.y where k <= quota"""


@query("q02_stratified_target", Q02_SQL)
def q02(spark, sf):
    l = load(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_returnflag", F.year("l_shipdate").cast("long").alias("y"), F.col("l_extendedprice").alias("area"))
    return Q.stratified_target(l, "l_returnflag", "y", "area", "id", 500, "R", 0.6).select("id", "l_returnflag", "y")


@query(
    "q03_two_pool_balance",
    """with c as (select l_suppkey, count(*) filter (where l_returnflag = 'R') as a, count(*) filter (where l_returnflag <> 'R') as b from lineitem group by 1),
    n as (select *, least(floor(a / 0.4), floor(b / 0.6), 150) as n from c), t as (select *, least(a, floor(n * 0.4 + 0.5 + 1e-9)) as ca from n)
    select l_suppkey, ca::bigint as take_a, least(b, n - ca)::bigint as take_b from t""",
)
def q03(spark, sf):
    c = load(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("a"), F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("b"))
    a, b = Q.balanced_pair(F.col("a"), F.col("b"), 40, 150)
    return c.select("l_suppkey", a.alias("take_a"), b.alias("take_b"))


@query(
    "q04_category_settings",
    """with s(cat, floor, pct, most) as (values ('en', 500, 50, 100), ('de', 0, 10, 1000), ('fr', 1000, 100, 7)), c as (select lang, doc_id, n_chars, count(*) over (partition by lang) as n from documents),
    r as (select c.*, pct, most, row_number() over (partition by lang order by n_chars desc, doc_id) as rank from c join s on lang = cat where n_chars >= floor) select lang, doc_id, rank from r where rank <= floor(n * pct / 100) and rank <= most""",
)
def q04(spark, sf):
    from pyspark.sql.window import Window

    s = spark.createDataFrame([("en", 500, 50, 100), ("de", 0, 10, 1000), ("fr", 1000, 100, 7)], "lang string, low int, pct int, most int")
    d = load(spark, sf, "documents").select("lang", "doc_id", "n_chars").withColumn("n", F.count("*").over(Window.partitionBy("lang")))
    d = d.join(F.broadcast(s), "lang").where(F.col("n_chars") >= F.col("low"))
    r = R.rank_in(d, ["lang"], [F.desc("n_chars"), F.col("doc_id")])
    return r.where((F.col("rank") <= F.floor(F.col("n") * F.col("pct") / 100)) & (F.col("rank") <= F.col("most"))).select("lang", "doc_id", "rank")


@query(
    "q05_share_plan",
    """with c as (select lang, count(*) as n, count(*) filter (where source = 'src0') as s from documents group by 1), m as (select *, least(1.0, min(n * 0.3 / nullif(s, 0)) over ()) as share from c)
    select lang, floor(s * share + 0.5 + 1e-9)::bigint as dropped from m""",
)
def q05(spark, sf):
    c = load(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count(F.when(F.col("source") == "src0", 1)).alias("s"))
    share = c.agg(F.least(F.lit(1.0), F.min(F.try_divide(F.col("n") * 0.3, F.col("s")))).alias("share"))
    return c.join(F.broadcast(share)).select("lang", Q.half_up(F.col("s") * F.col("share")).cast("long").alias("dropped"))


@query(
    "q06_style_assignment",
    """select doc_id, case when h < 5534023222112865484 then 'short' when h < 12912720851596686131 then 'long' else 'tags' end as style
    from (select doc_id, ('0x' || substr(sha256(doc_id::varchar), 1, 16))::ubigint::hugeint as h from documents)""",
)
def q06(spark, sf):
    return load(spark, sf, "documents").select("doc_id", Q.style_for(F.col("doc_id"), {"short": 30, "long": 40, "tags": 30}).alias("style"))


@query("q07_bucket_merge")
def q07(spark, sf):
    p = load(spark, sf, "part")
    b = p.groupBy(F.col("p_brand").alias("pool"), (F.col("p_size") % 3).cast("int").alias("tier"), (512 + (F.col("p_size") % 13) * 64).cast("int").alias("width"), F.lit(768).alias("height")).agg(F.count("*").alias("n"))
    return Q.merge_buckets(b, "pool")


@query("q08_shard_plan")
def q08(spark, sf):
    per = {r[0]: r[1] for r in load(spark, sf, "customer").groupBy("c_nationkey").count().collect()}
    nations = {r[0]: r[1] for r in load(spark, sf, "nation").select("n_nationkey", "n_regionkey").collect()}
    counts, children = {-1: sum(per.values())}, {-1: []}
    for nation, region in nations.items():
        key = 1000 + region
        counts[key] = counts.get(key, 0) + per.get(nation, 0)
        counts[nation] = per.get(nation, 0)
        children.setdefault(key, []).append(nation)
    children[-1] = sorted(k for k in children if k >= 1000)
    rows = Q.shard_plan(counts, children, -1, most=max(1, counts[-1] // 6))
    return spark.createDataFrame([(r["region"], r["exclude"], r["rows"]) for r in rows], "region long, exclude array<long>, rows long")


@query("q09_call_cost", "select c_custkey, 1 + greatest(1, ceil(coalesce(n, 0) / 7))::bigint as calls, n is null as at_least from customer left join (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey")
def q09(spark, sf):
    n = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    calls, low = Q.call_cost(F.col("n"), 7)
    return load(spark, sf, "customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", calls.cast("long").alias("calls"), low.alias("at_least"))
