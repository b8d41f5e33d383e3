"""Upserts, change logs, undo and reconciliation over the store-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import tables as K
from sievework.plans.registry import load, query


@query(
    "d01_upsert_keep_first_seen",
    """with o as (select c_custkey as k, c_acctbal as v, c_nationkey as y2, 1 as first_seen, 1 as last_seen from customer where c_custkey % 3 <> 0), n as (select c_custkey as k, -c_acctbal as v, 99 as y2, 2 as first_seen, 2 as last_seen from customer where c_custkey % 2 = 0)
    select k, coalesce(n.v, o.v) as v, coalesce(o.y2, n.y2) as y2, coalesce(o.first_seen, n.first_seen) as first_seen, coalesce(n.last_seen, o.last_seen) as last_seen from o full join n using (k)""",
)
def d01(spark, sf):
    c = load(spark, sf, "customer")
    old = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.col("c_nationkey").alias("y2"), F.lit(1).alias("first_seen"), F.lit(1).alias("last_seen"))
    new = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), (-F.col("c_acctbal")).alias("v"), F.lit(99).alias("y2"), F.lit(2).alias("first_seen"), F.lit(2).alias("last_seen"))
    return K.upsert(old, new, ["k"], update=["v", "last_seen"], once=["first_seen"])


@query("d02_insert_or_replace", "select p_partkey, case when p_partkey % 4 = 0 then p_size + 100 else p_size end as p_size from part where p_partkey % 3 <> 0 or p_partkey % 4 = 0")
def d02(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_size")
    return K.insert_replace(p.where("p_partkey % 3 <> 0"), p.where("p_partkey % 4 = 0").withColumn("p_size", F.col("p_size") + 100), ["p_partkey"])


@query("d03_insert_or_ignore", "select p_partkey, case when p_partkey % 3 <> 0 then p_size else p_size + 100 end as p_size from part where p_partkey % 3 <> 0 or p_partkey % 4 = 0")
def d03(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_size")
    return K.insert_ignore(p.where("p_partkey % 3 <> 0"), p.where("p_partkey % 4 = 0").withColumn("p_size", F.col("p_size") + 100), ["p_partkey"])


@query("d04_counter_deltas", "select scope, name, sum(n)::bigint as n from (select user_id as scope, event_type as name, 1 as n from events union all select user_id, 'moved', 1 from events where event_type = 'error' union all select user_id, 'error', -1 from events where event_type = 'error') group by 1, 2")
def d04(spark, sf):
    e = load(spark, sf, "events").select(F.col("user_id").alias("scope"), F.col("event_type").alias("name"), F.lit(1).alias("n"))
    err = e.where("name = 'error'")
    moved = err.withColumn("name", F.lit("moved")).unionByName(err.withColumn("n", F.lit(-1)))
    return K.add_counters(e, moved, ["scope", "name"], "n")


@query("d05_conditional_update", "select d.doc_id, case when l.doc_id is null then 'pending' when quality = 0 then 'failed' else 'stored' end as state from documents d left join labels l using (doc_id)")
def d05(spark, sf):
    d = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", F.when(F.col("quality").isNull(), "pending").when(F.col("quality") == 0, "failed").otherwise("stored").alias("state"))


@query("d06_latest_snapshot", "select user_id, arg_max(event_type, event_id) as state, arg_max(value, event_id) as value, max(event_id) as event_id from events group by 1")
def d06(spark, sf):
    return K.latest(load(spark, sf, "events").select("user_id", "event_id", F.col("event_type").alias("state"), "value"), ["user_id"], "event_id")


@query("d07_cascade_delete", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')")
def d07(spark, sf):
    gone = load(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return load(spark, sf, "lineitem").join(gone, "l_orderkey", "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "d08_membership_move",
    """with m as (select distinct l_suppkey as scope, l_partkey as k from lineitem), moved as (select k from m where scope = 1), have as (select k from m where scope = 2)
    select k, 2 as scope, k not in (select k from have) as gained from moved union all select k, scope, false from m where scope not in (1, 2) union all select k, 2, false from have where k not in (select k from moved)""",
)
def d08(spark, sf):
    m = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("scope"), F.col("l_partkey").alias("k")).distinct()
    moved, have, rest = m.where("scope = 1").select("k"), m.where("scope = 2").select("k", F.lit(True).alias("had")), m.where("scope not in (1, 2)")
    into = moved.withColumn("in", F.lit(True)).join(have, "k", "full").select("k", F.lit(2).cast("long").alias("scope"), (F.col("in").isNotNull() & F.col("had").isNull()).alias("gained"))
    return into.unionByName(rest.select("k", "scope", F.lit(False).alias("gained")))


@query("d09_undo_replay", "select user_id, arg_min(value, event_id) as restored from events where event_id >= 2000 group by 1")
def d09(spark, sf):
    log = load(spark, sf, "events").where("event_id >= 2000")
    return K.undo_to(log, ["user_id"], "event_id", "value").withColumnRenamed("value", "restored")


@query("d10_caption_versions", "select conv_id, arg_min(text, turn) as original, arg_max(text, turn) as current, count(*) as versions from conversations where role = 'assistant' group by 1")
def d10(spark, sf):
    c = load(spark, sf, "conversations").where("role = 'assistant'")
    return c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("original"), F.max_by("text", "turn").alias("current"), F.count("*").alias("versions"))


@query(
    "d11_regroup",
    """with t as (select o_orderkey, o_custkey % 7 as scope, r_name || '/' || (year(o_orderdate) // 10 * 10) as target from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
    select scope, target, count(*) as moves from t group by 1, 2""",
)
def d11(spark, sf):
    o, c, n, r = (load(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    t = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    target = F.concat_ws("/", "r_name", (F.floor(F.year("o_orderdate") / 10) * 10).cast("string"))
    return t.groupBy((F.col("o_custkey") % 7).alias("scope"), target.alias("target")).agg(F.count("*").alias("moves"))


@query(
    "d12_manifest_upsert",
    """with o as (select p_partkey as k, p_brand as path from part where p_partkey % 3 <> 0), n as (select p_partkey as k, case when p_partkey % 5 = 0 then p_type else p_brand end as path from part where p_partkey % 2 = 0)
    select k, coalesce(n.path, o.path) as path, case when o.path is null then 'new' when n.path is null then 'kept' when n.path <> o.path then 'moved' else 'kept' end as status from o full join n using (k)""",
)
def d12(spark, sf):
    p = load(spark, sf, "part")
    o = p.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("old"))
    n = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise(F.col("p_brand")).alias("new"))
    out = K.compare_sets(o, n, ["k"], [("new", ~F.col("_l")), ("kept", ~F.col("_r")), ("moved", F.col("old") != F.col("new"))])
    return out.select("k", F.coalesce("new", "old").alias("path"), "status")


@query("d13_reconcile_verdict", "select o_custkey, count(*) as n_rows, bool_and(o_orderstatus <> 'P') as done, case when bool_and(o_orderstatus <> 'P') then 'complete' when bool_or(o_orderstatus = 'F') then 'partial' else 'open' end as verdict from orders group by 1")
def d13(spark, sf):
    g = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_rows"), F.bool_and(F.col("o_orderstatus") != "P").alias("done"), F.bool_or(F.col("o_orderstatus") == "F").alias("some"))
    return g.select("o_custkey", "n_rows", "done", F.when(F.col("done"), "complete").when(F.col("some"), "partial").otherwise("open").alias("verdict"))


@query("d14_registry_merge", "select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as n from events where event_type = 'error' group by 1")
def d14(spark, sf):
    e = load(spark, sf, "events").where("event_type = 'error'").select("user_id", "ts")
    return e.groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n"))


@query("d15_ledger_seed", "select ts::date as day, event_type as method, count(*) as attempts, count(*) filter (where value < 100) as ok from (select distinct ts, event_type, value from events) group by 1, 2")
def d15(spark, sf):
    e = load(spark, sf, "events").select("ts", "event_type", "value")
    twice = e.unionByName(e).dropDuplicates(["ts", "event_type", "value"])
    return twice.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("method")).agg(F.count("*").alias("attempts"), F.count(F.when(F.col("value") < 100, 1)).alias("ok"))
