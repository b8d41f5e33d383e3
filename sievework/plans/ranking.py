"""Ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions.text import natural_key
from sievework.operators import ranking as R
from sievework.operators.tables import numbered
from sievework.plans.registry import load, query


def copies(spark, sf):
    l = load(spark, sf, "lineitem")
    return l.select(
        F.col("l_suppkey").alias("grp"), F.col("l_linenumber").cast("int").alias("tier"), (F.floor(F.col("l_quantity")) / 10).alias("score"), F.col("l_returnflag").alias("role"),
        (F.col("l_discount") > 0.05).alias("captioned"), F.col("l_partkey").alias("age"), F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("path"),
    )


W01_SQL = """with c as (select l_suppkey as grp, l_linenumber as tier, floor(l_quantity) / 10 as score, l_returnflag as role, l_discount > 0.05 as captioned, l_partkey as age,
    concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_quantity) as path from lineitem),
  b as (select *, max(score) over (partition by grp, tier) as top from c),
  h as (select *, row_number() over (partition by grp, tier order by role, captioned desc, age, path) as r from b where score >= top - 0.1),
  t as (select grp, tier, top as score, path, row_number() over (partition by grp order by tier desc) as k from h where r = 1),
  walk as (with recursive w as (select grp, k, score, path from t where k = 1 union all
    select t.grp, t.k, case when t.score >= w.score + 3.0 then t.score else w.score end, case when t.score >= w.score + 3.0 then t.path else w.path end from w join t on t.grp = w.grp and t.k = w.k + 1) select * from w)
  select grp, arg_max(path, k) as path from walk group by grp"""


@query("w01_best_copy", W01_SQL)
def w01(spark, sf):
    return R.choose_best_copies(copies(spark, sf), "grp")


@query(
    "w02_step_aside",
    """with c as (select l_orderkey, l_linenumber, l_discount > 0.08 as marked, bool_or(not (l_discount > 0.08)) over (partition by l_orderkey) as other from lineitem) select l_orderkey, l_linenumber from c where not marked or not other""",
)
def w02(spark, sf):
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") > 0.08).alias("marked"))
    return R.step_aside(l, "l_orderkey", "marked").select("l_orderkey", "l_linenumber")


@query(
    "w03_store_keeper",
    """with c as (select *, bool_or(l_returnflag <> 'R') over (partition by l_partkey) as other from lineitem) select l_partkey, l_orderkey, l_quantity from (
    select *, row_number() over (partition by l_partkey order by l_quantity desc, l_extendedprice desc, l_orderkey) as r from c where l_returnflag <> 'R' or not other) where r = 1""",
)
def w03(spark, sf):
    l = load(spark, sf, "lineitem").withColumn("painted", F.col("l_returnflag") == "R")
    kept = R.step_aside(l, "l_partkey", "painted")
    return R.rank_in(kept, ["l_partkey"], [F.desc("l_quantity"), F.desc("l_extendedprice"), F.col("l_orderkey")]).where("rank = 1").select("l_partkey", "l_orderkey", "l_quantity")


@query(
    "w04_floor_and_percent",
    """with c as (select l_suppkey, l_returnflag, l_orderkey * 8 + l_linenumber as id, l_extendedprice as s, count(*) over (partition by l_suppkey, l_returnflag) as n from lineitem where l_quantity > 2),
    r as (select *, row_number() over (partition by l_suppkey, l_returnflag order by s desc, id) as rank from c where s >= 30000) select l_suppkey, l_returnflag, id, rank from r where rank <= floor(n * 20 / 100)""",
)
def w04(spark, sf):
    l = load(spark, sf, "lineitem").where(F.col("l_quantity") > 2)
    d = l.select("l_suppkey", "l_returnflag", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_extendedprice").alias("s"))
    return R.cut_top(d, ["l_suppkey", "l_returnflag"], "s", "id", 30000, 20).select("l_suppkey", "l_returnflag", "id", "rank")


@query("w05_rank_with_tiers", "select p_partkey, row_number() over (partition by p_brand order by case when p_size > 25 then 0 else 1 end, p_retailprice desc, p_partkey) as rank from part")
def w05(spark, sf):
    p = load(spark, sf, "part").withColumn("t", F.when(F.col("p_size") > 25, 0).otherwise(1))
    return R.cut_top(p, ["p_brand"], "p_retailprice", "p_partkey", tiers="t").select("p_partkey", "rank")


@query("w06_gap_tiers")
def w06(spark, sf):
    d = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("score"))
    return R.gap_tiers(d, "score", "id", 4)


@query(
    "w08_consecutive_groups",
    """with s as (select user_id, event_id, ts, case when ts - lag(ts) over (partition by user_id order by event_id) <= interval 6 hour then 0 else 1 end as new from events)
    select user_id, event_id, sum(new) over (partition by user_id order by event_id)::bigint as session from s""",
)
def w08(spark, sf):
    e = load(spark, sf, "events").select("user_id", "event_id", "ts")
    close = F.expr("ts - _prev.ts <= interval 6 hours")
    return R.sessions(e, ["user_id"], ["event_id"], close).select("user_id", "event_id", "session")


@query("w09_doubtful_band", "select event_id, value from events where value between 10 and 90 order by abs(value - 50), event_id limit 200")
def w09(spark, sf):
    e = load(spark, sf, "events").where(F.col("value").between(10, 90))
    return e.orderBy(F.abs(F.col("value") - 50), "event_id").limit(200).select("event_id", "value")


@query(
    "w10_slot_sampling",
    """with r as (select lang, doc_id, row_number() over (partition by lang order by doc_id) - 1 as i, count(*) over (partition by lang) as n from documents),
    s as (select *, least(9, n) as k, (((i + 1) * least(9, n) - 1) // n)::int as slot from r),
    o as (select *, abs(i - floor(((slot * n) // k + ((slot + 1) * n) // k - 1) / 2)) as off from s)
    select lang, doc_id, slot, row_number() over (partition by lang, slot order by off, i)::int as try_order from o""",
)
def w10(spark, sf):
    return R.slot_picks(load(spark, sf, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"], 9)


@query("w11_seeded_draw", "select lang, doc_id from (select lang, doc_id, row_number() over (partition by lang order by sha256('s1:' || doc_id), doc_id) as r from documents) where r <= 20")
def w11(spark, sf):
    return R.top_of_each(load(spark, sf, "documents"), "lang", R.seeded_order("s1", "doc_id"), 20, "doc_id").select("lang", "doc_id")


@query(
    "w12_cap_by_confidence",
    """with hand as (select label, count(*) as n from embeddings where vec_id % 25 = 0 group by 1), r as (select vec_id, label, row_number() over (partition by label order by embedding[1]::double desc, vec_id) as r from embeddings where vec_id % 25 <> 0)
    select vec_id, r.label from r join hand using (label) where r <= 5 * n""",
)
def w12(spark, sf):
    e = load(spark, sf, "embeddings")
    hand = e.where(F.col("vec_id") % 25 == 0).groupBy("label").agg(F.count("*").alias("n"))
    r = R.rank_in(e.where(F.col("vec_id") % 25 != 0), ["label"], [F.desc(F.col("embedding")[0].cast("double")), F.col("vec_id")])
    return r.join(F.broadcast(hand), "label").where(F.col("rank") <= 5 * F.col("n")).select("vec_id", "label")


@query("w13_cap_per_class", "select o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_orderstatus order by sha256('cv:' || o_orderkey), o_orderkey) as r from orders) where r <= 100")
def w13(spark, sf):
    return R.top_of_each(load(spark, sf, "orders"), "o_orderstatus", R.seeded_order("cv", "o_orderkey"), 100, "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("w14_collision_suffixes", "select p_partkey, case when r = 1 then p_name else p_name || '-' || r end as name from (select *, row_number() over (partition by p_brand, lower(p_name) order by p_partkey) as r from part)")
def w14(spark, sf):
    return R.collision_names(load(spark, sf, "part"), "p_brand", "p_name", "p_partkey").select("p_partkey", "name")


@query("w15_renumbering", "select p_partkey, row_number() over (partition by p_type order by p_size, p_partkey) as n from part")
def w15(spark, sf):
    p = load(spark, sf, "part").withColumn("_f", F.concat(F.lit("img"), F.col("p_size").cast("string")))
    return R.rank_in(p, ["p_type"], [natural_key(F.col("_f")), F.col("p_partkey")], "n").select("p_partkey", "n")


@query(
    "w16_largest_size",
    """select l_orderkey, arg_max(l_linenumber, (case when l_returnflag <> 'N' then 1 else 0 end) * 1e9 + case when l_returnflag <> 'N' then l_quantity else 0 end * 100 + l_linenumber) as size from lineitem group by 1""",
)
def w16(spark, sf):
    known = (F.col("l_returnflag") != "N").cast("int")
    key = F.struct(known.alias("k"), F.when(known == 1, F.col("l_quantity")).otherwise(0.0).alias("a"), "l_linenumber")
    return load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_max(F.collect_list(key))["l_linenumber"].alias("size"))


@query(
    "w17_slot_survivor",
    """with r as (select conv_id, role, turn, length(text) as n, row_number() over (partition by conv_id, role order by length(text) desc, turn) as k from conversations)
    select conv_id, role, max(turn) filter (where k = 1) as survivor, count(*) - 1 as losers, max(n) filter (where k = 2) >= 0.9 * max(n) filter (where k = 1) as promote from r group by 1, 2""",
)
def w17(spark, sf):
    c = load(spark, sf, "conversations").select("conv_id", "role", "turn", F.char_length("text").cast("long").alias("n"))
    r = R.rank_in(c, ["conv_id", "role"], [F.desc("n"), F.col("turn")], "k")
    at = lambda c, k: F.max(F.when(F.col("k") == k, F.col(c)))
    return r.groupBy("conv_id", "role").agg(at("turn", 1).alias("survivor"), (F.count("*") - 1).alias("losers"), (at("n", 2) >= 0.9 * at("n", 1)).alias("promote"))


@query("t07_natural_sort", "select p_partkey, row_number() over (order by p_size, p_partkey) as n from part where p_size < 4")
def t07(spark, sf):
    p = load(spark, sf, "part").where(F.col("p_size") < 4)
    order = [natural_key(F.concat(F.lit("Img"), F.col("p_size").cast("string"))), F.col("p_partkey")]
    return numbered(p, order, "n").select("p_partkey", "n")
