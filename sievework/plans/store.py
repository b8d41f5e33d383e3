"""Joins, aggregates and set operations over the store-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.operators import tables as K
from sievework.plans.registry import load, query


@query("j01_members_status", "select o_custkey as scope, o_orderstatus as state, count(*) as n from lineitem join orders on l_orderkey = o_orderkey group by all")
def j01(spark, sf):
    l, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    return l.join(o, l.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("scope"), F.col("o_orderstatus").alias("state")).agg(F.count("*").alias("n"))


@query("j02_left_outer", "select d.doc_id, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id")
def j02(spark, sf):
    return load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")


@query("j03_missing_or_stale", "select d.doc_id from documents d left join (select doc_id, quality as version from labels) n on d.doc_id = n.doc_id where n.doc_id is null or n.version <> 1")
def j03(spark, sf):
    derived = load(spark, sf, "labels").withColumn("version", F.col("quality"))
    return K.pending(load(spark, sf, "documents").select("doc_id"), derived, ["doc_id"], 1)


@query("j04_absent_from_both", "select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 48) and p_partkey not in (select doc_id from documents)")
def j04(spark, sf):
    p = load(spark, sf, "part").select("p_partkey")
    a = load(spark, sf, "lineitem").where(F.col("l_quantity") > 48).select(F.col("l_partkey").alias("p_partkey"))
    b = load(spark, sf, "documents").select(F.col("doc_id").alias("p_partkey"))
    return p.join(a, "p_partkey", "left_anti").join(b, "p_partkey", "left_anti")


@query("j05_semi_copy", "select o_orderkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def j05(spark, sf):
    c = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return load(spark, sf, "orders").join(c, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@query(
    "j06_exists_and_count",
    """select o_orderkey, (select count(*) from lineitem where l_orderkey = o_orderkey) as lines from orders
    where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')""",
)
def j06(spark, sf):
    o, l = load(spark, sf, "orders").select("o_orderkey"), load(spark, sf, "lineitem")
    per = l.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.max(F.col("l_returnflag") == "R").alias("r"))
    return o.join(per.where("r"), "o_orderkey").select("o_orderkey", "lines")


@query(
    "j07_latest_earlier",
    """select c_custkey, (select arg_max(o_totalprice, o_orderkey) from orders where o_custkey = c_custkey and o_orderkey < 9000 and o_orderstatus <> 'P') as restored from customer""",
)
def j07(spark, sf):
    o = load(spark, sf, "orders").where((F.col("o_orderkey") < 9000) & (F.col("o_orderstatus") != "P"))
    last = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_totalprice", "o_orderkey").alias("restored"))
    return load(spark, sf, "customer").select("c_custkey").join(last, "c_custkey", "left")


@query("j08_versioned_join", "select d.doc_id, e.label from documents d join embeddings e on d.doc_id = e.vec_id where e.label < 4")
def j08(spark, sf):
    e = load(spark, sf, "embeddings").where(F.col("label") < 4).select(F.col("vec_id").alias("doc_id"), "label")
    return load(spark, sf, "documents").select("doc_id").join(e, "doc_id")


@query("j09_in_list", "select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey where c_custkey in (select o_custkey from orders where o_orderkey < 300)")
def j09(spark, sf):
    c, n = load(spark, sf, "customer"), load(spark, sf, "nation")
    keys = load(spark, sf, "orders").where(F.col("o_orderkey") < 300).select(F.col("o_custkey").alias("c_custkey"))
    return c.join(keys, "c_custkey", "left_semi").join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


@query("j10_semi_join", "select s_suppkey, s_name from supplier where s_nationkey in (select n_nationkey from nation where n_regionkey = 2)")
def j10(spark, sf):
    n = load(spark, sf, "nation").where(F.col("n_regionkey") == 2).select(F.col("n_nationkey").alias("s_nationkey"))
    return load(spark, sf, "supplier").join(n, "s_nationkey", "left_semi").select("s_suppkey", "s_name")


@query(
    "j17_sorted_lookup",
    "select l_orderkey, l_linenumber, l_partkey, p_size, p_partkey is not null as present from lineitem left join (select * from part where p_size < 25) on l_partkey = p_partkey",
)
def j17(spark, sf):
    p = load(spark, sf, "part").where(F.col("p_size") < 25).select(F.col("p_partkey").alias("l_partkey"), "p_size", F.lit(True).alias("_p"))
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(p, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "p_size", F.coalesce("_p", F.lit(False)).alias("present"))


@query("j18_sidecar_join", "select c.c_custkey, s.s_suppkey from customer c join supplier s on c.c_nationkey = s.s_nationkey and lower(right(c_name, 2)) = lower(right(s_name, 2))")
def j18(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("dir"), F.lower(F.right("c_name", F.lit(2))).alias("stem"))
    s = load(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("dir"), F.lower(F.right("s_name", F.lit(2))).alias("stem"))
    return c.join(s, ["dir", "stem"]).select("c_custkey", "s_suppkey")


@query(
    "j19_orphans",
    """select 'doc' as side, doc_id as id from documents where doc_id not in (select doc_id from labels) union all
    select 'page', page_id from pages where page_id not in (select doc_id from labels)""",
)
def j19(spark, sf):
    l = load(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    d = load(spark, sf, "documents").select(F.lit("doc").alias("side"), F.col("doc_id").alias("id"))
    p = load(spark, sf, "pages").select(F.lit("page").alias("side"), F.col("page_id").alias("id"))
    return d.unionByName(p).join(l, "id", "left_anti").select("side", "id")


@query(
    "j20_hierarchy_lookup",
    """with chain as (select c_custkey, unnest([n_regionkey + 1000, n_nationkey]) as node, unnest([0, 1]) as pos from customer join nation on c_nationkey = n_nationkey),
    listed as (select r_regionkey + 1000 as node, r_name as name from region union all select n_nationkey, n_name from nation where n_nationkey % 3 = 0)
    select c_custkey, arg_max(name, pos) as country from chain join listed using (node) group by c_custkey""",
)
def j20(spark, sf):
    n = load(spark, sf, "nation")
    listed = load(spark, sf, "region").select((F.col("r_regionkey") + 1000).alias("node"), F.col("r_name").alias("name")).unionByName(n.where(F.col("n_nationkey") % 3 == 0).select(F.col("n_nationkey").alias("node"), F.col("n_name").alias("name")))
    chains = n.select("n_nationkey", F.posexplode(F.array(F.col("n_regionkey") + 1000, F.col("n_nationkey"))).alias("pos", "node"))
    named = chains.join(listed, "node").groupBy("n_nationkey").agg(F.max_by("name", "pos").alias("country"))
    c = load(spark, sf, "customer")
    return c.join(named, c.c_nationkey == named.n_nationkey).select("c_custkey", "country")


@query(
    "j21_first_elsewhere",
    "select l.l_orderkey, l.l_linenumber, f.l_orderkey as first_order from lineitem l join (select l_partkey, min(l_orderkey) as l_orderkey from lineitem group by 1) f on l.l_partkey = f.l_partkey where l.l_orderkey <> f.l_orderkey",
)
def j21(spark, sf):
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    first = l.groupBy("l_partkey").agg(F.min("l_orderkey").alias("first_order"))
    return l.join(first, "l_partkey").where(F.col("l_orderkey") != F.col("first_order")).select("l_orderkey", "l_linenumber", "first_order")


@query(
    "j22_snapshot_comparison",
    """with a as (select doc_id, lang from documents where doc_id % 3 <> 0), b as (select doc_id, case when doc_id % 7 = 0 then 'xx' else lang end as held from documents where doc_id % 4 <> 0)
    select doc_id, case when lang is null then 'removed' when held is null then 'added' when lang <> held then 'changed' else 'kept' end as status from a full join b using (doc_id)""",
)
def j22(spark, sf):
    d = load(spark, sf, "documents")
    a = d.where(F.col("doc_id") % 3 != 0).select("doc_id", "lang")
    b = d.where(F.col("doc_id") % 4 != 0).select("doc_id", F.when(F.col("doc_id") % 7 == 0, "xx").otherwise(F.col("lang")).alias("held"))
    return K.compare_sets(a, b, ["doc_id"], [("removed", ~F.col("_l")), ("added", ~F.col("_r")), ("changed", F.col("lang") != F.col("held"))]).select("doc_id", "status")


@query(
    "j23_store_against_disk",
    """with a as (select o_orderkey as id, o_orderstatus as s from orders), b as (select l_orderkey as id, max(l_linestatus) as f from lineitem where l_linenumber < 4 group by 1)
    select id, case when s is null then 'unknown' when f is null and s = 'P' then 'never' when f is null then 'deleted' when f = 'O' and s = 'F' then 'moved' else 'kept' end as status from a full join b using (id)""",
)
def j23(spark, sf):
    a = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"))
    b = load(spark, sf, "lineitem").where(F.col("l_linenumber") < 4).groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_linestatus").alias("f"))
    rules = [("unknown", ~F.col("_l")), ("never", ~F.col("_r") & (F.col("s") == "P")), ("deleted", ~F.col("_r")), ("moved", (F.col("f") == "O") & (F.col("s") == "F"))]
    return K.compare_sets(a, b, ["id"], rules).select("id", "status")


@query("a01_count_filtered", "select count(*) as n from orders where o_orderstatus = 'F' and o_totalprice > 100000")
def a01(spark, sf):
    return load(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).agg(F.count("*").alias("n"))


@query("a02_sum_or_zero", "select coalesce(sum(l_quantity), 0)::double as held, coalesce(sum(case when l_quantity < 0 then l_quantity end), 0)::double as nothing from lineitem where l_shipdate < timestamp '1998-01-01'")
def a02(spark, sf):
    l = load(spark, sf, "lineitem").where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return l.agg(F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("held"), F.coalesce(F.sum(F.when(F.col("l_quantity") < 0, F.col("l_quantity"))), F.lit(0.0)).alias("nothing"))


@query("a03_boolean_key", "select o_orderstatus, o_custkey < 100 as owned, count(*) as n from orders group by 1, 2")
def a03(spark, sf):
    return load(spark, sf, "orders").groupBy("o_orderstatus", (F.col("o_custkey") < 100).alias("owned")).agg(F.count("*").alias("n"))


@query("a04_owner_by_min", "select l_partkey, min(l_suppkey) as owner from lineitem group by 1")
def a04(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("owner"))


@query("a05_state_outcome", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2 union all select l_returnflag, 'all', count(*) from lineitem group by 1")
def a05(spark, sf):
    cells = load(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return cells.unionByName(cells.groupBy("l_returnflag").agg(F.sum("n").alias("n")).withColumn("l_linestatus", F.lit("all")))


@query("a06_distinct", "select distinct o_custkey from orders")
def a06(spark, sf):
    return load(spark, sf, "orders").select("o_custkey").distinct()


@query("a07_dense_new_ids", "with n as (select distinct source as s_name from documents) select (select coalesce(max(s_suppkey), 0) from supplier) + row_number() over (order by s_name) as s_suppkey, s_name from n where s_name not in (select s_name from supplier)")
def a07(spark, sf):
    return K.assign_ids(load(spark, sf, "supplier"), load(spark, sf, "documents").select(F.col("source").alias("s_name")), "s_suppkey", "s_name")


@query(
    "a08_counter_rollup",
    """select name, count(*) as n from (select unnest(list_filter([case when l_quantity > 40 then 'bulk' end, case when l_discount > 0.05 then 'cheap' end, case when l_returnflag = 'R' then 'returned' end], lambda x: x is not null)) as name from lineitem) group by 1""",
)
def a08(spark, sf):
    flags = F.array_compact(F.array(F.when(F.col("l_quantity") > 40, "bulk"), F.when(F.col("l_discount") > 0.05, "cheap"), F.when(F.col("l_returnflag") == "R", "returned")))
    return load(spark, sf, "lineitem").select(F.explode(flags).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


@query("a09_per_period", "select strftime(o_orderdate, '%Y-%m') as month, count(*) as posts, count(distinct o_custkey) as people from orders group by 1")
def a09(spark, sf):
    return load(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("posts"), F.countDistinct("o_custkey").alias("people"))


@query(
    "a10_period_total",
    "select user_id, count(*) as used from events where ts::date >= date '2024-01-10' and ts::date <= date '2024-01-28' group by 1",
)
def a10(spark, sf):
    from sievework.functions.dates import period_start

    begin = period_start(F.lit("2024-01-28").cast("date"), 10)
    day = F.to_date("ts")
    return load(spark, sf, "events").where((day >= begin) & (day <= F.lit("2024-01-28").cast("date"))).groupBy("user_id").agg(F.count("*").alias("used"))


@query("a11_class_summary", "select lang, count(*) as n, count(*) filter (where n_chars > 2000) as long, sum(case when source = 'src0' then 1 else 0 end)::bigint as src0 from documents group by 1")
def a11(spark, sf):
    return load(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count(F.when(F.col("n_chars") > 2000, 1)).alias("long"), F.sum(F.when(F.col("source") == "src0", 1).otherwise(0)).alias("src0"))


@query("a12_bucket_histogram", "select p_brand as tier, (p_size // 8)::bigint as bucket, count(*) as before, count(*) filter (where p_retailprice > 1000) as after from part group by 1, 2")
def a12(spark, sf):
    return load(spark, sf, "part").groupBy(F.col("p_brand").alias("tier"), F.floor(F.col("p_size") / 8).alias("bucket")).agg(F.count("*").alias("before"), F.count(F.when(F.col("p_retailprice") > 1000, 1)).alias("after"))


@query("a13_band_by_verdict", "select floor(l_quantity / 10)::bigint as band, count(*) filter (where l_returnflag = 'A') as \"A\", count(*) filter (where l_returnflag = 'N') as \"N\", count(*) filter (where l_returnflag = 'R') as \"R\" from lineitem group by 1")
def a13(spark, sf):
    g = load(spark, sf, "lineitem").groupBy(F.floor(F.col("l_quantity") / 10).alias("band")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1)))
    return g.na.fill(0)


@query("a14_group_rollup", "select l_suppkey as grp, count(*) as size, count(distinct l_partkey) as parts, count(distinct l_returnflag) as flags, arg_max(l_orderkey, l_extendedprice * 1000000 + l_orderkey) as strongest from lineitem group by 1")
def a14(spark, sf):
    return load(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("grp")).agg(F.count("*").alias("size"), F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_returnflag").alias("flags"), F.max_by("l_orderkey", F.col("l_extendedprice") * 1000000 + F.col("l_orderkey")).alias("strongest"))


@query(
    "a15_confusion_matrix",
    """with p as (select toxic as truth, case when doc_id % 5 = 0 then 1 else 0 end as pred from labels), c as (select sum(case when truth = 1 and pred = 1 then 1 else 0 end) as tp,
    sum(case when truth = 0 and pred = 1 then 1 else 0 end) as fp, sum(case when truth = 1 and pred = 0 then 1 else 0 end) as fn, count(*) as n, sum(case when truth = pred then 1 else 0 end) as ok from p)
    select tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, ok::double / n as accuracy, tp::double / nullif(tp + fp, 0) as precision, tp::double / nullif(tp + fn, 0) as recall from c""",
)
def a15(spark, sf):
    from sievework.operators.learning import confusion

    l = load(spark, sf, "labels").select(F.col("toxic").alias("truth"), F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0).alias("pred"))
    return confusion(l, "truth", "pred")


@query("a16_percentile", "select lang, round(quantile_cont(n_chars, 0.1), 6) as p10, round(quantile_cont(n_chars, 0.5), 6) as p50, round(quantile_cont(n_chars, 0.95), 6) as p95 from documents group by 1")
def a16(spark, sf):
    return load(spark, sf, "documents").groupBy("lang").agg(*[F.round(F.percentile("n_chars", p), 6).alias(n) for n, p in (("p10", 0.1), ("p50", 0.5), ("p95", 0.95))])


@query(
    "a17_upper_median",
    """with r as (select lang, n_chars, row_number() over (partition by lang order by n_chars) - 1 as i, count(*) over (partition by lang) as n from documents)
    select lang, max(n_chars) filter (where i = n // 2) as median, max(n_chars) as longest, count(*) filter (where n_chars > 3000) as tail from r group by 1""",
)
def a17(spark, sf):
    w = Window.partitionBy("lang")
    d = load(spark, sf, "documents").select("lang", "n_chars", (F.row_number().over(w.orderBy("n_chars")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    return d.groupBy("lang").agg(F.max(F.when(F.col("i") == F.floor(F.col("n") / 2), F.col("n_chars"))).alias("median"), F.max("n_chars").alias("longest"), F.count(F.when(F.col("n_chars") > 3000, 1)).alias("tail"))


@query("a18_first_caption_of_group", "select conv_id, turn, arg_min(text, turn) filter (where role = 'assistant' and text <> '') over (partition by conv_id) as caption from conversations")
def a18(spark, sf):
    c = load(spark, sf, "conversations")
    first = c.where((F.col("role") == "assistant") & (F.col("text") != "")).groupBy("conv_id").agg(F.min_by("text", "turn").alias("caption"))
    return c.select("conv_id", "turn").join(first, "conv_id", "left").select("conv_id", "turn", "caption")


@query(
    "a19_reason_frequency",
    r"select reason, count(*) as n from (select unnest(string_split(regexp_replace(event_type || '; ' || props, '[0-9]+', '#', 'g'), '; ')) as reason from events) group by 1 order by n desc, reason",
)
def a19(spark, sf):
    text = F.regexp_replace(F.concat("event_type", F.lit("; "), "props"), "[0-9]+", "#")
    return load(spark, sf, "events").select(F.explode(F.split(text, "; ")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


@query("a20_status_prefix", "select split_part(url, ':', 1) as scheme, split_part(split_part(url, '//', 2), '/', 1) like '%.com' as com, count(*) as n from pages group by 1, 2")
def a20(spark, sf):
    host = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    return load(spark, sf, "pages").groupBy(F.split_part("url", F.lit(":"), F.lit(1)).alias("scheme"), F.endswith(host, F.lit(".com")).alias("com")).agg(F.count("*").alias("n"))


@query("a21_interval_stats", "select ts::date as day, count(*) as n, round(sum(value), 4) as total, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.9), 6) as p90 from events group by 1")
def a21(spark, sf):
    return load(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.percentile("value", 0.5), 6).alias("p50"), F.round(F.percentile("value", 0.9), 6).alias("p90"))


@query(
    "a22_pass_rate",
    r"""select role as style, avg(case when length(text) > 200 then 1.0 else 0.0 end) as pass_rate, avg(len(regexp_extract_all(text, '[^ \t\n\r\f]+'))) as mean_words, count(*) as n from conversations group by 1""",
)
def a22(spark, sf):
    from sievework.functions.text import word_count

    c = load(spark, sf, "conversations")
    return c.groupBy(F.col("role").alias("style")).agg(F.avg(F.when(F.char_length("text") > 200, 1.0).otherwise(0.0)).alias("pass_rate"), F.avg(word_count(F.col("text"))).alias("mean_words"), F.count("*").alias("n"))


@query("a23_most_used_spelling", "select l_suppkey, arg_max(l_returnflag, n * 1000 + ascii(l_returnflag)) as label from (select l_suppkey, l_returnflag, count(*) as n from lineitem group by 1, 2) group by 1")
def a23(spark, sf):
    n = load(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    return n.groupBy("l_suppkey").agg(F.max_by("l_returnflag", F.struct("n", "l_returnflag")).alias("label"))


@query(
    "a24_box_statistics",
    """with b as (select l_orderkey, list({'c': l_quantity / 50, 'a': l_extendedprice, 'k': l_returnflag}) as boxes from lineitem group by 1)
    select l_orderkey, len(boxes)::int as n, len(list_filter(boxes, lambda x: x.k = 'R'))::int as n_r, list_max(list_transform(list_filter(boxes, lambda x: x.k <> 'R'), lambda x: x.c)) as best,
    len(list_distinct(list_transform(boxes, lambda x: floor(x.a / 10000)::int)))::int as cells from b""",
)
def a24(spark, sf):
    b = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_quantity") / 50).alias("c"), F.col("l_extendedprice").alias("a"), F.col("l_returnflag").alias("k"))).alias("boxes"))
    best = F.array_max(F.transform(F.filter("boxes", lambda x: x["k"] != "R"), lambda x: x["c"]))
    cells = F.size(F.array_distinct(F.transform("boxes", lambda x: F.floor(x["a"] / 10000).cast("int"))))
    return b.select("l_orderkey", F.size("boxes").alias("n"), F.size(F.filter("boxes", lambda x: x["k"] == "R")).alias("n_r"), best.alias("best"), cells.alias("cells"))


@query("u02_insert_ignore", "select o_custkey as k, o_totalprice as v from orders where o_orderkey in (select min(o_orderkey) from orders group by o_custkey) union all select c_custkey, c_acctbal from customer where c_custkey not in (select o_custkey from orders)")
def u02(spark, sf):
    o = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min_by("o_totalprice", "o_orderkey").alias("v"))
    return K.insert_ignore(o, load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v")), ["k"])


@query("u03_set_difference", "select c_custkey from customer except select o_custkey from orders where o_orderstatus = 'F'")
def u03(spark, sf):
    gone = load(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return load(spark, sf, "customer").select("c_custkey").join(gone, "c_custkey", "left_anti")


@query("u04_overlap_ratio", "with a as (select distinct o_custkey as k from orders where o_orderkey % 2 = 0), b as (select distinct o_custkey as k from orders where o_orderkey % 3 = 0) select (select count(*) from (select k from a intersect select k from b))::double / (select count(*) from a) as ratio")
def u04(spark, sf):
    o = load(spark, sf, "orders")
    a = o.where(F.col("o_orderkey") % 2 == 0).select("o_custkey").distinct().withColumn("a", F.lit(1))
    b = o.where(F.col("o_orderkey") % 3 == 0).select("o_custkey").distinct().withColumn("b", F.lit(1))
    return a.join(b, "o_custkey", "left").agg((F.count("b").cast("double") / F.count("a")).alias("ratio"))


@query("u05_subset_test", "select not exists (select o_custkey from orders except select c_custkey from customer) as inside, not exists (select c_custkey from customer except select o_custkey from orders) as covers")
def u05(spark, sf):
    o, c = load(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct(), load(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    j = o.withColumn("o", F.lit(1)).join(c.withColumn("c", F.lit(1)), "k", "full")
    return j.agg((F.count(F.when(F.col("c").isNull(), 1)) == 0).alias("inside"), (F.count(F.when(F.col("o").isNull(), 1)) == 0).alias("covers"))


@query("u06_first_seen", "select l_partkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_quantity) as r from lineitem) where r = 1")
def u06(spark, sf):
    l = load(spark, sf, "lineitem")
    return l.groupBy("l_partkey").agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("r")).select("l_partkey", "r.*")


@query(
    "u07_candidate_merge",
    """with a as (select c_custkey as id, c_mktsegment as seg, ['a'] as q from customer where c_custkey % 3 <> 0), b as (select c_custkey as id, case when c_custkey % 2 = 0 then 'NEW' end as seg, ['b', 'a'] as q from customer where c_custkey % 5 <> 0)
    select id, coalesce(b.seg, a.seg) as seg, case when a.q is null then ['b', 'a'] when b.q is null then ['a'] else ['a', 'b'] end as queries from a full join b using (id)""",
)
def u07(spark, sf):
    c = load(spark, sf, "customer")
    a = c.where(F.col("c_custkey") % 3 != 0).select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"), F.array(F.lit("a")).alias("queries"))
    b = c.where(F.col("c_custkey") % 5 != 0).select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "NEW").alias("seg"), F.array(F.lit("b"), F.lit("a")).alias("queries"))
    return K.merge_prefer_new(a, b, ["id"], ["queries"])


@query("u08_pair_dedup", "select distinct least(l_partkey, l_suppkey) as a, greatest(l_partkey, l_suppkey) as b from lineitem where l_partkey <> l_suppkey")
def u08(spark, sf):
    l = load(spark, sf, "lineitem").where(F.col("l_partkey") != F.col("l_suppkey"))
    return l.select(F.least("l_partkey", "l_suppkey").alias("a"), F.greatest("l_partkey", "l_suppkey").alias("b")).distinct()
