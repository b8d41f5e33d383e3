"""Planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import geometry as G
from sievework.operators import planning as P
from sievework.operators import ranking as R
from sievework.plans.captions import GRID_SQL, pictures
from sievework.plans.registry import load, query


@query(
    "c01_reclassify_plan",
    """select d.doc_id, case when e.vec_id is null then 'missing' when d.doc_id % 17 = 0 then 'hand-moved' when n_chars > 6000 then 'aspect' when l.quality = 0 then 'low quality' when l.toxic = 1 then 'copy' when e.label = d.doc_id % 10 then 'kept' else 'moved' end as outcome
    from documents d left join embeddings e on d.doc_id = e.vec_id left join labels l on d.doc_id = l.doc_id""",
)
def c01(spark, sf):
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label", F.lit(True).alias("_e"))
    d = load(spark, sf, "documents").select("doc_id", "n_chars").join(e, "doc_id", "left").join(load(spark, sf, "labels"), "doc_id", "left")
    rules = [("missing", F.col("_e").isNull()), ("hand-moved", F.col("doc_id") % 17 == 0), ("aspect", F.col("n_chars") > 6000), ("low quality", F.col("quality") == 0), ("copy", F.col("toxic") == 1), ("kept", F.col("label") == F.col("doc_id") % 10)]
    return d.select("doc_id", P.first_rule(rules, "moved").alias("outcome"))


@query("c02_cleanup_plan", "select doc_id from documents where n_chars < 300 and doc_id not in (select doc_id from labels where quality = 1) and doc_id % 17 <> 0")
def c02(spark, sf):
    good = load(spark, sf, "labels").where("quality = 1").select("doc_id")
    return load(spark, sf, "documents").where("n_chars < 300 and doc_id % 17 <> 0").select("doc_id").join(good, "doc_id", "left_anti")


@query("c03_caption_work_list", "select o_orderkey from orders left join (select l_orderkey, count(*) as attempts from lineitem where l_returnflag = 'R' group by 1) on o_orderkey = l_orderkey where o_orderstatus <> 'F' and coalesce(attempts, 0) < 2")
def c03(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tries = load(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("attempts"))
    return P.work_list(o.select("o_orderkey"), o.where("o_orderstatus = 'F'"), tries, "o_orderkey", 2)


@query(
    "c04_select_and_copy",
    """select p_partkey, list_filter([case when p_size < 10 then 'score' end, case when p_retailprice < 1000 then 'area' end, case when p_type = 'ECONOMY' then 'tier' end], lambda x: x is not null) as reasons from part""",
)
def c04(spark, sf):
    rules = [("score", F.col("p_size") < 10), ("area", F.col("p_retailprice") < 1000), ("tier", F.col("p_type") == "ECONOMY")]
    return load(spark, sf, "part").select("p_partkey", P.reasons(rules).alias("reasons"))


@query("c05_score_and_sort")
def c05(spark, sf):
    d = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") + F.col("p_size") * 3).alias("score"), F.col("p_brand").alias("placed"))
    t = R.gap_tiers(d, "score", "id", 5)
    return t.withColumn("stale", F.col("placed") != F.concat(F.lit("Brand#"), F.col("tier").cast("string")))


@query(
    "c06_two_phase_build",
    f"""with {GRID_SQL}, k as (select p_partkey, tier, p_name from tiered join part using (p_partkey) where p_retailprice >= 950)
    select p_partkey, tier::int as tier, case when row_number() over (partition by tier, lower(p_name) order by p_partkey) = 1 then p_name else p_name || '-' || row_number() over (partition by tier, lower(p_name) order by p_partkey) end as name from k""",
)
def c06(spark, sf):
    p = load(spark, sf, "part").where("p_retailprice >= 950").join(pictures(spark, sf), "p_partkey")
    k = p.withColumn("tier", G.assign_tier(F.col("w"), F.col("h"))["tier"]).where(F.col("tier").isNotNull())
    return R.collision_names(k, "tier", "p_name", "p_partkey").select("p_partkey", "tier", "name")


@query("c07_score_cache", "with w as (select p_partkey, p_size as size, p_size + p_partkey % 2 as wanted, p_retailprice from part) select p_partkey, size = wanted as hit, case when size = wanted then p_retailprice end as score from w")
def c07(spark, sf):
    p = load(spark, sf, "part")
    work = p.select("p_partkey", (F.col("p_size") + F.col("p_partkey") % 2).cast("long").alias("size"))
    cache = p.select("p_partkey", F.col("p_size").cast("long").alias("size"), F.col("p_retailprice").alias("score"))
    return P.cached(work, cache, ["p_partkey", "size"], ["score"]).select("p_partkey", "hit", "score")


@query("c08_model_critique", "select event_id, round(exp(0.5 * ln(greatest(((props::json->>'k')::double / 10 + 5) / 2, 1.0)) + 0.5 * ln(greatest(coalesce(value / 50, 1.0), 1.0))), 6) as score from events")
def c08(spark, sf):
    reply = F.to_json(F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array(F.from_json("props", "k double")["k"] / 10, F.lit(5.0))))
    values = F.map_values(F.from_json(reply, "map<string,double>"))
    mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)
    return load(spark, sf, "events").select("event_id", F.round(G.blend(mean, F.coalesce(F.col("value") / 50, F.lit(1.0)), 0.5), 6).alias("score"))


@query(
    "c09_log_fold",
    """with e as (select event_id as seq, user_id as item, event_id // 500 as run, case when event_type = 'error' then 'undo' when event_id % 997 = 0 then 'undo_run' else 'done' end as kind, value from events),
    d as (select * from e where kind = 'done' and not exists (select 1 from e u where u.run = e.run and u.seq > e.seq and (u.kind = 'undo_run' or (u.kind = 'undo' and u.item = e.item))))
    select item, max(seq) as seq, arg_max(value, seq) as value from d group by 1""",
)
def c09(spark, sf):
    kind = F.when(F.col("event_type") == "error", "undo").when(F.col("event_id") % 997 == 0, "undo_run").otherwise("done")
    e = load(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("item"), F.floor(F.col("event_id") / 500).alias("run"), kind.alias("kind"), "value")
    return P.latest_done(e, "item", "seq", "run", "kind").select("item", "seq", "value")


@query(
    "c10_crop_composition",
    """with b as (select p_partkey, greatest(p_size * 3, 17) as x1, greatest(p_size, 9) as y1, least(900 - p_size, 800) as x2, least(700, 650 + p_size) as y2 from part) select p_partkey, (ceil(x1 / 8.0) * 8)::bigint as x1, (ceil(y1 / 8.0) * 8)::bigint as y1, (floor(x2 / 8.0) * 8)::bigint as x2, (floor(y2 / 8.0) * 8)::bigint as y2 from b""",
)
def c10(spark, sf):
    s = F.col("p_size")
    box = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    a = box(s * 3, s, 900 - s, F.lit(700))
    b = box(F.lit(17), F.lit(9), F.lit(800), 650 + s)
    return load(spark, sf, "part").select("p_partkey", G.align_box(G.intersect_boxes([a, b])).alias("b")).select("p_partkey", "b.*")


@query(
    "c11_subject_choice",
    """with r as (select conv_id, role, count(*) * 10 + max(length(text)) / 100.0 as s from conversations group by 1, 2) select conv_id, arg_max(role, s) as subject, round(max(s), 6)::double as score, count(*) > 1 as several from r group by 1""",
)
def c11(spark, sf):
    r = load(spark, sf, "conversations").groupBy("conv_id", "role").agg((F.count("*") * 10 + F.max(F.char_length("text")) / 100.0).alias("s"), F.min("turn").alias("t"))
    # Of equal scores the role that spoke first, as one reader of the turns meets them.
    first = F.when(F.col("role").isNotNull() & F.col("s").isNotNull(), F.struct("s", -F.col("t")))
    return r.groupBy("conv_id").agg(F.max_by("role", first).alias("subject"), F.round(F.max("s"), 6).alias("score"), (F.count("*") > 1).alias("several"))


@query("c12_border_action", "select p_partkey, case when p_size < 5 then 'none' when p_size * 20 < 300 then 'review' when p_retailprice < 950 then 'too small' else 'crop' end as action from part")
def c12(spark, sf):
    rules = [("none", F.col("p_size") < 5), ("review", F.col("p_size") * 20 < 300), ("too small", F.col("p_retailprice") < 950)]
    return load(spark, sf, "part").select("p_partkey", P.first_rule(rules, "crop").alias("action"))


@query("c13_family_placement", "with f as (select p_partkey, f, abs(p_size / 25.0 - f) as d from part, (values (0.5), (1.0), (1.5)) t(f)) select p_partkey, arg_min(f, d + f / 1000)::double as family from f group by 1")
def c13(spark, sf):
    fam = F.explode(F.array(F.lit(0.5), F.lit(1.0), F.lit(1.5))).alias("f")
    d = load(spark, sf, "part").select("p_partkey", "p_size", fam)
    return d.groupBy("p_partkey").agg(F.min_by("f", F.abs(F.col("p_size") / 25.0 - F.col("f")) + F.col("f") / 1000).alias("family"))


@query("c14_recheck_order", "select event_id from events where event_type = 'error' and ts < timestamp '2024-01-16' and user_id not in (select user_id from events where event_type <> 'error' and ts >= timestamp '2024-01-29')")
def c14(spark, sf):
    e = load(spark, sf, "events")
    fresh = e.where((F.col("event_type") != "error") & (F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz"))).select("user_id")
    return e.where((F.col("event_type") == "error") & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))).join(fresh, "user_id", "left_anti").select("event_id")


@query("c15_row_migration", r"with m as (select p_partkey, replace(p_name, ' ', '_') as stem from part) select stem, count(*) as n, count(*) > 1 as conflict from m group by 1")
def c15(spark, sf):
    return load(spark, sf, "part").groupBy(F.replace("p_name", F.lit(" "), F.lit("_")).alias("stem")).agg(F.count("*").alias("n"), (F.count("*") > 1).alias("conflict"))


@query("c16_chunked_folders", "select o_orderkey, ceil(row_number() over (partition by o_orderstatus order by o_orderkey) / 250.0)::int as folder from orders")
def c16(spark, sf):
    return P.numbered_folders(load(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"], 250).select("o_orderkey", "folder")


@query("c17_training_config", "select p_brand as dataset, case when p_size >= 34 then 1024 when p_size >= 17 then 768 else 512 end as tier, count(*) as n, any_value(case when p_size >= 34 then 2 when p_size >= 17 then 3 else 8 end) as batch from part group by 1, 2")
def c17(spark, sf):
    tier = F.when(F.col("p_size") >= 34, 1024).when(F.col("p_size") >= 17, 768).otherwise(512)
    g = load(spark, sf, "part").groupBy(F.col("p_brand").alias("dataset"), tier.alias("tier")).agg(F.count("*").alias("n"))
    return g.withColumn("batch", F.when(F.col("tier") == 1024, 2).when(F.col("tier") == 768, 3).otherwise(8))


@query("m02_class_rollup", "select vec_id, u.c as cls, round(sum(u.p), 6) as p from (select vec_id, unnest([{'c': 0, 'p': abs(embedding[1]::double)}, {'c': 0, 'p': abs(embedding[2]::double)}, {'c': 1, 'p': abs(embedding[3]::double)}]) as u from embeddings) group by 1, 2")
def m02(spark, sf):
    a = lambda i: F.abs(F.col("embedding")[i].cast("double"))
    sub = F.array(*[F.struct(F.lit(c).alias("c"), a(i).alias("p")) for c, i in ((0, 0), (0, 1), (1, 2))])
    return load(spark, sf, "embeddings").select("vec_id", F.explode(sub).alias("u")).groupBy("vec_id", F.col("u.c").alias("cls")).agg(F.round(F.sum("u.p"), 6).alias("p"))


@query(
    "m06_decision_reasons",
    """select vec_id, case when vec_id % 50 = 0 then 'example' when abs(embedding[1]) < 0.03 then 'disagreement' when abs(embedding[2]) < 0.04 then 'low confidence' when embedding[3] > 0.2 then 'isolated' else 'ok' end as reason from embeddings""",
)
def m06(spark, sf):
    v = lambda i: F.col("embedding")[i].cast("double")
    rules = [("example", F.col("vec_id") % 50 == 0), ("disagreement", F.abs(v(0)) < 0.03), ("low confidence", F.abs(v(1)) < 0.04), ("isolated", v(2) > 0.2)]
    return load(spark, sf, "embeddings").select("vec_id", P.first_rule(rules, "ok").alias("reason"))


@query("m08_priority_choice", "with p as (select vec_id, list_transform(embedding[1:5]::double[], lambda x: abs(x)) as p from embeddings) select vec_id, list_position(list_transform(p, lambda x: x >= list_max(p) - 0.05), true)::int - 1 as cls from p")
def m08(spark, sf):
    p = F.transform(F.slice("embedding", 1, 5), lambda x: F.abs(x.cast("double")))
    return load(spark, sf, "embeddings").select("vec_id", P.choose_priority(p, 0.05).alias("cls"))


@query(
    "m11_judge_cascade",
    """with s as (select d.doc_id, l.quality, n_chars / 5000.0 as s, d.doc_id % 3 = 0 as vlm from documents d left join labels l using (doc_id)) select doc_id, case when quality = 0 then 'no' when s >= 0.7 then 'yes' when s <= 0.2 then 'no' when vlm then 'yes' else 'unsure' end as verdict from s""",
)
def m11(spark, sf):
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left")
    s = F.col("n_chars") / 5000.0
    rules = [("no", F.col("quality") == 0), ("yes", s >= 0.7), ("no", s <= 0.2), ("yes", F.col("doc_id") % 3 == 0)]
    return d.select("doc_id", P.first_rule(rules, "unsure").alias("verdict"))
