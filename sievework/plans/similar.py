"""Similarity joins and groups over embeddings and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import similarity as S
from sievework.operators.graph import ensure_checkpoint_dir
from sievework.operators.ranking import seeded_order, top_of_each
from sievework.plans.registry import load, query

VEC = "e as (select vec_id, label, embedding::double[] as v from embeddings)"
COS = "list_cosine_similarity(a.v, b.v)"
KNN = f"{VEC}, p as (select a.vec_id as id, b.vec_id as other, {COS} as cos from e a, e b where a.vec_id <> b.vec_id), k as (select * from (select *, row_number() over (partition by id order by cos desc, other) as r from p) where r <= 10)"
BITS = "e as (select vec_id, label, list_sum(list_transform(range(64), lambda i: case when embedding[i + 1] > 0 then (1::hugeint << i) else 0 end))::uhugeint as h from embeddings)"


def vectors(spark, sf):
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", "embedding")


def neighbours(spark, sf, k=10, floor=-1.0):
    v = vectors(spark, sf)
    return S.cosine_neighbours(v, v, "id", "embedding", k, floor)


def codes(spark, sf):
    return vectors(spark, sf).select("id", "label", S.sign_hash(F.col("embedding")).alias("h"))


@query("j11_equal_content_pairs", "select a.doc_id as a, b.doc_id as b from documents a join documents b on sha256(a.text) = sha256(b.text) and a.doc_id < b.doc_id")
def j11(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    return d.select(F.col("doc_id").alias("a"), "k").join(d.select(F.col("doc_id").alias("b"), "k"), "k").where("a < b").select("a", "b")


@query("j12_exact_stars", "select min(doc_id) over (partition by sha256(text)) as a, doc_id as b from documents qualify a <> b")
def j12(spark, sf):
    return S.equal_stars(load(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("k")), "doc_id", "k")


@query("j13_hamming_pairs", f"with {BITS} select a.vec_id as a, b.vec_id as b, bit_count(xor(a.h, b.h)::bit)::int as dist from e a join e b on a.vec_id < b.vec_id where bit_count(xor(a.h, b.h)::bit) <= 21")
def j13(spark, sf):
    return S.hamming_pairs(codes(spark, sf), "id", "h", 21)


@query("j14_cosine_neighbours", f"with {KNN} select id, other, round(cos, 6) as cos from k")
def j14(spark, sf):
    return neighbours(spark, sf).select("id", "other", F.round("cos", 6).alias("cos"))


@query("j14_symmetric_pairs", f"with {KNN} select least(id, other) as a, greatest(id, other) as b, round(max(cos), 6) as cos from k where cos >= 0.35 group by 1, 2")
def j14b(spark, sf):
    return S.symmetric_pairs(neighbours(spark, sf, floor=0.35)).select("a", "b", F.round("cos", 6).alias("cos"))


@query(
    "j15_against_base",
    f"""with {VEC}, p as (select a.vec_id as id, b.vec_id as other, {COS} as cos from e a, e b where a.vec_id % 5 = 0 and b.vec_id % 5 <> 0), k as (select * from (select *, row_number() over (partition by id order by cos desc, other) as r from p) where r = 1)
    select id, other, round(cos, 6) as cos, case when cos >= 0.42 then 'copy' when cos >= 0.36 and other % 2 = 0 then 'copy' when cos >= 0.36 then 'candidate' else 'new' end as kind from k""",
)
def j15(spark, sf):
    v = vectors(spark, sf)
    q, b = v.where(F.col("id") % 5 == 0), v.where(F.col("id") % 5 != 0)
    near = S.cosine_neighbours(q, b, "id", "embedding", 1, skip_self=False).select("id", "other")
    tested = near.where(F.col("other") % 2 == 0).withColumn("passed", F.lit(True))
    return S.against_base(q, b, "id", "embedding", 0.42, 0.36, tested).select("id", "other", F.round("cos", 6).alias("cos"), "kind")


@query(
    "j16_nearest_label",
    f"with {VEC}, p as (select a.vec_id as id, b.label, {COS} as cos, b.vec_id as o from e a, e b where a.vec_id % 4 = 0 and b.vec_id % 4 <> 0) select id, case when max(cos) >= 0.35 then arg_max(label, cos) end as label from p group by 1",
)
def j16(spark, sf):
    v = vectors(spark, sf)
    near = S.cosine_neighbours(v.where(F.col("id") % 4 == 0), v.where(F.col("id") % 4 != 0), "id", "embedding", 1, skip_self=False)
    labelled = near.join(v.select(F.col("id").alias("other"), "label"), "other")
    return labelled.select("id", F.when(F.col("cos") >= 0.35, F.col("label")).alias("label"))


@query("w07_nearest_k", f"with {BITS}, p as (select a.vec_id as id, b.vec_id as other, bit_count(xor(a.h, b.h)::bit)::int as dist from e a, e b where a.vec_id <> b.vec_id and bit_count(xor(a.h, b.h)::bit) <= 22), r as (select *, row_number() over (partition by id order by dist, least(id, other), greatest(id, other)) as r from p) select distinct least(id, other) as a, greatest(id, other) as b, dist from r where r <= 3")
def w07(spark, sf):
    return S.nearest_pairs(codes(spark, sf), "id", "h", 3, 22)


@query("g01_exact_duplicates", "select sha256(text) as digest, count(*) as n, min(doc_id) as first_id from documents group by 1 having count(*) > 1")
def g01(spark, sf):
    return load(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("g02_rule_modes", f"with {BITS}, p as (select a.vec_id as a, b.vec_id as b, bit_count(xor(a.h, b.h)::bit) as d from e a join e b on a.vec_id < b.vec_id) select a, b, (d - 6 <= 14 and d - 8 <= 16) or (d - 6 <= 16 and d - 8 <= 8) as loose, d - 6 <= 8 and d - 8 <= 10 as strict from p where d <= 22")
def g02(spark, sf):
    p = S.hamming_pairs(codes(spark, sf), "id", "h", 22)
    d = F.col("dist")
    return p.select("a", "b", S.rule_holds("loose", d - 6, d - 8).alias("loose"), S.rule_holds("strict", d - 6, d - 8).alias("strict"))


@query(
    "g03_candidate_window",
    f"with {BITS}, p as (select a.vec_id as id, b.vec_id as other, bit_count(xor(a.h, b.h)::bit)::int as dist from e a, e b where a.vec_id <> b.vec_id and bit_count(xor(a.h, b.h)::bit) <= 22), r as (select *, row_number() over (partition by id order by dist, least(id, other), greatest(id, other)) as r from p) select distinct least(id, other) as a, greatest(id, other) as b, dist from r where r <= 30",
)
def g03(spark, sf):
    return S.nearest_pairs(codes(spark, sf), "id", "h", 30, 22)


@query(
    "g04_pair_verdict",
    f"""with {BITS}, p as (select a.vec_id as a, b.vec_id as b, a.label as la, b.label as lb, bit_count(xor(a.h, b.h)::bit) as d from e a join e b on a.vec_id < b.vec_id)
    select a, b, case when la = 0 or lb = 0 then 'UNHASHED' when la = 1 and lb = 1 then 'FLAT' when greatest(la, lb) * 2 >= 8 and least(la, lb) * 2 < 0.25 * greatest(la, lb) * 2 then 'COLOUR'
    when d <= 19 then 'HASH' when (a + b) % 7 = 0 then 'MIRROR' when d <= 21 then 'WIN' else 'FAR' end as verdict from p where d <= 23""",
)
def g04(spark, sf):
    h = codes(spark, sf)
    p = S.hamming_pairs(h, "id", "h", 23)
    p = p.join(h.select(F.col("id").alias("a"), F.col("label").alias("la")), "a").join(h.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b")
    la, lb, d = F.col("la"), F.col("lb"), F.col("dist")
    v = S.pair_verdict((la != 0) & (lb != 0), (la == 1) & (lb == 1), S.colour_veto(la * 2, lb * 2), d <= 19, (F.col("a") + F.col("b")) % 7 == 0, d <= 21)
    return p.select("a", "b", v.alias("verdict"))


@query("g05_feature_decision", "select l_orderkey, l_linenumber, l_partkey, case when l_returnflag <> 'N' then l_quantity >= 40 and l_discount * 10 >= 0.36 and l_tax * 10 >= 0.5 else l_linestatus = 'O' end as same from lineitem")
def g05(spark, sf):
    ran = F.col("l_returnflag") != "N"
    same = S.verified(F.col("l_linestatus") == "O", F.when(ran, F.col("l_quantity")), F.col("l_discount") * 10, F.col("l_tax") * 10)
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", same.alias("same"))


@query("g06_verification_cache", "select distinct least(l_partkey, l_suppkey) || '|' || greatest(l_partkey, l_suppkey) as key from (select lpad(l_partkey::varchar, 8, '0') as l_partkey, lpad(l_suppkey::varchar, 8, '0') as l_suppkey, l_orderkey from lineitem) where l_orderkey % 2 = 0 and key not in (select least(a, b) || '|' || greatest(a, b) from (select lpad(l_partkey::varchar, 8, '0') as a, lpad(l_suppkey::varchar, 8, '0') as b from lineitem where l_orderkey % 2 = 1))")
def g06(spark, sf):
    pad = lambda c: F.lpad(F.col(c).cast("string"), 8, "0")
    l = load(spark, sf, "lineitem").select("l_orderkey", S.order_free_key(pad("l_partkey"), pad("l_suppkey")).alias("key"))
    return l.where("l_orderkey % 2 = 0").select("key").distinct().join(l.where("l_orderkey % 2 = 1"), "key", "left_anti")


PAIRS = f"{KNN}, ed as (select distinct least(id, other) as a, greatest(id, other) as b from k where cos >= 0.4)"
REACH = f"with recursive {PAIRS}, s as (select a as u, b as v from ed union all select b, a from ed), r as (select u as node, u as root from s union select s.v, r.root from r join s on r.node = s.u), comp as (select node, min(root) as component from r group by 1)"


def edges(spark, sf):
    return S.symmetric_pairs(neighbours(spark, sf, floor=0.4)).select("a", "b")


@query("g07_components", f"{REACH} select node, component from comp")
def g07(spark, sf):
    from sievework.operators.graph import connected_components

    return connected_components(edges(spark, sf))


@query("g08_components_by_size", f"{REACH} select component, count(*) as size from comp group by 1 order by size desc, component")
def g08(spark, sf):
    return S.group_ids(edges(spark, sf)).groupBy("component").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "component")


@query(
    "g09_steps_from_keeper",
    f"{REACH}, d as (select component as node, component as root, 0 as steps from (select distinct component from comp) union select s.v, d.root, d.steps + 1 from d join s on d.node = s.u where d.steps < 12) select node, root, min(steps) as steps from d group by 1, 2",
)
def g09(spark, sf):
    ensure_checkpoint_dir(spark)
    e = edges(spark, sf).checkpoint()
    roots = S.group_ids(e).select(F.col("component").alias("node")).distinct()
    return S.steps_from(e, roots)


@query(
    "g10_group_plan",
    f"{REACH}, m as (select node, component, label, row_number() over (partition by component order by label desc, node) as r from comp join embeddings on node = vec_id) select node, component, r = 1 as keeper, case when r = 1 then 'best' else 'copy' end as reason from m",
)
def g10(spark, sf):
    from sievework.operators.ranking import rank_in

    m = S.group_ids(edges(spark, sf)).withColumnRenamed("id", "node").join(vectors(spark, sf).select(F.col("id").alias("node"), "label"), "node")
    r = rank_in(m, ["component"], [F.desc("label"), F.col("node")])
    return r.select("node", "component", (F.col("rank") == 1).alias("keeper"), F.when(F.col("rank") == 1, "best").otherwise("copy").alias("reason"))


@query("g11_copies_end_to_end", f"{REACH} select component, count(*) as size, count(distinct label) as labels, min(node) as keeper from comp join embeddings on node = vec_id group by 1")
def g11(spark, sf):
    m = S.group_ids(edges(spark, sf)).join(vectors(spark, sf), "id")
    return m.groupBy("component").agg(F.count("*").alias("size"), F.countDistinct("label").alias("labels"), F.min("id").alias("keeper"))


@query("g12_groups_from_report", "with recursive ed as (select min(doc_id) over (partition by sha256(text)) as a, doc_id as b, lang from documents qualify a <> b), s as (select a as u, b as v from ed where lang <> 'de' union all select b, a from ed where lang <> 'de'), r as (select u as node, u as root from s union select s.v, r.root from r join s on r.node = s.u) select node as id, min(root) as component from r group by 1")
def g12(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("k"))
    report = S.equal_stars(d, "doc_id", "k").join(d.select(F.col("doc_id").alias("b"), "lang"), "b")
    return S.group_ids(report.where(F.col("lang") != "de"))


@query("g14_review_sample", "select lang, digest from (select lang, digest, row_number() over (partition by lang order by sha256('review:' || digest), digest) as r from (select min(lang) as lang, sha256(text) as digest from documents group by sha256(text) having count(*) > 1)) where r <= 5")
def g14(spark, sf):
    g = load(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("lang").alias("lang"), F.count("*").alias("n")).where("n > 1")
    return top_of_each(g, "lang", seeded_order("review", "digest"), 5, "digest").select("lang", "digest")


@query("x58_hamming_distance", f"with {BITS} select a.vec_id as id, bit_count(xor(a.h, b.h)::bit)::int as dist from e a join e b on b.vec_id = a.vec_id + 1")
def x58(spark, sf):
    h = codes(spark, sf)
    n = h.select((F.col("id") - 1).alias("id"), F.col("h").alias("g"))
    return h.join(n, "id").select("id", S.hamming(F.col("h"), F.col("g")).alias("dist"))


@query("x59_cosine", f"with {VEC} select a.vec_id as id, round({COS}, 6) as cos, round(list_inner_product(a.v, a.v), 6) as norm2 from e a join e b on b.vec_id = a.vec_id + 1")
def x59(spark, sf):
    v = vectors(spark, sf)
    n = v.select((F.col("id") - 1).alias("id"), F.col("embedding").alias("w"))
    a, b = S.normalised(F.col("embedding")), S.normalised(F.col("w"))
    return v.join(n, "id").select("id", F.round(S.dot(a, b), 6).alias("cos"), F.round(S.dot(F.col("embedding"), F.col("embedding")), 6).alias("norm2"))


@query("m03_vote_shares", f"with {KNN} select id, label, count(*) / 10.0::double as share from k join e on k.other = e.vec_id group by 1, 2")
def m03(spark, sf):
    return S.vote_shares(neighbours(spark, sf), vectors(spark, sf), 10)


@query("m05_isolation", f"with {KNN}, i as (select id, 1 - avg(cos) as isolation from k group by 1) select id, round(isolation, 6) as isolation, isolation >= (select quantile_cont(isolation, 0.95) from i) as isolated from i")
def m05(spark, sf):
    ensure_checkpoint_dir(spark)
    i = S.isolation(neighbours(spark, sf)).checkpoint()
    gate = i.agg(F.percentile("isolation", 0.95).alias("gate"))
    return i.join(F.broadcast(gate)).select("id", F.round("isolation", 6).alias("isolation"), (F.col("isolation") >= F.col("gate")).alias("isolated"))
