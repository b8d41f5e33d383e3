"""Streaming jobs over events laid out as arriving files, held against the same result in one go."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sievework.operators.graph import ensure_checkpoint_dir
from sievework.plans.registry import load, query
from sievework.streaming import jobs as J


def arrivals(spark, sf, files=6):
    """Events as several files in a folder, a stream over it, and a folder for the job."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    e = load(spark, sf, "events")
    e.repartitionByRange(files, "event_id").write.parquet(f"{base}/in")
    return J.file_stream(spark, f"{base}/in", e.schema, 2), base


@query("r01_staged_pipeline", "select event_id, user_id, round(value * 2, 2) as doubled from events where event_type <> 'error'")
def r01(spark, sf):
    stream, base = arrivals(spark, sf)
    J.pipeline(stream, f"{base}/out", f"{base}/cp", lambda b: b.where("event_type <> 'error'").select("event_id", "user_id", F.round(F.col("value") * 2, 2).alias("doubled")))
    return spark.read.parquet(f"{base}/out").drop("batch")


@query("r02_two_source_priority", "select o_orderkey from (select o_orderkey, 0 as p from orders where o_orderstatus = 'P' union all select o_orderkey, 1 from orders where o_orderstatus = 'F') order by p, o_orderkey limit 9000")
def r02(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return J.with_priority(o.where("o_orderstatus = 'P'"), o.where("o_orderstatus = 'F'"), "o_orderkey", 9000).select("o_orderkey")


@query("r03_commit_once", "select count(*) as n, count(distinct event_id) as ids from events")
def r03(spark, sf):
    stream, base = arrivals(spark, sf)
    sink = J.commit_once(f"{base}/out")

    def twice(batch, number):
        sink(batch, number)
        sink(batch, number)

    J.run_available(stream, f"{base}/cp", twice)
    return spark.read.parquet(f"{base}/out").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


@query("r04_retries", "select o_orderkey, case when o_orderkey % 3 = 0 then 'done' when o_orderkey % 3 = 1 and o_orderkey % 4 + 1 >= 3 then 'given up' when o_orderkey % 3 = 1 then 'failed' else 'pending' end as state, (o_orderkey % 4 + case when o_orderkey % 3 = 1 then 1 else 0 end)::bigint as attempts from orders")
def r04(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.lit("pending").alias("state"), (F.col("o_orderkey") % 4).alias("attempts"))
    outcome = o.where("o_orderkey % 3 <> 2").select("o_orderkey", (F.col("o_orderkey") % 3 == 0).alias("ok"))
    return J.retry_pass(o, outcome, "o_orderkey", 3)


@query("r05_common_limit", "select count(*) as n from (select o_orderkey from orders limit 1234)")
def r05(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return J.with_priority(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), "o_orderkey", 1234).agg(F.count("*").alias("n"))


@query("r06_follow_missing", "select event_id, case when event_id % 5 = 0 then -1 else value end as value from events")
def r06(spark, sf):
    stream, base = arrivals(spark, sf)
    load(spark, sf, "events").where("event_id % 5 = 0").select("event_id", F.lit(-1.0).alias("value")).write.parquet(f"{base}/derived")
    J.follow_missing(stream, f"{base}/derived", f"{base}/cp", "event_id", lambda b: b.select("event_id", "value"))
    return spark.read.parquet(f"{base}/derived")


@query("r07_incremental_scan", "select event_id from events where event_id > 8000 - 5 or event_id < 700")
def r07(spark, sf):
    p = load(spark, sf, "events").select(F.col("event_id").alias("post_id"))
    return J.new_since(p, 8000, False, 700).select(F.col("post_id").alias("event_id"))


@query("r08_counters", "select event_type, count(*) as n, round(sum(value), 2) as total from events group by 1")
def r08(spark, sf):
    stream, base = arrivals(spark, sf)
    J.running_totals(stream, f"{base}/totals", f"{base}/cp", ["event_type"], "value")
    return spark.read.parquet(f"{base}/totals").select("event_type", "n", F.round("total", 2).alias("total"))


@query("r08_interval_counters", "select event_type, count(*) as n from events group by 1")
def r08b(spark, sf):
    stream, base = arrivals(spark, sf)
    J.interval_counts(stream, f"{base}/out", f"{base}/cp", ["event_type"])
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.sum("n").alias("n"))


@query("r09_resumable_shards", "select l_suppkey as shard, case when count(*) % 3 = 0 then 'skip' when count(*) % 3 = 1 then 'continue' else 'start' end as action, (count(*) % 3 = 1)::int * (count(*) // 100) as page from lineitem group by 1")
def r09(spark, sf):
    s = load(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("shard")).agg(F.count("*").alias("n"))
    k = F.col("n") % 3
    return s.select("shard", F.when(k == 0, "skip").when(k == 1, "continue").otherwise("start").alias("action"), F.when(k == 1, F.floor(F.col("n") / 100)).otherwise(F.lit(0).cast("long")).alias("page"))
