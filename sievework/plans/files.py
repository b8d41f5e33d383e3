"""Sources and sinks over the driver tables, written to and read from a folder of their own."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from sievework.operators.graph import ensure_checkpoint_dir
from sievework.operators.planning import numbered_folders
from sievework.plans.registry import load, query
from sievework.sources import files as S


def place(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("s03_first_file", "select count(*) as n from region")
def s03(spark, sf):
    from sievework.operators.search import DatasetSpec

    spec = DatasetSpec("r", "*.parquet", ("r_name",), first_file="region.parquet")
    return spark.read.parquet(spec.path(sf, quick=True)).agg(F.count("*").alias("n"))


@query("s04_arrow_to_parquet", "select c_custkey, c_name, c_acctbal from customer")
def s04(spark, sf):
    import pyarrow as pa

    def to_stream(batches):
        for rb in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rb.schema) as w:
                w.write_batch(rb)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["content"])

    def from_stream(batches):
        for rb in batches:
            for blob in rb.column(0):
                with pa.ipc.open_stream(pa.py_buffer(blob.as_py())) as r:
                    yield from r

    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    back = c.mapInArrow(to_stream, "content binary").mapInArrow(from_stream, "c_custkey long, c_name string, c_acctbal double")
    path = place(spark, "arrow")
    S.to_parquet_verified(back, path)
    return spark.read.parquet(path)


@query("s05_csv_sink", r"select doc_id, trim(regexp_replace(text, '[\t\n\f\r ]*[\r\n]+[\t\n\f\r ]*', ' ', 'g')) as text from documents where lang = 'en'")
def s05(spark, sf):
    from sievework.operators.search import fold_newlines, write_result

    path = place(spark, "csv")
    d = load(spark, sf, "documents").where("lang = 'en'").select("doc_id", fold_newlines(F.col("text")).alias("text"))
    write_result(d, path, {"search": "*", "lang": "en"}, {})
    return S.read_manifest(spark, path, "doc_id long, text string")


@query("s06_query_note", "select count(*) as n_rows, 'en' as lang from documents where lang = 'en'")
def s06(spark, sf):
    from sievework.operators.search import write_result

    path = place(spark, "note")
    write_result(load(spark, sf, "documents").where("lang = 'en'").select("doc_id"), path, {"search": "*", "lang": "en"}, {})
    note = F.from_json("value", "options map<string,string>, rows long")
    return spark.read.text(f"{path}.query").select(note["rows"].alias("n_rows"), note["options"]["lang"].alias("lang"))


@query("s07_flat_export", "select event_id as id, (props::json->>'k')::int as k, event_type as kind from events")
def s07(spark, sf):
    e = load(spark, sf, "events")
    doc = F.to_json(F.struct("event_id", F.struct(F.from_json("props", "k int").alias("props"), "event_type").alias("inner")))
    flat = S.flatten_records(e.select(doc.alias("doc")), "doc", "event_id long, inner struct<props:struct<k:int>,event_type:string>", {"id": "event_id", "k": "inner.props.k", "kind": "inner.event_type"})
    path = place(spark, "export")
    S.export(flat, path, "jsonl")
    return spark.read.schema("id long, k int, kind string").json(path)


@query("s08_partitioned_scan", "select count(*) as n, sum(l_linenumber)::bigint as total from lineitem")
def s08(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("total"))


@query("s09_keyset_page", "select o_orderkey, o_custkey from orders where o_orderkey > 1000 order by o_orderkey limit 300")
def s09(spark, sf):
    return load(spark, sf, "orders").where("o_orderkey > 1000").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(300)


@query("s10_sidecar_groups", "select n_nationkey as stem, 1 + (n_nationkey % 2) as n_sidecars from nation")
def s10(spark, sf):
    n = load(spark, sf, "nation").select(F.concat(F.lit("d/"), F.col("n_regionkey").cast("string")).alias("dir"), F.col("n_nationkey").cast("string").alias("stem"))
    exts = F.explode(F.when(F.col("stem").cast("int") % 2 == 1, F.array(F.lit("jpg"), F.lit("txt"), F.lit("json"))).otherwise(F.array(F.lit("png"), F.lit("txt")))).alias("ext")
    files = n.select("dir", "stem", exts).withColumn("path", F.concat_ws(".", F.concat_ws("/", "dir", "stem"), "ext"))
    return S.sidecar_groups(files).select(F.col("stem").cast("int").alias("stem"), F.size("sidecars").alias("n_sidecars"))


@query("s11_manifest_round_trip", "select p_partkey, p_name, p_brand from part")
def s11(spark, sf):
    path = place(spark, "manifest")
    S.write_manifest(load(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), path)
    return S.read_manifest(spark, path, "p_partkey long, p_name string, p_brand string")


@query("s12_message_export", "select conv_id, turn, role, text from conversations where turn < 2")
def s12(spark, sf):
    c = load(spark, sf, "conversations").where("turn < 2")
    path = place(spark, "messages")
    doc = c.groupBy("conv_id").agg(F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("messages"))
    doc.select("messages").write.json(path)
    rows = spark.read.schema("messages array<struct<conv_id:long,turn:long,role:string,text:string>>").json(path)
    return rows.select(F.explode("messages").alias("m")).select("m.*")


@query("s13_paged_source", "select n_nationkey::bigint as id, n_name as title, (row_number() over (partition by n_regionkey order by n_nationkey) - 1)::int as position from nation")
def s13(spark, sf):
    spark.dataSource.register(S.PagedSource)
    pages: dict[int, list] = {}
    for k, name, region in load(spark, sf, "nation").orderBy("n_nationkey").collect():
        pages.setdefault(region, []).append({"id": k, "title": name})
    return spark.read.format("paged").option("pages", json.dumps([json.dumps({"items": v}) for v in pages.values()])).load()


@query("s16_response_cache", "select event_id from events where epoch(timestamp '2024-01-31') - epoch(ts) <= 864000")
def s16(spark, sf):
    c = load(spark, sf, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).withColumn("ts", F.col("us") / 1e6)
    return S.fresh(c, 1_706_659_200.0, 864_000).select("event_id")


@query("s18_content_sniff", "select vec_id, case vec_id % 5 when 0 then 'png' when 1 then 'jpg' when 2 then 'gif' when 3 then 'webp' end as kind from embeddings")
def s18(spark, sf):
    k = F.col("vec_id") % 5
    raw = F.when(k == 0, F.unhex(F.lit("89504E470D0A1A0A00"))).when(k == 1, F.unhex(F.lit("FFD8FFE000"))).when(k == 2, F.unhex(F.lit("474946383961"))).when(k == 3, F.unhex(F.lit("524946460000000057454250"))).otherwise(F.unhex(F.lit("00")))
    return load(spark, sf, "embeddings").select("vec_id", S.content_type(raw).alias("kind"))


@query("s19_numbered_folders", "select doc_id, lang, ceil(row_number() over (partition by lang order by doc_id) / 100.0)::int as folder from documents")
def s19(spark, sf):
    return numbered_folders(load(spark, sf, "documents"), "lang", ["doc_id"], 100).select("doc_id", "lang", "folder")


@query("s20_bundle", "select 'orders' as t, count(*) as n from orders where o_custkey < 100 union all select 'customer', count(*) from customer where c_custkey < 100")
def s20(spark, sf):
    path = place(spark, "bundle")
    o = load(spark, sf, "orders").withColumnRenamed("o_custkey", "k").withColumn("local_path", F.lit("/home/u/x"))
    c = load(spark, sf, "customer").withColumnRenamed("c_custkey", "k")
    S.bundle({"orders": o, "customer": c}, c.where("k < 100"), "k", path, drop=["local_path"])
    parts = [spark.read.parquet(f"{path}/{t}").agg(F.lit(t).alias("t"), F.count("*").alias("n")) for t in ("orders", "customer")]
    return parts[0].unionByName(parts[1])
