"""Content-addressed web archive.

Payload bytes are stored once under their SHA-256, exact record headers in a table of their own; a join gives the original
records back. Equal payloads are one ``response`` and any number of ``revisit`` records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import scratch, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EPOCH = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are 32 characters, so 5 hex digits give 4 of them and nothing is padded."""
    digest = F.sha1(payload)
    chars = []
    for g in range(8):
        v = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        chars += [F.lit(BASE32).substr(F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def _urn(key: Column) -> Column:
    h = F.sha1(key.cast("binary"))
    cut = [F.substring(h, p, n) for p, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = EPOCH) -> None:
    """Writes ``path/headers`` (exact header bytes, one row a record) and ``path/payloads`` (distinct payload bytes by SHA-256).

    Of the records with equal payloads of at least ``min_bytes`` bytes the one with the largest id is the response; the others
    refer to it. Smaller payloads are all responses. Repeated rows with the largest id are all responses. A null payload is empty,
    a null url an empty target, a row without id a response of its own. Line breaks in a url are percent-encoded.
    The owner of a payload is found by an aggregate that combines before its shuffle; no payload bytes travel for it.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    base = pages.select(F.col(id_col).alias("rec_id"), url.alias("target"), payload.alias("payload")).withColumn("payload_key", F.sha2("payload", 256))
    small = base.select("rec_id", "target", "payload_key", F.octet_length("payload").cast("long").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    owners = small.where(F.col("n_bytes") >= min_bytes).groupBy("payload_key").agg(F.max("rec_id").alias("owner"), F.min("sha1").alias("s0"), F.max("sha1").alias("s1"), F.min("n_bytes").alias("b0"), F.max("n_bytes").alias("b1"))
    same = (F.col("s0") == F.col("s1")) & (F.col("b0") == F.col("b1"))
    owners = owners.select("payload_key", F.when(same, F.col("owner")).otherwise(F.raise_error(F.lit("two payloads share a SHA-256"))).alias("owner"))
    rec = small.join(owners, "payload_key", "left")
    revisit = F.col("owner").isNotNull() & F.col("rec_id").isNotNull() & (F.col("rec_id") != F.col("owner"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    text_id = F.coalesce(F.col("rec_id").cast("string"), F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _urn(F.concat(F.lit("record:"), text_id))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("target")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("X-Payload-SHA256", F.col("payload_key")),
        line("X-Source-ID", text_id),
        F.when(revisit, F.concat(line("WARC-Refers-To", _urn(F.concat(F.lit("record:"), F.col("owner").cast("string")))), line("X-Refers-To-ID", F.col("owner").cast("string")), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit("\r\n"),
    )
    rec.select("payload_key", header.cast("binary").alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    base.select("payload_key", "payload").dropDuplicates(["payload_key"]).write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_payloads(spark, path: str) -> DataFrame:
    """The stored payloads; each is checked against its key as it is read."""
    p = spark.read.parquet(f"{path}/payloads")
    ok = F.sha2("payload", 256) == F.col("payload_key")
    return p.select("payload_key", F.when(ok, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest"))).alias("payload"))


def parse_header(header: Column) -> dict[str, Column]:
    text = header.cast("string")
    field = lambda name: F.regexp_extract(text, rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return {"record_type": field("WARC-Type"), "source_id": field("X-Source-ID"), "refers_to": field("X-Refers-To-ID"), "target": field("WARC-Target-URI"), "digest": field("WARC-Payload-Digest"), "length": field("Content-Length"), "payload_sha256": field("X-Payload-SHA256")}


def read_records(spark, path: str) -> DataFrame:
    """The original records: ``header`` and ``block`` bytes (empty for revisits) and ``record``, their WARC form."""
    head = spark.read.parquet(f"{path}/headers").withColumn("record_type", parse_header(F.col("header"))["record_type"])
    own = head.where(F.col("record_type") == "response").join(read_payloads(spark, path), "payload_key")
    none = head.where(F.col("record_type") != "response").withColumn("payload", F.lit(b""))
    both = own.unionByName(none).withColumnRenamed("payload", "block")
    return both.withColumn("record", F.concat("header", "block", F.lit(b"\r\n\r\n")))


def parse_record(record: Column) -> tuple[Column, Column]:
    """Header (with its blank line) and block of a record's WARC form; a header holds no blank line before its end."""
    head = F.instr(record.cast("string"), "\r\n\r\n") + 3
    size = F.octet_length(F.substring(record.cast("string"), F.lit(1), head))
    return F.substring(record, F.lit(1), size), F.substring(record, size + 1, F.octet_length(record) - size - 4)


def read_index(spark, path: str) -> DataFrame:
    """One row per record with its full payload's length and digest, taken from the rebuilt records.

    Responses are put together and taken apart again; a revisit takes what was found for the response of its payload. Only lengths and
    digests travel for that. A record whose length or digest is not what its header says stops the read.
    """
    records = read_records(spark, path)
    header, block = parse_record(F.col("record"))
    own = records.where(F.col("record_type") == "response").select(header.alias("header"), block.alias("block"))
    parsed = parse_header(F.col("header"))
    own = own.select(*[c.alias(k) for k, c in parsed.items()], F.octet_length("block").cast("long").alias("payload_bytes"), base32_sha1(F.col("block")).alias("payload_digest"))
    good = (F.col("digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (F.col("length") == F.col("payload_bytes").cast("string"))
    own = own.withColumn("payload_digest", F.when(good, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record does not match its header"))))
    found = own.groupBy("payload_sha256").agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    again = spark.read.parquet(f"{path}/headers").select(*[c.alias(k) for k, c in parsed.items()]).where(F.col("record_type") == "revisit").join(found, "payload_sha256")
    good = F.col("digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    again = again.withColumn("payload_digest", F.when(good, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a revisit does not match its response"))))
    return own.unionByName(again)


def op7_content_addressed_warc(spark, sf_dir: str) -> DataFrame:
    """Archives all pages and reads them back."""
    path = scratch(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    write_archive(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    return read_index(spark, path).select(number("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
