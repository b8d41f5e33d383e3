"""The corpus pipeline: toxic documents go, one of each group of near copies stays, long repeated passages are cut, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.common import stored, table
from sievework.llm.packing import pack_documents
from sievework.llm.simhash import similar_components
from sievework.llm.suffix import find_repeats
from sievework.llm.toxicity import drop_toxic, fit_on

#: Repeated passages are cut from so many bytes on, which is most often under fifty words, and from so many words on in any case.
PASSAGE = 240
PASSAGE_WORDS = 51
PASSAGE_ORDER = 11


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the field is fitted on labelled ones of these."""
    return drop_toxic(docs, fit_on(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that is 0.8 alike in five-word shingles; rows without id stay.

    Groups are linked by SimHash, choices of blocks and verified distance, as in op9, and checked on the shingles; pairs that
    fingerprints cannot bring together are added in an exact way.
    """
    groups = similar_components(docs)
    gone = groups.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur anywhere else; characters stay whole, ``n_chars`` follows the text, null texts stay null."""
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("text").isNull().alias("_null"))
    carry = [n for n in named.columns if n != names["text"]]
    cut = find_repeats(named, length=PASSAGE, order=PASSAGE_ORDER, carry=carry, text_col=names["text"], whole_chars=True, words=PASSAGE_WORDS)
    cut = cut.withColumn(names["text"], F.when(~F.col("_null"), F.decode("kept", "utf-8")))
    if "n_chars" in names:
        size = F.char_length(names["text"]).cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn(names["n_chars"], F.when(F.col("n_removed") > 0, size).otherwise(F.col(names["n_chars"])))
    return cut.select(*[F.col(n).alias(c) for c, n in names.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", reject_toxic), ("near_dedup", drop_near_copies), ("suffix_dedup", cut_repeats), ("packing", pack)]

#: SQL can express none of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", "snappy")
    return docs
