"""Probes over embeddings. Fitted models have no SQL form; tests check their properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import learning as L
from sievework.plans.registry import load, query


def table(spark, sf):
    e = load(spark, sf, "embeddings")
    return L.centred(e.withColumn("label", F.col("label").cast("int")), "embedding", 64)


@query("m01_logistic_probe")
def m01(spark, sf):
    t = table(spark, sf)
    model = L.fit_probe(t.where(F.col("vec_id") % 4 != 0))
    return L.probe_probabilities(model, t).select("vec_id", F.col("prediction").cast("int").alias("predicted"), F.round(F.array_max("p"), 6).alias("p"))


@query("m04_cross_validation")
def m04(spark, sf):
    return L.cross_validate(table(spark, sf).select("vec_id", "label", "features"), "vec_id", "label", (0.01, 0.1), folds=3)


@query("m07_self_training")
def m07(spark, sf):
    t = table(spark, sf)
    out = L.self_train(t.where(F.col("vec_id") % 3 == 0), t.where(F.col("vec_id") % 3 != 0), "vec_id", least=0.3)
    return out.select("vec_id", F.col("prediction").cast("int").alias("predicted"), F.round(F.array_max("p"), 6).alias("p"))


@query("m09_quality_probe")
def m09(spark, sf):
    t = table(spark, sf).withColumn("bad", (F.col("label") >= 5).cast("int"))
    model = L.fit_probe(t.where(F.col("vec_id") % 4 != 0), "bad")
    p = L.probe_probabilities(model, t).withColumn("p_bad", F.col("p")[1])
    verdict = F.when(F.col("vec_id") % 100 == 0, F.lit("sample")).when(F.col("p_bad") >= 0.5, "bad").otherwise("good")
    return p.select("vec_id", F.round("p_bad", 6).alias("p_bad"), verdict.alias("verdict"))


@query("m10_colour_probe")
def m10(spark, sf):
    t = table(spark, sf).withColumn("colour", (F.col("label") % 2).cast("int"))
    sure = t.where(F.abs(F.col("embedding")[0]) > 0.05)
    return L.probe_probabilities(L.fit_probe(sure, "colour"), t).select("vec_id", F.col("prediction").cast("int").alias("colour"))
