"""Scoring and evaluation over tables of labels, probabilities and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Counts and ratios of a two-class prediction in one pass; a ratio without a base is null."""
    t, p = F.col(truth) == 1, F.col(pred) == 1
    n = lambda c: F.count(F.when(c, 1))
    one = df.agg(n(t & p).alias("tp"), n(~t & p).alias("fp"), n(t & ~p).alias("fn"), n(t == p).alias("ok"), F.count("*").alias("n"))
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), b)
    return one.select("tp", "fp", "fn", ratio("ok", F.col("n")).alias("accuracy"), ratio("tp", F.col("tp") + F.col("fp")).alias("precision"), ratio("tp", F.col("tp") + F.col("fn")).alias("recall"))


def centred(df: DataFrame, vector: str, size: int) -> DataFrame:
    """Adds ``features``: the vector less the mean, over one global scale. One aggregate row reaches the driver."""
    from pyspark.ml.functions import array_to_vector

    parts = [F.col(vector)[i].cast("double") for i in range(size)]
    stats = df.agg(*[F.avg(p).alias(f"m{i}") for i, p in enumerate(parts)], F.sqrt(sum((F.avg(p * p) - F.avg(p) * F.avg(p) for p in parts), F.lit(0.0)) / size).alias("scale")).first()
    scale = stats["scale"] or 1.0
    return df.withColumn("features", array_to_vector(F.array(*[(p - F.lit(stats[f"m{i}"])) / F.lit(scale) for i, p in enumerate(parts)])))


def fit_probe(train: DataFrame, label: str = "label", reg: float = 0.01):
    """A multinomial logistic probe over ``features`` with classes balanced by weight."""
    from pyspark.ml.classification import LogisticRegression

    n = train.groupBy(label).agg(F.count("*").alias("_n"))
    total = n.agg(F.sum("_n").alias("_t"), F.count("*").alias("_k"))
    weighted = train.join(F.broadcast(n), label).join(F.broadcast(total)).withColumn("_w", F.col("_t") / (F.col("_k") * F.col("_n")))
    return LogisticRegression(labelCol=label, weightCol="_w", regParam=reg, maxIter=50).fit(weighted)


def probe_probabilities(model, df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return model.transform(df).withColumn("p", vector_to_array("probability")).drop("rawPrediction", "probability")


def fold(ident: str, folds: int = 5):
    return F.pmod(F.xxhash64(ident), F.lit(folds))


def cross_validate(df: DataFrame, ident: str, label: str, grid: tuple[float, ...], folds: int = 5) -> DataFrame:
    """``reg, log_loss, accuracy``: out-of-fold over a grid of regularisation, folds by hashed id."""
    spark = df.sparkSession
    df = df.withColumn("_fold", fold(ident, folds)).cache()
    rows = []
    for reg in grid:
        loss = ok = n = 0.0
        for k in range(folds):
            p = probe_probabilities(fit_probe(df.where(F.col("_fold") != k), label, reg), df.where(F.col("_fold") == k))
            r = p.agg(F.sum(-F.log(F.greatest(F.lit(1e-15), F.get("p", F.col(label).cast("int"))))), F.sum((F.col("prediction") == F.col(label)).cast("double")), F.count("*")).first()
            loss, ok, n = loss + (r[0] or 0.0), ok + (r[1] or 0.0), n + r[2]
        rows.append((reg, loss / max(n, 1), ok / max(n, 1)))
    return spark.createDataFrame(rows, "reg double, log_loss double, accuracy double")


def self_train(labelled: DataFrame, unlabelled: DataFrame, ident: str, label: str = "label", least: float = 0.5, per_hand: int = 5) -> DataFrame:
    """Second pass: confident rows, at most ``per_hand`` times a class's hand examples, join the training set; all are scored again."""
    from pyspark.sql.window import Window

    first = probe_probabilities(fit_probe(labelled, label), unlabelled.drop(label))
    hand = labelled.groupBy(F.col(label).cast("double").alias("prediction")).agg(F.count("*").alias("_hand"))
    w = Window.partitionBy("prediction").orderBy(F.array_max("p").desc(), ident)
    sure = first.where(F.array_max("p") >= least).withColumn("_r", F.row_number().over(w)).join(F.broadcast(hand), "prediction").where(F.col("_r") <= per_hand * F.col("_hand"))
    more = labelled.select(ident, label, "features").unionByName(sure.select(ident, F.col("prediction").cast(labelled.schema[label].dataType).alias(label), "features"))
    return probe_probabilities(fit_probe(more, label), unlabelled.drop(label))
