"""Graph operators over edge DataFrames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def ensure_checkpoint_dir(spark) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; one of our own only where it is unset and all runs on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not path and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if not path:
        path = "file:/tmp/checkpoints/sievework"
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def components_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges and the smallest node of each one's component; rounds grow with the logarithm of the nodes."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label, i, j = np.arange(len(nodes)), at[: len(u)], at[len(u) :]
    while len(i):
        lo, hi = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        np.minimum.at(label, hi, lo)
        while not np.array_equal(label, label[label]):
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return nodes, nodes[label]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, few: int = 0) -> DataFrame:
    """Components of an undirected edge list as ``(node, component)``; the label is the smallest node.

    At most ``few`` rows, of stored edges between longs, are settled in the driver: a round's files and tasks follow the number of
    partitions, however few edges there are. More take rounds, with the same result.

    Alternates the large-star and small-star rewrites, which shrink the graph's depth by a constant factor a round and keep at
    most as many edges as there were. Each round is cut by a reliable checkpoint. Rows with a null end and self-loops are
    ignored; nodes without edges do not appear; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    if few and {edges.schema[a].dataType, edges.schema[b].dataType} == {LongType()} and e.count() <= few:
        got = e.select(F.col(a).alias("u"), F.col(b).alias("v")).toArrow()
        node, component = components_of(got.column("u").to_numpy(), got.column("v").to_numpy())
        return spark.createDataFrame(pa.table({"node": node, "component": component}), "node long, component long")
    e = e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint()
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
