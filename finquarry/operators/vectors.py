"""Nearest neighbours by cosine, and counts with noise."""

from __future__ import annotations

import secrets
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finquarry.operators.relational import top_n_per_key


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label: (query_id, vector). Sums per position combine on the map side."""
    x = df.select(F.col(label).alias("q"), F.posexplode(vector).alias("i", "v"))
    m = x.groupBy("q", "i").agg((F.sum(F.col("v").cast("decimal(18,8)")).cast("double") / F.count("*")).alias("v"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "v")))  # one entry per dimension
    return m.groupBy(F.col("q").alias("query_id")).agg(F.transform(ordered, lambda s: s["v"]).alias("vector"))


def _dot(a, b):
    product = F.zip_with(a, b, lambda x, y: (x * y).cast("decimal(28,12)"))
    return F.aggregate(product, F.lit(0).cast("decimal(38,12)"), lambda acc, p: (acc + p).cast("decimal(38,12)")).cast("double")


def nearest(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = 256) -> DataFrame:
    """The ``k`` most similar rows per query (query_id, vector), for any number of queries.

    Queries are packed into blocks of about ``block``, rows are dealt into as many buckets as
    there are shuffle partitions, and each block meets each bucket in a group of its own; Spark
    broadcasts the blocks if it measures them as small. Only the best ``k`` per query and task
    are shuffled after that.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.greatest(F.ceil(queries.agg(F.count("*")).scalar() / block), F.lit(1)).cast("int")
    at = F.pmod(F.xxhash64("query_id"), blocks).cast("int")
    pack = queries.select("query_id", "vector", F.sqrt(_dot(F.col("vector"), F.col("vector"))).alias("norm"), at.alias("_block"))
    packed = pack.groupBy("_block").agg(F.collect_list(F.struct("query_id", "vector", "norm")).alias("_qs"))
    packed = packed.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    rows = df.select(key, F.transform(vector, lambda x: x.cast("decimal(18,8)").cast("double")).alias("_x")).withColumn("_n", F.sqrt(_dot(F.col("_x"), F.col("_x"))))
    dealt = rows.select(key, "_x", "_n", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"))
    pairs = dealt.join(packed, ["_block", "_bucket"]).select(key, "_x", "_n", F.explode("_qs").alias("q"))
    scored = pairs.select(F.col("q.query_id").alias("query_id"), key, (_dot(F.col("_x"), F.col("q.vector")) / (F.col("_n") * F.col("q.norm"))).alias("similarity"))
    return top_n_per_key(scored, ["query_id"], [F.desc("similarity"), F.col(key)], k).select("query_id", key, F.col("rn").alias("rank"))


def noisy_counts(df: DataFrame, keys: Sequence[str], epsilon: float, seed: int | None = None) -> DataFrame:
    """Counts with Laplace noise of scale ``1 / epsilon``.

    The noise is drawn anew for every run from a seed that is not kept, so it cannot be
    subtracted; ``seed`` is for tests, whoever knows it can take the noise off. Every run spends ``epsilon`` once more: publish one run, don't average.
    The set of keys itself is not protected.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    u = F.rand(secrets.randbits(63) if seed is None else seed) - 0.5
    noise = -F.signum(u) * F.ln(F.greatest(1 - 2 * F.abs(u), F.lit(1e-300))) / epsilon
    return counts.select(*keys, F.greatest(F.round(F.col("n") + noise), F.lit(0.0)).alias("noisy_count"))
