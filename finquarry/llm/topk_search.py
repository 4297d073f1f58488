"""Exact top-k inner-product search by norm-bucketed retrieval.

Vectors are grouped by length into buckets, and each bucket is stored as one sorted block
of rows. A query starts from a lower bound on its k-th best product, found in the buckets
of the longest vectors. For every other bucket the bound becomes a local cosine threshold

    theta_b(q) = bound / (|q| * longest length in b)

A bucket whose threshold exceeds 1 is left out. In the rest the cheaper of two prunings is
chosen per bucket and query by how many rows it leaves: by length, the rows whose length
alone can reach the bound; or by coordinate, the rows whose value in the query's largest
coordinate lies in the range that the cosine threshold allows. What is left is verified by
exact integer products. Prunings keep a small margin for rounding, so no result is lost.

Queries are packed into blocks, and each block meets each bucket that it can't leave out:
work grows with queries times buckets, memory with one block and one bucket. Partial top-k
lists are merged by Spark.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no
part; vectors of different lengths have no product; a null id takes no part; repeated rows
are candidates each; the query's own id is no candidate; fewer than k candidates: all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import stored, table

BUCKET_ROWS, BLOCK_QUERIES, SEEDS = 2048, 256, 4
SLACK = 1e-9
PAIR = "query_id bigint, vec_id bigint, score bigint"


def scaled(df: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """id, dim, norm and the components floor(scale * x), for the vectors that take part."""
    x = F.col(vector_col)
    ok = F.col(id_col).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("bigint"))
    rows = df.filter(ok).select(F.col(id_col).cast("bigint").alias("id"), whole.alias("v"))
    return rows.select("id", "v", F.size("v").alias("dim"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))).alias("norm"))


def _blocks(rows: int):
    """Rows sorted by (dim, length descending) become blocks of at most ``rows`` rows of one dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple[int, np.ndarray, float]] = []
        block, dim = TaskContext.get().partitionId() << 33, None

        def out():
            ids, vectors, norms = zip(*held)
            longest = max(norms)
            m = np.stack(vectors).astype("<i8")
            return pa.record_batch([pa.array(c, k) for c, k in (([block], pa.int64()), ([dim], pa.int32()), ([len(ids)], pa.int64()), ([longest], pa.float64()), ([list(ids)], pa.list_(pa.int64())), ([m.tobytes()], pa.binary()))], names=["block", "dim", "rows", "longest", "ids", "data"])

        for b in batches:
            for i, v, d, n in zip(b.column("id").to_pylist(), b.column("v").to_pylist(), b.column("dim").to_pylist(), b.column("norm").to_pylist()):
                if held and (d != dim or len(held) == rows):
                    yield out()
                    block, held = block + 1, []
                dim = d
                held.append((i, np.array(v, np.int64), n))
        if held:
            yield out()

    return run


BLOCK = "block bigint, dim int, rows bigint, longest double, ids array<bigint>, data binary"


def bucketed(vectors: DataFrame, rows: int = BUCKET_ROWS) -> DataFrame:
    """Vectors (from ``scaled``) as blocks of similar length, longest first."""
    order = [F.col("dim"), F.desc("norm"), F.col("id")]
    return stored(vectors.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(rows), BLOCK), "buckets")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def search_bucket(ids: np.ndarray, rows: np.ndarray, norms: np.ndarray, query: np.ndarray, query_norm: float, query_id: int, bound: float, k: int) -> tuple[np.ndarray, np.ndarray, str]:
    """The top k of one bucket (rows by descending length) among products of at least ``bound``: ids, products, pruning used."""
    use, how = slice(0, len(rows)), "all"
    if query_norm > 0 and bound > 0:
        reach = int(np.searchsorted(-norms, -bound / query_norm * (1 - SLACK), "right"))
        theta = bound / (query_norm * norms[0]) * (1 - SLACK) if norms[0] > 0 else 2.0
        if theta > 1 or not reach:
            return ids[:0], ids[:0], "none"
        f = int(np.argmax(np.abs(query)))
        q = query[f] / query_norm
        wide = np.sqrt(max(0.0, (1 - theta * theta) * (1 - q * q)))
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.where(norms > 0, rows[:, f] / norms, 0.0)
        # the cosine to the query is at least theta only if this coordinate lies in the range
        low = -1.0 if q <= -theta else q * theta - wide
        high = 1.0 if q >= theta else q * theta + wide
        fits = (own >= low - 1e-7) & (own <= high + 1e-7)
        left = np.flatnonzero(fits[:reach])
        use, how = (left, "coordinate") if 2 * len(left) < reach else (slice(0, reach), "length")
    products = rows[use] @ query
    found = ids[use]
    ok = (found != query_id) & (products >= bound)
    products, found = products[ok], found[ok]
    at = _best(products, found, k)
    return found[at], products[at], how


def _searched(k: int):
    """Rows that pair a query block (q_ids, q_data, bounds) with a bucket; gives each query's top k of the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows = np.frombuffer(r["data"], "<i8").reshape(-1, r["dim"])
                queries = np.frombuffer(r["q_data"], "<i8").reshape(-1, r["dim"])
                ids, norms = np.array(r["ids"], np.int64), np.sqrt((rows.astype(np.float64) ** 2).sum(1))
                q_norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
                bounds = r["bounds"] or [None] * len(queries)
                out = [[], [], []]
                for q, i, n, bound in zip(queries, r["q_ids"], q_norms, bounds):
                    found, products, _ = search_bucket(ids, rows, norms, q, n, i, -np.inf if bound is None else bound, k)
                    for column, values in zip(out, (np.full(len(found), i), found, products)):
                        column.append(values)
                yield pa.record_batch([pa.array(np.concatenate(c), pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

    return run


def _top(pairs: DataFrame, k: int) -> DataFrame:
    best = F.slice(F.sort_array(F.collect_list(F.struct("score", (-F.col("vec_id")).alias("minus"))), asc=False), 1, k)
    return pairs.groupBy("query_id").agg(best.alias("best"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``vectors`` and ``queries`` from ``scaled``; returns query_id, rank, vec_id, score."""
    buckets = bucketed(vectors)
    blocks = bucketed(queries.dropDuplicates(["id"]), BLOCK_QUERIES).select(F.col("block").alias("q_block"), F.col("dim").alias("q_dim"), F.col("longest").alias("q_longest"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    sizes = buckets.select("block", F.col("dim").alias("b_dim"), "longest")  # one row per bucket, without its data
    seeds = [r["block"] for r in sizes.orderBy(F.desc("longest")).limit(SEEDS).collect()]
    # which block meets which bucket, in slim rows; salted, as all vectors have the same dim
    salts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = blocks.select("q_block", "q_dim", "q_longest", F.pmod(F.xxhash64("q_block"), F.lit(salts)).cast("int").alias("q_salt"))
    many = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    every = one.join(many, (F.col("q_dim") == F.col("b_dim")) & (F.col("q_salt") == F.col("salt"))).select("block", "q_block", "q_longest", "longest")

    def met(pairs: DataFrame) -> DataFrame:
        data = blocks.select("q_block", "q_ids", "q_data")
        held = buckets.select("block", "dim", "ids", "data")
        return pairs.select("block", "q_block", "bounds").join(data, "q_block").join(held, "block").mapInArrow(_searched(k), PAIR)

    first = every.filter(F.col("block").isin(seeds)).withColumn("bounds", F.lit(None).cast("array<double>"))
    seeded = stored(met(first), "seeded")
    # the k-th product of a query so far bounds its result from below
    kth = _top(seeded, k).filter(F.size("best") == k).select("query_id", F.element_at("best", k)["score"].cast("double").alias("bound"))
    ids = blocks.select("q_block", F.posexplode("q_ids").alias("at", "query_id"))
    bounds = ids.join(kth, "query_id", "left").groupBy("q_block").agg(F.array_sort(F.collect_list(F.struct("at", "bound"))).alias("b"))
    bounds = bounds.select("q_block", F.transform("b", lambda x: x["bound"]).alias("bounds"))
    rest = every.filter(~F.col("block").isin(seeds)).join(bounds, "q_block")
    least = F.aggregate("bounds", F.lit(float("inf")), lambda a, x: F.least(a, F.coalesce(x, F.lit(float("-inf")))))
    rest = rest.filter(least * (1 - SLACK) <= F.col("q_longest") * F.col("longest"))
    merged = _top(seeded.union(met(rest)), k)
    return merged.select("query_id", F.posexplode("best").alias("rank", "b")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), (-F.col("b.minus")).alias("vec_id"), F.col("b.score").alias("score"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("id") % 100 == 0), 10)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
