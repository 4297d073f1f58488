"""Joins, set operations, recursion and reshaping as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finquarry.operators import skew
from finquarry.session import cut_lineage


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key.

    An aggregate, not a window: it combines on the map side, so a key with very many
    versions never meets in one task. Make ``order`` unique to be deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ordering).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def anti_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is unknown to the parent; NULL keys count as orphans."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.join(keys, child[child_key] == F.col("_pk"), "left_anti")


def flatten_star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """One wide table: each dimension joined on its key, the key column of the dimension dropped.

    No broadcast hint: Spark broadcasts by measured size and falls back to a shuffle join.
    """
    out = fact
    for dim, fact_key, dim_key in dims:
        out = out.join(dim, out[fact_key] == dim[dim_key], "left")
        if dim_key != fact_key:
            out = out.drop(dim[dim_key])
    return out


def join_versions(fact: DataFrame, dim: DataFrame, key: str, at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Fact rows with the dimension version valid at ``at`` (half-open ``[start, end)``, open end NULL)."""
    d = dim.withColumnRenamed(key, "_dk")
    hit = (fact[key] == F.col("_dk")) & (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    return fact.join(d, hit, how).drop("_dk")


def join_as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, value: str, out: str, tie: str) -> DataFrame:
    """Per left row the last right ``value`` at or before its time.

    Both sides are merged into one ordered sequence and the value carried forward, so the
    cost is one shuffle and no row meets all rows of its key. ``tie`` is a unique left column.
    """
    l = left.withColumns({"_t": F.col(left_ts), "_s": F.lit(1), "_i": F.col(tie).cast("string"), "_v": F.lit(None).cast(right.schema[value].dataType)})
    r = right.select(F.col(key), F.col(right_ts).alias("_t"), F.lit(0).alias("_s"), F.col(value).alias("_v"))
    r = r.withColumn("_i", F.col("_v").cast("string"))
    merged = l.unionByName(r, allowMissingColumns=True)
    carried = skew.carry_last(merged, key, ["_t", "_s", "_i"], "_v", out)
    return carried.filter(F.col("_s") == 1).drop("_t", "_s", "_i", "_v")


def compare_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are missing on one side, or whose other columns differ."""
    rest = [c for c in a.columns if c not in keys]
    finger = lambda df: df.select(*keys, F.struct(*rest).alias("_r"))
    x, y = finger(a).withColumnRenamed("_r", "_a"), finger(b).withColumnRenamed("_r", "_b")
    state = F.when(F.col("_b").isNull(), "missing_in_target").when(F.col("_a").isNull(), "extra_in_target").otherwise("changed")
    return x.join(y, list(keys), "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys, state.alias("status"))


def walk(start: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Follow ``edges (src, dst, *extra)`` from ``start (root, node)``; one row per path found.

    Level by level: the frontier meets the edges in one equi-join, paths that would revisit a
    node are dropped, and every level is checkpointed so the plan stays short. The loop ends
    with the first empty level; only a report that is defined to a depth gives ``max_depth``.
    Every level meets the edges anew, so these are sorted, never sent to the driver for a broadcast.
    Result: root, node, depth, path.
    """
    frontier = start.select("root", "node").withColumns({"depth": F.lit(0), "path": F.array(F.col("node"))})

    def step(frontier: DataFrame, depth: int) -> DataFrame:
        return (
            frontier.join(edges.hint("merge"), frontier.node == edges.src)
            .filter(~F.array_contains("path", F.col("dst")))
            .select("root", F.col("dst").alias("node"), F.lit(depth).alias("depth"), F.concat("path", F.array("dst")).alias("path"))
        )

    return _levels(frontier, step, max_depth)


def _levels(frontier: DataFrame, step, max_depth: int | None = None) -> DataFrame:
    """All levels up to the first empty one: ``step(frontier, depth)`` gives the next. Many levels become one table, so no plan grows with the depth."""
    levels, depth = [frontier], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        frontier = cut_lineage(step(frontier, depth))
        if frontier.isEmpty():
            break
        levels.append(frontier)
        if len(levels) > 16:
            levels = [cut_lineage(reduce(DataFrame.unionByName, levels))]
    return reduce(DataFrame.unionByName, levels)


def hierarchy(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Every node of a forest with its level and path from the root (parent NULL)."""
    roots = nodes.filter(F.col(parent).isNull()).select(F.col(node).alias("root"), F.col(node).alias("node"))
    edges = nodes.filter(F.col(parent).isNotNull()).select(F.col(parent).alias("src"), F.col(node).alias("dst"))
    return walk(roots, edges)


def explode_bom(bom: DataFrame, roots: DataFrame) -> DataFrame:
    """Total quantity of every component below each root: ``bom (parent, child, qty)`` without cycles.

    Quantities of a part on one level are summed at once, so shared parts do not multiply paths.
    A cycle is an error: it is reported once a level lies deeper than there are parts.
    """
    frontier = roots.select("root", F.col("root").alias("part"), F.lit(1).cast("bigint").alias("total_qty"), F.lit(0).alias("level"))
    parts = bom.agg(F.count("*")).scalar()

    def step(frontier: DataFrame, level: int) -> DataFrame:
        below = frontier.join(bom, frontier.part == bom.parent).select("root", F.col("child").alias("part"), (F.col("total_qty") * F.col("qty")).alias("q"))
        checked = below.withColumn("q", F.when(F.lit(level) > parts, F.raise_error(F.lit("the parts list has a cycle")).cast("bigint")).otherwise(F.col("q")))
        return checked.groupBy("root", "part").agg(F.sum("q").alias("total_qty")).withColumn("level", F.lit(level))

    return _levels(frontier, step)


def calendar(spark, start: str, end: str, name: str = "d") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(name))


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` best rows per key.

    ``row_number() <= n`` lets Spark keep only n rows per key and task before the shuffle
    (window group limit), so hot keys shrink on the map side.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).withColumnRenamed("_rn", "rn")


def islands(df: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days per key (``df`` has one row per key and day).

    ``day - position`` is constant within a run; positions come from the skew-safe numbering.
    """
    rows = skew.row_numbers(df.select(key, day).distinct(), key, [day], "_rn")
    return rows.groupBy(key, F.date_sub(day, F.col("_rn").cast("int")).alias("_g")).agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date"), F.count("*").alias("days")
    ).drop("_g")


def salted_distinct_count(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact distinct count per key in two aggregates that both combine on the map side."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias("distinct_count"))
