"""Physical layout, pre-aggregated tables and tables that watch the platform itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finquarry.functions.exprs import davg, pct, ratio


def partition_stats(df: DataFrame, column: str) -> DataFrame:
    """Rows per partition value and their ratio to the mean (one row per partition value)."""
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"))
    return counts.withColumn("skew_ratio", F.col("row_count") / counts.agg(F.avg("row_count")).scalar())


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Dynamic partition overwrite. Rows are brought together by partition value; a value with much data is
    split over several tasks and files by measured bytes (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def cluster_sorted(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range partitions sorted inside: files get narrow min/max values and can be skipped."""
    n = [partitions] if partitions else []
    return df.repartitionByRange(*n, *cols).sortWithinPartitions(*cols)


def held(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by key and kept (in memory, the rest on disk), for several aggregates or joins on that key.

    The caller calls ``unpersist`` when done. What a lost executor held is computed again.
    """
    return df.repartition(*keys).persist(StorageLevel.MEMORY_AND_DISK)


def coalesced(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle, for little data left in many of them: each task reads several.

    It also lowers the parallelism of the step before; after a heavy one ``compact`` is better.
    """
    return df.coalesce(partitions)


def compact(spark: SparkSession, source: str, target: str, by: Sequence[str]) -> DataFrame:
    """Rewrite many small files as few larger ones in a new folder; the caller publishes it."""
    write_partitioned(spark.read.parquet(source), target, by)
    return spark.read.parquet(target)


def build_summary(df: DataFrame, group: Sequence[Column | str], measures: Sequence[Column]) -> DataFrame:
    """The stored aggregate behind a dashboard."""
    return df.groupBy(*group).agg(*measures)


def refresh_partitions(spark: SparkSession, path: str, summary: DataFrame, changed: DataFrame, column: str) -> None:
    """Replace only the partitions of a stored summary named in ``changed``."""
    touched = summary.join(changed.select(column).distinct(), column, "left_semi")
    write_partitioned(touched, path, [column])


def archive_split(df: DataFrame, column: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(kept, archived) by date."""
    old = F.col(column) < F.lit(cutoff).cast("date")
    return df.filter(~old), df.filter(old)


def query_log_stats(log: DataFrame, by: Sequence[str], slow_ms: float) -> DataFrame:
    """Runs, slow runs, cache hits and time per group of a query log."""
    d = F.col("duration_ms")
    return log.groupBy(*by).agg(
        F.count("*").alias("runs"),
        davg("duration_ms").alias("avg_ms"),
        F.max(d).alias("max_ms"),
        F.count_if(d > slow_ms).alias("slow_runs"),
        pct(F.count_if("cache_hit"), F.count("*")).alias("hit_rate_pct"),
        F.sum("rows_scanned").alias("rows_scanned"),
    )


def freshness_report(latest: DataFrame, limits_hours: dict[str, int], as_of: Column) -> DataFrame:
    """``latest (table_name, last_update)`` against a limit per table: age, status, breach."""
    limit = None
    for t, h in limits_hours.items():
        hit = F.col("table_name") == t
        limit = F.when(hit, h) if limit is None else limit.when(hit, h)
    age = ratio(F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(F.col("last_update").cast("timestamp")), F.lit(3600))
    out = latest.withColumns({"age_hours": age, "limit_hours": limit.otherwise(24)})
    return out.withColumn("status", F.when(F.col("age_hours") > F.col("limit_hours") * 2, "CRITICAL").when(F.col("age_hours") > F.col("limit_hours"), "STALE").otherwise("FRESH"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Success rate, duration and rows per job from a run log ``(job, status, duration_s, row_count)``."""
    return runs.groupBy("job").agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        pct(F.count_if(F.col("status") == "success"), F.count("*")).alias("success_rate"),
        davg("duration_s").alias("avg_duration_s"),
        F.sum("row_count").alias("rows_processed"),
    )


def volume_check(df: DataFrame, day: Column, low: int, high: int) -> DataFrame:
    return df.groupBy(day.alias("day")).agg(F.count("*").alias("row_count")).withColumn(
        "status", F.when(F.col("row_count") < low, "LOW").when(F.col("row_count") > high, "HIGH").otherwise("OK")
    )


def day_over_day(daily: DataFrame, limit_pct: float = 50.0) -> DataFrame:
    """``daily (day, row_count)``, one row per day: change against the day before."""
    prev = F.lag("row_count").over(Window.orderBy("day"))
    out = daily.withColumn("change_pct", pct(F.col("row_count") - prev, prev))
    return out.withColumn("breach", F.coalesce(F.abs("change_pct") > limit_pct, F.lit(False)))
