"""Readers, writers and versioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPTIONS = {"csv": {"header": "true"}, "xml": {"rowTag": "row"}}


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None, **options) -> DataFrame:
    """Files of any built-in format; text formats take an explicit schema, so nothing is scanned to infer one."""
    reader = spark.read.format(fmt).options(**{**OPTIONS.get(fmt, {}), **options})
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", by: Sequence[str] = (), **options) -> None:
    writer = df.write.mode(mode).format(fmt).options(**{**OPTIONS.get(fmt, {}), **options})
    (writer.partitionBy(*by) if by else writer).save(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, partitions: int, **properties) -> DataFrame:
    """A table read in parallel ranges of a numeric column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=partitions, properties=properties)


def convert(spark: SparkSession, source: str, target: str, from_fmt: str, to_fmt: str, schema=None) -> DataFrame:
    write(read(spark, source, from_fmt, schema), target, to_fmt)
    return read(spark, target, to_fmt, schema if to_fmt in ("csv", "json", "xml") else None)


def with_origin(df: DataFrame, system: str, batch: str, at: str) -> DataFrame:
    """Where a raw row came from: system, batch, load time, file."""
    return df.select("*", F.lit(at).cast("timestamp").alias("ingestion_timestamp"), F.lit(system).alias("source_system"), F.lit(batch).alias("batch_id"), F.col("_metadata.file_name").alias("source_file"))


def folder_size(df: DataFrame) -> DataFrame:
    """Files and bytes behind a file-based DataFrame."""
    return df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct().agg(F.count("*").alias("files"), F.sum("b").alias("bytes"))


def schema_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per expected or actual column: state of the schema and number of NULLs, in one pass over the data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in actual])
    rows = []
    for c in sorted(set(expected) | set(actual)):
        state = "missing" if c not in actual else "unexpected" if c not in expected else "ok" if actual[c] == expected[c] else "type_mismatch"
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(expected.get(c)).cast("string").alias("expected_type"), F.lit(actual.get(c)).cast("string").alias("actual_type"), F.lit(state).alias("state"), (F.col(c) if c in actual else F.lit(None)).cast("bigint").alias("null_count")))
    return nulls.select(F.inline(F.array(*rows)))


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns added, removed or retyped between two snapshots, with the filled share of the new ones."""
    was = {f.name: f.dataType.simpleString() for f in old.schema.fields}
    report = schema_report(new, was)
    change = F.when(F.col("state") == "missing", "removed").when(F.col("state") == "unexpected", "added").when(F.col("state") == "type_mismatch", "retyped")
    return report.withColumn("change", change).filter(F.col("change").isNotNull()).select("column_name", "change", F.col("expected_type").alias("old_type"), F.col("actual_type").alias("new_type"), "null_count")


class Versions:
    """A table kept as immutable snapshot folders plus a small ledger of (version, committed_at).

    A new state is written to its own folder first and becomes visible with its ledger row,
    so readers never see a half-written table and a job killed midway leaves no trace.
    """

    LEDGER = "version bigint, committed_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(self.LEDGER).parquet(f"{self.path}/_ledger")

    def commit(self, df: DataFrame, version: int, at: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/snapshot_id={version}")
        row = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(at).cast("timestamp").alias("committed_at"))
        row.write.mode("append").parquet(f"{self.path}/_ledger")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/snapshot_id={version}")

    def version_as_of(self, at: str) -> int:
        row = self.ledger().filter(F.col("committed_at") <= F.lit(at).cast("timestamp")).agg(F.max_by("version", F.struct("committed_at", "version")).alias("v")).first()
        if row.v is None:
            raise ValueError(f"no version at {at}")
        return row.v

    def read_as_of(self, at: str) -> DataFrame:
        return self.read(self.version_as_of(at))

    def deleted_between(self, old: int, new: int, key: str) -> DataFrame:
        """Rows of the old version whose key is gone: what a recovery would bring back."""
        return self.read(old).join(self.read(new).select(key), key, "left_anti")

    def clone(self, version: int, target: str, at: str) -> "Versions":
        other = Versions(self.spark, target)
        other.commit(self.read(version), 1, at)
        return other


def decode_messages(df: DataFrame, schema: str, value: str | Column = "value") -> DataFrame:
    """JSON message values into columns; works alike for batch and stream sources."""
    v = F.col(value) if isinstance(value, str) else value
    return df.select(F.from_json(v.cast("string"), schema).alias("m")).select("m.*")
