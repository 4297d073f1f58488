"""Running streams over file sources: sources, sentinel rows, exactly-once batch output.

All folders lie below the shared checkpoint folder of the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finquarry.operators.relational import latest_per_key
from finquarry.session import run_folder
from finquarry.sources.keyed import FILE_ROWS, KeyedTable


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files as a stream, a bounded number per micro-batch.

    A source that is one file must be given as a pattern; a pattern also fits a folder.
    """
    if path.endswith(".parquet"):
        path = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def timed(df: DataFrame, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """Event time as a zoned timestamp (watermarks reject the zone-less kind), with a watermark."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, delay) if delay else out


class Replay:
    """A folder or file replayed as a stream that ends: windows still open at its end are closed.

    Append mode holds back what the watermark has not passed. When all files have been read, a
    sentinel row far in the future (all other columns NULL) is delivered through a second
    folder and moves the watermark on; jobs drop it by its NULL key. Nothing is read but by
    the stream itself.
    """

    END = "9000-01-01 00:00:00"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ts: str = "ts", delay: str = "10 minutes"):
        self.spark, self.path, self.schema, self.ts, self.delay = spark, path, schema, ts, delay
        self.end = run_folder(spark, "sentinel")
        spark.createDataFrame([], schema).write.parquet(self.end)  # the folder must exist before it is watched

    def stream(self) -> DataFrame:
        both = file_stream(self.spark, self.path, self.schema).union(file_stream(self.spark, self.end, self.schema))
        return timed(both, self.ts, self.delay)

    def run(self, df: DataFrame, mode: str = "append") -> DataFrame:
        folder = run_folder(self.spark, "stream")
        run_to_end(df, folder, mode)
        values = [F.lit(self.END).cast(f.dataType) if f.name == self.ts else F.lit(None).cast(f.dataType) for f in self.schema.fields]
        self.spark.range(1).select(*[v.alias(f.name) for v, f in zip(values, self.schema.fields)]).write.mode("append").parquet(self.end)
        return run_to_end(df, folder, mode)


def run_to_end(df: DataFrame, folder: str, mode: str = "append", by: Sequence[str] = ()) -> DataFrame:
    """Process everything available now and return what was written, with ``batch_id``.

    Each micro-batch overwrites its own folder, so a batch that is repeated after a failure
    leaves no duplicates. Calling again with the same folder continues from the checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{folder}/out/batch_id={batch_id}")

    q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    return df.sparkSession.read.option("basePath", f"{folder}/out").schema(df.schema.add("batch_id", "long")).parquet(f"{folder}/out")


def upserted(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State of a keyed sink: per key the row of the latest batch."""
    return latest_per_key(written, list(keys), ["batch_id"]).drop("batch_id")


def run_to_table(df: DataFrame, folder: str, keys: Sequence[str], file_rows: int = FILE_ROWS, keep: int = 2) -> KeyedTable:
    """Process everything available now into a keyed table: each micro-batch replaces the rows of its keys.

    Only files that hold a changed key are read and written again, so a batch costs what it
    changes, however many came before; the last ``keep`` versions stay readable. A batch
    that is repeated after a failure finds its number in the table's ledger and does nothing.
    """
    table = KeyedTable(df.sparkSession, f"{folder}/table", keys, df.schema, file_rows, null_keys=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        _, mark = table.latest()
        if mark is None or batch_id > mark:
            table.merge(batch, dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), mark=batch_id)
            table.vacuum(keep)

    q = df.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    return table


class Inbox:
    """A folder that receives deliveries over time, and a job that can be stopped and resumed."""

    def __init__(self, spark: SparkSession, name: str, schema: StructType):
        self.spark, self.schema, self.folder = spark, schema, run_folder(spark, name)
        self.deliver(spark.createDataFrame([], schema))  # the folder must exist before it is watched

    def deliver(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.folder}/in")

    def stream(self) -> DataFrame:
        return file_stream(self.spark, f"{self.folder}/in", self.schema)

    def run(self, df: DataFrame, mode: str = "append") -> DataFrame:
        return run_to_end(df, f"{self.folder}/job", mode)
