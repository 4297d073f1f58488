"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "finquarry"):
    """A session with UTC timestamps, AQE (coalescing and skew joins) and dynamic partition overwrite.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: spark-submit decides.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster set it.

    Only where nothing is set (tests on one machine) is a folder of our own made; it is
    removed when the process ends.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="finquarry-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set(CHECKPOINT_KEY, folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for one run of one job."""
    return f"{shared_folder(spark)}/finquarry/{name}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of ours in the store, if it is there."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write to a fresh path of the shared folder and read back.

    Cuts the lineage as a checkpoint does, and the size estimates too: those of a checkpoint
    are carried on, and multiply in loops that join a table with itself.
    """
    path = run_folder(df.sparkSession, "rounds")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", "8"))
