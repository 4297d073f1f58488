"""Table functions: registered once, called from SQL or on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEALTHY, STALE = 300, 3600  # seconds since the last sync


def positions(log: DataFrame) -> DataFrame:
    """Loaded positions reduced to the last of each table and day, so that a partition of the function is short.

    A table with very many loads is combined on the map side; the function sees a row per day.
    """
    day = F.floor(F.col("synced_at") / 86400)
    return log.groupBy("table_name", day.alias("day")).agg(F.max("lsn").alias("lsn"), F.max("synced_at").alias("synced_at")).drop("day")


@F.udtf(returnType="table_name string, last_lsn bigint, minutes_since_sync bigint, status string", useArrow=True)
class CdcTableStatus:
    """Position, age and state of each table in a table argument partitioned by table name.

    The state is kept from row to row, and the one result row comes out at a partition's end.
    """

    def __init__(self):
        self.name, self.lsn, self.synced, self.now = None, None, None, None

    def eval(self, row, now):
        self.name, self.now = row["table_name"], now
        if row["lsn"] is not None:
            self.lsn = max(row["lsn"], self.lsn if self.lsn is not None else row["lsn"])
        if row["synced_at"] is not None:
            self.synced = max(row["synced_at"], self.synced if self.synced is not None else row["synced_at"])

    def terminate(self):
        if self.now is None:  # an empty partition
            return
        age = None if self.synced is None else self.now - self.synced
        state = "Critical" if age is None or age >= STALE else "Stale" if age >= HEALTHY else "Healthy"
        yield self.name, self.lsn, None if age is None else age // 60, state


def register(spark: SparkSession) -> None:
    """Make the table functions callable from SQL in this session."""
    spark.udtf.register("cdc_table_status", CdcTableStatus.asDeterministic())
