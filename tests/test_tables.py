"""Table functions, held and coalesced rows."""

from pyspark.sql import functions as F

from finquarry.functions import tables as U
from finquarry.operators import layout as L


def test_status_of_each_table(spark, rows):
    log = rows("table_name string, lsn bigint, synced_at bigint", [("a", 5, 1000), ("a", 9, 900), ("b", None, 500), ("c", 1, None), ("d", 7, -90000), ("d", 6, 800)])
    U.register(spark)
    got = spark.sql("SELECT * FROM cdc_table_status(TABLE({log}) PARTITION BY (table_name), 1100)", log=U.positions(log))
    want = [("a", 9, 1, "Healthy"), ("b", None, 10, "Stale"), ("c", 1, None, "Critical"), ("d", 7, 5, "Stale")]
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, U.CdcTableStatus(log.asTable().partitionBy("table_name"), F.lit(1100)).collect())) == want
    assert U.CdcTableStatus(log.limit(0).asTable().partitionBy("table_name"), F.lit(1100)).count() == 0


def test_held_rows_are_shuffled_once(spark):
    held = L.held(spark.range(1000).selectExpr("id % 7 AS k", "id AS v"), ["k"])
    try:
        both = held.groupBy("k").agg(F.sum("v").alias("s")).join(held.groupBy("k").agg(F.count("*").alias("n")), "k")
        assert sorted(r.n for r in both.collect()) == [142, 143, 143, 143, 143, 143, 143]
        plan = both._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        assert "Exchange hashpartitioning" not in plan and "InMemoryTableScan" in plan
    finally:
        held.unpersist()


def test_coalesced_rows_are_not_shuffled(spark):
    out = L.coalesced(spark.range(0, 1000, 1, 20).filter("id % 100 = 0"), 3)
    assert out.rdd.getNumPartitions() == 3 and out.count() == 10
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
