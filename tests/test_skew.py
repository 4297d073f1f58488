"""Hot-key forms against plain windows; one key owns a third of the rows."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finquarry.operators import skew


@pytest.fixture(scope="module")
def skewed(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 101 = 0 THEN NULL ELSE id % 50 END AS k", "(id * 7919) % 1009 AS t", "CAST((id * 31) % 977 AS decimal(18,2)) AS v", "CASE WHEN id % 97 = 0 THEN id END AS x")
    return df.cache()


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left = sorted(map(str, a.select(*cols).collect()))
    right = sorted(map(str, b.select(*cols).collect()))
    assert left == right


@pytest.fixture
def plain(spark):
    return W.partitionBy("k").orderBy("t", "id")


def test_hot_keys_are_cut_in_proportion_to_their_rows(spark, skewed):
    c = skew.cut(skewed, "k", ["t", "id"], limit=40)
    sizes = {}
    for r in c.rows.groupBy("k", "_chunk").count().collect():
        sizes.setdefault(r.k, []).append(r["count"])
    assert len(sizes[0]) > 10 and max(sizes[0]) < 400
    assert all(len(v) == 1 for k, v in sizes.items() if len(v) < skew.MIN_POINTS)


def test_small_inputs_stay_whole(skewed):
    assert skew.cut(skewed, "k", ["t", "id"], limit=10_000_000).rows.filter("_chunk > 0").isEmpty()


def test_no_job_runs_while_a_plan_is_built(spark, skewed):
    skewed.count()
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        skew.running(skewed, "k", ["t", "id"], {"s": "v"})
        skew.ntiles(skewed, [], ["t", "id"], 5, "o")
        skew.row_frame(skewed, "k", ["t", "id"], 2, 2, {"s": F.sum("v")})
        skew.trailing_range(skewed, "k", "t", 5, {"a": F.lit(1)})
        skew.quantiles(skewed, "k", "v", {"a": 0.5})
        assert not status.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def crowded(spark):
    """A hundred hot keys, and one key with 20,000 rows at a single time."""
    hot = spark.range(60_000).selectExpr("id", "id % 100 AS k", "(id * 7919) % 5003 AS t", "CAST((id * 31) % 977 AS decimal(18,2)) AS v", "CASE WHEN id % 97 = 0 THEN id END AS x")
    still = spark.range(60_000, 80_000).selectExpr("id", "100L AS k", "77L AS t", "CAST(id % 13 AS decimal(18,2)) AS v", "CASE WHEN id % 970 = 0 THEN id END AS x")
    return hot.unionByName(still).cache()


def test_a_hundred_hot_keys_and_one_crowded_time(plain, crowded, tiny_chunks):
    up = plain.rowsBetween(W.unboundedPreceding, 0)
    sizes = skew.cut(crowded, "k", ["t", "id"]).rows.groupBy("k", "_chunk").count()
    assert sizes.groupBy("k").count().filter("count < 5").isEmpty() and sizes.agg(F.max("count")).first()[0] < 500
    same(skew.running(crowded, "k", ["t", "id"], {"s": "v"}), crowded.withColumn("s", F.sum("v").over(up)))
    same(skew.neighbours(crowded, "k", ["t", "id"], {"v": "p"}, {"id": "n"}), crowded.withColumns({"p": F.lag("v").over(plain), "n": F.lead("id").over(plain)}))
    same(skew.carry_last(crowded, "k", ["t", "id"], "x", "o"), crowded.withColumn("o", F.last("x", True).over(up)))
    f = plain.rowsBetween(-30, 3)
    same(skew.row_frame(crowded, "k", ["t", "id"], 30, 3, {"s": F.sum("v")}), crowded.withColumn("s", F.sum("v").over(f)))
    w = W.partitionBy("k").orderBy("t").rangeBetween(-100, 0)
    same(skew.trailing_range(crowded, "k", "t", 100, {"a": F.lit(1), "b": "v"}), crowded.withColumns({"a": F.count("*").over(w), "b": F.sum("v").over(w)}))
    same(skew.ntiles(crowded, "k", ["t", "id"], 7, "o"), crowded.withColumn("o", F.ntile(7).over(plain).cast("bigint")))


def test_points_are_bounded_whatever_the_input(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_POINTS", 64)
    df = spark.range(20_000).selectExpr("id", "id % 4 AS k", "id AS v")
    c = skew.cut(df, "k", ["id"], limit=10)
    per = {r["_p_k"]: len(r["_points"]) for r in c.points.collect()}
    assert sum(per.values()) == 64 and min(per.values()) >= 5  # every hot key has its share
    same(skew.running(df, "k", ["id"], {"s": "v"}, limit=10), df.withColumn("s", F.sum("v").over(W.partitionBy("k").orderBy("id").rowsBetween(W.unboundedPreceding, 0))))


def test_running_and_numbers(plain, skewed, tiny_chunks):
    up = plain.rowsBetween(W.unboundedPreceding, 0)
    same(skew.running(skewed, "k", ["t", "id"], {"s": "v", "n": F.lit(1).cast("bigint")}), skewed.withColumn("s", F.sum("v").over(up)).withColumn("n", F.row_number().over(plain).cast("bigint")))


def test_neighbours(plain, skewed, tiny_chunks):
    got = skew.neighbours(skewed, "k", ["t", "id"], {"v": "p", "x": "px"}, {"id": "n"})
    same(got, skewed.withColumns({"p": F.lag("v").over(plain), "px": F.lag("x").over(plain), "n": F.lead("id").over(plain)}))


def test_carry_last(plain, skewed, tiny_chunks):
    up = plain.rowsBetween(W.unboundedPreceding, 0)
    same(skew.carry_last(skewed, "k", ["t", "id"], "x", "o"), skewed.withColumn("o", F.last("x", True).over(up)))


def test_trailing_ranges_of_null_times_and_values(spark, tiny_chunks):
    df = spark.range(900).selectExpr("id", "CASE WHEN id % 5 > 0 THEN id % 2 END AS k", "CASE WHEN id % 7 > 0 THEN id % 60 END AS t", "CASE WHEN id % 60 > 20 THEN id END AS v")
    w = W.partitionBy("k").orderBy("t").rangeBetween(-4, 0)
    same(skew.trailing_range(df, "k", "t", 4, {"a": F.lit(1), "b": "v"}), df.withColumns({"a": F.count("*").over(w), "b": F.sum("v").over(w)}))
    with pytest.raises(ValueError):
        skew.trailing_range(df.withColumn("v", F.col("v").cast("double")), "k", "t", 4, {"b": "v"})


@pytest.mark.parametrize(("before", "after"), [(2, 0), (2, 2), (24, -1), (60, 0)])
def test_row_frames(plain, skewed, tiny_chunks, before, after):
    f = plain.rowsBetween(-before, after)
    got = skew.row_frame(skewed, "k", ["t", "id"], before, after, {"s": F.sum("v"), "n": F.count("*")})
    same(got, skewed.withColumns({"s": F.sum("v").over(f), "n": F.count("*").over(f)}))


def test_trailing_ranges(plain, skewed, tiny_chunks):
    w = W.partitionBy("k").orderBy("t")
    got = skew.trailing_ranges(skewed, "k", "t", {5: {"a": F.lit(1)}, 200: {"b": "v"}})
    same(got, skewed.withColumns({"a": F.count("*").over(w.rangeBetween(-5, 0)), "b": F.sum("v").over(w.rangeBetween(-200, 0))}))


def test_ranks(plain, skewed, tiny_chunks):
    known = skewed.filter("k IS NOT NULL")
    w = W.partitionBy("k").orderBy("v")
    want = known.withColumns({"rank": F.rank().over(w).cast("bigint"), "dense_rank": F.dense_rank().over(w).cast("bigint"), "percent_rank": F.percent_rank().over(w), "cume_dist": F.cume_dist().over(w)})
    same(skew.value_ranks(known, "k", "v"), want)


@pytest.mark.parametrize("n", [1, 4, 5, 7, 4000])
def test_global_ntiles(plain, skewed, tiny_chunks, n):
    got = skew.ntiles(skewed.select("id", "t"), [], ["t", "id"], n, "o")
    same(got, skewed.select("id", "t").withColumn("o", F.ntile(n).over(W.orderBy("t", "id")).cast("bigint")))


def test_keyed_ntiles(plain, skewed, tiny_chunks):
    known = skewed.filter("k IS NOT NULL")
    same(skew.ntiles(known, "k", ["t", "id"], 5, "o"), known.withColumn("o", F.ntile(5).over(plain).cast("bigint")))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, skewed, how):
    right = spark.range(40).selectExpr("id AS k", "id * 2 AS z")
    same(skew.salted_join(skewed, right, "k", how=how), skewed.join(right, "k", how))


def test_broadcast_by_measured_size(spark):
    """Small after a filter that no estimate sees through; the large one is not broadcast."""
    big = spark.range(200_000).selectExpr("id AS k", "id AS v", "repeat('x', 200) AS pad")
    final = lambda df: (df.count(), df._jdf.queryExecution().executedPlan().toString())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
    try:
        few = skew.join_measured(big.select("k", "v"), big.filter("v % 1000 = 7").select("k", "pad"), "k")
        assert few.collect() and "BroadcastHashJoin" in final(few)[1] and few.count() == 200
        many = skew.join_measured(big.select("k", "v"), big.select("k", "pad"), "k")
        many.write.format("noop").mode("overwrite").save()
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exact_quantiles(skewed, tiny_chunks):
    known = skewed.filter("k IS NOT NULL")
    got = {r.k: (r.a, r.b) for r in skew.quantiles(known, "k", "v", {"a": 0.5, "b": 0.9}).collect()}
    want = {r.k: (r.a, r.b) for r in known.groupBy("k").agg(F.percentile(F.col("v").cast("double"), 0.5).alias("a"), F.percentile(F.col("v").cast("double"), 0.9).alias("b")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_tiles_by_exact_times_and_decimals(spark, tiny_chunks):
    df = spark.range(400).selectExpr("id", "timestamp_micros(1700000000000000 + (id * 37) % 50) AS at", "CAST(id % 7 + 12345678901234567890.01 AS decimal(38,2)) AS big", "CAST(timestamp_micros(1700000000000000 + (id * 11) % 30) AS timestamp_ntz) AS wall")
    for order in (["at", "id"], ["big", "id"], ["wall", "id"]):
        same(skew.ntiles(df, [], order, 9, "o"), df.withColumn("o", F.ntile(9).over(W.orderBy(*order)).cast("bigint")))
