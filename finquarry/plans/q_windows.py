"""Window functions. Row-level ones use the skew-safe forms; windows over a bounded calendar are plain."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finquarry.functions.exprs import dbl, dsum, pct, ratio
from finquarry.operators import relational as R
from finquarry.operators import skew
from finquarry.plans.registry import query
from finquarry.sources.banking import money

_ROWS = "o_custkey AS c, o_orderkey AS id, o_orderdate::DATE AS day, o_totalprice::DECIMAL(18,2) AS amount"
_W = "OVER (PARTITION BY c ORDER BY day, id)"


def rows(b):
    return b.table("orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"), money("o_totalprice").alias("amount"))


def sql(cols, extra=""):
    return f"SELECT {cols} FROM (SELECT {_ROWS} FROM orders) {extra}"


_MONTHS = "(SELECT date_trunc('month', o_orderdate)::DATE AS month, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1)"


def months(b):
    """One row per month: a bounded table, safe for a window without partitions."""
    return b.table("orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(dsum(money("o_totalprice")).alias("total"))


@query("win_row_number", sql(f"id, row_number() {_W} AS rn"))
def _(b):
    return skew.row_numbers(rows(b), "c", ["day", "id"], "rn").select("id", "rn")


_RANKS = "OVER (PARTITION BY l_suppkey ORDER BY l_quantity)"


def ranked(b):
    l = b.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return skew.value_ranks(l, "l_suppkey", "l_quantity")


@query("win_rank", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, rank() {_RANKS} AS rank FROM lineitem")
def _(b):
    return ranked(b).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rank")


@query("win_dense_rank", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, dense_rank() {_RANKS} AS rank FROM lineitem")
def _(b):
    return ranked(b).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("dense_rank").alias("rank"))


@query("win_percent_rank", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, percent_rank() {_RANKS} AS pr FROM lineitem")
def _(b):
    return ranked(b).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("percent_rank").alias("pr"))


@query("win_cume_dist", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, cume_dist() {_RANKS} AS cd FROM lineitem")
def _(b):
    return ranked(b).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("cume_dist").alias("cd"))


@query("win_ntile", "SELECT c_custkey, ntile(4) OVER (ORDER BY c_acctbal, c_custkey) AS quartile FROM customer")
def _(b):
    return skew.ntiles(b.table("customer").select("c_custkey", "c_acctbal"), [], ["c_acctbal", "c_custkey"], 4, "quartile").select("c_custkey", "quartile")


@query("win_lag", sql(f"id, amount::DOUBLE AS amount, lag(amount) {_W}::DOUBLE AS prev, (amount::DOUBLE - lag(amount) {_W}::DOUBLE) * 100.0::DOUBLE / nullif(lag(amount) {_W}::DOUBLE, 0) AS change_pct"))
def _(b):
    out = skew.neighbours(rows(b), "c", ["day", "id"], previous={"amount": "prev"})
    return out.select("id", "amount", "prev", pct(dbl("amount") - dbl("prev"), "prev").alias("change_pct"))


@query("win_lead", sql(f"id, lead(amount) {_W}::DOUBLE AS next, lead(day) {_W}::VARCHAR AS next_day"))
def _(b):
    return skew.neighbours(rows(b), "c", ["day", "id"], following={"amount": "next", "day": "next_day"}).select("id", "next", "next_day")


_FULL = "OVER (PARTITION BY c ORDER BY day, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


@query("win_first_last_value", sql(f"id, first_value(amount) {_FULL}::DOUBLE AS first_amount, last_value(amount) {_FULL}::DOUBLE AS last_amount"))
def _(b):
    at = F.struct("day", "id")
    ends = rows(b).groupBy("c").agg(F.min_by("amount", at).alias("first_amount"), F.max_by("amount", at).alias("last_amount"))
    return rows(b).join(ends, "c").select("id", "first_amount", "last_amount")


@query("win_nth_value", sql(f"id, nth_value(amount, 3) {_FULL}::DOUBLE AS third"))
def _(b):
    third = R.top_n_per_key(rows(b), ["c"], [F.col("day"), F.col("id")], 3).filter("rn = 3").select("c", F.col("amount").alias("third"))
    return rows(b).join(third, "c", "left").select("id", "third")


@query("win_running_total", sql(f"id, sum(amount) {_W}::DOUBLE AS running"))
def _(b):
    return skew.running_sum(rows(b), "c", ["day", "id"], "amount", "running").select("id", "running")


def _frame(name, frame, before, after):
    @query(name, sql(f"id, sum(amount) OVER (PARTITION BY c ORDER BY day, id ROWS BETWEEN {frame})::DOUBLE / count(amount) OVER (PARTITION BY c ORDER BY day, id ROWS BETWEEN {frame}) AS mean"))
    def _(b):
        out = skew.row_frame(rows(b), "c", ["day", "id"], before, after, {"s": F.sum("amount"), "n": F.count("amount")})
        return out.select("id", ratio("s", "n").alias("mean"))


_frame("win_moving_avg_3", "2 PRECEDING AND CURRENT ROW", 2, 0)
_frame("win_moving_avg_5_centred", "2 PRECEDING AND 2 FOLLOWING", 2, 2)
_frame("win_moving_avg_7", "6 PRECEDING AND CURRENT ROW", 6, 0)
_frame("win_trailing_excl_current", "24 PRECEDING AND 1 PRECEDING", 24, -1)


@query("win_range_interval", """SELECT event_id, count(*) OVER w AS n, sum(value::DECIMAL(18,2)) OVER w::DOUBLE AS total FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def _(b):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    e = b.table("events").select("event_id", "user_id", micros.alias("t"), money("value").alias("v"))
    return skew.trailing_range(e, "user_id", "t", 7 * 86400 * 1000000, {"n": F.lit(1), "total": "v"}).select("event_id", "n", "total")


@query("win_whole_partition", sql("id, sum(amount) OVER (PARTITION BY c)::DOUBLE AS total, count(*) OVER (PARTITION BY c) AS n"))
def _(b):
    per = rows(b).groupBy("c").agg(F.sum("amount").alias("total"), F.count("*").alias("n"))
    return rows(b).join(per, "c").select("id", "total", "n")


@query("win_pct_of_cumulative", f"SELECT month::VARCHAR AS month, total * 100.0::DOUBLE / sum(total::DECIMAL(28,2)) OVER (ORDER BY month)::DOUBLE AS share FROM {_MONTHS}")
def _(b):
    running = F.sum(F.col("total").cast("decimal(28,2)")).over(W.orderBy("month"))
    return months(b).select("month", ratio("total", running, 100.0).alias("share"))


@query("win_pct_of_total", sql("id, amount::DOUBLE * 100.0::DOUBLE / sum(amount) OVER (PARTITION BY c)::DOUBLE AS share"))
def _(b):
    per = rows(b).groupBy("c").agg(F.sum("amount").alias("t"))
    return rows(b).join(per, "c").select("id", ratio("amount", "t", 100.0).alias("share"))


@query("win_yoy", f"SELECT month::VARCHAR AS month, total, lag(total, 12) OVER (ORDER BY month) AS last_year, (total - lag(total, 12) OVER (ORDER BY month)) * 100.0::DOUBLE / lag(total, 12) OVER (ORDER BY month) AS growth FROM {_MONTHS}")
def _(b):
    # a dense month spine first, so that twelve rows back is one year back
    m = months(b)
    span = m.agg(F.min("month").alias("a"), F.max("month").alias("z")).select(F.explode(F.expr("sequence(a, z, interval 1 month)")).alias("month"))
    dense = span.join(m, "month", "left")
    prev = F.lag("total", 12).over(W.orderBy("month"))
    return dense.withColumn("last_year", prev).filter(F.col("total").isNotNull()).select("month", "total", "last_year", pct(F.col("total") - F.col("last_year"), "last_year").alias("growth"))


@query("win_trend", f"SELECT month::VARCHAR AS month, CASE WHEN total > lag(total) OVER (ORDER BY month) THEN 'UP' WHEN total < lag(total) OVER (ORDER BY month) THEN 'DOWN' ELSE 'STABLE' END AS trend FROM {_MONTHS}")
def _(b):
    p = F.lag("total").over(W.orderBy("month"))
    return months(b).select("month", F.when(F.col("total") > p, "UP").when(F.col("total") < p, "DOWN").otherwise("STABLE").alias("trend"))


@query("win_top_n_per_group", sql(f"c, id, row_number() OVER (PARTITION BY c ORDER BY amount DESC, id) AS rn", "QUALIFY rn <= 3"))
def _(b):
    return R.top_n_per_key(rows(b), ["c"], [F.desc("amount"), F.col("id")], 3).select("c", "id", "rn")


@query("win_nth_highest", "SELECT l_suppkey, max(l_quantity) AS second_highest FROM (SELECT l_suppkey, l_quantity, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r = 2 GROUP BY 1")
def _(b):
    values = b.table("lineitem").select("l_suppkey", "l_quantity").distinct()
    return R.top_n_per_key(values, ["l_suppkey"], [F.desc("l_quantity")], 2).filter("rn = 2").select("l_suppkey", F.col("l_quantity").alias("second_highest"))


@query("win_gap_between_events", sql(f"id, (day - lag(day) {_W})::BIGINT AS gap_days"))
def _(b):
    out = skew.neighbours(rows(b), "c", ["day", "id"], previous={"day": "prev"})
    return out.select("id", F.datediff("day", "prev").alias("gap_days"))


@query("win_first_event", sql("id, min(day) OVER (PARTITION BY c)::VARCHAR AS first_day, (day - min(day) OVER (PARTITION BY c))::BIGINT AS days_since"))
def _(b):
    first = rows(b).groupBy("c").agg(F.min("day").alias("first_day"))
    return rows(b).join(first, "c").select("id", "first_day", F.datediff("day", "first_day").alias("days_since"))


@query("win_avg_compare", "SELECT id, amount::DOUBLE AS amount FROM (SELECT *, sum(amount) OVER (PARTITION BY c)::DOUBLE / count(*) OVER (PARTITION BY c) AS m FROM (SELECT " + _ROWS + " FROM orders)) WHERE amount::DOUBLE > m")
def _(b):
    mean = rows(b).groupBy("c").agg(ratio(F.sum("amount"), F.count("*")).alias("m"))
    return rows(b).join(mean, "c").filter(dbl("amount") > F.col("m")).select("id", "amount")


@query("win_partition_skew", "SELECT c_nationkey::BIGINT AS part, n, n / avg(n) OVER () AS skew FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)")
def _(b):
    from finquarry.operators.layout import partition_stats

    return partition_stats(b.table("customer"), "c_nationkey").select(F.col("c_nationkey").alias("part"), F.col("row_count").alias("n"), F.col("skew_ratio").alias("skew"))
