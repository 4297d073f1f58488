"""Projections, filters, joins, aggregates, set operations, recursion and reshaping."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finquarry.functions.exprs import band, davg, dbl, dstd, dsum, pct, ratio, sum_if
from finquarry.operators import relational as R
from finquarry.operators import skew
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF, money

# --- projections and filters ---------------------------------------------------------------


@query("project_alias", "SELECT c_custkey AS customer_id, upper(c_name) AS name, c_acctbal * 2 AS double_balance FROM customer")
def _(b):
    return b.table("customer").select(F.col("c_custkey").alias("customer_id"), F.upper("c_name").alias("name"), (F.col("c_acctbal") * 2).alias("double_balance"))


@query("derived_columns", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, (price * l_quantity::DECIMAL(5,0))::DOUBLE AS gross FROM b_lines")
def _(b):
    return b.order_lines().select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("price") * F.col("l_quantity").cast("decimal(5,0)")).alias("gross"))


@query("filter_not_null", "SELECT customer_id, balance::DOUBLE AS balance FROM b_snap_new WHERE balance IS NOT NULL")
def _(b):
    return b.snapshot_new().filter(F.col("balance").isNotNull()).select("customer_id", "balance")


@query("filter_not_empty", "SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND trim(text) <> ''")
def _(b):
    return b.table("documents").filter(F.col("text").isNotNull() & (F.trim("text") != "")).select("doc_id", "lang")


@query("filter_range", "SELECT loan_id, interest_rate::DOUBLE AS interest_rate FROM b_loans WHERE interest_rate BETWEEN 0 AND 20 AND disbursement_date >= DATE '1998-01-01' AND disbursement_date <= DATE '2001-08-02' AND principal_amount > 0")
def _(b):
    c = F.col
    return b.loans().filter(c("interest_rate").between(0, 20) & (c("disbursement_date") >= "1998-01-01") & (c("disbursement_date") <= AS_OF) & (c("principal_amount") > 0)).select("loan_id", "interest_rate")


@query("predicate_in", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT','5-LOW')")
def _(b):
    return b.table("orders").filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


@query("predicate_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000")
def _(b):
    return b.table("orders").filter(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


@query("predicate_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def _(b):
    return b.table("part").filter(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


@query("predicate_regex", "SELECT doc_id FROM documents WHERE regexp_matches(text, '[a-z0-9.]+@[a-z0-9-]+[.][a-z]+')")
def _(b):
    return b.table("documents").filter(F.col("text").rlike("[a-z0-9.]+@[a-z0-9-]+[.][a-z]+")).select("doc_id")


@query("case_when_banding", "SELECT c_custkey, CASE WHEN c_acctbal > 7500 THEN 'HIGH' WHEN c_acctbal > 2500 THEN 'MEDIUM' WHEN c_acctbal > 0 THEN 'LOW' ELSE 'NEGATIVE' END AS band FROM customer")
def _(b):
    return b.table("customer").select("c_custkey", band(F.col("c_acctbal"), [(7500, "HIGH"), (2500, "MEDIUM"), (0, "LOW")], "NEGATIVE").alias("band"))


@query("null_logic", "SELECT customer_id, coalesce(balance, 0)::DOUBLE AS balance, nullif(nation, 0)::BIGINT AS nation, balance IS NULL AS is_missing FROM b_snap_new")
def _(b):
    return b.snapshot_new().select("customer_id", F.coalesce("balance", F.lit(0)).alias("balance"), F.nullif("nation", F.lit(0)).alias("nation"), F.col("balance").isNull().alias("is_missing"))


@query("having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def _(b):
    return b.table("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 12")


@query("qualify", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def _(b):
    best = R.latest_per_key(b.table("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_totalprice", -F.col("o_orderkey")])
    return best.select("o_custkey", "o_orderkey")


@query("sargable_rewrite", "SELECT count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders WHERE year(o_orderdate) = 1997 AND (o_orderstatus = 'F' OR o_orderstatus = 'O')")
def _(b):
    d = F.col("o_orderdate")
    rows = b.table("orders").filter((d >= F.lit("1997-01-01").cast("timestamp_ntz")) & (d < F.lit("1998-01-01").cast("timestamp_ntz")) & F.col("o_orderstatus").isin("F", "O"))
    return rows.agg(F.count("*").alias("n"), dsum(money("o_totalprice")).alias("total"))


@query("obt_flatten", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, revenue::DOUBLE AS revenue, o_orderstatus, c_mktsegment, n_name, r_name, p_brand, s_name
    FROM b_lines LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def _(b):
    lines = b.order_lines().select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "revenue")
    wide = R.flatten_star(lines, [
        (b.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "l_orderkey", "o_orderkey"),
        (b.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "o_custkey", "c_custkey"),
        (b.table("nation"), "c_nationkey", "n_nationkey"),
        (b.table("region"), "n_regionkey", "r_regionkey"),
        (b.table("part").select("p_partkey", "p_brand"), "l_partkey", "p_partkey"),
        (b.table("supplier").select("s_suppkey", "s_name"), "l_suppkey", "s_suppkey"),
    ])
    return wide.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "revenue", "o_orderstatus", "c_mktsegment", "n_name", "r_name", "p_brand", "s_name")


# --- joins -----------------------------------------------------------------------------------


@query("join_inner", """SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def _(b):
    o, c, n = b.table("orders"), b.table("customer"), b.table("nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select("o_orderkey", "c_name", "n_name")


@query("join_left", """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) n FROM orders WHERE o_totalprice > 400000 GROUP BY 1) ON c_custkey = o_custkey""")
def _(b):
    n = b.table("orders").filter("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return b.table("customer").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("join_right", "SELECT p_partkey, l_orderkey FROM lineitem RIGHT JOIN part ON l_partkey = p_partkey")
def _(b):
    l, p = b.table("lineitem"), b.table("part")
    return l.join(p, l.l_partkey == p.p_partkey, "right").select("p_partkey", "l_orderkey")


@query("join_full_outer", "SELECT coalesce(a.customer_id, z.customer_id) AS customer_id, a.nation::BIGINT AS old_nation, z.nation::BIGINT AS new_nation FROM b_snap_old a FULL JOIN b_snap_new z ON a.customer_id = z.customer_id")
def _(b):
    old = b.snapshot_old().select("customer_id", F.col("nation").alias("old_nation"))
    return old.join(b.snapshot_new().select("customer_id", F.col("nation").alias("new_nation")), "customer_id", "full")


@query("join_self", "SELECT e.c_custkey AS employee, m.c_name AS manager FROM customer e LEFT JOIN customer m ON e.c_custkey // 10 = m.c_custkey AND e.c_custkey > 0")
def _(b):
    e = b.table("customer").select(F.col("c_custkey").alias("employee"), F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 10)).alias("boss"))
    m = b.table("customer").select(F.col("c_custkey").alias("boss"), F.col("c_name").alias("manager"))
    return e.join(m, "boss", "left").select("employee", "manager")


@query("join_cross", """SELECT n_name, m.month, coalesce(v, 0) AS orders FROM nation CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
    LEFT JOIN (SELECT c_nationkey, month(o_orderdate) AS mo, count(*) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) x ON n_nationkey = c_nationkey AND m.month = mo""")
def _(b):
    # the scaffold (every nation with every month) comes from exploding twelve months per nation
    frame = b.table("nation").withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    o, c = b.table("orders"), b.table("customer")
    v = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("n_nationkey"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("v"))
    return frame.join(v, ["n_nationkey", "month"], "left").select("n_name", "month", F.coalesce("v", F.lit(0)).alias("orders"))


@query("join_natural", "SELECT doc_id, lang, quality::BIGINT AS quality FROM documents NATURAL JOIN labels")
def _(b):
    d, l = b.table("documents").select("doc_id", "lang"), b.table("labels").select("doc_id", "quality")
    return d.join(l, sorted(set(d.columns) & set(l.columns))).select("doc_id", "lang", "quality")


@query("join_lateral_top_n", """SELECT c_custkey, o_orderkey, o_totalprice FROM customer, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)""")
def _(b):
    top = R.top_n_per_key(b.table("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return b.table("customer").join(top, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey", "o_totalprice")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def _(b):
    o = b.table("orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return b.table("customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def _(b):
    return R.anti_orphans(b.table("customer"), b.table("orders").filter("o_totalprice > 300000"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("join_not_in", "SELECT customer_id, name FROM b_snap_new WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_old)")
def _(b):
    return R.anti_orphans(b.snapshot_new(), b.snapshot_old(), "customer_id", "customer_id").select("customer_id", "name")


@query("join_interval", """SELECT a.event_id, count(*) AS n_1h, sum(z.value::DECIMAL(18,2))::DOUBLE AS sum_1h FROM events a JOIN events z ON a.user_id = z.user_id
    AND epoch(date_trunc('second', z.ts)) BETWEEN epoch(date_trunc('second', a.ts)) - 3600 AND epoch(date_trunc('second', a.ts)) GROUP BY 1""")
def _(b):
    e = b.table("events").select("event_id", "user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"), money("value").alias("v"))
    return skew.trailing_range(e, "user_id", "t", 3600, {"n_1h": F.lit(1), "sum_1h": "v"}).select("event_id", "n_1h", "sum_1h")


@query("join_first_seen", """SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def _(b):
    e = b.table("events").select("user_id", "event_type", "event_id", "ts")
    return R.first_per_key(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


def _versions(b):
    """Two versions per customer: before and from the middle of 1998."""
    old = b.snapshot_old().select("customer_id", "nation", F.lit("1990-01-01").cast("date").alias("valid_from"), F.lit("1998-07-01").cast("date").alias("valid_to"))
    new = b.snapshot_old().select("customer_id", ((F.col("nation") + 1) % 25).cast("int").alias("nation"), F.lit("1998-07-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return old.unionByName(new)


@query("join_scd2_point_in_time", """WITH v AS (SELECT customer_id, nation, DATE '1990-01-01' AS f, DATE '1998-07-01' AS t FROM b_snap_old UNION ALL SELECT customer_id, (nation + 1) % 25, DATE '1998-07-01', NULL FROM b_snap_old)
    SELECT o_orderkey, nation::BIGINT AS nation FROM orders JOIN v ON o_custkey = customer_id AND o_orderdate::DATE >= f AND (t IS NULL OR o_orderdate::DATE < t)""")
def _(b):
    o = b.table("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("day"))
    return R.join_versions(o, _versions(b), "customer_id", "day", "valid_from", "valid_to").select("o_orderkey", "nation")


@query("join_as_of", """SELECT e.event_id, p.value AS last_purchase FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def _(b):
    e = b.table("events")
    buys = e.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), "value")
    return R.join_as_of(e.select("event_id", "user_id", "ts"), buys, "user_id", "ts", "bought", "value", "last_purchase", "event_id").select("event_id", "last_purchase")


@query("join_or_condition", """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey OR o_orderkey = c_custkey) AS n FROM customer""")
def _(b):
    """An OR of two equalities, counted as two equi-aggregates less the rows that match both."""
    o = b.table("orders").select("o_custkey", "o_orderkey")
    per = lambda rows, k: rows.groupBy(F.col(k).alias("c_custkey")).agg(F.count("*").alias("n"))
    parts = per(o, "o_custkey").unionByName(per(o.filter("o_custkey <> o_orderkey"), "o_orderkey"))
    n = parts.groupBy("c_custkey").agg(F.sum("n").alias("n"))
    return b.table("customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("join_broadcast", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(b):
    n = b.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return skew.join_measured(b.table("supplier"), n, "s_nationkey").select("s_suppkey", "n_name")


@query("join_skew_salt", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def _(b):
    l = b.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = b.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return skew.salted_join(l, s, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query("federated_view", """SELECT c_custkey, o.n AS orders, e.n AS events, d.n AS documents FROM customer LEFT JOIN (SELECT o_custkey, count(*) n FROM orders GROUP BY 1) o ON c_custkey = o_custkey
    LEFT JOIN (SELECT user_id, count(*) n FROM events GROUP BY 1) e ON c_custkey = user_id LEFT JOIN (SELECT doc_id, count(*) n FROM documents GROUP BY 1) d ON c_custkey = doc_id""")
def _(b):
    count = lambda t, k, n: b.table(t).groupBy(F.col(k).alias("c_custkey")).agg(F.count("*").alias(n))
    out = b.table("customer").select("c_custkey")
    for t, k, n in (("orders", "o_custkey", "orders"), ("events", "user_id", "events"), ("documents", "doc_id", "documents")):
        out = out.join(count(t, k, n), "c_custkey", "left")
    return out


_REGION_SQL = """SELECT r_name, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""


@query("join_snowflake_path", _REGION_SQL)
def _(b):
    wide = R.flatten_star(b.table("orders"), [(b.table("customer"), "o_custkey", "c_custkey"), (b.table("nation"), "c_nationkey", "n_nationkey"), (b.table("region"), "n_regionkey", "r_regionkey")])
    return wide.groupBy("r_name").agg(dsum(money("o_totalprice")).alias("total"))


@query("join_star_path", _REGION_SQL)
def _(b):
    """The dimension carries the region already: one join, after the fact has been summed per customer."""
    dim = R.flatten_star(b.table("customer"), [(b.table("nation"), "c_nationkey", "n_nationkey"), (b.table("region"), "n_regionkey", "r_regionkey")]).select(F.col("c_custkey").alias("o_custkey"), "r_name")
    per = b.table("orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("t"))
    return per.join(dim, "o_custkey").groupBy("r_name").agg(dsum("t").alias("total"))


# --- aggregates ----------------------------------------------------------------------------


@query("agg_basic", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(price)::DOUBLE AS total, sum(price)::DOUBLE / count(*) AS mean, min(price)::DOUBLE AS low, max(price)::DOUBLE AS high FROM b_lines GROUP BY ALL")
def _(b):
    return b.order_lines().groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), dsum("price").alias("total"), davg("price").alias("mean"), F.min("price").alias("low"), F.max("price").alias("high"))


@query("agg_stat", """SELECT l_returnflag, sqrt((q - s * s / n) / (n - 1)) AS sd, (q - s * s / n) / (n - 1) AS variance FROM
    (SELECT l_returnflag, count(*) AS n, sum(price)::DOUBLE AS s, sum((price * price)::DECIMAL(38,4))::DOUBLE AS q FROM b_lines GROUP BY 1)""")
def _(b):
    out = b.order_lines().groupBy("l_returnflag").agg(dstd("price").alias("sd"), F.count("*").alias("n"), dsum("price").alias("s"), dsum((F.col("price") * F.col("price")).cast("decimal(38,4)")).alias("q"))
    return out.select("l_returnflag", "sd", ((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)).alias("variance"))


@query("agg_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def _(b):
    return b.table("lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"))


@query("agg_conditional", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, coalesce(sum(o_totalprice::DECIMAL(18,2)) FILTER (WHERE o_totalprice > 250000)::DOUBLE, 0) AS large FROM orders GROUP BY 1")
def _(b):
    return b.table("orders").groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("done"), sum_if(F.col("o_totalprice") > 250000, money("o_totalprice")).alias("large"))


@query("agg_ratio", "SELECT user_id, count(*) FILTER (WHERE event_type = 'error') * 100.0::DOUBLE / nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS errors_per_100_clicks FROM events GROUP BY 1")
def _(b):
    t = F.col("event_type")
    return b.table("events").groupBy("user_id").agg(pct(F.count_if(t == "error"), F.count_if(t == "click")).alias("errors_per_100_clicks"))


@query("agg_approx_distinct", "SELECT l_returnflag, true AS within_ten_percent FROM lineitem GROUP BY 1")
def _(b):
    out = b.table("lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("a"), F.countDistinct("l_partkey").alias("e"))
    return out.select("l_returnflag", (F.abs(F.col("a") - F.col("e")) <= F.col("e") * 0.1).alias("within_ten_percent"))


@query("agg_approx_quantile", "SELECT l_returnflag, true AS within_two_percent FROM lineitem GROUP BY 1")
def _(b):
    out = b.table("lineitem").groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", 0.5, 10000).alias("m"), F.count("*").alias("n"))
    below = b.table("lineitem").join(out, "l_returnflag").groupBy("l_returnflag").agg(F.count_if(F.col("l_extendedprice") <= F.col("m")).alias("k"), F.count("*").alias("n"))
    return below.select("l_returnflag", (F.abs(F.col("k") / F.col("n") - 0.5) < 0.02).alias("within_two_percent"))


@query("agg_percentile", "SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1")
def _(b):
    return skew.quantiles(b.table("lineitem"), "l_returnflag", "l_quantity", {"p25": 0.25, "p90": 0.9})


@query("agg_median", "SELECT event_type, median(value) AS median_value FROM events GROUP BY 1")
def _(b):
    return skew.quantiles(b.table("events"), "event_type", "value", {"median_value": 0.5})


@query("agg_string", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def _(b):
    # distinct first: at most one short text per priority remains, however many orders a customer has
    few = b.table("orders").select("o_custkey", "o_orderpriority").distinct()
    return few.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("o_orderpriority")), ", ").alias("priorities"))


@query("agg_array", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS kinds, count(DISTINCT event_type) AS n FROM events GROUP BY 1")
def _(b):
    return b.table("events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("a")).select("user_id", F.array_join("a", "|").alias("kinds"), F.size("a").alias("n"))


@query("agg_bool", "SELECT o_custkey, bool_or(o_totalprice > 450000) AS any_large, bool_and(o_totalprice > 50000) AS all_over FROM orders GROUP BY 1")
def _(b):
    return b.table("orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 450000).alias("any_large"), F.bool_and(F.col("o_totalprice") > 50000).alias("all_over"))


@query("agg_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber::BIGINT AS l_linenumber FROM lineitem")
def _(b):
    return b.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("agg_partial_then_final", """SELECT c_custkey, coalesce(o.n, 0) AS orders, coalesce(e.v, 0) AS spend FROM customer LEFT JOIN (SELECT o_custkey, count(*) n FROM orders GROUP BY 1) o ON c_custkey = o_custkey
    LEFT JOIN (SELECT user_id, sum(value::DECIMAL(18,2))::DOUBLE v FROM events GROUP BY 1) e ON c_custkey = user_id""")
def _(b):
    o = b.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    e = b.table("events").groupBy(F.col("user_id").alias("c_custkey")).agg(dsum(money("value")).alias("v"))
    return b.table("customer").join(o, "c_custkey", "left").join(e, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("v", F.lit(0.0)).alias("spend"))


def _keyed(keys):
    return "SELECT l_returnflag, l_linestatus, l_linenumber::BIGINT AS l_linenumber, count(*) AS n FROM lineitem GROUP BY " + keys


@query("agg_grouping_sets", _keyed("GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())"))
def _(b):
    l = b.table("lineitem")
    return l.groupingSets([[l.l_returnflag, l.l_linestatus], [l.l_linenumber], []], l.l_returnflag, l.l_linestatus, l.l_linenumber).agg(F.count("*").alias("n"))


@query("agg_rollup", _keyed("ROLLUP (l_returnflag, l_linestatus, l_linenumber)"))
def _(b):
    return b.table("lineitem").rollup("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query("agg_cube", _keyed("CUBE (l_returnflag, l_linestatus, l_linenumber)"))
def _(b):
    return b.table("lineitem").cube("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query("agg_daily_snapshot", "SELECT ship_date::VARCHAR AS ship_date, l_suppkey, l_partkey, count(*) AS n, sum(l_quantity::DECIMAL(9,0))::DOUBLE AS quantity, sum(revenue)::DOUBLE AS revenue FROM b_lines GROUP BY ALL")
def _(b):
    return b.order_lines().groupBy("ship_date", "l_suppkey", "l_partkey").agg(F.count("*").alias("n"), dsum(F.col("l_quantity").cast("decimal(9,0)")).alias("quantity"), dsum("revenue").alias("revenue"))


@query("agg_over_agg", """SELECT month, total, total - lag(total) OVER (ORDER BY month) AS change FROM (SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS month, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1)""")
def _(b):
    m = b.table("orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(dsum(money("o_totalprice")).alias("total"))
    return m.withColumn("change", F.col("total") - F.lag("total").over(W.orderBy("month")))


@query("agg_semi_additive", """SELECT c_nationkey::BIGINT AS branch, sum(p)::DOUBLE AS closing FROM (SELECT o_custkey, max_by(o_totalprice::DECIMAL(18,2), (o_orderdate, o_orderkey)) AS p FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(b):
    """Balances add up over accounts, but over time only the last one counts."""
    last = b.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by(money("o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("p"))
    return last.join(b.table("customer"), "c_custkey").groupBy(F.col("c_nationkey").alias("branch")).agg(dsum("p").alias("closing"))


# --- sort, limit ------------------------------------------------------------------------------


@query("sort_multi", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END::BIGINT AS rank FROM orders ORDER BY 2, 1")
def _(b):
    p = F.col("o_orderpriority")
    rank = F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).otherwise(3)
    return b.table("orders").select("o_orderkey", rank.alias("rank")).orderBy("rank", "o_orderkey")


@query("limit_topk", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def _(b):
    return b.table("customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)


@query("limit_offset", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10 OFFSET 5")
def _(b):
    return b.table("customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").offset(5).limit(10)


@query("batch_keyset", "SELECT event_id, user_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 1000")
def _(b):
    return b.table("events").filter("event_id > 500").select("event_id", "user_id").orderBy("event_id").limit(1000)


# --- set operations -------------------------------------------------------------------------------


@query("set_union_all", "SELECT customer_id, balance::DOUBLE AS balance, NULL::VARCHAR AS kind FROM b_snap_old UNION ALL SELECT user_id, NULL, event_type FROM events")
def _(b):
    e = b.table("events").select(F.col("user_id").alias("customer_id"), F.col("event_type").alias("kind"))
    return b.snapshot_old().select("customer_id", "balance").unionByName(e, allowMissingColumns=True)


@query("set_union", "SELECT c_nationkey::BIGINT AS k FROM customer UNION SELECT s_nationkey::BIGINT FROM supplier")
def _(b):
    return b.table("customer").select(F.col("c_nationkey").alias("k")).union(b.table("supplier").select("s_nationkey")).distinct()


@query("set_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def _(b):
    return b.table("orders").select(F.col("o_custkey").alias("k")).intersect(b.table("events").select("user_id"))


@query("set_except", "SELECT customer_id, nation::BIGINT AS nation FROM b_snap_old EXCEPT ALL SELECT customer_id, nation FROM b_snap_new")
def _(b):
    return b.snapshot_old().select("customer_id", "nation").exceptAll(b.snapshot_new().select("customer_id", "nation"))


_COMPARE = """SELECT coalesce(a.customer_id, z.customer_id) AS customer_id, CASE WHEN z.customer_id IS NULL THEN 'missing_in_target' WHEN a.customer_id IS NULL THEN 'extra_in_target' ELSE 'changed' END AS status
    FROM b_snap_old a FULL JOIN b_snap_new z ON a.customer_id = z.customer_id WHERE z.customer_id IS NULL OR a.customer_id IS NULL OR a.nation <> z.nation OR a.balance IS DISTINCT FROM z.balance"""


@query("full_compare", _COMPARE)
def _(b):
    return R.compare_rows(b.snapshot_old(), b.snapshot_new(), ["customer_id"])


# --- common table expressions, subqueries, recursion, reshaping --------------------------------------


@query("cte_chain", """WITH per AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) t FROM orders GROUP BY 1), big AS (SELECT * FROM per WHERE t > 2000000)
    SELECT n_name, count(*) AS customers, sum(t)::DOUBLE AS total FROM big JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(b):
    per = b.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money("o_totalprice")).alias("t"))
    big = per.filter("t > 2000000").join(b.table("customer"), "c_custkey")
    return R.flatten_star(big, [(b.table("nation"), "c_nationkey", "n_nationkey")]).groupBy("n_name").agg(F.count("*").alias("customers"), dsum("t").alias("total"))


@query("sub_scalar_correlated", "SELECT o_orderkey, (SELECT sum(z.o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) FROM orders z WHERE z.o_custkey = a.o_custkey) AS customer_mean FROM orders a")
def _(b):
    mean = b.table("orders").groupBy("o_custkey").agg(davg(money("o_totalprice")).alias("customer_mean"))
    return b.table("orders").join(mean, "o_custkey").select("o_orderkey", "customer_mean")


@query("sub_scalar_uncorrelated", """SELECT (SELECT count(*) FROM customer) AS customers, (SELECT sum(c_acctbal::DECIMAL(18,2))::DOUBLE FROM customer) AS deposits, (SELECT count(*) FROM orders) AS orders,
    (SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM orders WHERE o_orderstatus = 'F') AS done""")
def _(b):
    """One pass per table; the one-row results meet as scalar subqueries."""
    c = b.table("customer").agg(F.count("*").alias("customers"), dsum(money("c_acctbal")).alias("deposits"))
    o = b.table("orders").agg(F.count("*").alias("orders"), dsum(F.when(F.col("o_orderstatus") == "F", money("o_totalprice"))).alias("done"))
    s = o.select(F.struct("*").alias("s")).scalar()
    return c.withColumn("s", s).select("customers", "deposits", "s.orders", "s.done")


@query("sub_exists", "SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50)")
def _(b):
    l = b.table("lineitem").filter("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"))
    return b.table("part").join(l, "p_partkey", "left_semi").select("p_partkey")


@query("sub_in", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')")
def _(b):
    n, r = b.table("nation"), b.table("region").filter("r_name = 'ASIA'")
    asia = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("s_nationkey"))
    return b.table("supplier").join(asia, "s_nationkey", "left_semi").select("s_suppkey")


@query("sub_derived_table", "SELECT o_orderpriority, sum(o_totalprice::DECIMAL(18,2))::DOUBLE * 100.0::DOUBLE / (SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM orders) AS share FROM orders GROUP BY 1")
def _(b):
    total = b.table("orders").agg(dsum(money("o_totalprice"))).scalar()
    return b.table("orders").groupBy("o_orderpriority").agg(dsum(money("o_totalprice")).alias("t")).select("o_orderpriority", ratio("t", total, 100.0).alias("share"))


@query("rec_hierarchy", """WITH RECURSIVE h AS (SELECT c_custkey AS node, 0 AS depth, c_custkey::VARCHAR AS path FROM customer WHERE c_custkey = 0
    UNION ALL SELECT c.c_custkey, h.depth + 1, h.path || '>' || c.c_custkey::VARCHAR FROM customer c JOIN h ON c.c_custkey // 10 = h.node AND c.c_custkey > 0) SELECT node, depth::BIGINT AS depth, path FROM h""")
def _(b):
    k = F.col("c_custkey")
    tree = b.table("customer").select(k.alias("node"), F.when(k > 0, F.floor(k / 10)).alias("parent"))
    return R.hierarchy(tree, "node", "parent").select("node", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


@query("rec_date_series", """SELECT d::DATE::VARCHAR AS day, (dayofweek(d) + 1)::BIGINT AS weekday, coalesce(n, 0) AS orders FROM generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY) t(d) LEFT JOIN (SELECT o_orderdate, count(*) n FROM orders GROUP BY 1) ON o_orderdate = d""")
def _(b):
    n = b.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return R.calendar(b.spark, "1995-01-01", "2001-08-01", "day").join(n, "day", "left").select("day", F.dayofweek("day").alias("weekday"), F.coalesce("n", F.lit(0)).alias("orders"))


@query("rec_bom", """WITH RECURSIVE x AS (SELECT p_partkey AS root, p_partkey AS part, 1::BIGINT AS total_qty, 0::BIGINT AS level FROM part WHERE p_partkey < 4
    UNION ALL SELECT root, p_partkey, total_qty * (1 + p_partkey % 3), level + 1 FROM x JOIN part ON p_partkey // 4 = x.part AND p_partkey >= 4) SELECT * FROM x""")
def _(b):
    k = F.col("p_partkey")
    bom = b.table("part").filter(k >= 4).select(F.floor(k / 4).alias("parent"), k.alias("child"), (k % 3 + 1).alias("qty"))
    return R.explode_bom(bom, b.table("part").filter(k < 4).select(k.alias("root")))


@query("pivot", """SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS month, sum(o_totalprice::DECIMAL(18,2)) FILTER (WHERE o_orderstatus = 'F')::DOUBLE AS "F", sum(o_totalprice::DECIMAL(18,2)) FILTER (WHERE o_orderstatus = 'O')::DOUBLE AS "O", sum(o_totalprice::DECIMAL(18,2)) FILTER (WHERE o_orderstatus = 'P')::DOUBLE AS "P" FROM orders GROUP BY 1""")
def _(b):
    return b.table("orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).pivot("o_orderstatus", ["F", "O", "P"]).agg(dsum(money("o_totalprice")))


@query("unpivot", "SELECT s_suppkey, u.k AS metric, u.v AS value FROM (SELECT s_suppkey, s_acctbal AS balance, s_nationkey::DOUBLE AS nation FROM supplier), LATERAL (VALUES ('balance', balance), ('nation', nation)) u(k, v)")
def _(b):
    s = b.table("supplier").select("s_suppkey", F.col("s_acctbal").alias("balance"), dbl("s_nationkey").alias("nation"))
    return s.unpivot("s_suppkey", ["balance", "nation"], "metric", "value")


@query("unnest", "SELECT label::BIGINT AS label, i - 1 AS pos, count(*) AS n FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY ALL")
def _(b):
    return b.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", F.col("pos").cast("bigint").alias("pos")).agg(F.count("*").alias("n"))
