"""Data quality queries."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import customer as CU
from finquarry.operators import ingest as I
from finquarry.operators import layout as L
from finquarry.operators import quality as Q
from finquarry.operators.relational import anti_orphans
from finquarry.plans import q_customer
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF, money
from finquarry.sources.clean import Clean

_COLS = ["rule_name", "total_rows", "failed_rows", "pass_rate", "status"]


def _row(name, table, failed, threshold=100.0):
    """Check SQL of one result row: ``failed`` is a count expression over ``table``."""
    return f"SELECT '{name}' AS rule_name, t AS total_rows, f AS failed_rows, (t - f) * 100.0::DOUBLE / t AS pass_rate, CASE WHEN (t - f) * 100.0::DOUBLE / t >= {threshold} THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS t, {failed} AS f FROM {table})"


def _register(name, rules, sqls):
    @query(name, " UNION ALL ".join(sqls))
    def _(b):
        return Q.run_rules(tables(b), rules, "2024-01-31 00:00:00").select(*_COLS)


class Tables(dict):
    """Tables by name, built when a rule first asks for them."""

    def __init__(self, b):
        super().__init__()
        self.b = b

    def __missing__(self, name):
        made = {"snap": self.b.snapshot_new, "bronze": self.b.customers, "customers": lambda: Clean(self.b).customers, "loans": lambda: Clean(self.b).loans}
        self[name] = made[name]() if name in made else self.b.table(name)
        return self[name]


def tables(b):
    return Tables(b)


R = Q.Rule
_register("dq_completeness", [R("balance_filled", "snap", "completeness", "balance", threshold=95), R("text_filled", "documents", "completeness", "text"), R("email_filled", "customers", "completeness", "email", threshold=95)],
          [_row("balance_filled", "b_snap_new", "count(*) FILTER (WHERE balance IS NULL)", 95), _row("text_filled", "documents", "count(*) FILTER (WHERE text IS NULL)"), _row("email_filled", "s_customers", "count(*) FILTER (WHERE email IS NULL)", 95)])
_register("dq_uniqueness", [R("text_unique", "documents", "uniqueness", "text"), R("order_unique", "orders", "uniqueness", "o_orderkey"), R("url_unique", "pages", "uniqueness", "url")],
          [_row("text_unique", "documents", "count(*) - count(DISTINCT text)"), _row("order_unique", "orders", "count(*) - count(DISTINCT o_orderkey)"), _row("url_unique", "pages", "count(*) - count(DISTINCT url)")])
_register("dq_compound_unique", [R("line_key", "lineitem", "uniqueness", columns=("l_orderkey", "l_linenumber")), R("turn_key", "conversations", "uniqueness", columns=("conv_id", "turn"))],
          [_row("line_key", "lineitem", "count(*) - count(DISTINCT (l_orderkey, l_linenumber))"), _row("turn_key", "conversations", "count(*) - count(DISTINCT (conv_id, turn))")])
_register("dq_range", [R("price_range", "orders", "range", "o_totalprice", low=1000, high=450000, threshold=90), R("balance_not_negative", "customer", "range", "c_acctbal", low=0, threshold=95)],
          [_row("price_range", "orders", "count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 450000)", 90), _row("balance_not_negative", "customer", "count(*) FILTER (WHERE c_acctbal < 0)", 95)])
_register("dq_accepted_values", [R("status_ok", "orders", "accepted_values", "o_orderstatus", values=("F", "O")), R("lang_ok", "documents", "accepted_values", "lang", values=("en", "fr", "de", "es"))],
          [_row("status_ok", "orders", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O'))"), _row("lang_ok", "documents", "count(*) FILTER (WHERE lang NOT IN ('en','fr','de','es'))")])
_register("dq_pattern", [R("email_format", "bronze", "pattern", "email", pattern="^[^@]+@[^@]+[.][a-z]+ *$", threshold=98), R("https_url", "pages", "pattern", "url", pattern="^https://")],
          [_row("email_format", "b_customers", "count(*) FILTER (WHERE NOT regexp_matches(email, '^[^@]+@[^@]+[.][a-z]+ *$'))", 98), _row("https_url", "pages", "count(*) FILTER (WHERE NOT regexp_matches(url, '^https://'))")])
_register("dq_referential", [R("label_document", "labels", "referential", "doc_id", parent="documents", parent_key="doc_id"), R("order_customer", "orders", "referential", "o_custkey", parent="snap", parent_key="customer_id", threshold=90)],
          [_row("label_document", "labels", "count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents))"), _row("order_customer", "orders", "count(*) FILTER (WHERE o_custkey NOT IN (SELECT customer_id FROM b_snap_new))", 90)])
_register("dq_zscore", [R("value_outliers", "events", "zscore", "value", high=3, threshold=99)],
          [_row("value_outliers", "events, (SELECT n, s / n AS m, sqrt((q - s * s / n) / (n - 1)) AS sd FROM (SELECT count(*) AS n, sum(value::DECIMAL(18,4))::DOUBLE AS s, sum((value::DECIMAL(18,4) * value::DECIMAL(18,4))::DECIMAL(38,4))::DOUBLE AS q FROM events))", "count(*) FILTER (WHERE abs((value - m) / sd) > 3)", 99)])
_register("dq_not_future_date", [R("order_not_future", "orders", "expression", "o_orderdate", expression="o_orderdate <= timestamp_ntz'2001-06-01 00:00:00'", threshold=99)], [_row("order_not_future", "orders", "count(*) FILTER (WHERE o_orderdate > TIMESTAMP '2001-06-01')", 99)])
_register("dq_negative_except_refund", [R("negative_balance", "customer", "expression", "c_acctbal", expression="c_acctbal >= 0 OR c_mktsegment = 'MACHINERY'")], [_row("negative_balance", "customer", "count(*) FILTER (WHERE NOT (c_acctbal >= 0 OR c_mktsegment = 'MACHINERY'))")])
_register("dq_loan_state", [R("loan_state", "loans", "expression", "loan_status", expression="NOT (loan_status = 'MATURED' AND principal_outstanding > 0)", threshold=50)], [_row("loan_state", "s_loans", "count(*) FILTER (WHERE loan_status = 'MATURED' AND principal_outstanding > 0)", 50)])
_register("dq_kyc", [R("kyc_contact", "customers", "expression", "email", expression="email IS NOT NULL OR phone IS NOT NULL")], [_row("kyc_contact", "s_customers", "count(*) FILTER (WHERE email IS NULL AND phone IS NULL)")])


@query("dq_duplicate_list", "SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def _(b):
    return Q.duplicates(b.table("documents"), ["text"])


@query("dq_freshness", "SELECT 'events' AS table_name, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT)::DOUBLE / 3600 AS age_hours, CASE WHEN (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT)::DOUBLE / 3600 > 24 THEN 'STALE' ELSE 'FRESH' END AS status FROM events")
def _(b):
    last = b.table("events").agg(F.max("ts").alias("last_update")).withColumn("table_name", F.lit("events"))
    return L.freshness_report(last, {"events": 24}, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")).select("table_name", "age_hours", "status")


@query("dq_timeliness_score", "SELECT event_type, greatest(0::DOUBLE, 100.0::DOUBLE - (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT)::DOUBLE / 3600 / 24 * 100.0::DOUBLE) AS score FROM events GROUP BY 1")
def _(b):
    age = (F.lit(1706659200) - X.epoch(F.max("ts"))).cast("double") / 3600
    return b.table("events").groupBy("event_type").agg(age.alias("a")).select("event_type", Q.timeliness(F.col("a"), 24.0).alias("score"))


_register("dq_validate_orders", Q.order_rules("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", ["F", "O"], "o_orderdate", "1996-01-01"),
          [_row("order_id_not_null", "orders", "count(*) FILTER (WHERE o_orderkey IS NULL)"), _row("order_id_unique", "orders", "count(*) - count(DISTINCT o_orderkey)"), _row("customer_not_null", "orders", "count(*) FILTER (WHERE o_custkey IS NULL)"), _row("amount_range", "orders", "count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 1000000)"), _row("status_valid", "orders", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O'))"), _row("date_range", "orders", "count(*) FILTER (WHERE o_orderdate < DATE '1996-01-01')")])
_register("dq_validate_customers", [R("id_unique", "customers", "uniqueness", "customer_id"), R("age_range", "customers", "expression", "date_of_birth", expression="months_between(date'2001-08-02', date_of_birth) / 12 BETWEEN 0 AND 150"), R("email_valid", "customers", "completeness", "email", threshold=95)],
          [_row("id_unique", "s_customers", "count(*) - count(DISTINCT customer_id)"), _row("age_range", "s_customers", "count(*) FILTER (WHERE date_of_birth > DATE '2001-08-02')"), _row("email_valid", "s_customers", "count(*) FILTER (WHERE email IS NULL)", 95)])
_register("dq_schema_tests", Q.table_tests("orders", unique=["o_orderkey"], not_null=["o_custkey"], accepted={"o_orderstatus": ["F", "O", "P"]}, parents={"o_custkey": ("customer", "c_custkey")}, holds={"o_totalprice": "o_totalprice > 0"}),
          [_row("unique_o_orderkey", "orders", "count(*) - count(DISTINCT o_orderkey)"), _row("not_null_o_custkey", "orders", "count(*) FILTER (WHERE o_custkey IS NULL)"), _row("accepted_values_o_orderstatus", "orders", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O','P'))"), _row("relationships_o_custkey", "orders", "count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))"), _row("expression_o_totalprice", "orders", "count(*) FILTER (WHERE o_totalprice <= 0)")])


@query("dq_validate_profit", "SELECT count(*) AS orders, count(*) FILTER (WHERE rev::DOUBLE - cost::DOUBLE < 0) AS negative_profit FROM (SELECT l_orderkey, sum(revenue) AS rev, sum(price * 0.95) AS cost FROM b_lines GROUP BY 1)")
def _(b):
    per = b.order_lines().groupBy("l_orderkey").agg(X.dsum("revenue").alias("r"), X.dsum(F.col("price") * F.lit("0.95").cast("decimal(4,2)")).alias("c"))
    return per.agg(F.count("*").alias("orders"), F.count_if(F.col("r") - F.col("c") < 0).alias("negative_profit"))


_DAILY = "(SELECT ts::DATE AS day, count(*) AS row_count FROM events GROUP BY 1)"


@query("dq_volume", f"SELECT day::VARCHAR AS day, row_count, p AS change_pct, CASE WHEN row_count < 300 OR row_count > 380 OR abs(coalesce(p, 0)) > 10 THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT *, (row_count - lag(row_count) OVER (ORDER BY day)) * 100.0::DOUBLE / lag(row_count) OVER (ORDER BY day) AS p FROM {_DAILY})")
def _(b):
    daily = b.table("events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("row_count"))
    return Q.volume_rule(daily, 300, 380, 10)


@query("dq_consecutive_failures", """WITH e AS (SELECT user_id, event_id, event_type IN ('error', 'click') AS bad FROM events), g AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM e) SELECT user_id, count(*) AS run_length, min(event_id) AS first_failure FROM g WHERE bad GROUP BY user_id, g HAVING count(*) >= 3""")
def _(b):
    h = b.table("events").select("user_id", "event_id", F.col("event_type").isin("error", "click").alias("bad"))
    return Q.consecutive_failures(h, "user_id", ["event_id"], "bad", 3)


@query("dq_custom_sql", "SELECT 'mean_price' AS rule_name, 1::BIGINT AS total_rows, CASE WHEN avg(o_totalprice) BETWEEN 200000 AND 300000 THEN 0 ELSE 1 END::BIGINT AS failed_rows, CASE WHEN avg(o_totalprice) BETWEEN 200000 AND 300000 THEN 'PASS' ELSE 'FAIL' END AS status FROM orders")
def _(b):
    b.table("orders").createOrReplaceTempView("dq_orders")
    rule = R("mean_price", "orders", "custom", sql="SELECT avg(o_totalprice) AS v FROM dq_orders", low=200000, high=300000)
    return Q.run_rules({"orders": b.table("orders")}, [rule]).select("rule_name", "total_rows", "failed_rows", "status")


@query("dq_balance_reconciliation", "SELECT o_orderkey AS k, o_totalprice AS expected, s::DOUBLE AS actual, o_totalprice - coalesce(s::DOUBLE, 0) AS variance FROM orders LEFT JOIN (SELECT l_orderkey, sum(price) AS s FROM b_lines GROUP BY 1) ON o_orderkey = l_orderkey WHERE abs(o_totalprice - coalesce(s::DOUBLE, 0)) > 0.01")
def _(b):
    o = b.table("orders").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("x"))
    l = b.order_lines().select(F.col("l_orderkey").alias("k"), F.col("price").alias("y"))
    return I.reconcile_by_key(o, l, "k", "x", "y")


@query("dq_segment_consistency", "SELECT customer_id, CASE WHEN net_relationship_value >= 50000 THEN 'PLATINUM' ELSE customer_segment END AS stored, customer_segment AS expected FROM m_c360 WHERE net_relationship_value >= 50000 AND customer_segment <> 'PLATINUM'")
def _(b):
    """Stored labels (made with an outdated limit) against labels computed again."""
    fresh = q_customer.c360(b).select("customer_id", "net_relationship_value", F.col("customer_segment").alias("expected"))
    stored = F.when(F.col("net_relationship_value") >= 50000, "PLATINUM").otherwise(F.col("expected"))
    return fresh.withColumn("stored", stored).filter("stored <> expected").select("customer_id", "stored", "expected")


@query("dq_sequence_gap", "SELECT o_custkey, o_orderkey, p::VARCHAR AS previous_date, d::VARCHAR AS day, (d - p)::BIGINT AS gap_days FROM (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d, lag(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) WHERE d - p > 365")
def _(b):
    return Q.sequence_gaps(q_customer.orders(b), "o_custkey", "day", "o_orderkey", 365)


@query("dq_missing_columns", "SELECT 'opened' AS missing_column, (SELECT count(*) FROM b_snap_new) AS row_count")
def _(b):
    df = b.snapshot_new()
    lost = Q.missing_columns(df, ["customer_id", "opened", "nation"])
    return df.agg(F.count("*").alias("row_count")).select(F.explode(F.array(*[F.lit(c) for c in lost])).alias("missing_column"), "row_count")


@query("dq_orphans", "SELECT o_custkey AS customer_id, count(*) AS orders FROM orders WHERE o_custkey NOT IN (SELECT customer_id FROM b_snap_new) GROUP BY 1")
def _(b):
    return anti_orphans(b.table("orders"), b.snapshot_new(), "o_custkey", "customer_id").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count("*").alias("orders"))


@query("dq_emi_error", "SELECT loan_id, emi_amount::DOUBLE AS emi_amount, e::DECIMAL(18,4)::DOUBLE AS expected FROM (SELECT *, principal_amount::DOUBLE * r * g / (g - 1) AS e FROM (SELECT *, interest_rate::DOUBLE / 1200.0::DOUBLE AS r, power(1.0::DOUBLE + interest_rate::DOUBLE / 1200.0::DOUBLE, tenure_months::DOUBLE) AS g FROM b_loans)) WHERE abs(emi_amount::DOUBLE - e) > 1000")
def _(b):
    e = X.emi("principal_amount", "interest_rate", "tenure_months")
    return b.loans().withColumn("expected", e).filter(F.abs(X.dbl("emi_amount") - F.col("expected")) > 1000).select("loan_id", "emi_amount", F.col("expected").cast("decimal(18,4)").alias("expected"))


CATALOG = [
    R("order_unique", "orders", "uniqueness", "o_orderkey", severity="CRITICAL", action="BLOCK"), R("price_range", "orders", "range", "o_totalprice", low=1000, high=450000, threshold=95, severity="HIGH"), R("status_ok", "orders", "accepted_values", "o_orderstatus", values=("F", "O"), severity="MEDIUM", action="LOG"),
    R("text_unique", "documents", "uniqueness", "text", threshold=90, severity="CRITICAL", action="BLOCK"), R("text_filled", "documents", "completeness", "text", severity="HIGH"), R("balance_filled", "snap", "completeness", "balance", threshold=95, severity="CRITICAL", action="BLOCK"),
    R("label_document", "labels", "referential", "doc_id", parent="documents", parent_key="doc_id", severity="HIGH"), R("events_fresh", "events", "freshness", "ts", high=24, severity="HIGH"),
]
_F24 = "CASE WHEN (epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(ts))) / 3600 <= 24 THEN 0 ELSE 1 END"
_CAT = [
    ("order_unique", "orders", "uniqueness", "CRITICAL", "BLOCK", 100, "orders", "count(*)", "count(*) - count(DISTINCT o_orderkey)"), ("price_range", "orders", "range", "HIGH", "ALERT", 95, "orders", "count(*)", "count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 450000)"),
    ("status_ok", "orders", "accepted_values", "MEDIUM", "LOG", 100, "orders", "count(*)", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O'))"), ("text_unique", "documents", "uniqueness", "CRITICAL", "BLOCK", 90, "documents", "count(*)", "count(*) - count(DISTINCT text)"),
    ("text_filled", "documents", "completeness", "HIGH", "ALERT", 100, "documents", "count(*)", "count(*) FILTER (WHERE text IS NULL)"), ("balance_filled", "snap", "completeness", "CRITICAL", "BLOCK", 95, "b_snap_new", "count(*)", "count(*) FILTER (WHERE balance IS NULL)"),
    ("label_document", "labels", "referential", "HIGH", "ALERT", 100, "labels", "count(*)", "count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents))"), ("events_fresh", "events", "freshness", "HIGH", "ALERT", 100, "events", "1::BIGINT", f"{_F24}::BIGINT"),
]
RES = "res0 AS (" + " UNION ALL ".join(f"SELECT '{n}' AS rule_name, '{t}' AS table_name, '{k}' AS rule_type, '{s}' AS severity, '{a}' AS action, {th}::DOUBLE AS threshold, {tot} AS total_rows, {f} AS failed_rows FROM {src}" for n, t, k, s, a, th, src, tot, f in _CAT) + "), res AS (SELECT *, (total_rows - failed_rows) * 100.0::DOUBLE / total_rows AS pass_rate, (total_rows - failed_rows) * 100.0::DOUBLE / total_rows >= threshold AS threshold_met, CASE WHEN (total_rows - failed_rows) * 100.0::DOUBLE / total_rows >= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM res0) "


def results(b):
    return Q.run_rules(tables(b), CATALOG, "2024-01-31 00:00:00")


@query("dq_results", f"WITH {RES} SELECT rule_name, table_name, rule_type, severity, action, threshold, total_rows, failed_rows, pass_rate, threshold_met, status FROM res")
def _(b):
    return results(b).drop("column_name")


@query("dq_rule_runner", f"WITH {RES} SELECT table_name, count(*) AS rules, count(*) FILTER (WHERE status = 'FAIL') AS failed FROM res GROUP BY 1")
def _(b):
    return results(b).groupBy("table_name").agg(F.count("*").alias("rules"), F.count_if(F.col("status") == "FAIL").alias("failed"))


@query("dq_gate", f"WITH {RES} SELECT rule_name, CASE WHEN status = 'PASS' THEN 'PASS' ELSE action END AS decision FROM res")
def _(b):
    return Q.gate(results(b)).select("rule_name", "decision")


def _dim(kind):
    return f"coalesce(sum(pass_rate::DECIMAL(28,10)) FILTER (WHERE rule_type = '{kind}')::DOUBLE / nullif(count(*) FILTER (WHERE rule_type = '{kind}'), 0), 100)"


def _score_sql(group=""):
    g = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"SELECT *, CASE WHEN overall_score >= 99 THEN 'EXCELLENT' WHEN overall_score >= 95 THEN 'GOOD' WHEN overall_score >= 90 THEN 'POOR' ELSE 'CRITICAL' END AS grade, total_checks - passed_checks AS failed_checks FROM (SELECT *, (completeness_score + uniqueness_score + timeliness_score) / 3 AS overall_score FROM (SELECT {g}{_dim('completeness')} AS completeness_score, {_dim('uniqueness')} AS uniqueness_score, {_dim('freshness')} AS timeliness_score, count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed_checks FROM res{tail}))"


@query("dq_score", f"WITH {RES} " + _score_sql())
def _(b):
    return Q.score(results(b))


@query("dq_score_weighted", "SELECT (CASE WHEN count(*) = count(DISTINCT text) THEN 100 ELSE 0 END + (100 - count(*) FILTER (WHERE text IS NULL) * 100.0::DOUBLE / count(*)) + 100 + (100 - count(*) FILTER (WHERE n_chars < 200) * 100.0::DOUBLE / count(*))) * 0.25::DOUBLE AS score FROM documents")
def _(b):
    t = b.table("documents").groupBy("text").agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("z"), F.count_if(F.col("n_chars") < 200).alias("s"))
    m = t.agg(F.sum("n").alias("n"), F.count("*").alias("d"), F.sum("z").alias("z"), F.sum("s").alias("s"))
    return m.select(Q.weighted_score(F.when(F.col("n") == F.col("d"), 100.0).otherwise(0.0), 100 - X.pct("z", "n"), F.lit(100.0), 100 - X.pct("s", "n")).alias("score"))


@query("dq_score_table", """SELECT 'accounts' AS table_name, count(*) AS total_rows, count(DISTINCT account_id) AS unique_primary_keys, count(DISTINCT account_id) * 100.0::DOUBLE / count(*) AS uniqueness_pct, count(customer_id) * 100.0::DOUBLE / count(*) AS completeness_pct, count(*) FILTER (WHERE current_balance >= 0) * 100.0::DOUBLE / count(*) AS validity_pct FROM s_accounts
    UNION ALL SELECT 'transactions', count(*), count(DISTINCT txn_id), count(DISTINCT txn_id) * 100.0::DOUBLE / count(*), count(account_id) * 100.0::DOUBLE / count(*), count(*) FILTER (WHERE amount > 0) * 100.0::DOUBLE / count(*) FROM s_transactions
    UNION ALL SELECT 'cards', count(*), count(DISTINCT card_number), count(DISTINCT card_number) * 100.0::DOUBLE / count(*), count(customer_id) * 100.0::DOUBLE / count(*), count(*) FILTER (WHERE card_limit > 30000) * 100.0::DOUBLE / count(*) FROM s_cards""")
def _(b):
    c = Clean(b)
    return Q.table_metrics(c.accounts, "accounts", "account_id", "customer_id", F.col("current_balance") >= 0).unionByName(Q.table_metrics(c.transactions, "transactions", "txn_id", "account_id", F.col("amount") > 0)).unionByName(Q.table_metrics(c.cards, "cards", "card_number", "customer_id", F.col("card_limit") > 30000))


_SCORES = "(SELECT ts::DATE AS d, 100.0::DOUBLE - count(*) FILTER (WHERE event_type = 'error') * 100.0::DOUBLE / count(*) AS s FROM events GROUP BY 1)"


def daily_scores(b):
    e = b.table("events")
    return e.groupBy(F.col("ts").cast("date").alias("score_date")).agg((F.lit(100.0) - X.pct(F.count_if(F.col("event_type") == "error"), F.count("*"))).alias("overall_score"))


@query("dq_score_trend", f"SELECT d::VARCHAR AS score_date, s AS overall_score, lag(s) OVER w AS previous_day_score, s - lag(s) OVER w AS score_change, sum(s::DECIMAL(28,10)) OVER (ORDER BY d ROWS 6 PRECEDING)::DOUBLE / count(*) OVER (ORDER BY d ROWS 6 PRECEDING) AS moving_avg_7d, s - lag(s, 7) OVER w AS week_over_week, s - lag(s, 30) OVER w AS month_over_month, CASE WHEN s > lag(s) OVER w THEN 'IMPROVING' WHEN s < lag(s) OVER w THEN 'DECLINING' ELSE 'STABLE' END AS trend FROM {_SCORES} WINDOW w AS (ORDER BY d)")
def _(b):
    return Q.score_trend(daily_scores(b))


# results and anomalies as a log: one run per event, an anomaly per error -------------------------------
def runs(b):
    return b.table("events").select((F.col("user_id") % 20).alias("rule_id"), F.when(F.col("event_type") == "error", "FAIL").otherwise("PASS").alias("status"), F.col("ts").alias("completed_at"), (F.col("event_id") % 500).alias("duration_ms"))


def catalog(b):
    r = F.col("rule_id")
    ids = b.table("events").select((F.col("user_id") % 20).alias("rule_id")).distinct()
    return ids.select(r, F.concat(F.lit("rule_"), r.cast("string")).alias("rule_name"), F.element_at(F.array(*[F.lit(s) for s in Q.SEVERITY_ORDER]), (r % 4 + 1).cast("int")).alias("severity"), F.concat(F.lit("team_"), (r % 3).cast("string")).alias("owner"))


def anomalies(b):
    i = F.col("event_id")
    return b.table("events").filter("event_type = 'error'").select(i.alias("anomaly_id"), (F.col("user_id") % 20).alias("rule_id"), F.col("ts").alias("detected_at"), F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("table_name"), F.when(F.col("value") > 150, "CRITICAL").when(F.col("value") > 80, "HIGH").when(F.col("value") > 30, "MEDIUM").otherwise("LOW").alias("severity"), F.element_at(F.array(*[F.lit(s) for s in ("OPEN", "INVESTIGATING", "RESOLVED", "FALSE_POSITIVE")]), (i % 4 + 1).cast("int")).alias("status"), (i % 100).alias("affected_rows"))


LOG = """runs AS (SELECT user_id % 20 AS rule_id, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS status, ts AS completed_at, event_id % 500 AS duration_ms FROM events),
    cat AS (SELECT DISTINCT user_id % 20 AS rule_id, 'rule_' || (user_id % 20) AS rule_name, CASE user_id % 20 % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity, 'team_' || (user_id % 20 % 3) AS owner FROM events),
    an AS (SELECT event_id AS anomaly_id, user_id % 20 AS rule_id, ts AS detected_at, 't' || (user_id % 5) AS table_name, CASE WHEN value > 150 THEN 'CRITICAL' WHEN value > 80 THEN 'HIGH' WHEN value > 30 THEN 'MEDIUM' ELSE 'LOW' END AS severity, CASE event_id % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'INVESTIGATING' WHEN 2 THEN 'RESOLVED' ELSE 'FALSE_POSITIVE' END AS status, event_id % 100 AS affected_rows FROM events WHERE event_type = 'error') """


@query("dq_main_dashboard", f"WITH {RES}, {LOG}, sc AS ({_score_sql()}) SELECT overall_score AS current_quality_score, grade AS quality_grade, (SELECT count(*) FROM an) AS anomalies_detected, (SELECT count(*) FROM an WHERE severity = 'CRITICAL') AS critical_anomalies, (SELECT count(*) FROM an WHERE status = 'OPEN') AS open_anomalies, (SELECT count(*) FROM runs WHERE status = 'PASS') AS tests_passed, (SELECT count(*) FROM runs WHERE status = 'FAIL') AS tests_failed, (SELECT sum(duration_ms)::DOUBLE / count(*) / 1000.0::DOUBLE FROM runs) AS avg_test_duration_sec, CASE WHEN overall_score >= 99 THEN 'HEALTHY' WHEN overall_score >= 95 THEN 'WARNING' WHEN overall_score >= 90 THEN 'DEGRADED' ELSE 'CRITICAL' END AS system_health FROM sc")
def _(b):
    return Q.main_dashboard(Q.score(results(b)), anomalies(b), runs(b))


@query("dq_table_dashboard", f"WITH {RES}, sc AS ({_score_sql('table_name')}), cf AS (SELECT table_name, count(*) FILTER (WHERE status = 'FAIL' AND severity = 'CRITICAL') AS critical_failures FROM res GROUP BY 1) SELECT sc.*, critical_failures, CASE WHEN critical_failures > 0 THEN 'CRITICAL' WHEN failed_checks > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS status FROM sc JOIN cf ON sc.table_name = cf.table_name")
def _(b):
    return Q.table_dashboard(results(b))


@query("dq_daily_report", f"WITH {RES} SELECT rule_type, count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS failed, string_agg(rule_name, ', ' ORDER BY rule_name) AS rules FROM res GROUP BY 1")
def _(b):
    return results(b).groupBy("rule_type").agg(F.count("*").alias("checks"), F.count_if(F.col("status") == "FAIL").alias("failed"), F.array_join(F.sort_array(F.collect_list("rule_name")), ", ").alias("rules"))


@query("dq_critical_failures", f"WITH {LOG}, f AS (SELECT rule_id, rule_name, severity, owner, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', completed_at))::BIGINT)::DOUBLE / 3600 AS h FROM runs JOIN cat USING (rule_id) WHERE status = 'FAIL' AND severity IN ('CRITICAL','HIGH')) SELECT rule_id, rule_name, severity, owner, h AS hours_since_failure, CASE WHEN (severity = 'CRITICAL' AND h > 1) OR (severity = 'HIGH' AND h > 4) THEN 'YES - ESCALATE' ELSE 'NO' END AS escalation_needed FROM f WHERE h BETWEEN 0 AND 24")
def _(b):
    return Q.critical_failures(runs(b), catalog(b), "2024-01-31 00:00:00", 24).select("rule_id", "rule_name", "severity", "owner", "hours_since_failure", "escalation_needed")


@query("dq_failed_tests", f"WITH {LOG} SELECT rule_id, rule_name, severity, owner, count(*) AS failures, strftime(max(completed_at), '%Y-%m-%d %H:%M:%S') AS last_failure FROM runs JOIN cat USING (rule_id) WHERE status = 'FAIL' GROUP BY ALL")
def _(b):
    return Q.failed_tests(runs(b), catalog(b))


@query("dq_recent_results", f"WITH {LOG} SELECT rule_id, status, count(*) AS runs FROM runs WHERE completed_at >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY ALL")
def _(b):
    return runs(b).filter(F.col("completed_at") >= F.lit("2024-01-24").cast("timestamp_ntz")).groupBy("rule_id", "status").agg(F.count("*").alias("runs"))


@query("dq_active_rules", f"WITH {LOG} SELECT rule_id, rule_name, severity, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END::BIGINT AS severity_rank FROM cat")
def _(b):
    return catalog(b).select("rule_id", "rule_name", "severity", Q.severity_rank().alias("severity_rank"))


@query("dq_anomaly_open", f"WITH {LOG} SELECT anomaly_id, table_name, an.severity, status, rule_name, owner FROM an LEFT JOIN cat USING (rule_id) WHERE status IN ('OPEN','INVESTIGATING')")
def _(b):
    return Q.open_anomalies(anomalies(b), catalog(b)).select("anomaly_id", "table_name", "severity", "status", "rule_name", "owner")


@query("dq_anomaly_summary", f"WITH {LOG} SELECT detected_at::DATE::VARCHAR AS detection_date, table_name, severity, count(*) AS anomaly_count, sum(affected_rows)::BIGINT AS total_affected_rows FROM an GROUP BY ALL")
def _(b):
    return Q.anomaly_summary(anomalies(b))


@query("dq_anomaly_trend", f"WITH {LOG} SELECT detected_at::DATE::VARCHAR AS detection_date, count(*) AS total_anomalies, " + ", ".join(f"count(*) FILTER (WHERE severity = '{s}') AS {s.lower()}_count" for s in Q.SEVERITY_ORDER) + ", count(*) FILTER (WHERE status = 'RESOLVED') AS resolved_count, count(*) FILTER (WHERE status = 'OPEN') AS open_count FROM an GROUP BY 1")
def _(b):
    return Q.anomaly_trend(anomalies(b))


@query("dq_anomaly_history", f"WITH {LOG} SELECT anomaly_id, status AS old_status, 'RESOLVED' AS new_status FROM an WHERE anomaly_id % 3 = 0 AND status <> 'RESOLVED'")
def _(b):
    old = anomalies(b)
    new = old.withColumn("status", F.when(F.col("anomaly_id") % 3 == 0, "RESOLVED").otherwise(F.col("status")))
    return Q.status_changes(old, new, "anomaly_id")


@query("dq_issues_by_owner", f"WITH {LOG}, f AS (SELECT rule_id, count(*) AS n FROM runs WHERE status = 'FAIL' GROUP BY 1) SELECT owner, sum(n)::BIGINT AS failed_checks, count(*) AS rules, string_agg(DISTINCT severity, ', ' ORDER BY severity) AS severities FROM f JOIN cat USING (rule_id) GROUP BY 1")
def _(b):
    return Q.issues_by_owner(runs(b), catalog(b))


@query("dq_profile", """SELECT 'l_quantity' AS column_name, count(*) AS row_count, 0.0::DOUBLE AS null_pct, count(DISTINCT l_quantity) AS distinct_count, min(l_quantity)::VARCHAR AS min_value, max(l_quantity)::VARCHAR AS max_value, sum(l_quantity::DECIMAL(18,4))::DOUBLE / count(*) AS mean_value FROM lineitem
    UNION ALL SELECT 'l_returnflag', count(*), 0.0::DOUBLE, count(DISTINCT l_returnflag), min(l_returnflag), max(l_returnflag), NULL FROM lineitem""")
def _(b):
    return Q.profile(b.table("lineitem"), ["l_quantity"], ["l_returnflag"])


@query("dq_null_trace", "SELECT 1::BIGINT AS layer_order, 'raw' AS layer, count(*) AS row_count, count(*) FILTER (WHERE email IS NULL) AS null_count, count(*) FILTER (WHERE email IS NULL) * 100.0::DOUBLE / count(*) AS null_pct FROM b_customers UNION ALL SELECT 2, 'clean', count(*), count(*) FILTER (WHERE email IS NULL), count(*) FILTER (WHERE email IS NULL) * 100.0::DOUBLE / count(*) FROM s_customers UNION ALL SELECT 3, 'mart', count(*), count(*) FILTER (WHERE email IS NULL), count(*) FILTER (WHERE email IS NULL) * 100.0::DOUBLE / count(*) FROM m_c360")
def _(b):
    return Q.null_trace({"raw": b.customers(), "clean": Clean(b).customers, "mart": q_customer.c360(b)}, "email")


@query("obs_distribution_drift", """WITH e AS (SELECT value, ts < TIMESTAMP '2024-01-15 00:00:00' AS a, (CASE WHEN value > 10 THEN 1 ELSE 0 END + CASE WHEN value > 25 THEN 1 ELSE 0 END + CASE WHEN value > 50 THEN 1 ELSE 0 END + CASE WHEN value > 100 THEN 1 ELSE 0 END) AS bin FROM events), c AS (SELECT bin, count(*) FILTER (WHERE a) AS x, count(*) FILTER (WHERE NOT a) AS y FROM e GROUP BY 1), p AS (SELECT CASE WHEN x = 0 THEN 0.5 ELSE x END::DOUBLE / sum(x) OVER ()::DOUBLE AS p, CASE WHEN y = 0 THEN 0.5 ELSE y END::DOUBLE / sum(y) OVER ()::DOUBLE AS q FROM c)
    SELECT sum(((q - p) * ln(q / p))::DECIMAL(28,12))::DOUBLE AS psi, count(*) AS bins, CASE WHEN sum((q - p) * ln(q / p)) > 0.25 THEN 'MAJOR' WHEN sum((q - p) * ln(q / p)) > 0.1 THEN 'MODERATE' ELSE 'NONE' END AS drift FROM p""")
def _(b):
    e, cut = b.table("events"), F.lit("2024-01-15").cast("timestamp_ntz")
    return Q.population_stability(e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut), "value", [10, 25, 50, 100])


@query("obs_anomaly", """WITH d AS (SELECT ts::DATE AS day, sum(value::DECIMAL(18,2)) AS x FROM events GROUP BY 1), w AS (SELECT day, x, count(*) OVER z AS n, sum(x) OVER z::DOUBLE AS s, sum((x * x)::DECIMAL(38,4)) OVER z::DOUBLE AS q FROM d WINDOW z AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) SELECT day::VARCHAR AS day, x::DOUBLE AS total, coalesce(n >= 3 AND abs(x::DOUBLE - s / n) > sqrt(greatest((q - s * s / n) / (n - 1), 0)) * 2, false) AS is_anomaly FROM w""")
def _(b):
    daily = b.table("events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.sum(money("value")).alias("total"))
    return Q.trailing_band(daily, "day", "total", 7, 2.0)
