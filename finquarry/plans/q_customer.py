"""Customer and commerce queries."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import customer as C
from finquarry.operators import relational as R
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF, money
from finquarry.sources.clean import Clean

SINCE = "2001-07-03"
EXPOSURE = [(500000, "HIGH"), (200000, "MEDIUM")]
SEGMENTS = [(60000, "PLATINUM"), (40000, "GOLD"), (10000, "SILVER")]
ACTIVITY = [(1, "HIGH"), (0, "MEDIUM")]


def c360(b):
    c = Clean(b)
    return C.customer_360(c.customers, c.accounts, c.cards, c.loans, c.transactions, SINCE, EXPOSURE, SEGMENTS, ACTIVITY)


_C360 = "SELECT * FROM m_c360"


@query("customer_360", _C360)
def _(b):
    return c360(b)


@query("int_customer_accounts", "SELECT customer_id, count(*) AS total_accounts, count(*) FILTER (WHERE account_type_standardized = 'SAVINGS') AS savings_accounts, count(*) FILTER (WHERE account_type_standardized = 'CURRENT') AS current_accounts, count(*) FILTER (WHERE account_type_standardized = 'FIXED_DEPOSIT') AS fd_accounts, sum(current_balance)::DOUBLE AS total_balance, sum(available_balance)::DOUBLE AS total_available_balance, max(last_updated)::VARCHAR AS last_account_update FROM s_accounts WHERE status_standardized = 'ACTIVE' GROUP BY 1")
def _(b):
    return C.customer_accounts(Clean(b).accounts)


@query("int_customer_cards", "SELECT customer_id, count(*) AS total_cards, sum(card_limit)::DOUBLE AS total_card_limit, sum(credit_used)::DOUBLE AS total_card_outstanding, sum(available_credit)::DOUBLE AS total_card_available, sum(credit_used)::DOUBLE * 100.0::DOUBLE / sum(card_limit)::DOUBLE AS avg_card_utilization_pct, max(last_updated)::VARCHAR AS last_card_update FROM s_cards WHERE status = 'ACTIVE' GROUP BY 1")
def _(b):
    return C.customer_cards(Clean(b).cards)


@query("int_customer_loans", "SELECT customer_id, count(*) AS total_loans, sum(principal_amount)::DOUBLE AS total_loan_amount, sum(principal_outstanding)::DOUBLE AS total_loan_outstanding, sum(emi_amount)::DOUBLE AS total_monthly_emi, sum(interest_rate)::DOUBLE / count(*) AS avg_interest_rate, max(last_updated)::VARCHAR AS last_loan_update FROM s_loans WHERE loan_status = 'ACTIVE' GROUP BY 1")
def _(b):
    return C.customer_loans(Clean(b).loans)


def _listed(view, kind, amount, where="true"):
    return f"(SELECT customer_id, string_agg(k || ' x' || n || ': ' || format('{{:,}}', floor(v)::BIGINT), '; ' ORDER BY k || ' x' || n || ': ' || format('{{:,}}', floor(v)::BIGINT)) AS t FROM (SELECT customer_id, {kind} AS k, count(*) AS n, sum({amount}) AS v FROM {view} WHERE {where} GROUP BY ALL) GROUP BY 1)"


@query("customer_single_view", f"""SELECT customer_id, customer_name, a.t AS accounts_summary, l.t AS loans_summary, r.t AS recent_transactions FROM s_customers LEFT JOIN {_listed('s_accounts', 'account_type_standardized', 'current_balance')} a USING (customer_id)
    LEFT JOIN {_listed('s_loans', 'loan_type_standardized', 'principal_outstanding')} l USING (customer_id) LEFT JOIN {_listed('(SELECT t.*, customer_id FROM s_transactions t JOIN s_accounts USING (account_id))', 'txn_type_standardized', 'amount', "txn_date >= DATE '2001-07-26'")} r USING (customer_id)""")
def _(b):
    c = Clean(b)
    return C.single_view(c.customers, c.accounts, c.loans, c.transactions, "2001-07-26")


@query("customer_segmentation", "SELECT customer_segment, count(*) AS customer_count, sum(total_balance::DECIMAL(28,2))::DOUBLE AS segment_total_balance, sum(total_card_outstanding::DECIMAL(28,2))::DOUBLE AS segment_card_outstanding, sum(total_loan_outstanding::DECIMAL(28,2))::DOUBLE AS segment_loan_outstanding, sum(net_relationship_value::DECIMAL(28,2))::DOUBLE AS segment_net_value FROM m_c360 GROUP BY 1")
def _(b):
    return C.segment_summary(c360(b))


@query("customer_clv", """WITH a AS (SELECT customer_id, sum(f)::DOUBLE AS f, sum(i)::DOUBLE AS i, sum(current_balance)::DOUBLE / count(current_balance) AS bal FROM s_accounts LEFT JOIN (SELECT account_id, sum(amount) FILTER (WHERE txn_type_standardized = 'DEBIT' AND description LIKE '%FEE%') AS f, sum(amount) FILTER (WHERE txn_type_standardized = 'DEBIT' AND description LIKE '%INTEREST%') AS i FROM s_transactions GROUP BY 1) USING (account_id) GROUP BY 1),
    l AS (SELECT customer_id, sum(principal_outstanding)::DOUBLE AS debt FROM s_loans GROUP BY 1)
    SELECT customer_id, customer_name, datesub('month', created_date, DATE '2001-08-02') AS tenure_months, coalesce(f, 0) AS total_fees_paid, coalesce(i, 0) AS total_interest_paid, bal AS avg_daily_balance, coalesce(f, 0) * 12.0::DOUBLE / datesub('month', created_date, DATE '2001-08-02') AS estimated_annual_fee_revenue,
    CASE WHEN debt > 500000 THEN 'HIGH_RISK' WHEN debt > 200000 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_score FROM s_customers LEFT JOIN a USING (customer_id) LEFT JOIN l USING (customer_id) WHERE datesub('month', created_date, DATE '2001-08-02') > 12 ORDER BY estimated_annual_fee_revenue DESC, customer_id LIMIT 100""")
def _(b):
    c = Clean(b)
    out = C.clv(c.customers, c.accounts, c.transactions, c.loans, AS_OF, [(500000, "HIGH_RISK"), (200000, "MEDIUM_RISK")])
    return out.orderBy(F.desc("estimated_annual_fee_revenue"), "customer_id").limit(100)


@query("v_customer_summary", "SELECT customer_id, customer_name, coalesce(a.n, 0) AS accounts, coalesce(k.n, 0) AS cards, coalesce(l.n, 0) AS loans FROM s_customers LEFT JOIN (SELECT customer_id, count(*) n FROM s_accounts GROUP BY 1) a USING (customer_id) LEFT JOIN (SELECT customer_id, count(*) n FROM s_cards GROUP BY 1) k USING (customer_id) LEFT JOIN (SELECT customer_id, count(*) n FROM s_loans GROUP BY 1) l USING (customer_id)")
def _(b):
    c, out = Clean(b), None
    out = c.customers.select("customer_id", "customer_name")
    for df, n in ((c.accounts, "accounts"), (c.cards, "cards"), (c.loans, "loans")):
        out = out.join(df.groupBy("customer_id").agg(F.count("*").alias(n)), "customer_id", "left")
    return out.fillna(0, ["accounts", "cards", "loans"])


@query("v_daily_summary", "SELECT txn_date::VARCHAR AS txn_date, count(*) AS transactions, sum(amount)::DOUBLE AS total, count(*) FILTER (WHERE status = 'FAILED') AS failed FROM s_transactions GROUP BY 1")
def _(b):
    return Clean(b).transactions.groupBy("txn_date").agg(F.count("*").alias("transactions"), X.dsum("amount").alias("total"), F.count_if(F.col("status") == "FAILED").alias("failed"))


@query("v_branch_performance", "SELECT branch_code::BIGINT AS branch_code, accounts, customers, balance, coalesce(loans, 0) AS loans, coalesce(lo, 0) AS loan_outstanding FROM (SELECT branch_code, count(*) AS accounts, count(DISTINCT customer_id) AS customers, sum(current_balance)::DOUBLE AS balance FROM s_accounts GROUP BY 1) LEFT JOIN (SELECT branch_code, count(*) AS loans, sum(principal_outstanding)::DOUBLE AS lo FROM s_loans JOIN s_accounts USING (customer_id) WHERE loan_status = 'ACTIVE' GROUP BY 1) USING (branch_code)")
def _(b):
    c = Clean(b)
    return C.branch_performance(c.accounts, c.loans)


_DW = """SELECT customer_id, customer_name, city, CASE WHEN segment = 'MACHINERY' THEN 'CORPORATE' ELSE 'RETAIL' END AS customer_segment, coalesce(n, 0) AS total_accounts, coalesce(dep, 0) AS total_deposit_balance, coalesce(cur, 0) AS total_current_balance, coalesce(tn, 0) AS total_transactions_30d, coalesce(ta, 0) AS total_transaction_amount_30d, coalesce(ln, 0) AS total_loans, coalesce(lo, 0) AS total_loan_outstanding
    FROM s_customers LEFT JOIN (SELECT customer_id, count(*) AS n, (sum(current_balance) FILTER (WHERE account_type_standardized IN ('SAVINGS','FIXED_DEPOSIT')))::DOUBLE AS dep, (sum(current_balance) FILTER (WHERE account_type_standardized = 'CURRENT'))::DOUBLE AS cur FROM s_accounts WHERE status_standardized = 'ACTIVE' GROUP BY 1) USING (customer_id)
    LEFT JOIN (SELECT customer_id, count(*) AS tn, sum(amount)::DOUBLE AS ta FROM s_transactions JOIN s_accounts USING (account_id) WHERE txn_date >= DATE '2001-07-03' GROUP BY 1) USING (customer_id) LEFT JOIN (SELECT customer_id, count(*) AS ln, sum(principal_outstanding)::DOUBLE AS lo FROM s_loans GROUP BY 1) USING (customer_id)"""


def dw360(b):
    c = Clean(b)
    t = F.col("account_type_standardized")
    acc = c.accounts.filter("status_standardized = 'ACTIVE'").groupBy("customer_id").agg(F.count("*").alias("total_accounts"), X.sum_if(t.isin("SAVINGS", "FIXED_DEPOSIT"), "current_balance").alias("total_deposit_balance"), X.sum_if(t == "CURRENT", "current_balance").alias("total_current_balance"))
    recent = c.transactions.filter(F.col("txn_date") >= SINCE).groupBy("account_id").agg(F.count("*").alias("n"), F.sum("amount").alias("a")).join(c.accounts.select("account_id", "customer_id"), "account_id")
    txn = recent.groupBy("customer_id").agg(F.sum("n").alias("total_transactions_30d"), X.dsum("a").alias("total_transaction_amount_30d"))
    loans = c.loans.groupBy("customer_id").agg(F.count("*").alias("total_loans"), X.dsum("principal_outstanding").alias("total_loan_outstanding"))
    base = c.customers.select("customer_id", "customer_name", "city", F.when(F.col("segment") == "MACHINERY", "CORPORATE").otherwise("RETAIL").alias("customer_segment"))
    return base.join(acc, "customer_id", "left").join(txn, "customer_id", "left").join(loans, "customer_id", "left").fillna(0)


@query("dw_customer_360", _DW)
def _(b):
    return dw360(b)


@query("dw_top_customers", f"SELECT customer_id, customer_name, total_deposit_balance FROM ({_DW}) ORDER BY total_deposit_balance DESC, customer_id LIMIT 10")
def _(b):
    return dw360(b).select("customer_id", "customer_name", "total_deposit_balance").orderBy(F.desc("total_deposit_balance"), "customer_id").limit(10)


@query("dw_activity_by_month", "SELECT CASE WHEN segment = 'MACHINERY' THEN 'CORPORATE' ELSE 'RETAIL' END AS customer_segment, strftime(txn_date, '%B') AS month_name, year(txn_date) AS year, count(*) AS transaction_count, sum(amount)::DOUBLE AS total_amount FROM s_transactions JOIN s_accounts USING (account_id) JOIN s_customers USING (customer_id) GROUP BY ALL")
def _(b):
    c = Clean(b)
    seg = c.customers.select("customer_id", F.when(F.col("segment") == "MACHINERY", "CORPORATE").otherwise("RETAIL").alias("customer_segment"))
    per = c.transactions.groupBy("account_id", F.date_format("txn_date", "MMMM").alias("month_name"), F.year("txn_date").alias("year")).agg(F.count("*").alias("n"), F.sum("amount").alias("a"))
    return per.join(c.accounts.select("account_id", "customer_id"), "account_id").join(seg, "customer_id").groupBy("customer_segment", "month_name", "year").agg(F.sum("n").alias("transaction_count"), X.dsum("a").alias("total_amount"))


@query("daily_transaction_summary", """SELECT txn_date::VARCHAR AS txn_date, channel_standardized AS channel, txn_type_standardized AS txn_type, count(*) AS transaction_count, sum(amount)::DOUBLE AS total_amount, sum(amount)::DOUBLE / count(*) AS avg_amount, min(amount)::DOUBLE AS min_amount, max(amount)::DOUBLE AS max_amount,
    count(DISTINCT account_id) AS unique_accounts, count(*) FILTER (WHERE amount > 250000) AS high_value_count, count(*) FILTER (WHERE is_weekend) AS weekend_count, count(*) FILTER (WHERE time_bucket = 'NIGHT') AS night_count FROM s_transactions GROUP BY ALL""")
def _(b):
    return C.daily_summary(Clean(b).transactions, 250000)


def orders(b):
    return b.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), money("o_totalprice").alias("amount"))


@query("rfm", """WITH p AS (SELECT o_custkey, (DATE '2001-08-02' - max(o_orderdate)::DATE)::BIGINT AS recency, count(DISTINCT o_orderkey) AS frequency, sum(o_totalprice::DECIMAL(18,2)) AS monetary FROM orders GROUP BY 1),
    s AS (SELECT *, ntile(5) OVER (ORDER BY recency DESC, o_custkey) AS r_score, ntile(5) OVER (ORDER BY frequency, o_custkey) AS f_score, ntile(5) OVER (ORDER BY monetary, o_custkey) AS m_score FROM p)
    SELECT o_custkey, recency, frequency, monetary::DOUBLE AS monetary, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers' WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers' WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' ELSE 'Potential' END AS customer_segment FROM s""")
def _(b):
    return C.rfm(orders(b), "o_custkey", "o_orderkey", "day", "amount", AS_OF)


@query("cohort_retention", """WITH a AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate)::DATE AS m FROM orders), f AS (SELECT o_custkey, min(m) AS c FROM a GROUP BY 1), z AS (SELECT c, count(*) AS n FROM f GROUP BY 1)
    SELECT c::VARCHAR AS cohort_month, datediff('month', c, m) AS months_since_first, count(*) AS active_customers, any_value(n) AS cohort_size, count(*) * 100.0::DOUBLE / any_value(n) AS retention_pct FROM a JOIN f USING (o_custkey) JOIN z USING (c) GROUP BY c, m""")
def _(b):
    return C.cohort_retention(orders(b), "o_custkey", "day")


@query("cohort_ltv", """WITH f AS (SELECT o_custkey, date_trunc('month', min(o_orderdate))::DATE AS c FROM orders GROUP BY 1), s AS (SELECT c, datediff('month', c, o_orderdate::DATE) AS n, sum(o_totalprice::DECIMAL(18,2)) AS v FROM orders JOIN f USING (o_custkey) GROUP BY ALL)
    SELECT c::VARCHAR AS cohort_month, n AS month_no, v::DOUBLE AS spend, sum(v) OVER (PARTITION BY c ORDER BY n)::DOUBLE AS cumulative_spend FROM s""")
def _(b):
    return C.cohort_ltv(orders(b), "o_custkey", "day", "amount")


@query("funnel_analysis", """WITH a AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'signup' GROUP BY 1), v AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN a ON e.user_id = a.user_id AND ts > a.t WHERE event_type = 'view' GROUP BY 1), p AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN v ON e.user_id = v.user_id AND ts > v.t WHERE event_type = 'purchase' GROUP BY 1)
    SELECT 1::BIGINT AS step_no, 'signup' AS step, count(*) AS users FROM a UNION ALL SELECT 2, 'view', count(*) FROM v UNION ALL SELECT 3, 'purchase', count(*) FROM p""")
def _(b):
    return C.funnel(b.table("events"), "user_id", "event_type", "ts", ["signup", "view", "purchase"])


@query("sessionization", """WITH e AS (SELECT *, lag(ts) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session_no FROM e)
    SELECT user_id, session_no, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS events FROM s GROUP BY ALL""")
def _(b):
    return C.sessions(b.table("events"), "user_id", "ts", "event_id", 1800)


@query("gaps_and_islands", """WITH d AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events), g AS (SELECT *, d - row_number() OVER (PARTITION BY user_id ORDER BY d)::INT AS k FROM d) SELECT user_id, min(d)::VARCHAR AS start_date, max(d)::VARCHAR AS end_date, count(*) AS days FROM g GROUP BY user_id, k""")
def _(b):
    return R.islands(b.table("events").select("user_id", F.col("ts").cast("date").alias("d")), "user_id", "d")


@query("period_over_period", "WITH q AS (SELECT date_trunc('quarter', o_orderdate)::DATE AS q, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS t FROM orders GROUP BY 1) SELECT q::VARCHAR AS quarter, t AS total, lag(t, 1) OVER (ORDER BY q) AS prev_quarter, lag(t, 4) OVER (ORDER BY q) AS prev_year, (t - lag(t, 4) OVER (ORDER BY q)) * 100.0::DOUBLE / lag(t, 4) OVER (ORDER BY q) AS yoy_pct FROM q")
def _(b):
    q = orders(b).groupBy(F.trunc("day", "quarter").alias("quarter")).agg(X.dsum("amount").alias("total"))
    w = W.orderBy("quarter")
    py = F.lag("total", 4).over(w)
    return q.select("quarter", "total", F.lag("total", 1).over(w).alias("prev_quarter"), py.alias("prev_year"), X.pct(F.col("total") - py, py).alias("yoy_pct"))


@query("monthly_ecommerce_metrics", """WITH p AS (SELECT l_orderkey, sum(revenue) AS r, sum(price * 0.60) AS c FROM b_lines GROUP BY 1), m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, count(DISTINCT o_custkey) AS customers, sum(r)::DOUBLE AS revenue, sum(c)::DOUBLE AS cost FROM orders JOIN p ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT month, orders, customers, revenue, lag(revenue) OVER w AS prev_month, (revenue - lag(revenue) OVER w) * 100.0::DOUBLE / lag(revenue) OVER w AS mom_growth_pct, (sum(revenue::DECIMAL(28,4)) OVER (ORDER BY month ROWS 2 PRECEDING))::DOUBLE / count(revenue) OVER (ORDER BY month ROWS 2 PRECEDING) AS moving_avg_3m, (revenue - cost) * 100.0::DOUBLE / revenue AS margin_pct FROM m WINDOW w AS (ORDER BY month)""")
def _(b):
    return C.monthly_commerce(b.order_lines(), b.table("orders"), "0.60")


@query("product_affinity", """WITH k AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), n AS (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem)
    SELECT a.l_partkey AS product_a, z.l_partkey AS product_b, count(*) AS pair_count, count(*) * 100.0::DOUBLE / any_value(n) AS support_pct FROM k a JOIN k z ON a.l_orderkey = z.l_orderkey AND a.l_partkey < z.l_partkey, n GROUP BY ALL HAVING count(*) >= 2""")
def _(b):
    return C.affinity(b.table("lineitem"), "l_orderkey", "l_partkey", 2)


@query("customer_risk_profile", """WITH s AS (SELECT user_id, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS t, sum((value::DECIMAL(18,2) * value::DECIMAL(18,2))::DECIMAL(38,4))::DOUBLE AS q FROM events GROUP BY 1), x AS (SELECT *, t / n AS m, coalesce(CASE WHEN n > 1 THEN sqrt(greatest((q - t * t / n) / (n - 1), 0)) END, 0) AS sd FROM s),
    z AS (SELECT *, (CASE WHEN m > 50 THEN 3 WHEN m > 45 THEN 2 ELSE 1 END + CASE WHEN n > 80 THEN 3 WHEN n > 65 THEN 2 ELSE 1 END + CASE WHEN sd > m * 2 THEN 3 WHEN sd > m THEN 2 ELSE 1 END)::BIGINT AS sc FROM x)
    SELECT user_id, n AS txn_count, t AS total_amount, sc AS total_risk_score, CASE WHEN sc >= 7 THEN 'HIGH' WHEN sc >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category FROM z""")
def _(b):
    e = b.table("events").withColumn("v", money("value"))
    return C.risk_profile(e, "user_id", "v", (45, 50), (65, 80)).select("user_id", "txn_count", "total_amount", "total_risk_score", "risk_category")


@query("price_change_alert", """WITH p AS (SELECT event_type, event_id, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events) SELECT event_type, event_id, value AS price, prev AS previous_price, (value - prev) * 100.0::DOUBLE / nullif(prev, 0) AS change_pct FROM p WHERE abs((value - prev) * 100.0::DOUBLE / nullif(prev, 0)) > 10""")
def _(b):
    p = b.table("events").select("event_type", "event_id", "ts", F.col("value").alias("price"))
    return C.price_changes(p, "event_type", "ts", "event_id", "price", 10).drop("ts")


@query("real_time_pnl", "SELECT account_id, coalesce((sum(amount) FILTER (WHERE txn_type_standardized = 'CREDIT'))::DOUBLE, 0) AS credits, coalesce((sum(amount) FILTER (WHERE txn_type_standardized = 'DEBIT'))::DOUBLE, 0) AS debits, coalesce((sum(amount) FILTER (WHERE txn_type_standardized = 'CREDIT'))::DOUBLE, 0) - coalesce((sum(amount) FILTER (WHERE txn_type_standardized = 'DEBIT'))::DOUBLE, 0) AS net FROM s_transactions GROUP BY 1")
def _(b):
    return C.pnl_per_account(Clean(b).transactions)


@query("net_inventory", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket, sum(CASE WHEN event_type = 'view' THEN event_id % 10 WHEN event_type = 'purchase' THEN -(event_id % 10) ELSE 0 END)::BIGINT AS net_change, count(*) AS events FROM events GROUP BY 1")
def _(b):
    kind = F.col("event_type")
    return C.net_change(b.table("events"), F.date_trunc("hour", F.col("ts").cast("timestamp")), kind == "view", kind == "purchase", F.col("event_id") % 10)
