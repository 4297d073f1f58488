"""Dimensions, history, facts and vault queries."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import history as H
from finquarry.operators import relational as R
from finquarry.operators import warehouse as D
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF, money
from finquarry.sources.clean import Clean

# --- dimensions -----------------------------------------------------------------------------------


@query("dim_date", """SELECT strftime(d, '%Y%m%d')::BIGINT AS date_key, d::DATE::VARCHAR AS full_date, (dayofweek(d) + 1)::BIGINT AS day_of_week, strftime(d, '%A') AS day_name, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
    dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_business_day, weekofyear(d) AS week_of_year, month(d) AS month_number, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_abbrev,
    quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name, year(d) AS year, strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter, year(d) AS fiscal_year, quarter(d) AS fiscal_quarter,
    last_day(d) = d::DATE AS is_month_end, (last_day(d) = d::DATE AND month(d) % 3 = 0) AS is_quarter_end, (month(d) = 12 AND day(d) = 31) AS is_year_end, coalesce(n, 0) AS orders
    FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(d) LEFT JOIN (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY 1) ON o_orderdate = d""")
def _(b):
    n = b.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(F.count("*").alias("orders"))
    return D.dim_date(b.spark, "1995-01-01", "2001-12-31").join(n, "full_date", "left").fillna({"orders": 0})


@query("dim_account", "SELECT md5(account_id::VARCHAR) AS account_sk, account_id, customer_id, account_type_standardized AS account_type, CASE WHEN account_type_standardized IN ('SAVINGS','FIXED_DEPOSIT','RECURRING_DEPOSIT') THEN 'DEPOSIT' WHEN account_type_standardized = 'CURRENT' THEN 'CURRENT' ELSE 'OTHER' END AS account_type_group, status_standardized AS status, status_standardized = 'ACTIVE' AS is_active, branch_code::BIGINT AS branch_code, current_balance::DOUBLE AS current_balance FROM s_accounts")
def _(b):
    return D.dim_account(Clean(b).accounts)


@query("dim_customer_build", """SELECT md5(customer_id::VARCHAR) AS customer_sk, customer_id, customer_name, city, region, datesub('year', date_of_birth, DATE '2001-08-02') AS age,
    CASE WHEN datesub('year', date_of_birth, DATE '2001-08-02') < 30 THEN 'YOUNG' WHEN datesub('year', date_of_birth, DATE '2001-08-02') < 45 THEN 'ADULT' WHEN datesub('year', date_of_birth, DATE '2001-08-02') < 60 THEN 'MIDDLE_AGE' ELSE 'SENIOR' END AS age_group,
    CASE WHEN segment = 'MACHINERY' THEN 'CORPORATE' ELSE 'RETAIL' END AS customer_segment FROM s_customers""")
def _(b):
    return D.dim_customer(Clean(b).customers, AS_OF)


@query("dim_branch", "SELECT md5(n_nationkey::VARCHAR) AS branch_sk, n_nationkey::BIGINT AS branch_code, n_name AS branch_name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(b):
    return D.dim_branch(b.table("nation"), b.table("region"))


@query("dim_product", "SELECT DISTINCT md5(coalesce(length(p_type) || ':' || p_type, '-') || coalesce(length(p_brand) || ':' || p_brand, '-')) AS product_sk, p_type AS product_category, p_brand AS product_name FROM part")
def _(b):
    return D.dim_product(b.table("part"))


@query("dim_customer_mart", """SELECT md5(customer_id::VARCHAR) AS customer_sk, customer_id, customer_name, coalesce(n, 0) AS total_accounts, tot::DOUBLE AS total_balance, hi::DOUBLE AS max_account_balance, lo::DOUBLE AS min_account_balance,
    coalesce(sv, 0) AS savings_accounts, coalesce(cu, 0) AS current_accounts, CASE WHEN coalesce(tot, 0) >= 8000 THEN 'PLATINUM' WHEN coalesce(tot, 0) >= 5000 THEN 'GOLD' WHEN coalesce(tot, 0) >= 1000 THEN 'SILVER' ELSE 'STANDARD' END AS customer_segment
    FROM s_customers LEFT JOIN (SELECT customer_id, count(*) n, sum(current_balance) tot, max(current_balance) hi, min(current_balance) lo, count(*) FILTER (WHERE account_type_standardized = 'SAVINGS') sv, count(*) FILTER (WHERE account_type_standardized = 'CURRENT') cu FROM s_accounts GROUP BY 1) USING (customer_id)""")
def _(b):
    c = Clean(b)
    return D.dim_customer_mart(c.customers, c.accounts, [(8000, "PLATINUM"), (5000, "GOLD"), (1000, "SILVER")])


@query("surrogate_key", "SELECT md5(coalesce(length(l_orderkey::VARCHAR) || ':' || l_orderkey::VARCHAR, '-') || coalesce(length(l_linenumber::VARCHAR) || ':' || l_linenumber::VARCHAR, '-') || coalesce(length(l_partkey::VARCHAR) || ':' || l_partkey::VARCHAR, '-') || coalesce(length(l_suppkey::VARCHAR) || ':' || l_suppkey::VARCHAR, '-')) AS line_sk, count(*) AS n FROM lineitem GROUP BY 1")
def _(b):
    return b.table("lineitem").select(X.key_hash("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_sk")).groupBy("line_sk").agg(F.count("*").alias("n"))


@query("dim_junk", "SELECT DISTINCT l_returnflag, l_linestatus, md5(coalesce(length(l_returnflag) || ':' || l_returnflag, '-') || coalesce(length(l_linestatus) || ':' || l_linestatus, '-')) AS junk_sk FROM lineitem")
def _(b):
    return D.junk_dimension(b.table("lineitem"), ["l_returnflag", "l_linestatus"])


@query("dim_degenerate", "SELECT l_orderkey AS order_number, count(*) AS lines, sum(revenue)::DOUBLE AS revenue FROM b_lines GROUP BY 1")
def _(b):
    return b.order_lines().groupBy(F.col("l_orderkey").alias("order_number")).agg(F.count("*").alias("lines"), X.dsum("revenue").alias("revenue"))


@query("dim_role_playing", "SELECT year(o_orderdate) AS order_year, year(l_shipdate) AS ship_year, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def _(b):
    o = b.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("order_date"))
    dates = D.dim_date(b.spark, "1995-01-01", "2001-12-31")
    rows = b.order_lines().select("l_orderkey", "ship_date").join(o, "l_orderkey")
    return D.role_playing(rows, dates, {"order": "order_date", "ship": "ship_date"}, ["year"]).groupBy("order_year", "ship_year").agg(F.count("*").alias("n"))


@query("dim_conformed", "SELECT n_name, c.n AS customers, s.n AS suppliers FROM nation LEFT JOIN (SELECT c_nationkey, count(*) n FROM customer GROUP BY 1) c ON n_nationkey = c_nationkey LEFT JOIN (SELECT s_nationkey, count(*) n FROM supplier GROUP BY 1) s ON n_nationkey = s_nationkey")
def _(b):
    c = b.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    s = b.table("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    return b.table("nation").join(c, "n_nationkey", "left").join(s, "n_nationkey", "left").select("n_name", "customers", "suppliers")


def customer_tree(b):
    k = F.col("c_custkey")
    tree = b.table("customer").select(k.alias("node"), F.when(k > 0, F.floor(k / 10)).alias("parent"))
    return R.hierarchy(tree, "node", "parent")


@query("dim_hierarchy_flatten", """WITH RECURSIVE h AS (SELECT c_custkey AS node, [c_custkey] AS path FROM customer WHERE c_custkey = 0 UNION ALL SELECT c.c_custkey, list_append(h.path, c.c_custkey) FROM customer c JOIN h ON c.c_custkey // 10 = h.node AND c.c_custkey > 0)
    SELECT node, path[1] AS level_1, path[2] AS level_2, path[3] AS level_3, path[4] AS level_4 FROM h""")
def _(b):
    return D.flatten_levels(customer_tree(b), 4)


@query("dim_hierarchy_levels", """WITH RECURSIVE h AS (SELECT c_custkey AS node, [c_custkey] AS path FROM customer WHERE c_custkey = 0 UNION ALL SELECT c.c_custkey, list_append(h.path, c.c_custkey) FROM customer c JOIN h ON c.c_custkey // 10 = h.node AND c.c_custkey > 0)
    SELECT node, unnest(generate_series(1, len(path))) AS level, unnest(path) AS ancestor FROM h""")
def _(b):
    return D.node_levels(customer_tree(b))


@query("dim_unknown_member", "SELECT l.doc_id, coalesce(md5(d.doc_id::VARCHAR), '-1') AS doc_sk FROM labels l LEFT JOIN (SELECT doc_id FROM documents WHERE lang = 'en') d ON l.doc_id = d.doc_id")
def _(b):
    dim = b.table("documents").filter("lang = 'en'").select("doc_id", X.key_hash("doc_id").alias("doc_sk"))
    return D.with_unknown_member(b.table("labels").select("doc_id"), dim, "doc_id", "doc_sk")


# --- slowly changing dimensions -----------------------------------------------------------------------


@query("scd0", "SELECT customer_id, nation::BIGINT AS nation FROM b_snap_old UNION ALL SELECT customer_id, nation FROM b_snap_new WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_old)")
def _(b):
    return H.scd0(b.snapshot_old(), b.snapshot_new(), "customer_id").select("customer_id", "nation")


_SCD1 = "SELECT coalesce(o.customer_id, n.customer_id) AS customer_id, CASE WHEN n.customer_id IS NULL THEN o.nation ELSE n.nation END::BIGINT AS nation, CASE WHEN n.customer_id IS NULL THEN o.balance ELSE n.balance END::DOUBLE AS balance FROM b_snap_old o FULL JOIN b_snap_new n ON o.customer_id = n.customer_id"


@query("scd1", _SCD1)
def _(b):
    return H.scd1(b.snapshot_old(), b.snapshot_new(), "customer_id").select("customer_id", "nation", "balance")


_SCD2 = """WITH j AS (SELECT coalesce(o.customer_id, n.customer_id) AS customer_id, o.customer_id IS NOT NULL AS known, n.customer_id IS NOT NULL AS fresh, o.nation AS on_, n.nation AS nn, o.balance AS ob, n.balance AS nb FROM b_snap_old o FULL JOIN b_snap_new n ON o.customer_id = n.customer_id),
    j2 AS (SELECT *, known AND fresh AND (on_ IS DISTINCT FROM nn OR ob IS DISTINCT FROM nb) AS changed FROM j),
    v AS (SELECT customer_id, on_::BIGINT AS nation, ob::DOUBLE AS balance, '1995-01-01' AS valid_from, CASE WHEN changed OR NOT fresh THEN '2001-08-02' END AS valid_to, NOT (changed OR NOT fresh) AS is_current FROM j2 WHERE known
      UNION ALL SELECT customer_id, nn::BIGINT, nb::DOUBLE, '2001-08-02', NULL, true FROM j2 WHERE fresh AND (NOT known OR changed)) """


def versions(b):
    first = H.first_versions(b.snapshot_old(), "customer_id", "1995-01-01")
    return H.scd2(first, b.snapshot_new(), "customer_id", ["nation", "balance"], AS_OF, close_missing=True)


@query("scd2", _SCD2 + "SELECT *, md5(coalesce(length(customer_id::VARCHAR) || ':' || customer_id::VARCHAR, '-') || coalesce(length(valid_from) || ':' || valid_from, '-')) AS sk FROM v")
def _(b):
    return versions(b).select("customer_id", "nation", "balance", "valid_from", "valid_to", "is_current", "sk")


@query("scd2_from_changes", """WITH e AS (SELECT user_id, event_type, ts, event_id FROM events), c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM e), r AS (SELECT * FROM c WHERE p IS NULL OR p <> event_type)
    SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM r""")
def _(b):
    return H.scd2_from_changes(b.table("events").select("user_id", "event_type", "event_id"), "user_id", ["event_type"], "event_id")


@query("scd3", "SELECT coalesce(o.customer_id, n.customer_id) AS customer_id, CASE WHEN n.customer_id IS NULL THEN o.nation ELSE n.nation END::BIGINT AS nation, CASE WHEN o.nation <> n.nation THEN o.nation END::BIGINT AS previous_nation, CASE WHEN o.nation <> n.nation THEN '2001-08-02' END AS change_date FROM b_snap_old o FULL JOIN b_snap_new n ON o.customer_id = n.customer_id")
def _(b):
    return H.scd3(b.snapshot_old().select("customer_id", "nation"), b.snapshot_new().select("customer_id", "nation"), "customer_id", "nation", AS_OF)


@query("scd4_current", _SCD1)
def _(b):
    return H.scd4(b.snapshot_old(), b.snapshot_new(), "customer_id", AS_OF)[0].select("customer_id", "nation", "balance")


@query("scd4_history", "SELECT o.customer_id, o.nation::BIGINT AS nation, o.balance::DOUBLE AS balance, '2001-08-02' AS valid_to FROM b_snap_old o JOIN b_snap_new n ON o.customer_id = n.customer_id WHERE o.nation <> n.nation OR o.balance IS DISTINCT FROM n.balance")
def _(b):
    return H.scd4(b.snapshot_old(), b.snapshot_new(), "customer_id", AS_OF)[1].select("customer_id", "nation", "balance", "valid_to")


@query("scd5", "SELECT a.customer_id, a.nation, coalesce(h.n, 0) AS archived_versions FROM (" + _SCD1 + ") a LEFT JOIN (SELECT o.customer_id, count(*) AS n FROM b_snap_old o JOIN b_snap_new n ON o.customer_id = n.customer_id WHERE o.nation <> n.nation OR o.balance IS DISTINCT FROM n.balance GROUP BY 1) h ON a.customer_id = h.customer_id")
def _(b):
    return H.scd5(b.snapshot_old(), b.snapshot_new(), "customer_id", AS_OF).select("customer_id", "nation", "archived_versions")


@query("scd6", """WITH j AS (SELECT coalesce(o.customer_id, n.customer_id) AS customer_id, o.nation AS a, n.nation AS z, o.customer_id IS NOT NULL AS known, n.customer_id IS NOT NULL AS fresh FROM b_snap_old o FULL JOIN b_snap_new n ON o.customer_id = n.customer_id)
    SELECT customer_id, a::BIGINT AS nation, NULL::BIGINT AS previous_nation, coalesce(z, a)::BIGINT AS current_nation, coalesce(a = z, true) AS is_current FROM j WHERE known
    UNION ALL SELECT customer_id, z, a, z, true FROM j WHERE fresh AND (NOT known OR a <> z)""")
def _(b):
    first = H.first_versions(b.snapshot_old().select("customer_id", "nation"), "customer_id", "1995-01-01")
    return H.scd6(first, b.snapshot_new().select("customer_id", "nation"), "customer_id", "nation", AS_OF).select("customer_id", "nation", "previous_nation", "current_nation", "is_current")


@query("dim_current", _SCD2 + "SELECT customer_id, nation FROM v WHERE is_current")
def _(b):
    return H.current_rows(versions(b)).select("customer_id", "nation")


@query("dim_history", _SCD2 + "SELECT customer_id, nation, valid_from, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS version FROM v")
def _(b):
    return H.history_rows(versions(b), "customer_id").select("customer_id", "nation", "valid_from", "version")


# --- facts -----------------------------------------------------------------------------------------------


def dims(b):
    c = Clean(b)
    return c, D.dim_account(c.accounts), D.dim_customer(c.customers, AS_OF), D.dim_branch(b.table("nation"), b.table("region"))


def fact_table(b, loaded=None):
    c, a, cu, br = dims(b)
    return D.fact_transactions(c.transactions, a, cu, br, 250000, loaded)


_FACT = "FROM s_transactions t JOIN s_accounts a ON t.account_id = a.account_id JOIN b_customers c ON a.customer_id = c.customer_id JOIN nation ON a.branch_code = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("fact_transactions_load", f"SELECT strftime(txn_date, '%Y%m%d')::BIGINT AS date_key, md5(c.customer_id::VARCHAR) AS customer_sk, md5(a.account_id::VARCHAR) AS account_sk, md5(n_nationkey::VARCHAR) AS branch_sk, txn_id, txn_type_standardized AS txn_type, channel_standardized AS channel, amount::DOUBLE AS transaction_amount, amount > 250000 AS is_high_value, is_weekend {_FACT} WHERE txn_date >= DATE '1998-01-01'")
def _(b):
    return fact_table(b, Clean(b).transactions.filter("txn_date < '1998-01-01'"))


@query("fact_transactions_incremental", """SELECT txn_id, t.account_id, txn_date::VARCHAR AS txn_date, amount::DOUBLE AS amount, CASE WHEN amount < 100000 THEN 'SMALL' WHEN amount < 250000 THEN 'MEDIUM' WHEN amount < 400000 THEN 'LARGE' ELSE 'VERY_LARGE' END AS amount_category,
    year(txn_date) AS transaction_year, month(txn_date) AS transaction_month, sum(amount) OVER (PARTITION BY t.account_id ORDER BY txn_date, txn_id)::DOUBLE AS running_balance, md5(a.account_id::VARCHAR) AS account_sk
    FROM s_transactions t LEFT JOIN s_accounts a ON t.account_id = a.account_id WHERE txn_date > DATE '1999-12-31'""")
def _(b):
    c, a, _, _ = dims(b)
    return D.fact_transactions_incremental(c.transactions, a, "1999-12-31", [(100000, "SMALL"), (250000, "MEDIUM"), (400000, "LARGE")])


_BAL = """d AS (SELECT account_id, txn_date AS day, count(*) FILTER (WHERE txn_type_standardized = 'CREDIT') AS cc, count(*) FILTER (WHERE txn_type_standardized <> 'CREDIT') AS dc, sum(CASE WHEN txn_type_standardized = 'CREDIT' THEN amount ELSE -amount END) AS net FROM s_transactions GROUP BY ALL),
    r AS (SELECT d.*, coalesce(current_balance, 0) + sum(net) OVER (PARTITION BY d.account_id ORDER BY day) AS closing FROM d LEFT JOIN s_accounts USING (account_id)) """


def balances(b):
    c = Clean(b)
    return D.fact_account_balance(c.transactions, c.accounts.select("account_id", F.col("current_balance").alias("opening_balance")))


@query("fact_account_balance", "WITH " + _BAL + "SELECT account_id, day::VARCHAR AS day, cc AS credit_count, dc AS debit_count, net::DOUBLE AS net_flow, (closing - net)::DOUBLE AS opening_balance, closing::DOUBLE AS closing_balance FROM r")
def _(b):
    return balances(b).select("account_id", "day", "credit_count", "debit_count", "net_flow", "opening_balance", "closing_balance")


@query("fact_account_balance_month_end", "WITH " + _BAL + """, m AS (SELECT account_id, date_trunc('month', day)::DATE AS month, max_by(closing, day) AS closing FROM r GROUP BY ALL),
    s AS (SELECT account_id, unnest(generate_series(min(month)::TIMESTAMP, TIMESTAMP '2001-08-01', INTERVAL 1 MONTH))::DATE AS month FROM m GROUP BY 1)
    SELECT account_id, month::VARCHAR AS month, last_value(closing IGNORE NULLS) OVER (PARTITION BY account_id ORDER BY month ROWS UNBOUNDED PRECEDING)::DOUBLE AS balance FROM s LEFT JOIN m USING (account_id, month)""")
def _(b):
    return D.month_end_balances(balances(b), "1995-01-01", "2001-08-01")


@query("fact_loan_payment", """SELECT strftime(payment_date, '%Y%m%d')::BIGINT AS date_key, md5(customer_id::VARCHAR) AS customer_sk, p.loan_id, loan_type_standardized AS loan_type, payment_id, amount::DOUBLE AS payment_amount,
    principal_outstanding::DOUBLE / tenure_months::DOUBLE AS principal_amount, amount::DOUBLE - principal_outstanding::DOUBLE / tenure_months::DOUBLE AS interest_amount, principal_outstanding::DOUBLE AS principal_outstanding, tenure_months::BIGINT AS tenure_months, status_standardized = 'SUCCESS' AS payment_success
    FROM s_payments p JOIN s_loans l ON p.loan_id = l.loan_id""")
def _(b):
    c, _, cu, _ = dims(b)
    return D.fact_loan_payment(c.payments, c.loans, cu)


@query("fact_accumulating", """SELECT user_id, strftime(min(ts) FILTER (WHERE event_type = 'signup'), '%Y-%m-%d %H:%M:%S') AS signup_at, strftime(min(ts) FILTER (WHERE event_type = 'view'), '%Y-%m-%d %H:%M:%S') AS view_at, strftime(min(ts) FILTER (WHERE event_type = 'purchase'), '%Y-%m-%d %H:%M:%S') AS purchase_at,
    epoch(date_trunc('second', min(ts) FILTER (WHERE event_type = 'view')))::BIGINT - epoch(date_trunc('second', min(ts) FILTER (WHERE event_type = 'signup')))::BIGINT AS signup_to_view_s,
    epoch(date_trunc('second', min(ts) FILTER (WHERE event_type = 'purchase')))::BIGINT - epoch(date_trunc('second', min(ts) FILTER (WHERE event_type = 'view')))::BIGINT AS view_to_purchase_s FROM events GROUP BY 1""")
def _(b):
    return D.accumulating_snapshot(b.table("events"), "user_id", "event_type", "ts", ["signup", "view", "purchase"])


@query("fact_factless", "SELECT l_suppkey, l_returnflag, count(DISTINCT l_partkey) AS l_partkey_count FROM lineitem GROUP BY ALL")
def _(b):
    return D.factless(b.table("lineitem"), ["l_suppkey", "l_returnflag"], "l_partkey")


@query("fact_customer_daily", "SELECT user_id, ts::DATE::VARCHAR AS day, count(*) FILTER (WHERE event_type = 'view') AS view_count, count(*) FILTER (WHERE event_type = 'click') AS click_count, count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL")
def _(b):
    e = b.table("events").withColumn("v", money("value"))
    return D.customer_daily_activity(e, "user_id", F.col("ts").cast("date"), "event_type", ["view", "click", "purchase"], "v")


@query("vw_daily_transaction_summary", f"""SELECT txn_date::VARCHAR AS full_date, strftime(txn_date, '%A') AS day_name, year(txn_date) AS year, CASE WHEN c.segment = 'MACHINERY' THEN 'CORPORATE' ELSE 'RETAIL' END AS customer_segment, account_type_standardized AS account_type, r_name AS region, txn_type_standardized AS txn_type, channel_standardized AS channel,
    count(*) AS transaction_count, sum(amount)::DOUBLE AS total_amount, max(amount)::DOUBLE AS max_amount, count(*) FILTER (WHERE amount > 250000) AS high_value_count {_FACT} GROUP BY ALL""")
def _(b):
    c, a, cu, br = dims(b)
    f = D.fact_transactions(c.transactions, a, cu, br, 250000)
    dates = D.dim_date(b.spark, "1995-01-01", "2001-12-31").select("date_key", "full_date", "day_name", "year")
    star = f.join(dates, "date_key").join(cu.select("customer_sk", "customer_segment"), "customer_sk").join(a.select("account_sk", "account_type"), "account_sk").join(br.select("branch_sk", "region"), "branch_sk")
    return star.groupBy("full_date", "day_name", "year", "customer_segment", "account_type", "region", "txn_type", "channel").agg(
        F.count("*").alias("transaction_count"), X.dsum("transaction_amount").alias("total_amount"), F.max("transaction_amount").alias("max_amount"), F.count_if("is_high_value").alias("high_value_count"))


@query("star_query", """SELECT r_name, strftime(o_orderdate, '%Y-%m') AS month, sum(revenue)::DOUBLE AS revenue, count(DISTINCT o_orderkey) AS orders FROM b_lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def _(b):
    per = b.order_lines().groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("revenue").alias("r"))
    o = b.table("orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).join(per, "o_orderkey")
    wide = R.flatten_star(o, [(b.table("customer"), "o_custkey", "c_custkey"), (b.table("nation"), "c_nationkey", "n_nationkey"), (b.table("region"), "n_regionkey", "r_regionkey")])
    return wide.groupBy("r_name", "month").agg(X.dsum("r").alias("revenue"), F.count("*").alias("orders"))


@query("low_stock_velocity", """WITH d AS (SELECT l_partkey, ship_date, sum(l_quantity::DECIMAL(9,0)) q FROM b_lines GROUP BY ALL), v AS (SELECT l_partkey, sum(q)::DOUBLE / count(*) AS avg_daily_sales FROM d GROUP BY 1)
    SELECT p_partkey, p_size::BIGINT AS stock_level, avg_daily_sales, p_size::DOUBLE / avg_daily_sales AS days_of_stock, CASE WHEN p_size::DOUBLE / avg_daily_sales < 3 THEN 'CRITICAL' WHEN p_size::DOUBLE / avg_daily_sales < 7 THEN 'LOW' ELSE 'OK' END AS stock_status FROM part JOIN v ON p_partkey = l_partkey""")
def _(b):
    daily = b.order_lines().groupBy(F.col("l_partkey").alias("p_partkey"), "ship_date").agg(F.sum(F.col("l_quantity").cast("decimal(9,0)")).alias("quantity"))
    stock = b.table("part").select("p_partkey", F.col("p_size").alias("stock_level"))
    return D.low_stock(daily, stock, ["p_partkey"]).select("p_partkey", "stock_level", "avg_daily_sales", "days_of_stock", "stock_status")


# --- vault --------------------------------------------------------------------------------------------------


@query("vault_hub", "SELECT md5(customer_id::VARCHAR) AS hub_key, customer_id AS business_key, '1995-01-01' AS load_date, 'core' AS record_source FROM b_snap_old UNION ALL SELECT md5(customer_id::VARCHAR), customer_id, '2001-08-02', 'core' FROM b_snap_new WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_old)")
def _(b):
    return D.hub(D.hub(None, b.snapshot_old(), "customer_id", "1995-01-01", "core"), b.snapshot_new(), "customer_id", AS_OF, "core")


@query("vault_link", "SELECT md5(coalesce(length(o_custkey::VARCHAR) || ':' || o_custkey::VARCHAR, '-') || coalesce(length(o_orderkey::VARCHAR) || ':' || o_orderkey::VARCHAR, '-')) AS link_key, md5(o_custkey::VARCHAR) AS o_custkey_hk, md5(o_orderkey::VARCHAR) AS o_orderkey_hk, '2001-08-02' AS load_date FROM orders")
def _(b):
    return D.link(b.table("orders"), ["o_custkey", "o_orderkey"], AS_OF)


_SAT = """sat AS (SELECT customer_id, '1995-01-01' AS load_date, nation, segment FROM b_snap_old UNION ALL SELECT n.customer_id, '2001-08-02', n.nation, n.segment FROM b_snap_new n LEFT JOIN b_snap_old o ON n.customer_id = o.customer_id WHERE o.customer_id IS NULL OR n.nation <> o.nation OR n.segment <> o.segment) """


def sat(b):
    cols = ["nation", "segment"]
    return D.satellite(D.satellite(None, b.snapshot_old(), "customer_id", cols, "1995-01-01"), b.snapshot_new(), "customer_id", cols, AS_OF)


@query("vault_satellite", "WITH " + _SAT + "SELECT md5(customer_id::VARCHAR) AS hub_key, load_date, md5(coalesce(length(nation::VARCHAR) || ':' || nation::VARCHAR, '-') || coalesce(length(segment) || ':' || segment, '-')) AS hash_diff, nation::BIGINT AS nation, segment FROM sat")
def _(b):
    return sat(b)


@query("vault_current_sat", "WITH " + _SAT + "SELECT md5(customer_id::VARCHAR) AS hub_key, max(load_date) AS load_date, max_by(nation, load_date)::BIGINT AS nation FROM sat GROUP BY 1")
def _(b):
    return D.current_satellite(sat(b)).select("hub_key", "load_date", "nation")


@query("vault_end_dated", "WITH " + _SAT + "SELECT md5(customer_id::VARCHAR) AS hub_key, load_date, lead(load_date) OVER (PARTITION BY customer_id ORDER BY load_date) AS load_end_date FROM sat")
def _(b):
    return D.end_dated(sat(b)).select("hub_key", "load_date", "load_end_date")


@query("anchor_attribute", "SELECT md5(customer_id::VARCHAR) AS hub_key, '1995-01-01' AS load_date, nation::BIGINT AS nation FROM b_snap_old UNION ALL SELECT md5(n.customer_id::VARCHAR), '2001-08-02', n.nation FROM b_snap_new n LEFT JOIN b_snap_old o ON n.customer_id = o.customer_id WHERE o.customer_id IS NULL OR n.nation <> o.nation")
def _(b):
    """Anchor modelling: one satellite per attribute."""
    first = D.satellite(None, b.snapshot_old(), "customer_id", ["nation"], "1995-01-01")
    return D.satellite(first, b.snapshot_new(), "customer_id", ["nation"], AS_OF).select("hub_key", "load_date", "nation")
