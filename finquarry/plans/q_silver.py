"""Cleaning queries."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import silver as S
from finquarry.operators.relational import latest_per_key
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF, money
from finquarry.sources.clean import Clean

CUSTOMER_COLS = "customer_id, customer_name, date_of_birth::VARCHAR AS date_of_birth, gender, nationality, pan_number, email, phone, city, last_updated::VARCHAR AS last_updated"


@query("clean_customers", f"SELECT {CUSTOMER_COLS} FROM s_customers")
def _(b):
    return S.clean_customers(b.customers_with_old_rows()).select("customer_id", "customer_name", "date_of_birth", "gender", "nationality", "pan_number", "email", "phone", "city", "last_updated")


@query("clean_accounts", "SELECT account_id, account_type_standardized, current_balance::DOUBLE AS current_balance, available_balance::DOUBLE AS available_balance, available_balance_safe::DOUBLE AS available_balance_safe, status_standardized, branch_code::BIGINT AS branch_code FROM s_accounts")
def _(b):
    return Clean(b).accounts.select("account_id", "account_type_standardized", "current_balance", "available_balance", "available_balance_safe", "status_standardized", "branch_code")


@query("clean_transactions", "SELECT txn_id, account_id, txn_type_standardized, channel_standardized, amount::DOUBLE AS amount, txn_date::VARCHAR AS txn_date, is_weekend, time_bucket FROM s_transactions")
def _(b):
    return Clean(b).transactions.select("txn_id", "account_id", "txn_type_standardized", "channel_standardized", "amount", "txn_date", "is_weekend", "time_bucket")


@query("clean_cards", "SELECT card_number_masked, customer_id, card_brand, card_limit::DOUBLE AS card_limit, credit_used::DOUBLE AS credit_used, available_credit::DOUBLE AS available_credit, utilization_pct, status FROM s_cards")
def _(b):
    return Clean(b).cards.select("card_number_masked", "customer_id", "card_brand", "card_limit", "credit_used", "available_credit", "utilization_pct", "status")


@query("clean_loans", "SELECT loan_id, customer_id, loan_type_standardized, principal_outstanding::DOUBLE AS principal_outstanding, interest_rate_band, loan_status, maturity_date::VARCHAR AS maturity_date FROM s_loans")
def _(b):
    return Clean(b).loans.select("loan_id", "customer_id", "loan_type_standardized", "principal_outstanding", "interest_rate_band", "loan_status", "maturity_date")


@query("clean_card_transactions", "SELECT txn_id, card_number, merchant_name, merchant_category, amount::DOUBLE AS amount, txn_type_standardized, high_value_flag, unusual_time_flag, weekend_flag, status FROM s_card_txns")
def _(b):
    return Clean(b).card_transactions.select("txn_id", "card_number", "merchant_name", "merchant_category", "amount", "txn_type_standardized", "high_value_flag", "unusual_time_flag", "weekend_flag", "status")


@query("clean_loan_payments", "SELECT payment_id, loan_id, payment_mode_standardized, status_standardized, amount::DOUBLE AS amount FROM s_payments")
def _(b):
    return Clean(b).payments.select("payment_id", "loan_id", "payment_mode_standardized", "status_standardized", "amount")


@query("standardize_type", "SELECT account_type_standardized AS t, count(*) AS n FROM s_accounts GROUP BY 1")
def _(b):
    kept = b.accounts().filter(F.col("opening_date") <= AS_OF)
    return kept.groupBy(X.standardize("account_type", S.ACCOUNT_TYPES, "OTHER").alias("t")).agg(F.count("*").alias("n"))


@query("stg_customers", "SELECT c_custkey::VARCHAR AS customer_id, upper(trim(c_name)) AS customer_name, upper(c_mktsegment) AS segment, c_acctbal::DECIMAL(15,2)::DOUBLE AS balance FROM customer")
def _(b):
    return S.staged(b.table("customer"), {"customer_id": ("c_custkey", "string"), "customer_name": ("c_name", "string"), "segment": ("c_mktsegment", "string"), "balance": ("c_acctbal", "decimal(15,2)")}, ["customer_name", "segment"])


@query("stg_accounts", "SELECT account_id::VARCHAR AS account_id, upper(trim(account_type)) AS account_type, upper(trim(currency)) AS currency, current_balance::DOUBLE AS balance, opening_date::VARCHAR AS opened FROM b_accounts")
def _(b):
    return S.staged(b.accounts(), {"account_id": ("account_id", "string"), "account_type": ("account_type", "string"), "currency": ("currency", "string"), "balance": ("current_balance", "decimal(15,2)"), "opened": ("opening_date", "date")}, ["account_type", "currency"])


@query("stg_transactions", "SELECT txn_id::VARCHAR AS transaction_id, account_id::VARCHAR AS account_id, upper(trim(txn_type)) AS transaction_type, amount::DOUBLE AS amount, txn_date::VARCHAR AS transaction_date FROM b_transactions")
def _(b):
    return S.staged(b.transactions(), {"transaction_id": ("txn_id", "string"), "account_id": ("account_id", "string"), "transaction_type": ("txn_type", "string"), "amount": ("amount", "decimal(15,2)"), "transaction_date": ("txn_date", "date")}, ["transaction_type"])


@query("dedup_latest", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def _(b):
    return latest_per_key(b.table("events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("dedup_any", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(b):
    return b.table("orders").select("o_custkey", "o_orderstatus").dropDuplicates()


@query("dedup_keep_min_id", "SELECT text, lang, min(doc_id) AS doc_id FROM documents GROUP BY ALL")
def _(b):
    return S.dedup_keep_min(b.table("documents").select("text", "lang", "doc_id"), ["text", "lang"], "doc_id")


def _rules():
    return {"missing_balance": F.col("balance").isNull(), "negative_balance": F.col("balance") < 0, "bad_nation": ~F.col("nation").between(0, 20)}


@query("quality_flag", """SELECT customer_id, CASE WHEN balance IS NULL THEN 'FAIL_missing_balance' WHEN balance < 0 THEN 'FAIL_negative_balance' WHEN nation NOT BETWEEN 0 AND 20 THEN 'FAIL_bad_nation' ELSE 'PASS' END AS quality_flag FROM b_snap_new""")
def _(b):
    return S.flag_quality(b.snapshot_new(), _rules()).select("customer_id", "quality_flag")


@query("quarantine_split", """SELECT customer_id, r AS reasons, r <> '' AS rejected FROM (SELECT customer_id, concat_ws(';', CASE WHEN balance IS NULL THEN 'missing_balance' END, CASE WHEN balance < 0 THEN 'negative_balance' END, CASE WHEN nation NOT BETWEEN 0 AND 20 THEN 'bad_nation' END) AS r FROM b_snap_new)""")
def _(b):
    ok, bad = S.quarantine(b.snapshot_new(), _rules())
    return ok.select("customer_id", F.lit("").alias("reasons"), F.lit(False).alias("rejected")).unionByName(bad.select("customer_id", F.array_join("reasons", ";").alias("reasons"), F.lit(True).alias("rejected")))


@query("enrich", """SELECT o_orderkey, c_mktsegment, rev::DOUBLE AS revenue, rev::DOUBLE - cost::DOUBLE AS profit, (rev::DOUBLE - cost::DOUBLE) * 100.0::DOUBLE / nullif(rev::DOUBLE, 0) AS margin_pct, (DATE '2001-08-02' - o_orderdate::DATE)::BIGINT AS age_days
    FROM orders LEFT JOIN (SELECT l_orderkey, sum(revenue) AS rev, sum(price * 0.60) AS cost FROM b_lines GROUP BY 1) ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def _(b):
    return S.enrich_orders(b.table("orders"), b.order_lines(), b.table("customer"), "0.60", AS_OF)


@query("impute_defaults", "SELECT customer_id, coalesce(email, 'unknown@example.com') AS email, coalesce(phone, 'N/A') AS phone FROM s_customers")
def _(b):
    return S.impute(Clean(b).customers.select("customer_id", "email", "phone"), {"email": "unknown@example.com", "phone": "N/A"})


@query("normalize_dims", "SELECT md5(p_brand) AS brand_key, p_brand, count(*) AS parts FROM part GROUP BY ALL")
def _(b):
    sub, dim = S.split_dimension(b.table("part").select("p_partkey", "p_brand"), "p_brand", "brand_key")
    return dim.groupBy("brand_key").agg(F.count("*").alias("parts")).join(sub, "brand_key")


@query("denormalize_dims", "SELECT p_partkey, p_brand FROM part")
def _(b):
    sub, dim = S.split_dimension(b.table("part").select("p_partkey", "p_brand"), "p_brand", "brand_key")
    return dim.join(sub, "brand_key").select("p_partkey", "p_brand")
