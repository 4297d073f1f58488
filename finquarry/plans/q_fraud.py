"""Fraud and money-laundering queries."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import fraud as FR
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF
from finquarry.sources.clean import Clean

NOW = "2024-01-31 00:00:00"
_A = "txn_id, card_number, customer_id, merchant_name, amount::DOUBLE AS amount, rule_name, severity, description"


_LIMITS = {
    "high": {"limits": [(300, "CRITICAL"), (200, "HIGH"), (150, "MEDIUM")]},
    "velocity": {"short_hours": 24, "long_hours": 72, "limits": [(4, "CRITICAL"), (3, "HIGH"), (2, "MEDIUM")], "at_least": 1},
    "time": {"min_amount": 50},
    "cnp": {"recent_hours": 240, "history_days": 30, "min_amount": 30},
    "geo": {"recent_hours": 480},
}


def rules(b):
    t, k = Clean(b).card_transactions, b.cards()
    return {
        "high": FR.rule_high_value(t, k, **_LIMITS["high"]),
        "velocity": FR.rule_velocity(t, k, NOW, **_LIMITS["velocity"]),
        "time": FR.rule_unusual_time(t, k, **_LIMITS["time"]),
        "cnp": FR.rule_cnp(t, k, NOW, **_LIMITS["cnp"]),
        "geo": FR.rule_new_category(t, k, NOW, **_LIMITS["geo"]),
    }


def score(b):
    return FR.fraud_score([FR.all_rules(Clean(b).card_transactions, b.cards(), NOW, **_LIMITS)], NOW)


def _rule(name, key):
    @query(name, f"SELECT {_A} FROM f_{key}")
    def _(b):
        return rules(b)[key].select("txn_id", "card_number", "customer_id", "merchant_name", "amount", "rule_name", "severity", "description")


for _n, _k in (("fraud_rule_high_value", "high"), ("fraud_rule_velocity", "velocity"), ("fraud_rule_unusual_time", "time"), ("fraud_rule_cnp", "cnp"), ("fraud_rule_geo_anomaly", "geo")):
    _rule(_n, _k)


@query("fraud_score", "SELECT txn_id, card_number, customer_id, merchant_name, amount::DOUBLE AS amount, triggered_rules, rule_count, max_severity_score, fraud_score, recommended_action, strftime(evaluated_at, '%Y-%m-%d %H:%M:%S') AS evaluated_at FROM f_score")
def _(b):
    return score(b).select("txn_id", "card_number", "customer_id", "merchant_name", "amount", "triggered_rules", "rule_count", "max_severity_score", "fraud_score", "recommended_action", "evaluated_at")


@query("fraud_alert_summary", "SELECT txn_timestamp::DATE::VARCHAR AS alert_date, hour(txn_timestamp) AS alert_hour, triggered_rules, recommended_action, count(*) AS alert_count, sum(amount)::DOUBLE AS total_amount_at_risk, count(DISTINCT card_number) AS affected_cards, count(DISTINCT customer_id) AS affected_customers FROM f_score WHERE evaluated_at >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY ALL")
def _(b):
    return FR.alert_summary(score(b), "2024-01-24 00:00:00")


_RISK = """WITH c AS (SELECT a.txn_id, count(*) FILTER (WHERE epoch(date_trunc('second', z.txn_timestamp)) >= epoch(date_trunc('second', a.txn_timestamp)) - 3600) AS n1, count(*) AS n24 FROM s_card_txns a JOIN s_card_txns z ON a.card_number = z.card_number AND epoch(date_trunc('second', z.txn_timestamp)) BETWEEN epoch(date_trunc('second', a.txn_timestamp)) - 86400 AND epoch(date_trunc('second', a.txn_timestamp)) GROUP BY 1),
    d AS (SELECT card_number, txn_date, sum(amount)::DOUBLE AS day_amount FROM s_card_txns GROUP BY ALL),
    s AS (SELECT t.*, n1, n24, day_amount, customer_id, (CASE WHEN high_value_flag THEN 30 ELSE 0 END + CASE WHEN unusual_time_flag THEN 25 ELSE 0 END + CASE WHEN weekend_flag THEN 10 ELSE 0 END + CASE WHEN n1 > 1 THEN 35 ELSE 0 END)::BIGINT AS sc FROM s_card_txns t JOIN c USING (txn_id) JOIN d USING (card_number, txn_date) JOIN b_cards USING (card_number) WHERE t.status = 'SUCCESS')
    SELECT txn_id, customer_id, n1 AS txn_count_last_1hr, n24 AS txn_count_last_24hr, day_amount AS daily_cumulative_amount, sc AS risk_score, CASE WHEN sc >= 80 THEN 'CRITICAL' WHEN sc >= 50 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level FROM s WHERE sc >= 30"""


@query("fraud_txn_risk", _RISK)
def _(b):
    return FR.txn_risk(Clean(b).card_transactions, b.cards(), 1).select("txn_id", "customer_id", "txn_count_last_1hr", "txn_count_last_24hr", "daily_cumulative_amount", "risk_score", "alert_level")


@query("alert_realtime", "SELECT txn_id, 'XXXX-' || right(card_number, 4) AS card_masked, customer_id, customer_name, amount::DOUBLE AS amount, triggered_rules, rule_count, fraud_score, recommended_action, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', evaluated_at))::BIGINT) // 60 AS age_minutes, phone, email FROM f_score JOIN s_customers USING (customer_id) WHERE evaluated_at >= TIMESTAMP '2024-01-26 00:00:00' AND recommended_action IN ('BLOCK', 'REVIEW')")
def _(b):
    return FR.alerts_realtime(score(b), Clean(b).customers, NOW, 120)


@query("alert_critical", "SELECT txn_id, card_number, customer_id, fraud_score, triggered_rules, CASE WHEN fraud_score >= 80 THEN 'AUTO_BLOCK' WHEN fraud_score >= 60 THEN 'MANUAL_REVIEW' ELSE 'LOG_ONLY' END AS action_required, 'Contact ' || coalesce(phone, '-') || ' or ' || coalesce(email, '-') AS customer_contact_info FROM f_score JOIN s_customers USING (customer_id) WHERE fraud_score >= 50 AND evaluated_at >= TIMESTAMP '2024-01-01 00:00:00'")
def _(b):
    return FR.alerts_critical(score(b), Clean(b).customers, NOW, 720, 50)


@query("alert_daily_summary", "SELECT txn_timestamp::DATE::VARCHAR AS report_date, count(*) AS total_alerts, count(DISTINCT card_number) AS unique_cards_flagged, sum(amount)::DOUBLE AS total_amount_flagged, max(amount)::DOUBLE AS max_amount_flagged, " + ", ".join(f"count(*) FILTER (WHERE recommended_action = '{a}') AS {a.lower()}_count" for a in ("BLOCK", "REVIEW", "MONITOR")) + ", " + ", ".join(f"count(*) FILTER (WHERE triggered_rules LIKE '%{r}%') AS {n}" for n, r in (("high_value_count", "HIGH_VALUE"), ("velocity_count", "VELOCITY"), ("unusual_time_count", "UNUSUAL_TIME"), ("cnp_count", "CNP_PATTERN"), ("geo_count", "GEO_ANOMALY"))) + ", count(*) FILTER (WHERE recommended_action = 'BLOCK') * 100.0::DOUBLE / count(*) AS block_rate_pct FROM f_score GROUP BY 1")
def _(b):
    return FR.alerts_per_day(score(b))


@query("alert_top_risky_cards", "SELECT card_number, customer_id, count(*) AS total_alerts, count(DISTINCT triggered_rules) AS distinct_rules_triggered, sum(amount)::DOUBLE AS total_flagged_amount, sum(fraud_score)::DOUBLE / count(*) AS avg_fraud_score, max(fraud_score) AS max_fraud_score, CASE WHEN count(*) >= 10 OR max(fraud_score) >= 80 THEN 'HIGH_RISK' WHEN count(*) >= 5 OR max(fraud_score) >= 60 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS card_risk_level FROM f_score GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY total_alerts DESC, avg_fraud_score DESC, card_number LIMIT 50")
def _(b):
    return FR.risky_cards(score(b), 3, 50)


@query("alert_heatmap", "SELECT hour(txn_timestamp) AS hour_of_day, dayofweek(txn_timestamp) + 1 AS day_of_week, count(*) AS alert_count, sum(amount)::DOUBLE AS total_amount, sum(fraud_score)::DOUBLE / count(*) AS avg_fraud_score, CASE WHEN count(*) > 10 THEN 'VERY_HIGH' WHEN count(*) > 5 THEN 'HIGH' WHEN count(*) > 2 THEN 'MEDIUM' ELSE 'LOW' END AS frequency_band FROM f_score GROUP BY 1, 2")
def _(b):
    return FR.alert_heatmap(score(b))


@query("alert_merchant_risk", "SELECT merchant_name, merchant_category, count(*) AS total_alerts, count(DISTINCT card_number) AS unique_cards_flagged, sum(amount)::DOUBLE AS total_flagged_amount, sum(fraud_score)::DOUBLE / count(*) AS avg_fraud_score, CASE WHEN count(*) > 15 THEN 'HIGH_RISK_MERCHANT' WHEN count(*) > 10 THEN 'MEDIUM_RISK_MERCHANT' ELSE 'LOW_RISK_MERCHANT' END AS merchant_risk_level, CASE WHEN count(*) > 15 THEN 'Consider blocking this merchant' WHEN count(*) > 10 THEN 'Monitor closely' ELSE 'Normal monitoring' END AS recommendation FROM f_score GROUP BY 1, 2 HAVING count(*) >= 5")
def _(b):
    return FR.merchant_risk(score(b), 5, (15, 10))


@query("alert_aging", "SELECT txn_id, card_number, fraud_score, recommended_action, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', evaluated_at))::BIGINT) // 60 AS age_minutes, CASE WHEN recommended_action = 'BLOCK' AND (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', evaluated_at))::BIGINT) // 60 > 5 THEN 'SLA_BREACH' WHEN recommended_action = 'REVIEW' AND (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', evaluated_at))::BIGINT) // 60 > 15 THEN 'SLA_WARNING' ELSE 'ON_TRACK' END AS sla_status, CASE WHEN fraud_score >= 80 THEN 'P1' WHEN fraud_score >= 60 THEN 'P2' WHEN fraud_score >= 40 THEN 'P3' ELSE 'P4' END AS priority FROM f_score WHERE recommended_action IN ('BLOCK', 'REVIEW') AND evaluated_at BETWEEN TIMESTAMP '2024-01-28 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'")
def _(b):
    return FR.alert_aging(score(b), NOW, 72)


# --- money laundering -----------------------------------------------------------------------------------
P = {"near_low": 400000, "near_high": 499999, "cash": 200000, "near_count": 0, "txns": 1, "single": 450000, "round": 100}


def ctr(b):
    c = Clean(b)
    return FR.ctr(c.transactions, c.accounts, c.customers, "2001-06-01", 300000, 400000)


def sar(b):
    c = Clean(b)
    return FR.str_candidates(c.transactions, c.accounts, c.customers, "2001-07-03", P)


def pep(b):
    c = Clean(b)
    registry = b.table("customer").filter("c_acctbal > 9000").select(F.col("c_custkey").alias("customer_id"), F.lit(True).alias("is_pep"), F.col("c_mktsegment").alias("pep_category"))
    return FR.pep_monitoring(c.customers, registry, c.accounts, c.transactions, "2001-05-01", 400000)


_CTR = "SELECT txn_id, account_id, customer_id, customer_name, pan_number, amount, txn_date, 'CTR' AS report_type, CASE WHEN amount >= 400000 THEN 'MANDATORY' ELSE 'RECOMMENDED' END AS reporting_requirement FROM s_transactions JOIN s_accounts USING (account_id) JOIN s_customers USING (customer_id) WHERE txn_type_standardized = 'DEBIT' AND amount >= 300000 AND txn_date >= DATE '2001-06-01'"
_STR = """SELECT *, CASE WHEN sc >= 60 THEN 'HIGH' WHEN sc >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_classification, CASE WHEN sc >= 60 THEN 'FILE_STR_IMMEDIATELY' WHEN sc >= 30 THEN 'ENHANCED_MONITORING' ELSE 'STANDARD_MONITORING' END AS recommended_action FROM
    (SELECT *, (CASE WHEN cash > 200000 THEN 30 ELSE 0 END + CASE WHEN near > 0 THEN 40 ELSE 0 END + CASE WHEN n > 1 THEN 20 ELSE 0 END + CASE WHEN mx > 450000 THEN 25 ELSE 0 END + CASE WHEN tot % 100 = 0 THEN 10 ELSE 0 END)::BIGINT AS sc,
      concat_ws('; ', CASE WHEN cash > 200000 THEN 'High cash volume' END, CASE WHEN near > 0 THEN 'Potential structuring' END, CASE WHEN n > 1 THEN 'Unusual frequency' END, CASE WHEN mx > 450000 THEN 'Large single transaction' END) AS why
     FROM (SELECT customer_id, count(*) AS n, sum(amount) AS tot, max(amount) AS mx, sum(CASE WHEN channel_standardized = 'BRANCH' THEN amount ELSE 0 END) AS cash, count(*) FILTER (WHERE channel_standardized = 'BRANCH') AS cn, count(*) FILTER (WHERE amount BETWEEN 400000 AND 499999) AS near FROM s_transactions JOIN s_accounts USING (account_id) WHERE txn_date >= DATE '2001-07-03' GROUP BY 1)
     WHERE cash > 200000 OR near > 0 OR n > 1 OR mx > 450000)"""
_PEP = """SELECT customer_id, customer_name, pan_number, c_mktsegment AS pep_category, coalesce(n, 0) AS total_txns_30d, tot AS total_amount_30d, mx AS max_single_txn, CASE WHEN tot > 400000 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level FROM s_customers JOIN customer ON customer_id = c_custkey LEFT JOIN (SELECT customer_id, count(*) AS n, sum(amount)::DOUBLE AS tot, max(amount)::DOUBLE AS mx FROM s_transactions JOIN s_accounts USING (account_id) WHERE txn_date >= DATE '2001-05-01' GROUP BY 1) USING (customer_id) WHERE c_acctbal > 9000"""


@query("aml_ctr", f"SELECT * REPLACE (amount::DOUBLE AS amount, txn_date::VARCHAR AS txn_date) FROM ({_CTR})")
def _(b):
    return ctr(b)


@query("aml_str", f"SELECT customer_id, customer_name, pan_number, n AS total_txns_30d, tot::DOUBLE AS total_amount_30d, cash::DOUBLE AS cash_amount_30d, cn AS cash_count_30d, near AS near_threshold_count, sc AS suspicion_score, risk_classification, recommended_action, why AS suspicion_reasons FROM ({_STR}) JOIN s_customers USING (customer_id)")
def _(b):
    return sar(b)


@query("aml_pep_monitoring", _PEP)
def _(b):
    return pep(b).select("customer_id", "customer_name", "pan_number", "pep_category", "total_txns_30d", "total_amount_30d", "max_single_txn", "risk_level")


@query("aml_daily_summary", f"""WITH c AS ({_CTR}), s AS ({_STR}), p AS ({_PEP}) SELECT (SELECT count(*) FROM c) AS ctr_count, (SELECT sum(amount)::DOUBLE FROM c) AS ctr_total_amount, (SELECT count(*) FROM s WHERE risk_classification = 'HIGH') AS high_risk_str_count, (SELECT count(*) FROM s WHERE risk_classification = 'MEDIUM') AS medium_risk_str_count,
    (SELECT count(*) FROM p) AS pep_count, (SELECT sum(total_amount_30d::DECIMAL(28,2))::DOUBLE FROM p) AS pep_total_amount, '2001-08-02' AS report_date, (SELECT CASE WHEN count(*) > 5 THEN 'ELEVATED' WHEN count(*) > 0 THEN 'WATCH' ELSE 'NORMAL' END FROM s WHERE risk_classification = 'HIGH') AS overall_risk_status, (SELECT CASE WHEN count(*) > 0 THEN 'CTR_SUBMITTED' ELSE 'CTR_PENDING' END FROM c) AS ctr_status""")
def _(b):
    return FR.aml_day(ctr(b), sar(b), pep(b), AS_OF)


@query("aml_alert_aging", f"SELECT customer_id, sc AS suspicion_score, risk_classification, recommended_action, 2::BIGINT AS age_days, CASE WHEN risk_classification = 'HIGH' THEN 'SLA_BREACH' ELSE 'ON_TRACK' END AS sla_status FROM ({_STR}) WHERE recommended_action <> 'STANDARD_MONITORING'")
def _(b):
    return FR.str_aging(sar(b), "2001-07-31", AS_OF)


@query("aml_large_txn", "SELECT customer_name, amount::DOUBLE AS amount, txn_type_standardized AS transaction_type, txn_date::VARCHAR AS transaction_date, account_id FROM s_transactions JOIN s_accounts USING (account_id) JOIN s_customers USING (customer_id) WHERE amount > 450000 AND txn_date >= DATE '2001-05-01'")
def _(b):
    c = Clean(b)
    big = c.transactions.filter((F.col("amount") > 450000) & (F.col("txn_date") >= "2001-05-01"))
    rows = big.join(c.accounts.select("account_id", "customer_id"), "account_id").join(c.customers.select("customer_id", "customer_name"), "customer_id")
    return rows.select("customer_name", "amount", F.col("txn_type_standardized").alias("transaction_type"), F.col("txn_date").alias("transaction_date"), "account_id")


@query("aml_suspicious_activity", "SELECT customer_id, any_value(customer_name) AS customer_name, count(*) AS cash_transactions, sum(amount)::DOUBLE AS total_cash FROM s_transactions JOIN s_accounts USING (account_id) JOIN s_customers USING (customer_id) WHERE channel_standardized IN ('ATM', 'BRANCH') GROUP BY 1 HAVING count(*) > 4 AND sum(amount) > 1000000")
def _(b):
    c = Clean(b)
    per = c.transactions.filter(F.col("channel_standardized").isin("ATM", "BRANCH")).groupBy("account_id").agg(F.count("*").alias("n"), F.sum("amount").alias("a"))
    per = per.join(c.accounts.select("account_id", "customer_id"), "account_id").groupBy("customer_id").agg(F.sum("n").alias("cash_transactions"), F.sum("a").alias("t"))
    hot = per.filter("cash_transactions > 4 AND t > 1000000")
    return hot.join(c.customers.select("customer_id", "customer_name"), "customer_id").select("customer_id", "customer_name", "cash_transactions", X.dbl("t").alias("total_cash"))
