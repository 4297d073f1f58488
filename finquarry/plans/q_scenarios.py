"""Queries over the wide card-transaction table."""

from pyspark.sql import functions as F

from finquarry.operators import scenarios as S
from finquarry.plans.registry import query

A = "transaction_amount"
BASE = f"count(*) AS transaction_count, sum({A})::DOUBLE AS total_amount, sum({A})::DOUBLE / count(*) AS avg_amount"
POSTED = "b_bench WHERE status = 'POSTED'"
DAY = "transaction_date::DATE"


def _sumif(cond):
    return f"coalesce((sum({A}) FILTER (WHERE {cond}))::DOUBLE, 0)"


def _case(pairs, default):
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in pairs) + f" ELSE '{default}' END"


def t(b):
    return b.benchmark_transactions()


_v = ["hourly_count > 4", "hourly_count > 2 AND unique_merchants > 1", "hourly_amount > 300"]


@query("fraud_velocity_detection", f"SELECT *, {_case(zip(_v, ['CRITICAL_VELOCITY', 'SUSPICIOUS_PATTERN', 'HIGH_VALUE_VELOCITY']), 'NORMAL')} AS fraud_risk_level, {_case(zip(_v, ['BLOCK_CARD', 'REVIEW_TRANSACTION', 'FLAG_FOR_ANALYSIS']), 'MONITOR')} AS recommended_action FROM (SELECT card_id, customer_id, {DAY}::VARCHAR AS txn_date, hour(transaction_date) AS txn_hour, count(*) AS hourly_count, sum({A})::DOUBLE AS hourly_amount, count(DISTINCT merchant_name) AS unique_merchants, count(DISTINCT merchant_category) AS unique_categories FROM {POSTED} GROUP BY ALL) WHERE hourly_count > 1 OR hourly_amount > 150 ORDER BY hourly_amount DESC, hourly_count DESC, card_id, txn_date, txn_hour LIMIT 1000")
def _(b):
    return S.velocity(t(b), 4, 2, 1, 300, 1, 150, 1000)


@query("fraud_geo_impossible", f"SELECT transaction_id, card_id, customer_id, merchant_name, {A}::DOUBLE AS transaction_amount, prev_merchant, m AS minutes_between, CASE WHEN m < 30 THEN 'IMPOSSIBLE_TRAVEL' WHEN m < 5 THEN 'TOO_RAPID' ELSE 'NORMAL' END AS fraud_indicator FROM (SELECT *, lag(merchant_name) OVER w AS prev_merchant, (epoch(date_trunc('second', transaction_date))::BIGINT - epoch(date_trunc('second', lag(transaction_date) OVER w))::BIGINT) // 60 AS m FROM {POSTED} WINDOW w AS (PARTITION BY card_id ORDER BY transaction_date, transaction_id)) WHERE m < 60 AND merchant_name <> prev_merchant ORDER BY m, transaction_id LIMIT 500")
def _(b):
    return S.impossible_travel(t(b), 500).select("transaction_id", "card_id", "customer_id", "merchant_name", "transaction_amount", "prev_merchant", "minutes_between", "fraud_indicator")


_ct = ["small_txn_count >= 5 AND unique_merchants >= 3", "small_txn_count >= 3 AND unique_merchants >= 2", "small_txn_count >= 2 AND unique_merchants >= 1"]


@query("fraud_card_testing", f"SELECT *, {_case(zip(_ct, ['CONFIRMED_CARD_TESTING', 'PROBABLE_CARD_TESTING', 'SUSPICIOUS_PATTERN']), 'MONITOR')} AS risk_level, {_case(zip(_ct, ['BLOCK_CARD_IMMEDIATELY', 'HOLD_NEXT_TRANSACTION', 'SEND_ALERT_TO_CUSTOMER']), 'LOG_FOR_REVIEW')} AS recommended_action FROM (SELECT card_id, customer_id, {DAY}::VARCHAR AS txn_date, count(*) AS small_txn_count, sum({A})::DOUBLE AS total_small_amount, count(DISTINCT merchant_name) AS unique_merchants, min({A})::DOUBLE AS min_amount, max({A})::DOUBLE AS max_amount, sum({A})::DOUBLE / count(*) AS avg_amount FROM {POSTED} AND {A} < 50 AND transaction_type = 'PURCHASE' GROUP BY ALL) WHERE small_txn_count >= 2 ORDER BY small_txn_count DESC, unique_merchants DESC, card_id, txn_date LIMIT 500")
def _(b):
    return S.card_testing(t(b), 50, [(5, 3), (3, 2), (2, 1)], 2, 500)


@query("customer_360_complete", f"""WITH s AS (SELECT customer_id, count(*) AS total_transactions, sum({A})::DOUBLE AS total_spend, sum({A})::DOUBLE / count(*) AS avg_transaction, count(DISTINCT merchant_category) AS categories_used FROM b_bench GROUP BY 1),
    k AS (SELECT *, CASE WHEN total_spend > 6000 THEN 'PLATINUM' WHEN total_spend > 3000 THEN 'GOLD' WHEN total_spend > 600 THEN 'SILVER' WHEN total_spend > 60 THEN 'BRONZE' ELSE 'NEW' END AS customer_tier, CASE WHEN total_transactions > 130 THEN 'POWER_USER' WHEN total_transactions > 80 THEN 'REGULAR_USER' WHEN total_transactions > 60 THEN 'OCCASIONAL_USER' ELSE 'NEW_USER' END AS usage_pattern FROM s)
    SELECT *, CASE WHEN customer_tier = 'PLATINUM' THEN 'VIP_SERVICE' WHEN customer_tier = 'GOLD' THEN 'PRIORITY_SERVICE' WHEN usage_pattern = 'NEW_USER' THEN 'WELCOME_PROGRAM' ELSE 'STANDARD_SERVICE' END AS service_level, CASE WHEN total_spend > 3000 AND categories_used > 4 THEN 'CROSS_SELL_OPPORTUNITY' WHEN customer_tier = 'PLATINUM' THEN 'RETENTION_PRIORITY' ELSE 'STANDARD' END AS marketing_action FROM k ORDER BY total_spend DESC, customer_id LIMIT 1000""")
def _(b):
    return S.customer_overview(t(b), 0.006, [(130, "POWER_USER"), (80, "REGULAR_USER"), (60, "OCCASIONAL_USER")], 1000)


@query("customer_lifetime_value", f"""SELECT *, total_revenue * 0.1::DOUBLE AS estimated_annual_value, total_revenue * 0.1::DOUBLE * 3 AS estimated_3yr_value, (total_transactions * 3 + active_days * 4 + category_diversity * 3) / 10.0::DOUBLE AS engagement_score, CASE WHEN total_revenue > 3000 THEN 'HIGH_VALUE' WHEN total_revenue > 600 THEN 'MEDIUM_VALUE' WHEN total_revenue > 60 THEN 'LOW_VALUE' ELSE 'PROSPECT' END AS value_segment, CASE WHEN active_days > 28 THEN 'HIGHLY_ENGAGED' WHEN active_days > 25 THEN 'ENGAGED' WHEN active_days > 20 THEN 'CASUAL' ELSE 'AT_RISK' END AS engagement_segment
    FROM (SELECT customer_id, count(*) AS total_transactions, sum({A})::DOUBLE AS total_revenue, count(DISTINCT {DAY}) AS active_days, (max({DAY}) - min({DAY}))::BIGINT AS customer_tenure_days, count(DISTINCT merchant_category) AS category_diversity FROM {POSTED} GROUP BY 1) ORDER BY total_revenue DESC, customer_id LIMIT 1000""")
def _(b):
    return S.lifetime_value(t(b), 0.006, [(28, "HIGHLY_ENGAGED"), (25, "ENGAGED"), (20, "CASUAL")], 1000)


_BW = "CASE WHEN merchant_category IN ('CRYPTOCURRENCY','GAMBLING') THEN 1.5 WHEN merchant_category IN ('ELECTRONICS','TRAVEL') THEN 1.0 WHEN merchant_category IN ('GROCERY','FOOD') THEN 0.5 WHEN merchant_category IN ('UTILITIES','EDUCATION') THEN 0.2 ELSE 0.75 END::DOUBLE"


@query("basel_iii_capital", f"SELECT *, total_amount * w AS risk_weighted_asset, total_amount * w * 0.08::DOUBLE AS minimum_capital, CASE WHEN w > 1 THEN total_amount * 0.15::DOUBLE WHEN w > 0.75 THEN total_amount * 0.10::DOUBLE ELSE total_amount * 0.05::DOUBLE END AS provision_required, CASE WHEN w > 1.5 THEN 'HIGH_RISK_REVIEW' WHEN w > 1 THEN 'ELEVATED_RISK' ELSE 'STANDARD_RISK' END AS compliance_status FROM (SELECT merchant_category, transaction_type, {BASE}, {_BW} AS w FROM {POSTED} GROUP BY ALL)".replace("SELECT *, total_amount * w", "SELECT merchant_category, transaction_type, transaction_count, total_amount, avg_amount, w AS risk_weight, total_amount * w"))
def _(b):
    return S.basel_by_category(t(b))


@query("npa_classification", f"SELECT *, total_spend * provision_rate AS estimated_provision FROM (SELECT *, declined_count * 100.0::DOUBLE / total_transactions AS decline_rate, CASE WHEN d > 6 THEN 'LOSS' WHEN d > 4 THEN 'DOUBTFUL' WHEN d > 2 THEN 'SUB_STANDARD' ELSE 'SPECIAL_MENTION' END AS npa_classification, CASE WHEN d > 6 THEN 1.0 WHEN d > 4 THEN 0.4 WHEN d > 2 THEN 0.15 ELSE 0.025 END::DOUBLE AS provision_rate FROM (SELECT customer_id, count(*) AS total_transactions, sum({A})::DOUBLE AS total_spend, (DATE '2024-01-31' - max({DAY}))::BIGINT AS d, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count FROM b_bench GROUP BY 1) WHERE d > 1) ORDER BY d DESC, customer_id LIMIT 1000".replace("SELECT *, total_spend", "SELECT customer_id, total_transactions, total_spend, d AS days_since_last_txn, declined_count, decline_rate, npa_classification, provision_rate, total_spend"))
def _(b):
    return S.inactivity_classes(t(b), "2024-01-31", [(6, "LOSS", 1.0), (4, "DOUBTFUL", 0.4), (2, "SUB_STANDARD", 0.15), (1, "SPECIAL_MENTION", 0.025)], 1000)


_st = ["near_threshold_count >= 2", "daily_count > 3 AND daily_amount > 150", "daily_amount > 300"]


@query("aml_suspicious_patterns", f"SELECT *, {_case(zip(_st, ['STRUCTURING_SUSPECTED', 'VELOCITY_LAUNDERING', 'HIGH_VALUE_ALERT']), 'NORMAL')} AS aml_risk_flag, {_case(zip(_st, ['FILE_SAR', 'ENHANCED_DUE_DILIGENCE', 'MANUAL_REVIEW']), 'MONITOR')} AS recommended_action, CASE WHEN {_st[0]} THEN daily_amount * 0.3::DOUBLE WHEN {_st[1]} THEN daily_amount * 0.2::DOUBLE ELSE 0 END AS suspicious_amount FROM (SELECT card_id, customer_id, {DAY}::VARCHAR AS txn_date, count(*) AS daily_count, sum({A})::DOUBLE AS daily_amount, sum({A})::DOUBLE / count(*) AS avg_amount, count(*) FILTER (WHERE {A} BETWEEN 90 AND 99.99) AS near_threshold_count FROM {POSTED} GROUP BY ALL) WHERE near_threshold_count >= 1 OR (daily_count > 3 AND daily_amount > 75) OR daily_amount > 180 ORDER BY suspicious_amount DESC, daily_amount DESC, card_id, txn_date LIMIT 500")
def _(b):
    return S.structuring(t(b), (90, 99.99), {"near": 2, "count": 3, "volume": 150, "high": 300}, 500)


@query("merchant_performance", f"SELECT merchant_category, merchant_name, {BASE}, count(DISTINCT card_id) AS unique_customers, count(*) FILTER (WHERE status = 'POSTED') AS successful_count, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count, count(*) FILTER (WHERE status = 'DECLINED') * 100.0::DOUBLE / count(*) AS decline_rate, CASE WHEN sum({A}) > 6000 THEN 'PLATINUM_MERCHANT' WHEN sum({A}) > 3000 THEN 'GOLD_MERCHANT' WHEN sum({A}) > 600 THEN 'SILVER_MERCHANT' ELSE 'BRONZE_MERCHANT' END AS merchant_tier FROM b_bench GROUP BY 1, 2 HAVING count(*) >= 10 ORDER BY total_amount DESC, merchant_category, merchant_name LIMIT 1000")
def _(b):
    return S.merchant_performance(t(b), 0.006, 10, 1000)


@query("merchant_settlement", f"SELECT *, CASE WHEN settlement_rate > 99 THEN 'FULLY_SETTLED' WHEN settlement_rate > 95 THEN 'MOSTLY_SETTLED' WHEN settlement_rate > 90 THEN 'PARTIALLY_SETTLED' ELSE 'SETTLEMENT_ISSUES' END AS settlement_status FROM (SELECT *, settled_count * 100.0::DOUBLE / transaction_count AS settlement_rate, purchase_amount - payment_amount AS net_settlement FROM (SELECT merchant_category, {DAY}::VARCHAR AS txn_date, count(*) AS transaction_count, sum({A})::DOUBLE AS gross_amount, {_sumif(chr(116) + 'ransaction_type = ' + chr(39) + 'PURCHASE' + chr(39))} AS purchase_amount, {_sumif('transaction_type = ' + chr(39) + 'PAYMENT' + chr(39))} AS payment_amount, count(*) FILTER (WHERE status = 'POSTED') AS settled_count, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count FROM b_bench GROUP BY ALL))")
def _(b):
    return S.settlement(t(b))


_lr = ["spend_volatility > avg_spend * 2", "declined_count > 15", "total_spend > estimated_income * 3"]
_PAY = _sumif("transaction_type = 'PAYMENT'")
_BUY = _sumif("transaction_type = 'PURCHASE'")
_SD = f"CASE WHEN count(*) > 1 THEN sqrt(greatest((sum(({A} * {A})::DECIMAL(38,4))::DOUBLE - sum({A})::DOUBLE * sum({A})::DOUBLE / count(*)) / nullif(count(*) - 1, 0), 0)) END"


@query("loan_risk_analysis", f"SELECT *, total_spend / nullif(estimated_income, 0) AS dti_ratio, {_case(zip(_lr, ['HIGH_RISK', 'ELEVATED_RISK', 'OVEREXTENDED']), 'LOW_RISK')} AS loan_risk_score, {_case(zip(_lr, ['REQUIRE_ADDITIONAL_DOC', 'MANUAL_UNDERWRITING', 'REDUCE_LOAN_AMOUNT']), 'STANDARD_APPROVAL')} AS recommended_action FROM (SELECT customer_id, count(*) AS total_transactions, sum({A})::DOUBLE AS total_spend, sum({A})::DOUBLE / count(*) AS avg_spend, {_SD} AS spend_volatility, count(*) FILTER (WHERE {A} > 150) AS large_transactions, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count, {_PAY} AS estimated_income FROM b_bench GROUP BY 1)")
def _(b):
    return S.loan_risk(t(b), 150, 15)


@query("loan_repayment_pattern", f"""WITH d AS (SELECT customer_id, {DAY} AS d, coalesce(sum({A}) FILTER (WHERE transaction_type = 'PAYMENT'), 0) AS p, coalesce(sum({A}) FILTER (WHERE transaction_type = 'PURCHASE'), 0) AS q FROM b_bench GROUP BY ALL), m AS (SELECT customer_id, count(*) AS active_days, sum(p)::DOUBLE AS total_payments, sum(q)::DOUBLE AS total_purchases, count(*) FILTER (WHERE p > 0) AS payment_days FROM d GROUP BY 1), r AS (SELECT *, total_payments / nullif(total_purchases, 0) AS payment_to_purchase_ratio, payment_days * 100.0::DOUBLE / active_days AS payment_consistency FROM m)
    SELECT *, CASE WHEN payment_consistency > 80 THEN 'EXCELLENT_PAYER' WHEN payment_consistency > 60 THEN 'GOOD_PAYER' WHEN payment_consistency > 40 THEN 'FAIR_PAYER' WHEN payment_consistency > 20 THEN 'POOR_PAYER' ELSE 'DELINQUENT' END AS repayment_behavior, CASE WHEN payment_consistency > 80 THEN 'LOW_DEFAULT_RISK' WHEN payment_consistency > 60 THEN 'MODERATE_DEFAULT_RISK' WHEN payment_consistency > 40 THEN 'ELEVATED_DEFAULT_RISK' ELSE 'HIGH_DEFAULT_RISK' END AS default_risk FROM r ORDER BY payment_consistency DESC, customer_id LIMIT 1000""")
def _(b):
    return S.repayment(t(b), 1000)


@query("card_utilization_analysis", f"SELECT card_id, customer_id, {BASE}, max({A})::DOUBLE AS max_spend, count(DISTINCT merchant_category) AS categories_used, count(DISTINCT merchant_name) AS unique_merchants, {_BUY} AS total_purchases, {_PAY} AS total_payments, count(*) FILTER (WHERE hour(transaction_date) BETWEEN 9 AND 17) AS business_hours_count, count(*) FILTER (WHERE hour(transaction_date) >= 18) AS evening_count, count(*) FILTER (WHERE hour(transaction_date) <= 8) AS night_count, CASE WHEN sum({A}) > 3000 THEN 'PREMIUM_CARD' WHEN sum({A}) > 600 THEN 'GOLD_CARD' WHEN sum({A}) > 60 THEN 'SILVER_CARD' ELSE 'BASIC_CARD' END AS card_tier FROM {POSTED} GROUP BY 1, 2 ORDER BY total_amount DESC, card_id, customer_id LIMIT 1000")
def _(b):
    return S.card_utilization(t(b), 0.006, 1000)


@query("card_rewards_optimization", f"SELECT *, CASE WHEN reward_multiplier < 1 THEN 'SWITCH_TO_BETTER_CARD' WHEN reward_multiplier >= 2 THEN 'MAXIMIZE_THIS_CATEGORY' WHEN transaction_count > 10 THEN 'HIGH_FREQUENCY_BENEFIT' ELSE 'STANDARD_REWARDS' END AS optimization_recommendation, points_earned * 12 AS estimated_annual_points FROM (SELECT *, category_spend * reward_multiplier / 100.0::DOUBLE AS points_earned FROM (SELECT card_id, customer_id, merchant_category, sum({A})::DOUBLE AS category_spend, count(*) AS transaction_count, CASE WHEN merchant_category IN ('ELECTRONICS','ONLINE_SHOPPING') THEN 2.0 WHEN merchant_category IN ('TRAVEL','ENTERTAINMENT') THEN 1.5 WHEN merchant_category = 'FUEL' THEN 0.5 ELSE 1.0 END::DOUBLE AS reward_multiplier FROM {POSTED} AND transaction_type = 'PURCHASE' GROUP BY ALL)) ORDER BY points_earned DESC, card_id, merchant_category LIMIT 1000")
def _(b):
    return S.card_rewards(t(b), 1000)


@query("geographic_risk_analysis", f"SELECT *, declined_count * 100.0::DOUBLE / transaction_count AS decline_rate, total_volume / unique_cards AS volume_per_card, CASE risk_zone WHEN 'HIGH_RISK' THEN total_volume * 0.3::DOUBLE + declined_count * 1000 WHEN 'MEDIUM_RISK' THEN total_volume * 0.15::DOUBLE + declined_count * 500 ELSE total_volume * 0.05::DOUBLE + declined_count * 100 END / unique_cards AS risk_score, CASE risk_zone WHEN 'HIGH_RISK' THEN 'ENHANCED_MONITORING' WHEN 'MEDIUM_RISK' THEN 'STANDARD_MONITORING' ELSE 'BASIC_MONITORING' END AS monitoring_level FROM (SELECT merchant_category, CASE WHEN merchant_category IN ('CRYPTOCURRENCY','GAMBLING') THEN 'HIGH_RISK' WHEN merchant_category IN ('TRAVEL','ELECTRONICS') THEN 'MEDIUM_RISK' WHEN merchant_category IN ('FOOD','GROCERY','UTILITIES') THEN 'LOW_RISK' ELSE 'STANDARD_RISK' END AS risk_zone, count(*) AS transaction_count, sum({A})::DOUBLE AS total_volume, sum({A})::DOUBLE / count(*) AS avg_amount, count(DISTINCT card_id) AS unique_cards, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count FROM b_bench GROUP BY ALL)")
def _(b):
    return S.category_risk(t(b))


@query("executive_dashboard_kpis", f"""WITH d AS (SELECT {DAY} AS dd, count(*) AS total_transactions, sum({A})::DOUBLE AS total_volume, count(DISTINCT card_id) AS active_cards, count(*) FILTER (WHERE status = 'POSTED') AS successful_count, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count FROM b_bench GROUP BY 1)
    SELECT dd::VARCHAR AS metric_date, total_transactions, total_volume, active_cards, successful_count, declined_count, successful_count * 100.0::DOUBLE / total_transactions AS success_rate, total_volume - lag(total_volume) OVER w AS volume_change, (total_volume - lag(total_volume) OVER w) * 100.0::DOUBLE / lag(total_volume) OVER w AS volume_growth_pct, sum(total_volume::DECIMAL(28,2)) OVER (ORDER BY dd ROWS 6 PRECEDING)::DOUBLE / count(*) OVER (ORDER BY dd ROWS 6 PRECEDING) AS volume_7day_avg, CASE WHEN total_volume > lag(total_volume) OVER w * 1.1::DOUBLE THEN 'GROWING' WHEN total_volume < lag(total_volume) OVER w * 0.9::DOUBLE THEN 'DECLINING' ELSE 'STABLE' END AS trend_indicator FROM d WINDOW w AS (ORDER BY dd) ORDER BY dd DESC LIMIT 30""")
def _(b):
    return S.daily_kpis(t(b), 30)


@query("real_time_monitoring", f"""WITH h AS (SELECT {DAY} AS dd, hour(transaction_date) AS txn_hour, count(*) AS hourly_count, sum({A})::DOUBLE AS hourly_volume, count(DISTINCT card_id) AS active_cards, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count, count(*) FILTER (WHERE {A} > 150) AS large_txn_count FROM b_bench GROUP BY ALL), m AS (SELECT *, sum(hourly_volume::DECIMAL(28,2)) OVER w::DOUBLE / nullif(count(*) OVER w, 0) AS mv, sum(hourly_count::DECIMAL(28,2)) OVER w::DOUBLE / nullif(count(*) OVER w, 0) AS mc FROM h WINDOW w AS (ORDER BY dd, txn_hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    SELECT dd::VARCHAR AS txn_date, txn_hour, hourly_count, hourly_volume, active_cards, declined_count, large_txn_count, hourly_volume / nullif(mv, 0) AS volume_vs_avg, CASE WHEN hourly_count > mc * 2 THEN 'SPIKE_DETECTED' WHEN hourly_count < mc * 0.5::DOUBLE THEN 'DROP_DETECTED' ELSE 'NORMAL' END AS anomaly_status, CASE WHEN hourly_volume > mv * 3 THEN 'CRITICAL' WHEN hourly_volume > mv * 2 THEN 'WARNING' ELSE 'NORMAL' END AS alert_level FROM m ORDER BY dd DESC, txn_hour DESC LIMIT 500""")
def _(b):
    return S.hourly_monitor(t(b), 150, 500)


@query("branch_performance", f"SELECT *, successful_count * 100.0::DOUBLE / transaction_count AS success_rate, total_volume / unique_customers AS revenue_per_customer, rank() OVER (PARTITION BY txn_date ORDER BY total_volume DESC) AS volume_rank, rank() OVER (PARTITION BY txn_date ORDER BY transaction_count DESC) AS count_rank, CASE WHEN total_volume > 2500 THEN 'TOP_PERFORMER' WHEN total_volume > 1250 THEN 'ABOVE_AVERAGE' WHEN total_volume > 250 THEN 'AVERAGE' ELSE 'BELOW_AVERAGE' END AS performance_tier FROM (SELECT 'BRANCH-' || (substring(card_id, 6)::BIGINT % 10 + 1) AS branch_id, {DAY}::VARCHAR AS txn_date, count(*) AS transaction_count, sum({A})::DOUBLE AS total_volume, count(DISTINCT card_id) AS unique_customers, count(*) FILTER (WHERE status = 'POSTED') AS successful_count, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count FROM b_bench GROUP BY ALL)")
def _(b):
    return S.branch_days(t(b), 10, 0.0025)


@query("merchant_category_summary", f"SELECT merchant_category, {BASE}, max({A})::DOUBLE AS max_amount FROM b_bench GROUP BY 1")
def _(b):
    return S.category_summary(t(b))


@query("bench_daily_summary", f"SELECT {DAY}::VARCHAR AS transaction_day, {BASE}, count(DISTINCT card_id) AS unique_cards FROM b_bench GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def _(b):
    return S.day_summary(t(b), 30)


@query("bench_customer_segmentation", f"SELECT customer_id, {BASE}, max({A})::DOUBLE AS max_spend, count(DISTINCT merchant_category) AS unique_categories, CASE WHEN sum({A}) > 6000 THEN 'PLATINUM' WHEN sum({A}) > 3000 THEN 'GOLD' WHEN sum({A}) > 600 THEN 'SILVER' ELSE 'BRONZE' END AS customer_tier FROM b_bench GROUP BY 1 HAVING count(*) >= 5 ORDER BY total_amount DESC, customer_id LIMIT 1000")
def _(b):
    return S.spend_segments(t(b), 0.06, 5, 1000)


@query("card_performance", f"SELECT card_type, merchant_category, {BASE}, count(*) FILTER (WHERE status = 'DECLINED') AS declined_count, count(*) FILTER (WHERE status = 'DECLINED') * 100.0::DOUBLE / count(*) AS decline_rate FROM b_bench GROUP BY 1, 2")
def _(b):
    return S.card_performance(t(b))


@query("fraud_detection_velocity", f"SELECT *, CASE WHEN daily_count > 5 THEN 'HIGH_VELOCITY' WHEN daily_amount > 300 THEN 'HIGH_VALUE' ELSE 'NORMAL' END AS risk_flag FROM (SELECT card_id, {DAY}::VARCHAR AS txn_date, count(*) AS daily_count, sum({A})::DOUBLE AS daily_amount, sum({A})::DOUBLE / count(*) AS avg_amount FROM b_bench GROUP BY 1, 2) WHERE daily_count > 4 OR daily_amount > 200 ORDER BY daily_amount DESC, card_id, txn_date LIMIT 1000")
def _(b):
    return S.daily_velocity(t(b), 5, 300, 4, 200, 1000)


@query("geographic_analysis", f"SELECT merchant_category, {BASE}, CASE WHEN merchant_category IN ('ELECTRONICS','ONLINE_SHOPPING') THEN 'ONLINE' WHEN merchant_category IN ('FOOD','GROCERY') THEN 'ESSENTIALS' WHEN merchant_category IN ('TRAVEL','ENTERTAINMENT') THEN 'LIFESTYLE' WHEN merchant_category IN ('HEALTHCARE','EDUCATION') THEN 'SERVICES' ELSE 'OTHER' END AS spending_category FROM b_bench GROUP BY 1")
def _(b):
    return S.spending_places(t(b))


@query("hourly_patterns", f"SELECT hour(transaction_date) AS hour_of_day, {BASE}, count(DISTINCT card_id) AS unique_cards FROM b_bench GROUP BY 1")
def _(b):
    return S.hour_patterns(t(b))


@query("percentile_analysis", f"SELECT merchant_category, {BASE}, min({A})::DOUBLE AS min_amount, max({A})::DOUBLE AS max_amount, {_SD} AS stddev_amount, quantile_cont({A}::DOUBLE, 0.5)::DECIMAL(18,6)::DOUBLE AS p50, quantile_cont({A}::DOUBLE, 0.95)::DECIMAL(18,6)::DOUBLE AS p95 FROM b_bench GROUP BY 1 HAVING count(*) >= 100")
def _(b):
    return S.amount_distribution(t(b), 100).withColumns({c: F.col(c).cast("decimal(18,6)") for c in ("p50", "p95")})


@query("daily_transaction_report", f"""WITH g AS (SELECT {DAY} AS d, merchant_category, count(*) AS n, sum({A}) AS a FROM b_bench GROUP BY ALL) SELECT d::VARCHAR AS txn_date, merchant_category, n AS transaction_count, a::DOUBLE AS total_amount, a::DOUBLE * 100.0::DOUBLE / sum(a) OVER (PARTITION BY d)::DOUBLE AS share_of_day, (a::DOUBLE - lag(a::DOUBLE) OVER w) * 100.0::DOUBLE / lag(a::DOUBLE) OVER w AS day_over_day_pct, CASE WHEN a > lag(a) OVER w THEN 'UP' WHEN a < lag(a) OVER w THEN 'DOWN' ELSE 'FLAT' END AS trend FROM g WINDOW w AS (PARTITION BY merchant_category ORDER BY d)""")
def _(b):
    return S.day_report(t(b))


@query("dashboard_by_tier", f"WITH m AS (SELECT customer_id, count(*) AS n, sum({A}) AS a FROM b_bench GROUP BY 1) SELECT CASE WHEN a > 6000 THEN 'PLATINUM' WHEN a > 3000 THEN 'GOLD' WHEN a > 600 THEN 'SILVER' ELSE 'BRONZE' END AS customer_tier, count(*) AS customers, sum(n)::BIGINT AS transactions, sum(a)::DOUBLE AS total_amount, sum(a)::DOUBLE / count(*) AS avg_per_customer FROM m GROUP BY 1")
def _(b):
    return S.tier_dashboard(t(b), 0.06)


@query("hourly_velocity_flags", f"SELECT * FROM (SELECT card_id, strftime(date_trunc('hour', transaction_date), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS n, sum({A})::DOUBLE AS amount, CASE WHEN count(*) > 2 THEN 'HIGH_VELOCITY' WHEN sum({A}) > 200 THEN 'HIGH_VALUE' ELSE 'NORMAL' END AS flag FROM b_bench GROUP BY 1, 2) WHERE flag <> 'NORMAL'")
def _(b):
    return S.hour_flags(t(b), 2, 200)
