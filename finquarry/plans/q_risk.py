"""Risk, regulatory, finance and executive queries."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import risk as K
from finquarry.operators import warehouse as D
from finquarry.plans import q_customer, q_fraud
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF
from finquarry.sources.clean import Clean

CAPITAL = K.Capital(paid_up=20000000, premium=1000000, additional_tier1=2000000, subordinated_debt=4000000, general_provisions=2000000)
TOTAL = 29000000.0
YEAR_AGO, MONTH_AGO, EQUITY = "2000-08-02", "2001-07-03", 6200000.0


def dash(b, classes=K.FIVE_CLASSES, past_due="days"):
    c = Clean(b)
    return K.credit_dashboard(c.loans, c.customers, c.payments, AS_OF, classes, past_due)


_DASH = """SELECT loan_id, customer_id, customer_name, loan_type_standardized AS loan_type, principal_amount, principal_outstanding, interest_rate, emi_amount, loan_status, coalesce(n, 0) AS total_payments_made, coalesce(ok, 0) AS successful_payments, coalesce(ko, 0) AS failed_payments,
    coalesce(ok * 100.0::DOUBLE / n, 0) AS payment_success_rate, (DATE '2001-08-02' - last_payment)::BIGINT AS days, last_payment FROM s_loans JOIN s_customers USING (customer_id)
    LEFT JOIN (SELECT loan_id, count(*) AS n, count(*) FILTER (WHERE status_standardized = 'SUCCESS') AS ok, count(*) FILTER (WHERE status_standardized = 'FAILED') AS ko, max(payment_date) AS last_payment FROM s_payments GROUP BY 1) USING (loan_id)"""
_CLS = "CASE WHEN loan_status <> 'ACTIVE' THEN 'CLOSED' WHEN days > 180 THEN 'LOSS' WHEN days > 90 THEN 'DOUBTFUL' WHEN days > 60 THEN 'SUB_STANDARD' WHEN days > 30 THEN 'SPECIAL_MENTION' ELSE 'STANDARD' END"
_DPD = "CASE WHEN loan_status <> 'ACTIVE' THEN NULL WHEN days > 30 THEN days ELSE 0 END"
D5 = f"d0 AS ({_DASH}), d5 AS (SELECT *, {_CLS} AS cls, {_DPD} AS dpd, {_CLS} IN ('SUB_STANDARD','DOUBTFUL','LOSS') AS bad FROM d0), act AS (SELECT * FROM d5 WHERE loan_status = 'ACTIVE') "
PO = "principal_outstanding"


def _s(cond):
    return f"coalesce((sum({PO}) FILTER (WHERE {cond}))::DOUBLE, 0)"


@query("credit_risk_dashboard", f"SELECT loan_id, customer_id, customer_name, loan_type, {PO}::DOUBLE AS principal_outstanding, loan_status, total_payments_made, successful_payments, failed_payments, payment_success_rate, CASE WHEN loan_status <> 'ACTIVE' THEN NULL WHEN days > 90 THEN 90 WHEN days > 60 THEN 60 WHEN days > 30 THEN 30 ELSE 0 END::BIGINT AS estimated_dpd, CASE WHEN loan_status <> 'ACTIVE' THEN 'CLOSED' WHEN days > 90 THEN 'NPA' WHEN days > 60 THEN 'SUB_STANDARD' WHEN days > 30 THEN 'SPECIAL_MENTION' ELSE 'STANDARD' END AS risk_classification FROM ({_DASH})")
def _(b):
    return dash(b, K.DASHBOARD_CLASSES, "threshold").select("loan_id", "customer_id", "customer_name", "loan_type", "principal_outstanding", "loan_status", "total_payments_made", "successful_payments", "failed_payments", "payment_success_rate", "estimated_dpd", "risk_classification")


_NAMES = ["STANDARD", "SPECIAL_MENTION", "SUB_STANDARD", "DOUBTFUL", "LOSS"]


@query("credit_risk_summary", f"WITH {D5} SELECT count(*) AS total_active_loans, sum(principal_amount)::DOUBLE AS total_disbursed, sum({PO})::DOUBLE AS total_outstanding, " + ", ".join(f"count(*) FILTER (WHERE cls = '{n}') AS {n.lower()}_count" for n in _NAMES) + ", " + ", ".join(_s(f"cls = '{n}'") + f" AS {n.lower()}_exposure" for n in _NAMES) + f", {_s('bad')} * 100.0::DOUBLE / sum({PO})::DOUBLE AS npl_ratio, sum(interest_rate)::DOUBLE / count(*) AS avg_interest_rate FROM act")
def _(b):
    return K.risk_summary(dash(b))


@query("risk_by_loan_type", f"WITH {D5} SELECT loan_type, count(*) AS loan_count, sum(principal_amount)::DOUBLE AS total_disbursed, sum({PO})::DOUBLE AS total_outstanding, count(*) FILTER (WHERE cls = 'STANDARD') AS standard_count, count(*) FILTER (WHERE bad) AS npa_count, count(*) FILTER (WHERE bad) * 100.0::DOUBLE / count(*) AS npa_rate, sum(interest_rate)::DOUBLE / count(*) AS avg_interest_rate, min(interest_rate)::DOUBLE AS min_interest_rate, max(interest_rate)::DOUBLE AS max_interest_rate, sum(total_payments_made)::BIGINT AS total_payments, sum(successful_payments)::BIGINT AS successful_payments, sum(failed_payments)::BIGINT AS failed_payments FROM act GROUP BY 1")
def _(b):
    return K.risk_by_type(dash(b))


@query("risk_by_customer_segment", f"WITH {D5} SELECT customer_id, customer_segment, count(*) AS loan_count, sum({PO})::DOUBLE AS total_exposure, sum(emi_amount)::DOUBLE AS total_monthly_emi, min(dpd) AS best_dpd, max(dpd) AS worst_dpd, CASE WHEN max(dpd) > 90 THEN 'HIGH_RISK' WHEN max(dpd) > 30 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS customer_risk_level FROM act JOIN (SELECT customer_id, customer_segment FROM m_c360) USING (customer_id) GROUP BY 1, 2")
def _(b):
    return K.risk_by_segment(dash(b), q_customer.c360(b))


_CONC = "CASE WHEN p > {h} THEN 'HIGH_CONCENTRATION' WHEN p > {m} THEN 'MEDIUM_CONCENTRATION' ELSE 'LOW_CONCENTRATION' END"


@query("concentration_risk", f"""WITH a AS (SELECT * FROM s_loans WHERE loan_status = 'ACTIVE'), t AS (SELECT sum({PO})::DOUBLE AS t FROM a), y AS (SELECT loan_type_standardized AS category, sum({PO})::DOUBLE AS exposure FROM a GROUP BY 1), c AS (SELECT customer_name AS category, sum({PO})::DOUBLE AS exposure FROM a JOIN s_customers USING (customer_id) GROUP BY customer_id, customer_name HAVING sum({PO}) > 0)
    SELECT 'BY_LOAN_TYPE' AS concentration_type, category, exposure, p AS pct_of_portfolio, {_CONC.format(h=30, m=20)} AS concentration_level FROM (SELECT *, exposure * 100.0::DOUBLE / t AS p FROM y, t) UNION ALL SELECT 'BY_CUSTOMER', category, exposure, p, {_CONC.format(h=10, m=5)} FROM (SELECT *, exposure * 100.0::DOUBLE / t AS p FROM c, t)""")
def _(b):
    c = Clean(b)
    return K.concentration(c.loans, c.customers)


_RATE = "CASE cls WHEN 'STANDARD' THEN 0.01 WHEN 'SPECIAL_MENTION' THEN 0.02 WHEN 'SUB_STANDARD' THEN 0.25 WHEN 'DOUBTFUL' THEN 0.5 WHEN 'LOSS' THEN 1.0 ELSE 0.01 END::DOUBLE"


@query("provision_requirement", f"WITH {D5} SELECT cls AS risk_classification, count(*) AS loan_count, sum({PO})::DOUBLE AS exposure, {_RATE} AS provision_rate, sum({PO})::DOUBLE * {_RATE} AS required_provision FROM act GROUP BY 1")
def _(b):
    return K.provisions(dash(b))


# --- non-performing assets ----------------------------------------------------------------------------------
_PROV = f"({_s(chr(99) + 'ls = ' + chr(39) + 'SUB_STANDARD' + chr(39))} * 0.25::DOUBLE + {_s(chr(99) + 'ls = ' + chr(39) + 'DOUBTFUL' + chr(39))} * 0.5::DOUBLE + {_s(chr(99) + 'ls = ' + chr(39) + 'LOSS' + chr(39))} * 1.0::DOUBLE)"
_NPA = f"count(*) AS total_loans, sum({PO})::DOUBLE AS total_outstanding, count(*) FILTER (WHERE bad) AS npa_count, {_s('bad')} AS npa_amount, {_s('bad')} * 100.0::DOUBLE / nullif(sum({PO})::DOUBLE, 0) AS npa_ratio"


@query("npa_status", f"WITH {D5} SELECT {_NPA}, " + ", ".join(_s(f"cls = '{n}'") + f" AS {n.lower()}_amount" for n in ("SUB_STANDARD", "DOUBTFUL", "LOSS")) + f", {_PROV} AS total_provisions, {_PROV} * 100.0::DOUBLE / nullif({_s('bad')}, 0) AS provision_coverage_ratio FROM act")
def _(b):
    return K.npa_status(dash(b))


def _flag(suffix=""):
    return f"CASE WHEN coalesce(npa_ratio, 0) > 5 THEN 'HIGH_RISK{suffix}' WHEN coalesce(npa_ratio, 0) > 3 THEN 'MEDIUM_RISK{suffix}' ELSE 'LOW_RISK{suffix}' END AS risk_flag"


@query("npa_by_loan_type", f"WITH {D5} SELECT *, {_flag()} FROM (SELECT loan_type, {_NPA} FROM act GROUP BY 1)")
def _(b):
    return K.npa_by(dash(b), "loan_type")


@query("npa_by_branch", f"WITH {D5} SELECT *, {_flag('_BRANCH')} FROM (SELECT branch_code::BIGINT AS branch_code, {_NPA} FROM act JOIN (SELECT customer_id, branch_code FROM s_accounts) USING (customer_id) GROUP BY 1)")
def _(b):
    home = Clean(b).accounts.select("customer_id", "branch_code").distinct()
    return K.npa_by(dash(b).join(home, "customer_id"), "branch_code", "_BRANCH")


FIRST, LAST = "1999-09-01", "2001-08-01"


def monthly(b):
    c = Clean(b)
    return K.monthly_snapshots(c.loans, c.payments, FIRST, LAST)


_W = "CASE loan_type_standardized WHEN 'HOME_LOAN' THEN 0.35 WHEN 'PERSONAL_LOAN' THEN 0.75 WHEN 'CAR_LOAN' THEN 0.65 WHEN 'BUSINESS_LOAN' THEN 1.0 WHEN 'EDUCATION_LOAN' THEN 0.75 WHEN 'GOLD_LOAN' THEN 0.5 ELSE 1.0 END::DECIMAL(4,2)"
MON = f"""ms AS (SELECT last_day(d::DATE) AS me FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 MONTH) t(d)), lm AS (SELECT *, me - lp AS days FROM (SELECT l.*, me, max(p.payment_date) AS lp FROM s_loans l JOIN ms ON disbursement_date <= me AND maturity_date >= me LEFT JOIN s_payments p ON p.loan_id = l.loan_id AND p.payment_date <= me GROUP BY ALL)),
    lc AS (SELECT *, {_W} AS w, CASE WHEN days > 180 THEN 'LOSS' WHEN days > 90 THEN 'DOUBTFUL' WHEN days > 60 THEN 'SUB_STANDARD' WHEN days > 30 THEN 'SPECIAL_MENTION' ELSE 'STANDARD' END AS cls FROM lm), lb AS (SELECT *, cls IN ('SUB_STANDARD','DOUBTFUL','LOSS') AS bad FROM lc),
    mon AS (SELECT date_trunc('month', me)::DATE AS report_month, count(*) AS total_active_loans, sum({PO})::DOUBLE AS total_outstanding, {_s('bad')} AS npa_amount, {_s('bad')} * 100.0::DOUBLE / sum({PO})::DOUBLE AS npa_ratio, {_PROV} AS total_provisions, sum({PO} * w)::DOUBLE AS rwa FROM lb GROUP BY 1) """


@query("risk_trend", f"WITH {MON}, c AS (SELECT *, {TOTAL}::DOUBLE * 100.0::DOUBLE / rwa AS car_ratio FROM mon) SELECT report_month::VARCHAR AS report_month, total_active_loans, total_outstanding, npa_amount, npa_ratio, lag(npa_ratio) OVER w AS prev_month_npa, npa_ratio - lag(npa_ratio) OVER w AS npa_change, total_provisions, car_ratio, CASE WHEN npa_ratio > lag(npa_ratio) OVER w THEN 'DETERIORATING' WHEN npa_ratio < lag(npa_ratio) OVER w THEN 'IMPROVING' ELSE 'STABLE' END AS npa_trend, CASE WHEN car_ratio > lag(car_ratio) OVER w THEN 'IMPROVING' WHEN car_ratio < lag(car_ratio) OVER w THEN 'DETERIORATING' ELSE 'STABLE' END AS car_trend FROM c WINDOW w AS (ORDER BY report_month)")
def _(b):
    return K.risk_trend(monthly(b), TOTAL)


@query("npa_trend", f"WITH {MON} SELECT report_month::VARCHAR AS report_month, npa_amount, npa_ratio, lag(npa_ratio) OVER w AS prev_month_npa_ratio, npa_ratio - lag(npa_ratio) OVER w AS mom_npa_change, lag(npa_amount) OVER w AS prev_month_npa_amount, lag(npa_ratio, 12) OVER w AS yoy_npa_ratio, npa_ratio - lag(npa_ratio, 12) OVER w AS yoy_npa_change, CASE WHEN npa_ratio > lag(npa_ratio) OVER w THEN 'DETERIORATING' WHEN npa_ratio < lag(npa_ratio) OVER w THEN 'IMPROVING' ELSE 'STABLE' END AS trend, CASE WHEN npa_ratio <= 2 THEN 'GREEN' WHEN npa_ratio <= 3 THEN 'YELLOW' WHEN npa_ratio <= 5 THEN 'ORANGE' ELSE 'RED' END AS traffic_light FROM mon WINDOW w AS (ORDER BY report_month)")
def _(b):
    return K.npa_trend(monthly(b))


@query("npa_forecast", f"""WITH {D5}, {MON}, s AS (SELECT {_s('bad')} * 100.0::DOUBLE / sum({PO})::DOUBLE AS r FROM act), l AS (SELECT * FROM mon ORDER BY report_month DESC LIMIT 6), d AS (SELECT *, npa_ratio - lag(npa_ratio) OVER (ORDER BY report_month) AS d FROM l), f AS (SELECT sum(npa_ratio::DECIMAL(28,10))::DOUBLE / count(*) AS ma, sum(d::DECIMAL(28,10))::DOUBLE / count(d) AS ch, max_by(npa_ratio, report_month) AS last FROM d)
    SELECT r AS current_npa, ma AS moving_avg, ch AS avg_monthly_change, last + ch * 3 AS forecast_3m, CASE WHEN r > 5 THEN 'HIGH' WHEN r > 3 THEN 'MEDIUM' ELSE 'LOW' END AS current_risk_level, CASE WHEN r > 5 THEN 'URGENT: Increase provisions, tighten lending criteria' WHEN r > 3 THEN 'CAUTION: Monitor closely, review high-risk accounts' ELSE 'NORMAL: Continue standard monitoring' END AS recommendation FROM s, f""")
def _(b):
    return K.npa_forecast(monthly(b), K.npa_status(dash(b)))


@query("top_npa_accounts", f"WITH {D5} SELECT loan_id, customer_id, customer_name, loan_type, {PO}::DOUBLE AS principal_outstanding, dpd AS estimated_dpd, cls AS risk_classification, CASE WHEN dpd > 180 THEN 'P1_LEGAL_ACTION' WHEN dpd > 90 THEN 'P2_RECOVERY' WHEN dpd > 60 THEN 'P3_RESTRUCTURE' ELSE 'P4_FOLLOWUP' END AS recovery_priority, {PO}::DOUBLE * {_RATE} AS potential_provision, days AS days_since_last_payment FROM act WHERE bad ORDER BY dpd DESC, {PO} DESC, loan_id LIMIT 100")
def _(b):
    return K.top_npa(dash(b), 100)


@query("npa_by_dpd", f"WITH {D5} SELECT CASE WHEN days > 180 THEN 'Loss' WHEN days > 90 THEN 'Doubtful' WHEN days > 60 THEN 'Substandard' WHEN days > 30 THEN 'Special Mention' ELSE 'Standard' END AS classification, count(*) AS loan_count, sum({PO})::DOUBLE AS total_outstanding FROM act GROUP BY 1")
def _(b):
    c = Clean(b)
    last = c.payments.groupBy("loan_id").agg(F.max("payment_date").alias("last_payment"))
    return K.npa_by_dpd(c.loans.filter("loan_status = 'ACTIVE'"), last, AS_OF)


@query("mart_credit_risk", f"SELECT loan_type_standardized AS loan_type, count(*) AS total_loans, sum(principal_amount)::DOUBLE AS total_disbursed, sum({PO})::DOUBLE AS total_outstanding, count(*) FILTER (WHERE loan_status = 'ACTIVE') AS active_loans, count(*) FILTER (WHERE loan_status = 'MATURED') AS matured_loans, sum(interest_rate)::DOUBLE / count(*) AS avg_interest_rate, sum(emi_amount)::DOUBLE AS total_monthly_emi, sum(emi_amount)::DOUBLE / count(*) AS avg_emi, {_s('loan_status = ' + chr(39) + 'MATURED' + chr(39))} * 100.0::DOUBLE / nullif(sum({PO})::DOUBLE, 0) AS npa_ratio FROM s_loans GROUP BY 1")
def _(b):
    return K.credit_mart(Clean(b).loans)


# --- capital and call report -----------------------------------------------------------------------------------


def weighted(b):
    c = Clean(b)
    return K.rwa(c.loans, c.cards, c.transactions, YEAR_AGO)


def tiers(b):
    income = Clean(b).transactions.filter((F.col("txn_date") >= YEAR_AGO) & ~F.col("description").contains("PAYMENT")).agg(X.dsum("amount").alias("income"))
    return K.capital_tiers(CAPITAL, income)


def car(b):
    return K.capital_ratios(tiers(b), weighted(b))


_RWA = f"""rwa AS (SELECT 'CREDIT_RISK' AS risk_category, loan_type_standardized AS sub_category, sum({PO})::DOUBLE AS exposure, any_value({_W})::DOUBLE AS risk_weight FROM s_loans WHERE loan_status = 'ACTIVE' GROUP BY 2 UNION ALL SELECT 'MARKET_RISK', 'TRADING_BOOK', sum(card_limit - credit_used)::DOUBLE, 0.08::DOUBLE FROM s_cards WHERE status = 'ACTIVE' UNION ALL SELECT 'OPERATIONAL_RISK', 'OPERATIONAL', sum(amount)::DOUBLE, 0.15::DOUBLE FROM s_transactions WHERE txn_date >= DATE '{YEAR_AGO}' AND txn_type_standardized = 'DEBIT'),
    cap AS (SELECT 21000000.0::DOUBLE + coalesce(sum(amount)::DOUBLE, 0) AS cet1 FROM s_transactions WHERE txn_date >= DATE '{YEAR_AGO}' AND description <> 'PAYMENT'),
    car0 AS (SELECT cet1 AS cet1_capital, cet1 + 2000000 AS tier1_capital, cet1 + 8000000 AS total_capital, (SELECT sum((exposure * risk_weight)::DECIMAL(28,4))::DOUBLE FROM rwa) AS total_rwa FROM cap),
    car AS (SELECT *, cet1_capital * 100.0::DOUBLE / total_rwa AS cet1_ratio, tier1_capital * 100.0::DOUBLE / total_rwa AS tier1_ratio, total_capital * 100.0::DOUBLE / total_rwa AS car_ratio, cet1_capital - total_rwa * 0.045::DOUBLE AS cet1_surplus, tier1_capital - total_rwa * 0.06::DOUBLE AS tier1_surplus, total_capital - total_rwa * 0.08::DOUBLE AS car_surplus FROM car0),
    ratios AS (SELECT *, CASE WHEN cet1_ratio >= 4.5 AND tier1_ratio >= 6 AND car_ratio >= 8 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS compliance_status FROM car) """


@query("basel_rwa", f"WITH {_RWA} SELECT *, exposure * risk_weight AS risk_weighted_exposure FROM rwa")
def _(b):
    return weighted(b)


@query("basel_capital", f"WITH {_RWA} SELECT 'TIER1_COMMON' AS tier, cet1 AS amount FROM cap UNION ALL SELECT 'TIER1_ADDITIONAL', 2000000.0::DOUBLE UNION ALL SELECT 'TIER2', 6000000.0::DOUBLE")
def _(b):
    return tiers(b)


@query("basel_car", f"WITH {_RWA} SELECT * FROM ratios")
def _(b):
    return car(b)


@query("large_exposure", f"WITH {_RWA}, e AS (SELECT customer_id, customer_name, sum({PO})::DOUBLE AS total_exposure, count(*) AS loan_count, string_agg(DISTINCT loan_type_standardized, ', ' ORDER BY loan_type_standardized) AS loan_types FROM s_loans JOIN s_customers USING (customer_id) WHERE loan_status = 'ACTIVE' GROUP BY 1, 2) SELECT customer_id, customer_name, total_exposure, loan_count, loan_types, tier1_capital * 0.015::DOUBLE AS single_borrower_limit, CASE WHEN total_exposure > tier1_capital * 0.015::DOUBLE THEN 'EXCEEDS_LIMIT' ELSE 'WARNING' END AS exposure_status, total_exposure * 100.0::DOUBLE / (tier1_capital * 0.015::DOUBLE) AS pct_of_limit FROM e, ratios WHERE total_exposure > tier1_capital * 0.01::DOUBLE")
def _(b):
    c = Clean(b)
    t1 = car(b).select("tier1_capital").scalar()
    return K.large_exposures(c.loans, c.customers, t1 * 0.01, t1 * 0.015)


@query("large_exposure_fixed", f"SELECT customer_id, customer_name, sum({PO})::DOUBLE AS total_exposure, count(*) AS loan_count, CASE WHEN sum({PO}) > 500000 THEN 'EXCEEDS_LIMIT' ELSE 'WARNING' END AS exposure_status FROM s_loans JOIN s_customers USING (customer_id) WHERE loan_status = 'ACTIVE' GROUP BY 1, 2 HAVING sum({PO}) > 300000")
def _(b):
    c = Clean(b)
    return K.large_exposures(c.loans, c.customers, F.lit(300000.0), F.lit(500000.0)).select("customer_id", "customer_name", "total_exposure", "loan_count", "exposure_status")


def sheet(b):
    c = Clean(b)
    return K.balance_sheet(c.accounts, c.loans, c.cards, EQUITY)


_SHEET = f"""sheet AS (SELECT *, total_liabilities + total_loans AS total_assets, 6200000.0::DOUBLE AS total_equity FROM (SELECT coalesce((sum(current_balance) FILTER (WHERE account_type_standardized = 'SAVINGS'))::DOUBLE, 0) AS customer_deposits_savings, coalesce((sum(current_balance) FILTER (WHERE account_type_standardized = 'CURRENT'))::DOUBLE, 0) AS customer_deposits_current, sum(current_balance)::DOUBLE AS total_liabilities FROM s_accounts WHERE status_standardized = 'ACTIVE'),
    (SELECT {", ".join(f"coalesce((sum({PO}) FILTER (WHERE loan_type_standardized = '{v}'))::DOUBLE, 0) AS {k}" for k, v in (("home_loans", "HOME_LOAN"), ("personal_loans", "PERSONAL_LOAN"), ("car_loans", "CAR_LOAN"), ("business_loans", "BUSINESS_LOAN")))}, sum({PO})::DOUBLE AS total_loans FROM s_loans WHERE loan_status = 'ACTIVE'), (SELECT sum(card_limit)::DOUBLE AS credit_card_limits FROM s_cards WHERE status = 'ACTIVE')) """
_QUAL = f"""qual AS (SELECT *, loss * 100.0::DOUBLE / portfolio AS npl_ratio, loss * 0.15::DOUBLE * 100.0::DOUBLE / nullif(loss, 0) AS provision_coverage_ratio FROM (SELECT sum({PO})::DOUBLE AS portfolio, {_s('coalesce(days, 0) <= 0')} AS standard_loans, {_s('days BETWEEN 1 AND 30')} AS special_mention, {_s('days BETWEEN 31 AND 60')} AS sub_standard, {_s('days BETWEEN 61 AND 90')} AS doubtful, {_s('days > 90')} AS loss FROM act)) """
_LIQ = "liq AS (SELECT total_deposits, liquid_assets, liquid_assets * 100.0::DOUBLE / nullif(sv, 0) AS lcr_ratio, CASE WHEN liquid_assets * 100.0::DOUBLE / nullif(sv, 0) >= 100 THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS lcr_compliance FROM (SELECT sum(current_balance)::DOUBLE AS total_deposits, sum(available_balance)::DOUBLE AS liquid_assets, (sum(current_balance) FILTER (WHERE account_type_standardized = 'SAVINGS'))::DOUBLE AS sv FROM s_accounts WHERE status_standardized = 'ACTIVE')) "


@query("call_report_balance_sheet", f"WITH {_SHEET} SELECT * FROM sheet")
def _(b):
    return sheet(b)


@query("call_report_capital", f"WITH {_RWA} SELECT cet1_capital, tier1_capital, total_capital, total_rwa AS risk_weighted_assets, cet1_ratio, tier1_ratio, car_ratio, compliance_status FROM ratios")
def _(b):
    return car(b).select("cet1_capital", "tier1_capital", "total_capital", F.col("total_rwa").alias("risk_weighted_assets"), "cet1_ratio", "tier1_ratio", "car_ratio", "compliance_status")


@query("call_report_asset_quality", f"WITH {D5}, {_QUAL} SELECT * FROM qual")
def _(b):
    return K.asset_quality(dash(b))


@query("call_report_liquidity", f"WITH {_LIQ} SELECT * FROM liq")
def _(b):
    return K.liquidity(Clean(b).accounts)


@query("call_report", f"WITH {D5}, {_RWA}, {_SHEET}, {_QUAL}, {_LIQ} SELECT * FROM sheet, ratios, qual, liq")
def _(b):
    return K.call_report(sheet(b), car(b), K.asset_quality(dash(b)), K.liquidity(Clean(b).accounts))


@query("sbv_call_report", f"WITH {D5}, {_RWA}, {_QUAL} SELECT (SELECT (sum(current_balance) FILTER (WHERE account_type_standardized = 'SAVINGS'))::DOUBLE FROM s_accounts) AS total_savings_deposits, (SELECT (sum(current_balance) FILTER (WHERE account_type_standardized = 'CURRENT'))::DOUBLE FROM s_accounts) AS total_current_deposits, portfolio AS total_loan_outstanding, cet1_ratio, tier1_ratio, car_ratio, loss AS npa_amount, npl_ratio AS npa_ratio, compliance_status AS basel_compliance FROM ratios, qual")
def _(b):
    t = F.col("account_type_standardized")
    a = Clean(b).accounts.agg(X.sum_if(t == "SAVINGS", "current_balance").alias("total_savings_deposits"), X.sum_if(t == "CURRENT", "current_balance").alias("total_current_deposits"))
    q = K.asset_quality(dash(b)).select(F.col("portfolio").alias("total_loan_outstanding"), F.col("loss").alias("npa_amount"), F.col("npl_ratio").alias("npa_ratio"))
    return K.one_row(a, car(b).select("cet1_ratio", "tier1_ratio", "car_ratio", F.col("compliance_status").alias("basel_compliance")), q)


@query("call_report_validation", f"WITH {D5}, {_RWA}, {_SHEET}, {_QUAL} SELECT 'Balance Sheet Check' AS validation, CASE WHEN total_assets - total_liabilities - total_equity = 0 THEN 'PASS' ELSE 'FAIL' END AS result, total_assets - total_liabilities - total_equity AS value FROM sheet UNION ALL SELECT 'Capital Ratio Check', CASE WHEN car_ratio >= 8 THEN 'PASS' ELSE 'FAIL' END, car_ratio FROM ratios UNION ALL SELECT 'NPL Ratio Check', CASE WHEN npl_ratio <= 3 THEN 'PASS' WHEN npl_ratio <= 5 THEN 'WARNING' ELSE 'FAIL' END, npl_ratio FROM qual")
def _(b):
    return K.call_report_checks(sheet(b), car(b), K.asset_quality(dash(b)))


@query("car_simple", f"WITH {_RWA} SELECT 29000000.0::DOUBLE * 100.0::DOUBLE / sum((exposure * risk_weight)::DECIMAL(28,4))::DOUBLE AS car FROM rwa")
def _(b):
    return weighted(b).agg(X.pct(F.lit(TOTAL), X.dsum(F.col("risk_weighted_exposure").cast("decimal(28,4)"))).alias("car"))


@query("deposits_by_branch", "SELECT n_name AS branch_name, sum(current_balance)::DOUBLE AS total_deposits, count(DISTINCT account_id) AS account_count FROM s_accounts JOIN nation ON branch_code = n_nationkey GROUP BY 1")
def _(b):
    per = Clean(b).accounts.groupBy("branch_code").agg(X.dsum("current_balance").alias("total_deposits"), F.countDistinct("account_id").alias("account_count"))
    return per.join(b.table("nation"), F.col("branch_code") == F.col("n_nationkey")).select(F.col("n_name").alias("branch_name"), "total_deposits", "account_count")


@query("npa_by_type", f"SELECT loan_type_standardized AS loan_type, count(*) AS total_loans, sum(principal_amount)::DOUBLE AS total_loan_amount, coalesce((sum(principal_amount) FILTER (WHERE loan_status = 'MATURED' AND {PO} > 0))::DOUBLE, 0) AS npa_amount, coalesce((sum(principal_amount) FILTER (WHERE loan_status = 'MATURED' AND {PO} > 0))::DOUBLE, 0) * 100.0::DOUBLE / sum(principal_amount)::DOUBLE AS npa_ratio FROM s_loans GROUP BY 1")
def _(b):
    late = (F.col("loan_status") == "MATURED") & (F.col("principal_outstanding") > 0)
    return Clean(b).loans.groupBy(F.col("loan_type_standardized").alias("loan_type")).agg(F.count("*").alias("total_loans"), X.dsum("principal_amount").alias("total_loan_amount"), X.sum_if(late, "principal_amount").alias("npa_amount"), X.pct(X.sum_if(late, "principal_amount"), F.sum("principal_amount")).alias("npa_ratio"))


@query("npa_regulatory_report", f"WITH {D5} SELECT cls AS risk_classification, count(*) AS loans, sum({PO})::DOUBLE AS outstanding, sum({PO})::DOUBLE * 100.0::DOUBLE / (SELECT sum({PO})::DOUBLE FROM act) AS share, CASE WHEN sum({PO})::DOUBLE * 100.0::DOUBLE / (SELECT sum({PO})::DOUBLE FROM act) > 3 AND any_value(bad) THEN 'REVIEW' ELSE 'OK' END AS compliance FROM act GROUP BY 1")
def _(b):
    act = dash(b).filter("loan_status = 'ACTIVE'")
    total = act.agg(X.dsum("principal_outstanding")).scalar()
    out = act.groupBy("risk_classification").agg(F.count("*").alias("loans"), X.dsum("principal_outstanding").alias("outstanding")).withColumn("share", X.pct("outstanding", total))
    return out.withColumn("compliance", F.when((F.col("share") > 3) & F.col("risk_classification").isin(*K.NON_PERFORMING), "REVIEW").otherwise("OK"))


# --- executive -----------------------------------------------------------------------------------------------------


def kpi(b):
    c = Clean(b)
    alerts = q_fraud.score(b).filter((F.col("evaluated_at") >= F.lit("2024-01-30").cast("timestamp_ntz")) & F.col("recommended_action").isin("BLOCK", "REVIEW"))
    return K.ceo_dashboard(c.accounts, dash(b), c.customers, c.transactions, car(b), alerts, q_fraud.sar(b).filter("risk_classification = 'HIGH'"), AS_OF, MONTH_AGO)


_KPI = f"""{D5}, {_RWA}, a AS (SELECT sum(current_balance)::DOUBLE AS dep, sum(available_balance)::DOUBLE AS av, (sum(current_balance) FILTER (WHERE account_type_standardized = 'SAVINGS'))::DOUBLE AS sv, (sum(current_balance) FILTER (WHERE account_type_standardized IN ('SAVINGS','CURRENT')))::DOUBLE AS cost FROM s_accounts WHERE status_standardized = 'ACTIVE'),
    l AS (SELECT sum({PO})::DOUBLE AS loans, sum({PO} * interest_rate)::DOUBLE / 100.0::DOUBLE AS inc, {_s('dpd > 90')} AS npl FROM act), c AS (SELECT count(*) AS n, count(*) FILTER (WHERE created_date >= DATE '{MONTH_AGO}') AS fresh, count(*) FILTER (WHERE created_date <= DATE '{MONTH_AGO}') AS old FROM s_customers),
    x AS (SELECT count(*) AS n, sum(amount)::DOUBLE AS v, count(*) FILTER (WHERE channel_standardized IN ('MOBILE','ONLINE')) AS dig, count(DISTINCT customer_id) FILTER (WHERE customer_id IS NOT NULL) AS act FROM s_transactions LEFT JOIN s_accounts USING (account_id) WHERE txn_date >= DATE '{MONTH_AGO}'),
    fa AS (SELECT count(*) AS n FROM f_score WHERE evaluated_at >= TIMESTAMP '2024-01-30 00:00:00' AND recommended_action IN ('BLOCK','REVIEW')), am AS (SELECT count(*) AS n FROM ({q_fraud._STR}) WHERE risk_classification = 'HIGH'),
    kpi AS (SELECT '2001-08-02' AS report_date, dep + loans AS total_assets, dep AS total_deposits, loans AS total_loans, (inc - cost * 0.02::DOUBLE) * 100.0::DOUBLE / dep AS net_interest_margin_pct, inc * 0.3::DOUBLE * 100.0::DOUBLE / (dep + loans) AS return_on_assets_pct, npl * 100.0::DOUBLE / loans AS npl_ratio, npl * 0.5::DOUBLE * 100.0::DOUBLE / nullif(npl, 0) AS provision_coverage_ratio, cet1_ratio, tier1_ratio, car_ratio, av * 100.0::DOUBLE / sv AS lcr_ratio,
      c.n AS total_customers, fresh AS new_customers_30d, x.act AS active_customers_30d, x.act * 100.0::DOUBLE / nullif(old, 0) AS customer_retention_pct, dig * 100.0::DOUBLE / nullif(x.n, 0) AS digital_txn_pct, x.n AS txn_volume_30d, v AS txn_value_30d, fa.n AS fraud_alerts_24h, am.n AS aml_alerts, compliance_status AS basel_compliance, CASE WHEN car_ratio > 10 THEN 'STRONG' WHEN car_ratio > 8 THEN 'ADEQUATE' ELSE 'WEAK' END AS car_status FROM a, l, c, x, fa, am, ratios) """


@query("ceo_dashboard", f"WITH {_KPI} SELECT * FROM kpi")
def _(b):
    return kpi(b)


@query("ceo_monthly_trend", f"WITH {MON}, v AS (SELECT date_trunc('month', txn_date)::DATE AS report_month, sum(amount)::DOUBLE AS mv FROM s_transactions GROUP BY 1), m AS (SELECT mon.*, mv, {TOTAL}::DOUBLE * 100.0::DOUBLE / rwa AS car FROM mon LEFT JOIN v USING (report_month)) SELECT report_month::VARCHAR AS report_month, mv AS monthly_txn_value, npa_ratio AS avg_npl_ratio, car AS avg_car_ratio, mv - lag(mv) OVER w AS mom_txn_change, npa_ratio - lag(npa_ratio) OVER w AS mom_npl_change, car - lag(car) OVER w AS mom_car_change, mv - lag(mv, 12) OVER w AS yoy_txn_change, npa_ratio - lag(npa_ratio, 12) OVER w AS yoy_npl_change FROM m WINDOW w AS (ORDER BY report_month)")
def _(b):
    return K.monthly_kpis(Clean(b).transactions, monthly(b), TOTAL)


@query("ceo_strategic_alerts", f"""WITH {_KPI}, {MON}, p AS (SELECT npa_ratio AS prev FROM mon WHERE report_month = DATE '2001-07-01') SELECT CASE WHEN npl_ratio < prev THEN 'NPL ratio improved' END AS alert_npl_improvement, CASE WHEN digital_txn_pct > 70 THEN 'Digital adoption target met' ELSE 'Digital adoption below target (target: 70%)' END AS alert_digital_adoption, CASE WHEN car_ratio > 10 THEN 'CAR strong' WHEN car_ratio > 8 THEN 'CAR adequate' ELSE 'CAR weak - ACTION REQUIRED' END AS alert_capital_adequacy,
    CASE WHEN fraud_alerts_24h > 10 THEN 'High fraud activity: ' || fraud_alerts_24h || ' alerts in 24h' WHEN fraud_alerts_24h > 5 THEN 'Elevated fraud activity: ' || fraud_alerts_24h || ' alerts in 24h' ELSE 'Fraud activity normal' END AS alert_fraud_activity, CASE WHEN new_customers_30d > 1000 THEN 'Strong' WHEN new_customers_30d > 500 THEN 'Moderate' ELSE 'Low' END || ' customer growth: ' || new_customers_30d || ' new customers' AS alert_customer_growth, CASE WHEN basel_compliance = 'COMPLIANT' THEN 'Basel III compliant' ELSE 'Basel III NON-COMPLIANT - URGENT ACTION REQUIRED' END AS alert_compliance FROM kpi, p""")
def _(b):
    prev = monthly(b).filter("report_month = '2001-07-01'").select("npa_ratio").scalar()
    return K.strategic_alerts(kpi(b), prev)


@query("board_presentation", f"WITH {_KPI} " + " UNION ALL ".join(f"SELECT '{s}' AS section, '{m}' AS metric, {v} AS value, '{t}' AS target, CASE WHEN {ok} THEN 'ON_TRACK' ELSE 'BEHIND' END AS status FROM kpi" for s, m, v, t, ok in (("FINANCIAL HIGHLIGHTS", "Total Assets", "total_assets", "Target: Grow 15% YoY", "total_assets > 0"), ("FINANCIAL HIGHLIGHTS", "Net Interest Margin", "net_interest_margin_pct", "Target: > 2.5%", "net_interest_margin_pct > 2.5"), ("ASSET QUALITY", "NPL Ratio", "npl_ratio", "Target: < 3%", "npl_ratio < 3"), ("CAPITAL ADEQUACY", "CAR", "car_ratio", "Target: > 10%", "car_ratio > 10"), ("DIGITAL TRANSFORMATION", "Digital Transaction %", "digital_txn_pct", "Target: > 70%", "digital_txn_pct > 70"), ("CUSTOMER METRICS", "Customer Retention", "customer_retention_pct", "Target: > 90%", "customer_retention_pct > 90"))))
def _(b):
    return K.board_rows(kpi(b))


def loan_facts(b):
    c = Clean(b)
    return D.fact_loan_payment(c.payments, c.loans, D.dim_customer(c.customers, AS_OF))


_INT = f"(amount::DOUBLE - {PO}::DOUBLE / tenure_months::DOUBLE)::DECIMAL(28,6)"


@query("pnl_monthly", f"""WITH i AS (SELECT (year(payment_date) * 100 + month(payment_date))::BIGINT AS k, {", ".join(f"coalesce((sum({_INT}) FILTER (WHERE loan_type_standardized = '{v}'))::DOUBLE, 0) AS {n}" for n, v in (("home_loan_interest", "HOME_LOAN"), ("personal_loan_interest", "PERSONAL_LOAN"), ("car_loan_interest", "CAR_LOAN"), ("business_loan_interest", "BUSINESS_LOAN")))}, sum({_INT})::DOUBLE AS total_interest_income FROM s_payments JOIN s_loans USING (loan_id) GROUP BY 1),
    x AS (SELECT (year(txn_date) * 100 + month(txn_date))::BIGINT AS k, coalesce((sum(amount) FILTER (WHERE description LIKE '%FEE%'))::DOUBLE, 0) AS total_fee_income, count(*) AS total_transactions, sum(amount)::DOUBLE AS total_transaction_volume FROM s_transactions GROUP BY 1)
    SELECT k AS month_key, total_fee_income, total_transactions, total_transaction_volume, coalesce(home_loan_interest, 0) AS home_loan_interest, coalesce(personal_loan_interest, 0) AS personal_loan_interest, coalesce(car_loan_interest, 0) AS car_loan_interest, coalesce(business_loan_interest, 0) AS business_loan_interest, coalesce(total_interest_income, 0) AS total_interest_income, coalesce(total_interest_income, 0) + total_fee_income AS total_revenue FROM x LEFT JOIN i USING (k)""")
def _(b):
    return K.monthly_pnl(loan_facts(b), Clean(b).transactions)


_REG = f"""WITH l AS (SELECT branch_code, count(*) AS active_loans, sum({PO})::DOUBLE AS loan_portfolio, sum({PO} * interest_rate)::DOUBLE / 100.0::DOUBLE AS interest_income FROM s_loans JOIN (SELECT customer_id, branch_code FROM s_accounts) USING (customer_id) WHERE loan_status = 'ACTIVE' GROUP BY 1), t AS (SELECT branch_code, count(*) AS transaction_count, sum(amount)::DOUBLE AS transaction_volume FROM s_transactions JOIN s_accounts USING (account_id) GROUP BY 1)
    SELECT r_name AS region, n_name AS branch_name, coalesce(interest_income, 0) AS interest_income, coalesce(transaction_count, 0) AS transaction_count, coalesce(transaction_volume, 0) AS transaction_volume, coalesce(active_loans, 0) AS active_loans, coalesce(loan_portfolio, 0) AS loan_portfolio FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN l ON n_nationkey = l.branch_code LEFT JOIN t ON n_nationkey = t.branch_code"""


def regional(b):
    c = Clean(b)
    return K.regional_pnl(c.loans, c.transactions, c.accounts, D.dim_branch(b.table("nation"), b.table("region")))


@query("pnl_regional", _REG)
def _(b):
    return regional(b)


@query("pnl_product_performance", "SELECT p_type AS product_category, p_brand AS product_name, count(*) AS lines, sum(revenue)::DOUBLE AS total_revenue, sum(l_discount::DECIMAL(4,2))::DOUBLE / count(*) AS avg_discount FROM b_lines JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def _(b):
    per = b.order_lines().groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), F.sum("revenue").alias("r"), F.sum(F.col("l_discount").cast("decimal(4,2)")).alias("d"))
    return per.join(b.table("part"), "p_partkey").groupBy(F.col("p_type").alias("product_category"), F.col("p_brand").alias("product_name")).agg(F.sum("n").alias("lines"), X.dsum("r").alias("total_revenue"), (F.sum("d").cast("double") / F.sum("n")).alias("avg_discount"))


@query("pnl_summary", f"SELECT 'Total Interest' AS metric, (SELECT sum({_INT})::DOUBLE FROM s_payments JOIN s_loans USING (loan_id) WHERE year(payment_date) = 2000) AS value UNION ALL SELECT 'Total Transactions', (SELECT count(*)::DOUBLE FROM s_transactions WHERE year(txn_date) = 2000) UNION ALL SELECT 'Total Loan Portfolio', (SELECT sum({PO})::DOUBLE FROM s_loans)")
def _(b):
    f = loan_facts(b).filter(F.floor(F.col("date_key") / 10000) == 2000).agg(X.dsum(F.col("interest_amount").cast("decimal(28,6)")).alias("i"))
    t = Clean(b).transactions.filter(F.col("txn_date").between("2000-01-01", "2000-12-31")).agg(F.count("*").alias("n"))
    l = Clean(b).loans.agg(X.dsum("principal_outstanding").alias("p"))
    row = lambda name, c: F.struct(F.lit(name).alias("metric"), X.dbl(c).alias("value"))
    return K.one_row(f, t, l).select(F.inline(F.array(row("Total Interest", "i"), row("Total Transactions", "n"), row("Total Loan Portfolio", "p"))))


@query("kpi_rows", f"SELECT 'Total Deposits' AS metric, (SELECT sum(current_balance)::DOUBLE FROM s_accounts) AS value, 'VND' AS unit UNION ALL SELECT 'Total Loans', (SELECT sum({PO})::DOUBLE FROM s_loans WHERE loan_status = 'ACTIVE'), 'VND' UNION ALL SELECT 'Overdue Ratio', (SELECT (sum({PO}) FILTER (WHERE loan_status = 'MATURED'))::DOUBLE * 100.0::DOUBLE / sum({PO})::DOUBLE FROM s_loans), '%'")
def _(b):
    c, s = Clean(b), F.col("loan_status")
    a = c.accounts.agg(X.dsum("current_balance").alias("d"))
    l = c.loans.agg(X.sum_if(s == "ACTIVE", "principal_outstanding").alias("l"), X.pct(X.sum_if(s == "MATURED", "principal_outstanding"), F.sum("principal_outstanding")).alias("o"))
    row = lambda name, v, unit: F.struct(F.lit(name).alias("metric"), F.col(v).alias("value"), F.lit(unit).alias("unit"))
    return K.one_row(a, l).select(F.inline(F.array(row("Total Deposits", "d", "VND"), row("Total Loans", "l", "VND"), row("Overdue Ratio", "o", "%"))))


@query("regional_ranking", "SELECT region, customers, deposits, rank() OVER (ORDER BY deposits DESC) AS deposit_rank FROM (SELECT r_name AS region, count(DISTINCT customer_id) AS customers, sum(current_balance)::DOUBLE AS deposits FROM s_accounts JOIN nation ON branch_code = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)")
def _(b):
    from pyspark.sql import Window

    br = D.dim_branch(b.table("nation"), b.table("region"))
    out = Clean(b).accounts.join(br, "branch_code").groupBy("region").agg(F.countDistinct("customer_id").alias("customers"), X.dsum("current_balance").alias("deposits"))
    return out.withColumn("deposit_rank", F.rank().over(Window.orderBy(F.desc("deposits"))).cast("bigint"))


@query("product_ranking", "SELECT account_type_standardized AS product, count(*) AS accounts, sum(current_balance)::DOUBLE AS balance, sum(current_balance)::DOUBLE / count(*) AS avg_balance FROM s_accounts GROUP BY 1")
def _(b):
    return Clean(b).accounts.groupBy(F.col("account_type_standardized").alias("product")).agg(F.count("*").alias("accounts"), X.dsum("current_balance").alias("balance"), X.davg("current_balance").alias("avg_balance"))


@query("branch_ranking", f"SELECT branch_name, transaction_volume, loan_portfolio, rank() OVER (ORDER BY transaction_volume DESC) AS volume_rank FROM ({_REG})")
def _(b):
    from pyspark.sql import Window

    return regional(b).select("branch_name", "transaction_volume", "loan_portfolio", F.rank().over(Window.orderBy(F.desc("transaction_volume"))).cast("bigint").alias("volume_rank"))
