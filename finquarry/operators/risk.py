"""Credit risk, capital, regulatory and executive reports.

Fixed values: risk weights, provision rates and ratio minimums below are those of the rules
the reports follow. Capital amounts are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finquarry.functions import exprs as X

RISK_WEIGHTS = {"HOME_LOAN": 0.35, "PERSONAL_LOAN": 0.75, "CAR_LOAN": 0.65, "BUSINESS_LOAN": 1.0, "EDUCATION_LOAN": 0.75, "GOLD_LOAN": 0.5}
PROVISION_RATES = {"STANDARD": 0.01, "SPECIAL_MENTION": 0.02, "SUB_STANDARD": 0.25, "DOUBTFUL": 0.5, "LOSS": 1.0}
NON_PERFORMING = ("SUB_STANDARD", "DOUBTFUL", "LOSS")
DASHBOARD_CLASSES = [(90, "NPA"), (60, "SUB_STANDARD"), (30, "SPECIAL_MENTION")]
FIVE_CLASSES = [(180, "LOSS"), (90, "DOUBTFUL"), (60, "SUB_STANDARD"), (30, "SPECIAL_MENTION")]
MINIMUM = {"cet1": 4.5, "tier1": 6.0, "car": 8.0}


def _map(c: Column, values: dict[str, float], default: float) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def _day(d: str) -> Column:
    return F.lit(d).cast("date")


def one_row(base: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row tables side by side, as scalar subqueries instead of joins."""
    out = base
    for i, o in enumerate(others):
        out = out.withColumn(f"_o{i}", o.select(F.struct(*o.columns)).scalar())
    return out.select(*base.columns, *[F.col(f"_o{i}.{c}").alias(c) for i, o in enumerate(others) for c in o.columns])


# --- loan level -------------------------------------------------------------------------------------------
def credit_dashboard(loans: DataFrame, customers: DataFrame, payments: DataFrame, as_of: str, classes: Sequence[tuple[int, str]] = DASHBOARD_CLASSES, past_due: str = "threshold") -> DataFrame:
    """One row per loan with payment record, days past due and class.

    Payments are summed per loan before the join. Thresholds are tried from the largest
    down. ``estimated_dpd`` is the threshold passed (``past_due="threshold"``), or the days since
    the last payment once the lowest threshold is passed (``"days"``).
    """
    st = F.col("status_standardized")
    paid = payments.groupBy("loan_id").agg(F.count("*").alias("total_payments_made"), F.count_if(st == "SUCCESS").alias("successful_payments"), F.count_if(st == "FAILED").alias("failed_payments"), F.max("payment_date").alias("last_payment"))
    out = loans.join(paid, "loan_id", "left").fillna(0, ["total_payments_made", "successful_payments", "failed_payments"])
    out = out.join(customers.select("customer_id", "customer_name", "phone", "email"), "customer_id")
    days, active = F.datediff(_day(as_of), "last_payment"), F.col("loan_status") == "ACTIVE"
    cls = F.when(~active, "CLOSED")
    dpd = F.when(~active, None)
    for limit, name in classes:
        cls = cls.when(days > limit, name)
        dpd = dpd.when(days > limit, F.lit(limit) if past_due == "threshold" else days)
    return out.withColumns(
        {
            "payment_success_rate": F.coalesce(X.pct("successful_payments", "total_payments_made"), F.lit(0.0)), "estimated_dpd": dpd.otherwise(0), "risk_classification": cls.otherwise("STANDARD"),
            "days_since_last_payment": days, "loan_type": F.col("loan_type_standardized"),
        }
    )


def _npl(c: str = "principal_outstanding") -> Column:
    return X.sum_if(F.col("risk_classification").isin(*NON_PERFORMING, "NPA"), c)


def risk_summary(dash: DataFrame) -> DataFrame:
    c = F.col("risk_classification")
    names = ["STANDARD", "SPECIAL_MENTION", "SUB_STANDARD", "DOUBTFUL", "LOSS"]
    return dash.filter("loan_status = 'ACTIVE'").agg(
        F.count("*").alias("total_active_loans"), X.dsum("principal_amount").alias("total_disbursed"), X.dsum("principal_outstanding").alias("total_outstanding"),
        *[F.count_if(c == n).alias(f"{n.lower()}_count") for n in names], *[X.sum_if(c == n, "principal_outstanding").alias(f"{n.lower()}_exposure") for n in names],
        X.pct(_npl(), F.sum("principal_outstanding")).alias("npl_ratio"), X.davg("interest_rate").alias("avg_interest_rate"),
    )


def risk_by_type(dash: DataFrame) -> DataFrame:
    c = F.col("risk_classification")
    return dash.filter("loan_status = 'ACTIVE'").groupBy("loan_type").agg(
        F.count("*").alias("loan_count"), X.dsum("principal_amount").alias("total_disbursed"), X.dsum("principal_outstanding").alias("total_outstanding"), F.count_if(c == "STANDARD").alias("standard_count"),
        F.count_if(c.isin(*NON_PERFORMING)).alias("npa_count"), X.pct(F.count_if(c.isin(*NON_PERFORMING)), F.count("*")).alias("npa_rate"), X.davg("interest_rate").alias("avg_interest_rate"), F.min("interest_rate").alias("min_interest_rate"), F.max("interest_rate").alias("max_interest_rate"),
        F.sum("total_payments_made").alias("total_payments"), F.sum("successful_payments").alias("successful_payments"), F.sum("failed_payments").alias("failed_payments"),
    )


def risk_by_segment(dash: DataFrame, c360: DataFrame) -> DataFrame:
    per = dash.filter("loan_status = 'ACTIVE'").groupBy("customer_id").agg(F.count("*").alias("loan_count"), X.dsum("principal_outstanding").alias("total_exposure"), X.dsum("emi_amount").alias("total_monthly_emi"), F.min("estimated_dpd").alias("best_dpd"), F.max("estimated_dpd").alias("worst_dpd"))
    level = F.when(F.col("worst_dpd") > 90, "HIGH_RISK").when(F.col("worst_dpd") > 30, "MEDIUM_RISK").otherwise("LOW_RISK")
    return per.join(c360.select("customer_id", "customer_segment"), "customer_id").withColumn("customer_risk_level", level)


def concentration(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of the active portfolio per loan type (limits 30/20) and per customer (10/5)."""
    active = loans.filter("loan_status = 'ACTIVE'")
    total = active.agg(X.dsum("principal_outstanding")).scalar()

    def share(df, kind, high, medium):
        out = df.withColumn("pct_of_portfolio", X.pct("exposure", total))
        level = X.band(F.col("pct_of_portfolio"), [(high, "HIGH_CONCENTRATION"), (medium, "MEDIUM_CONCENTRATION")], "LOW_CONCENTRATION")
        return out.select(F.lit(kind).alias("concentration_type"), "category", "exposure", "pct_of_portfolio", level.alias("concentration_level"))

    by_type = active.groupBy(F.col("loan_type_standardized").alias("category")).agg(X.dsum("principal_outstanding").alias("exposure"))
    by_cust = active.groupBy("customer_id").agg(X.dsum("principal_outstanding").alias("exposure")).filter("exposure > 0").join(customers.select("customer_id", F.col("customer_name").alias("category")), "customer_id")
    return share(by_type, "BY_LOAN_TYPE", 30, 20).unionByName(share(by_cust, "BY_CUSTOMER", 10, 5))


def provisions(dash: DataFrame) -> DataFrame:
    out = dash.filter("loan_status = 'ACTIVE'").groupBy("risk_classification").agg(F.count("*").alias("loan_count"), X.dsum("principal_outstanding").alias("exposure"))
    return out.withColumn("provision_rate", _map(F.col("risk_classification"), PROVISION_RATES, 0.01)).withColumn("required_provision", F.col("exposure") * F.col("provision_rate"))


# --- non-performing assets -------------------------------------------------------------------------------------
def _npa_columns() -> list[Column]:
    c = F.col("risk_classification")
    return [F.count("*").alias("total_loans"), X.dsum("principal_outstanding").alias("total_outstanding"), F.count_if(c.isin(*NON_PERFORMING)).alias("npa_count"), _npl().alias("npa_amount"), X.pct(_npl(), F.sum("principal_outstanding")).alias("npa_ratio")]


def _provisions() -> Column:
    c = F.col("risk_classification")
    return X.sum_if(c == "SUB_STANDARD", "principal_outstanding") * 0.25 + X.sum_if(c == "DOUBTFUL", "principal_outstanding") * 0.5 + X.sum_if(c == "LOSS", "principal_outstanding") * 1.0


def npa_status(dash: DataFrame) -> DataFrame:
    c = F.col("risk_classification")
    out = dash.filter("loan_status = 'ACTIVE'").agg(*_npa_columns(), *[X.sum_if(c == n, "principal_outstanding").alias(f"{n.lower()}_amount") for n in NON_PERFORMING], _provisions().alias("total_provisions"))
    return out.withColumn("provision_coverage_ratio", X.pct("total_provisions", "npa_amount"))


def npa_by(dash: DataFrame, column: str, suffix: str = "") -> DataFrame:
    out = dash.filter("loan_status = 'ACTIVE'").groupBy(column).agg(*_npa_columns())
    return out.withColumn("risk_flag", X.band(F.coalesce("npa_ratio", F.lit(0.0)), [(5, f"HIGH_RISK{suffix}"), (3, f"MEDIUM_RISK{suffix}")], f"LOW_RISK{suffix}"))


def _month(day: Column) -> Column:
    """Months since year 0; also the number of the first month end not before the day."""
    return F.year(day) * 12 + F.month(day) - 1


def monthly_snapshots(loans: DataFrame, payments: DataFrame, first: str, last: str, classes: Sequence[tuple[int, str]] = FIVE_CLASSES) -> DataFrame:
    """Portfolio figures at each month end.

    A loan's class only changes at a payment or when a number of days since the last one has
    passed. Each stretch of one class is a plus at its first month and a minus at the month
    after its last; summed per month and class, running totals over the months of the report
    give the portfolio. No loan is laid out over its months.
    """
    low, high = _month(_day(first)), _month(_day(last)) + 1
    # payments before the first month count for it; a loan keeps its last one per month of the report
    per = payments.groupBy("loan_id", F.greatest(_month(F.col("payment_date")), low).alias("m")).agg(F.max("payment_date").alias("p")).filter(F.col("m") < high)
    follows = F.lead("m").over(Window.partitionBy("loan_id").orderBy("m"))  # at most a row for each month of the report
    paid = per.select(F.col("loan_id").alias("_l"), "m", "p", F.coalesce(follows, high).alias("_next"))
    begin = paid.groupBy("_l").agg(F.min("m").alias("_next")).select("_l", F.lit(None).cast("int").alias("m"), F.lit(None).cast("date").alias("p"), "_next")
    rising = sorted(classes)
    starts = [F.col("m"), *[_month(F.date_add("p", limit + 1)) for limit, _ in rising]]
    names = ["STANDARD", *[name for _, name in rising]]
    # before any payment a loan counts as standard
    live = loans.select("loan_id", "principal_outstanding", (F.col("principal_outstanding") * _map(F.col("loan_type_standardized"), RISK_WEIGHTS, 1.0).cast("decimal(4,2)")).alias("_w"), F.greatest(_month(F.col("disbursement_date")), low).alias("_from"), F.least(_month(F.date_add("maturity_date", 1)), high).alias("_to"))
    laid = live.join(paid.unionByName(begin), F.col("loan_id") == F.col("_l"), "left")
    until = F.least(F.coalesce("_next", high), F.col("_to"))
    stretch = lambda name, a, z: F.struct(F.lit(name).alias("c"), F.greatest(a, F.col("_from")).alias("a"), F.least(z, until).alias("z"))
    unpaid = F.array(stretch("STANDARD", F.col("_from"), until))
    since = F.array(*[stretch(name, F.greatest(starts[i], F.col("m")), starts[i + 1] if i + 1 < len(starts) else until) for i, name in enumerate(names)])
    cut = laid.select("principal_outstanding", "_w", F.inline(F.filter(F.when(F.col("p").isNull(), unpaid).otherwise(since), lambda x: x["a"] < x["z"])))
    events = cut.select("c", "principal_outstanding", "_w", F.inline(F.array(F.struct(F.col("a").alias("month"), F.lit(1).alias("sign")), F.struct(F.col("z").alias("month"), F.lit(-1).alias("sign")))))
    sums = events.groupBy("month", "c").agg(F.sum("sign").alias("n"), F.sum(F.col("principal_outstanding") * F.col("sign")).alias("po"), F.sum(F.col("_w") * F.col("sign")).alias("w"))
    spine = loans.sparkSession.range(1).select(F.explode(F.sequence(low, high - 1)).alias("month")).select("month", F.explode(F.array(*map(F.lit, names))).alias("c"))
    upto = Window.partitionBy("c").orderBy("month")  # a row for each month of the report
    total = lambda x: F.sum(F.coalesce(x, F.lit(0))).over(upto)
    state = spine.join(sums, ["month", "c"], "left").select("month", F.col("c").alias("risk_classification"), total("n").alias("n"), total("po").alias("principal_outstanding"), total("w").alias("_w"))
    out = state.groupBy(F.make_date((F.col("month") / 12).cast("int"), F.col("month") % 12 + 1, F.lit(1)).alias("report_month")).agg(
        F.sum("n").alias("total_active_loans"), X.dsum("principal_outstanding").alias("total_outstanding"), _npl().alias("npa_amount"), X.pct(_npl(), F.sum("principal_outstanding")).alias("npa_ratio"),
        _provisions().alias("total_provisions"), X.pct(_provisions(), _npl()).alias("provision_coverage_ratio"), X.dsum("_w").alias("rwa"),
    )
    return out.filter("total_active_loans > 0")


def _trend(c: str, w, up: str, down: str) -> Column:
    p = F.lag(c).over(w)
    return F.when(F.col(c) > p, up).when(F.col(c) < p, down).otherwise("STABLE")


def risk_trend(monthly: DataFrame, capital: float) -> DataFrame:
    w = Window.orderBy("report_month")  # one row per month
    m = monthly.withColumn("car_ratio", X.pct(F.lit(capital), "rwa"))
    return m.select(
        "report_month", "total_active_loans", "total_outstanding", "npa_amount", "npa_ratio", F.lag("npa_ratio").over(w).alias("prev_month_npa"), (F.col("npa_ratio") - F.lag("npa_ratio").over(w)).alias("npa_change"),
        "total_provisions", "car_ratio", _trend("npa_ratio", w, "DETERIORATING", "IMPROVING").alias("npa_trend"), _trend("car_ratio", w, "IMPROVING", "DETERIORATING").alias("car_trend"),
    )


def npa_trend(monthly: DataFrame) -> DataFrame:
    w = Window.orderBy("report_month")  # one row per month, no gaps
    r = F.col("npa_ratio")
    return monthly.select(
        "report_month", "npa_amount", "npa_ratio", F.lag(r).over(w).alias("prev_month_npa_ratio"), (r - F.lag(r).over(w)).alias("mom_npa_change"), F.lag("npa_amount").over(w).alias("prev_month_npa_amount"),
        F.lag(r, 12).over(w).alias("yoy_npa_ratio"), (r - F.lag(r, 12).over(w)).alias("yoy_npa_change"), _trend("npa_ratio", w, "DETERIORATING", "IMPROVING").alias("trend"),
        F.when(r <= 2, "GREEN").when(r <= 3, "YELLOW").when(r <= 5, "ORANGE").otherwise("RED").alias("traffic_light"),
    )


def npa_forecast(monthly: DataFrame, status: DataFrame, months: int = 6) -> DataFrame:
    """Latest ratio plus three times the mean monthly change of the last months."""
    w = Window.orderBy("report_month")
    rows = monthly.orderBy(F.desc("report_month")).limit(months).select("report_month", "npa_ratio", (F.col("npa_ratio") - F.lag("npa_ratio").over(w)).alias("d"))
    s = rows.agg((F.sum(F.col("npa_ratio").cast("decimal(28,10)")).cast("double") / F.count("*")).alias("moving_avg"), (F.sum(F.col("d").cast("decimal(28,10)")).cast("double") / F.count("d")).alias("avg_monthly_change"), F.max_by("npa_ratio", "report_month").alias("_last"))
    out = one_row(status.select(F.col("npa_ratio").alias("current_npa")), s)
    c = F.col("current_npa")
    return out.select(
        "current_npa", "moving_avg", "avg_monthly_change", (F.col("_last") + F.col("avg_monthly_change") * 3).alias("forecast_3m"), F.when(c > 5, "HIGH").when(c > 3, "MEDIUM").otherwise("LOW").alias("current_risk_level"),
        F.when(c > 5, "URGENT: Increase provisions, tighten lending criteria").when(c > 3, "CAUTION: Monitor closely, review high-risk accounts").otherwise("NORMAL: Continue standard monitoring").alias("recommendation"),
    )


def top_npa(dash: DataFrame, n: int) -> DataFrame:
    d, c = F.col("estimated_dpd"), F.col("risk_classification")
    rows = dash.filter((F.col("loan_status") == "ACTIVE") & c.isin(*NON_PERFORMING))
    prio = F.when(d > 180, "P1_LEGAL_ACTION").when(d > 90, "P2_RECOVERY").when(d > 60, "P3_RESTRUCTURE").otherwise("P4_FOLLOWUP")
    out = rows.select("loan_id", "customer_id", "customer_name", "loan_type", "principal_outstanding", "estimated_dpd", "risk_classification", prio.alias("recovery_priority"), (X.dbl("principal_outstanding") * _map(c, PROVISION_RATES, 0.01)).alias("potential_provision"), "days_since_last_payment")
    return out.orderBy(F.desc("estimated_dpd"), F.desc("principal_outstanding"), "loan_id").limit(n)


def npa_by_dpd(loans: DataFrame, last_payment: DataFrame, as_of: str) -> DataFrame:
    days = F.datediff(_day(as_of), "last_payment")
    cls = F.when(days > 180, "Loss").when(days > 90, "Doubtful").when(days > 60, "Substandard").when(days > 30, "Special Mention").otherwise("Standard")
    return loans.join(last_payment, "loan_id", "left").groupBy(cls.alias("classification")).agg(F.count("*").alias("loan_count"), X.dsum("principal_outstanding").alias("total_outstanding"))


def credit_mart(loans: DataFrame) -> DataFrame:
    s = F.col("loan_status")
    return loans.groupBy(F.col("loan_type_standardized").alias("loan_type")).agg(
        F.count("*").alias("total_loans"), X.dsum("principal_amount").alias("total_disbursed"), X.dsum("principal_outstanding").alias("total_outstanding"), F.count_if(s == "ACTIVE").alias("active_loans"), F.count_if(s == "MATURED").alias("matured_loans"),
        X.davg("interest_rate").alias("avg_interest_rate"), X.dsum("emi_amount").alias("total_monthly_emi"), X.davg("emi_amount").alias("avg_emi"), X.pct(X.sum_if(s == "MATURED", "principal_outstanding"), F.sum("principal_outstanding")).alias("npa_ratio"),
    )


# --- capital ------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Capital:
    paid_up: float
    premium: float
    additional_tier1: float
    subordinated_debt: float
    general_provisions: float
    deductions: float = 0.0
    revaluation: float = 0.0


def rwa(loans: DataFrame, cards: DataFrame, transactions: DataFrame, since: str) -> DataFrame:
    """Risk-weighted exposures: credit by loan type, market, operational."""
    t = F.col("loan_type_standardized")
    credit = loans.filter("loan_status = 'ACTIVE'").groupBy(t.alias("sub_category")).agg(X.dsum("principal_outstanding").alias("exposure")).withColumn("risk_weight", _map(F.col("sub_category"), RISK_WEIGHTS, 1.0)).withColumn("risk_category", F.lit("CREDIT_RISK"))
    market = cards.filter("status = 'ACTIVE'").agg(X.dsum(F.col("card_limit") - F.col("credit_used")).alias("exposure")).withColumns({"sub_category": F.lit("TRADING_BOOK"), "risk_weight": F.lit(0.08), "risk_category": F.lit("MARKET_RISK")})
    oper = transactions.filter((F.col("txn_date") >= _day(since)) & (F.col("txn_type_standardized") == "DEBIT")).agg(X.dsum("amount").alias("exposure")).withColumns({"sub_category": F.lit("OPERATIONAL"), "risk_weight": F.lit(0.15), "risk_category": F.lit("OPERATIONAL_RISK")})
    out = credit.unionByName(market).unionByName(oper)
    return out.withColumn("risk_weighted_exposure", F.col("exposure") * F.col("risk_weight"))


def capital_tiers(p: Capital, income: DataFrame) -> DataFrame:
    """``income`` is one row ``income``: the retained earnings of the year."""
    row = lambda name, v: F.struct(F.lit(name).alias("tier"), v.cast("double").alias("amount"))
    cet1 = F.lit(p.paid_up) + F.lit(p.premium) + F.coalesce("income", F.lit(0.0)) - F.lit(p.deductions)
    return income.select(F.inline(F.array(row("TIER1_COMMON", cet1), row("TIER1_ADDITIONAL", F.lit(p.additional_tier1)), row("TIER2", F.lit(p.subordinated_debt + p.general_provisions + p.revaluation)))))


def capital_ratios(tiers: DataFrame, weighted: DataFrame) -> DataFrame:
    t = F.col("tier")
    exact = F.col("amount").cast("decimal(28,4)")
    c = tiers.agg(X.sum_if(t == "TIER1_COMMON", exact).alias("cet1_capital"), X.sum_if(t != "TIER2", exact).alias("tier1_capital"), X.dsum(exact).alias("total_capital"))
    out = one_row(c, weighted.agg(X.dsum(F.col("risk_weighted_exposure").cast("decimal(28,4)")).alias("total_rwa")))
    names = {"cet1": "cet1_capital", "tier1": "tier1_capital", "car": "total_capital"}
    out = out.withColumns({f"{k}_ratio": X.pct(v, "total_rwa") for k, v in names.items()})
    out = out.withColumns({f"{k}_surplus": F.col(v) - F.col("total_rwa") * (MINIMUM[k] / 100.0) for k, v in names.items()})
    ok = (F.col("cet1_ratio") >= MINIMUM["cet1"]) & (F.col("tier1_ratio") >= MINIMUM["tier1"]) & (F.col("car_ratio") >= MINIMUM["car"])
    return out.withColumn("compliance_status", F.when(ok, "COMPLIANT").otherwise("NON_COMPLIANT"))


def _loan_types(loans: DataFrame) -> DataFrame:
    few = loans.select("customer_id", "loan_type_standardized").distinct()
    return few.groupBy("customer_id").agg(F.array_join(F.sort_array(F.collect_list("loan_type_standardized")), ", ").alias("loan_types"))


def large_exposures(loans: DataFrame, customers: DataFrame, warn: Column, limit: Column) -> DataFrame:
    """Borrowers above ``warn``; ``limit`` is the single-borrower maximum."""
    active = loans.filter("loan_status = 'ACTIVE'")
    per = active.groupBy("customer_id").agg(X.dsum("principal_outstanding").alias("total_exposure"), F.count("*").alias("loan_count"))
    big = per.withColumns({"_w": warn, "single_borrower_limit": limit}).filter(F.col("total_exposure") > F.col("_w")).drop("_w")
    state = F.when(F.col("total_exposure") > F.col("single_borrower_limit"), "EXCEEDS_LIMIT").otherwise("WARNING")
    types = _loan_types(active.join(big.select("customer_id"), "customer_id", "left_semi"))
    return big.join(types, "customer_id").join(customers.select("customer_id", "customer_name"), "customer_id").withColumns({"exposure_status": state, "pct_of_limit": X.pct("total_exposure", "single_borrower_limit")})


# --- call report ------------------------------------------------------------------------------------------------------
def balance_sheet(accounts: DataFrame, loans: DataFrame, cards: DataFrame, equity: float) -> DataFrame:
    """One conditional aggregate per source table."""
    t, l = F.col("account_type_standardized"), F.col("loan_type_standardized")
    a = accounts.filter("status_standardized = 'ACTIVE'").agg(X.sum_if(t == "SAVINGS", "current_balance").alias("customer_deposits_savings"), X.sum_if(t == "CURRENT", "current_balance").alias("customer_deposits_current"), X.dsum("current_balance").alias("total_liabilities"))
    names = {"home_loans": "HOME_LOAN", "personal_loans": "PERSONAL_LOAN", "car_loans": "CAR_LOAN", "business_loans": "BUSINESS_LOAN"}
    b = loans.filter("loan_status = 'ACTIVE'").agg(*[X.sum_if(l == v, "principal_outstanding").alias(k) for k, v in names.items()], X.dsum("principal_outstanding").alias("total_loans"))
    k = cards.filter("status = 'ACTIVE'").agg(X.dsum("card_limit").alias("credit_card_limits"))
    out = one_row(a, b, k)
    return out.withColumns({"total_assets": F.col("total_liabilities") + F.col("total_loans"), "total_equity": F.lit(equity).cast("double")})


def asset_quality(dash: DataFrame) -> DataFrame:
    """Bands by the days past due, counted from the first day; a loan never paid late or never paid is standard."""
    d = F.coalesce(F.greatest("days_since_last_payment", F.lit(0)), F.lit(0))
    out = dash.filter("loan_status = 'ACTIVE'").agg(
        X.dsum("principal_outstanding").alias("portfolio"), X.sum_if(d == 0, "principal_outstanding").alias("standard_loans"), X.sum_if(d.between(1, 30), "principal_outstanding").alias("special_mention"),
        X.sum_if(d.between(31, 60), "principal_outstanding").alias("sub_standard"), X.sum_if(d.between(61, 90), "principal_outstanding").alias("doubtful"), X.sum_if(d > 90, "principal_outstanding").alias("loss"),
    )
    return out.withColumns({"npl_ratio": X.pct("loss", "portfolio"), "provision_coverage_ratio": X.pct(F.col("loss") * 0.15, "loss")})


def liquidity(accounts: DataFrame) -> DataFrame:
    a = accounts.filter("status_standardized = 'ACTIVE'").agg(X.dsum("current_balance").alias("total_deposits"), X.dsum("available_balance").alias("liquid_assets"), X.sum_if(F.col("account_type_standardized") == "SAVINGS", "current_balance").alias("_s"))
    out = a.withColumn("lcr_ratio", X.pct("liquid_assets", "_s")).drop("_s")
    return out.withColumn("lcr_compliance", F.when(F.col("lcr_ratio") >= 100, "COMPLIANT").otherwise("NON_COMPLIANT"))


def call_report(sheet: DataFrame, capital: DataFrame, quality: DataFrame, liquid: DataFrame) -> DataFrame:
    return one_row(sheet, capital, quality, liquid)


def call_report_checks(sheet: DataFrame, capital: DataFrame, quality: DataFrame) -> DataFrame:
    """Balance, capital and quality checks as PASS, WARNING or FAIL."""
    r = one_row(sheet.select("total_assets", "total_liabilities", "total_equity"), capital.select("car_ratio"), quality.select("npl_ratio"))
    gap = F.col("total_assets") - F.col("total_liabilities") - F.col("total_equity")
    row = lambda name, res, v: F.struct(F.lit(name).alias("validation"), res.alias("result"), v.alias("value"))
    npl = F.col("npl_ratio")
    return r.select(F.inline(F.array(
        row("Balance Sheet Check", F.when(gap == 0, "PASS").otherwise("FAIL"), gap), row("Capital Ratio Check", F.when(F.col("car_ratio") >= 8, "PASS").otherwise("FAIL"), F.col("car_ratio")),
        row("NPL Ratio Check", F.when(npl <= 3, "PASS").when(npl <= 5, "WARNING").otherwise("FAIL"), npl),
    )))


# --- executive --------------------------------------------------------------------------------------------------------
def ceo_dashboard(accounts: DataFrame, dash: DataFrame, customers: DataFrame, transactions: DataFrame, capital: DataFrame, fraud_alerts: DataFrame, aml_alerts: DataFrame, as_of: str, since: str) -> DataFrame:
    """The KPI row: one pass per source table.

    ``fraud_alerts`` and ``aml_alerts`` are the alert rows to count. Retention relates
    customers with recent activity to customers of more than a month.
    """
    t = F.col("account_type_standardized")
    a = accounts.filter("status_standardized = 'ACTIVE'").agg(X.dsum("current_balance").alias("total_deposits"), X.dsum("available_balance").alias("_av"), X.sum_if(t == "SAVINGS", "current_balance").alias("_sav"), X.sum_if(t.isin("SAVINGS", "CURRENT"), "current_balance").alias("_cost"))
    l = dash.filter("loan_status = 'ACTIVE'").agg(X.dsum("principal_outstanding").alias("total_loans"), X.dsum(F.col("principal_outstanding") * F.col("interest_rate")).alias("_int"), X.sum_if(F.col("estimated_dpd") > 90, "principal_outstanding").alias("_npl"))
    c = customers.agg(F.count("*").alias("total_customers"), F.count_if(F.col("created_date") >= _day(since)).alias("new_customers_30d"), F.count_if(F.col("created_date") <= _day(since)).alias("_old"))
    dig = F.col("channel_standardized").isin("MOBILE", "ONLINE")
    per = transactions.filter(F.col("txn_date") >= _day(since)).groupBy("account_id").agg(F.count("*").alias("n"), F.sum("amount").alias("v"), F.count_if(dig).alias("d"))
    owner = accounts.select(F.col("account_id").alias("_a"), "customer_id")
    x = per.join(owner, F.col("account_id") == F.col("_a"), "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("txn_volume_30d"), X.dsum("v").alias("txn_value_30d"), F.coalesce(F.sum("d"), F.lit(0)).alias("_dig"), F.countDistinct("customer_id").alias("active_customers_30d"))
    cap = capital.select("cet1_ratio", "tier1_ratio", "car_ratio", F.col("compliance_status").alias("basel_compliance"))
    r = one_row(a, l, c, x, cap, fraud_alerts.agg(F.count("*").alias("fraud_alerts_24h")), aml_alerts.agg(F.count("*").alias("aml_alerts")))
    income = F.col("_int") / 100.0
    assets = F.col("total_deposits") + F.col("total_loans")
    return r.select(
        F.lit(as_of).alias("report_date"), assets.alias("total_assets"), "total_deposits", "total_loans", X.pct(income - F.col("_cost") * 0.02, "total_deposits").alias("net_interest_margin_pct"), X.pct(income * 0.3, assets).alias("return_on_assets_pct"),
        X.pct("_npl", "total_loans").alias("npl_ratio"), X.pct(F.col("_npl") * 0.5, "_npl").alias("provision_coverage_ratio"), "cet1_ratio", "tier1_ratio", "car_ratio", X.pct("_av", "_sav").alias("lcr_ratio"), "total_customers", "new_customers_30d", "active_customers_30d",
        X.pct("active_customers_30d", "_old").alias("customer_retention_pct"), X.pct("_dig", "txn_volume_30d").alias("digital_txn_pct"), "txn_volume_30d", "txn_value_30d", "fraud_alerts_24h", "aml_alerts", "basel_compliance",
        F.when(F.col("car_ratio") > 10, "STRONG").when(F.col("car_ratio") > 8, "ADEQUATE").otherwise("WEAK").alias("car_status"),
    )


def shown(c: Column | str) -> Column:
    """A percentage for a text: two digits."""
    return F.format_string("%.2f%%", F.col(c) if isinstance(c, str) else c)


def strategic_alerts(kpi: DataFrame, prev_npl: Column) -> DataFrame:
    f, g, car, dig = F.col("fraud_alerts_24h"), F.col("new_customers_30d"), F.col("car_ratio"), F.col("digital_txn_pct")
    k = kpi.withColumn("_prev", prev_npl)
    return k.select(
        F.when(F.col("npl_ratio") < F.col("_prev"), F.lit("NPL ratio improved")).alias("alert_npl_improvement"),
        F.when(dig > 70, F.lit("Digital adoption target met")).otherwise(F.lit("Digital adoption below target (target: 70%)")).alias("alert_digital_adoption"),
        F.when(car > 10, F.lit("CAR strong")).when(car > 8, F.lit("CAR adequate")).otherwise(F.lit("CAR weak - ACTION REQUIRED")).alias("alert_capital_adequacy"),
        F.when(f > 10, F.concat(F.lit("High fraud activity: "), f.cast("string"), F.lit(" alerts in 24h"))).when(f > 5, F.concat(F.lit("Elevated fraud activity: "), f.cast("string"), F.lit(" alerts in 24h"))).otherwise("Fraud activity normal").alias("alert_fraud_activity"),
        F.concat(F.when(g > 1000, "Strong").when(g > 500, "Moderate").otherwise("Low"), F.lit(" customer growth: "), g.cast("string"), F.lit(" new customers")).alias("alert_customer_growth"),
        F.when(F.col("basel_compliance") == "COMPLIANT", "Basel III compliant").otherwise("Basel III NON-COMPLIANT - URGENT ACTION REQUIRED").alias("alert_compliance"),
    )


def board_rows(kpi: DataFrame) -> DataFrame:
    """KPIs as (section, metric, value, target, status) rows."""
    spec = [("FINANCIAL HIGHLIGHTS", "Total Assets", "total_assets", "Target: Grow 15% YoY", F.col("total_assets") > 0), ("FINANCIAL HIGHLIGHTS", "Net Interest Margin", "net_interest_margin_pct", "Target: > 2.5%", F.col("net_interest_margin_pct") > 2.5), ("ASSET QUALITY", "NPL Ratio", "npl_ratio", "Target: < 3%", F.col("npl_ratio") < 3), ("CAPITAL ADEQUACY", "CAR", "car_ratio", "Target: > 10%", F.col("car_ratio") > 10), ("DIGITAL TRANSFORMATION", "Digital Transaction %", "digital_txn_pct", "Target: > 70%", F.col("digital_txn_pct") > 70), ("CUSTOMER METRICS", "Customer Retention", "customer_retention_pct", "Target: > 90%", F.col("customer_retention_pct") > 90)]
    rows = [F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), X.dbl(v).alias("value"), F.lit(t).alias("target"), F.when(ok, "ON_TRACK").otherwise("BEHIND").alias("status")) for s, m, v, t, ok in spec]
    return kpi.select(F.inline(F.array(*rows)))


def monthly_kpis(transactions: DataFrame, monthly: DataFrame, capital: float) -> DataFrame:
    """Transaction value and portfolio ratios per month with changes on month and year."""
    v = transactions.groupBy(F.trunc("txn_date", "month").alias("report_month")).agg(X.dsum("amount").alias("monthly_txn_value"))
    m = monthly.join(v, "report_month", "left").withColumn("car_ratio", X.pct(F.lit(capital), "rwa"))
    w = Window.orderBy("report_month")  # one row per month
    d = lambda c, n=1: F.col(c) - F.lag(c, n).over(w)
    return m.select("report_month", "monthly_txn_value", F.col("npa_ratio").alias("avg_npl_ratio"), F.col("car_ratio").alias("avg_car_ratio"), d("monthly_txn_value").alias("mom_txn_change"), d("npa_ratio").alias("mom_npl_change"), d("car_ratio").alias("mom_car_change"), d("monthly_txn_value", 12).alias("yoy_txn_change"), d("npa_ratio", 12).alias("yoy_npl_change"))


def monthly_pnl(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Interest and fee income per month; each fact is summed by month before they meet."""
    t, d = F.col("loan_type"), F.col("interest_amount").cast("decimal(28,6)")
    names = {"home_loan_interest": "HOME_LOAN", "personal_loan_interest": "PERSONAL_LOAN", "car_loan_interest": "CAR_LOAN", "business_loan_interest": "BUSINESS_LOAN"}
    i = payments.groupBy(F.floor(F.col("date_key") / 100).alias("month_key")).agg(*[X.sum_if(t == v, d).alias(k) for k, v in names.items()], X.dsum(d).alias("total_interest_income"))
    fee = F.col("description").contains("FEE")
    x = transactions.groupBy((F.year("txn_date") * 100 + F.month("txn_date")).cast("bigint").alias("month_key")).agg(X.sum_if(fee, "amount").alias("total_fee_income"), F.count("*").alias("total_transactions"), X.dsum("amount").alias("total_transaction_volume"))
    return x.join(i, "month_key", "left").fillna(0.0).withColumn("total_revenue", F.col("total_interest_income") + F.col("total_fee_income"))


def regional_pnl(loans: DataFrame, transactions: DataFrame, accounts: DataFrame, branches: DataFrame) -> DataFrame:
    """Per branch; a customer's loans count once for a branch, however many accounts they have there."""
    home = accounts.select("customer_id", "account_id", "branch_code")
    l = loans.filter("loan_status = 'ACTIVE'").groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("principal_outstanding").alias("p"), F.sum(F.col("principal_outstanding") * F.col("interest_rate")).alias("i")).join(home.select("customer_id", "branch_code").distinct(), "customer_id").groupBy("branch_code").agg(F.sum("n").alias("active_loans"), X.dsum("p").alias("loan_portfolio"), (X.dsum("i") / 100.0).alias("interest_income"))
    t = transactions.groupBy("account_id").agg(F.count("*").alias("n"), F.sum("amount").alias("a")).join(home, "account_id").groupBy("branch_code").agg(F.sum("n").alias("transaction_count"), X.dsum("a").alias("transaction_volume"))
    return branches.join(l, "branch_code", "left").join(t, "branch_code", "left").fillna(0).select("region", "branch_name", "interest_income", "transaction_count", "transaction_volume", "active_loans", "loan_portfolio")
