"""Card-transaction analytics over one wide transaction table.

Money limits are parameters (``scale`` multiplies the published ones) and every report
that lists the top rows orders by a unique key last, so it is repeatable. Multipliers,
weights and rates are fixed values of the reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import skew

AMOUNT = "transaction_amount"
BASEL_WEIGHTS = {("CRYPTOCURRENCY", "GAMBLING"): 1.5, ("ELECTRONICS", "TRAVEL"): 1.0, ("GROCERY", "FOOD"): 0.5, ("UTILITIES", "EDUCATION"): 0.2}
REWARDS = {("ELECTRONICS", "ONLINE_SHOPPING"): 2.0, ("TRAVEL", "ENTERTAINMENT"): 1.5, ("FOOD", "GROCERY"): 1.0, ("FUEL",): 0.5}
RISK_ZONES = {("CRYPTOCURRENCY", "GAMBLING"): "HIGH_RISK", ("TRAVEL", "ELECTRONICS"): "MEDIUM_RISK", ("FOOD", "GROCERY", "UTILITIES"): "LOW_RISK"}
SPENDING = {("ELECTRONICS", "ONLINE_SHOPPING"): "ONLINE", ("FOOD", "GROCERY"): "ESSENTIALS", ("TRAVEL", "ENTERTAINMENT"): "LIFESTYLE", ("HEALTHCARE", "EDUCATION"): "SERVICES"}


def _groups(c: str, values: dict, default) -> Column:
    out = None
    for names, v in values.items():
        hit = F.col(c).isin(*names)
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out.otherwise(F.lit(default))


def _cases(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    out = None
    for cond, label in cases:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def _posted(t: DataFrame) -> DataFrame:
    return t.filter(F.col("status") == "POSTED")


def _day() -> Column:
    return F.col("transaction_date").cast("date")


def _base() -> list[Column]:
    return [F.count("*").alias("transaction_count"), X.dsum(AMOUNT).alias("total_amount"), X.davg(AMOUNT).alias("avg_amount")]


DECLINED = F.count_if
C = F.col


def velocity(t: DataFrame, many: int, some: int, merchants: int, amount: float, at_least: int, at_amount: float, n: int) -> DataFrame:
    """Busy hours per card."""
    h = _posted(t).groupBy("card_id", "customer_id", _day().alias("txn_date"), F.hour("transaction_date").alias("txn_hour")).agg(
        F.count("*").alias("hourly_count"), X.dsum(AMOUNT).alias("hourly_amount"), F.countDistinct("merchant_name").alias("unique_merchants"), F.countDistinct("merchant_category").alias("unique_categories")
    )
    tests = [C("hourly_count") > many, (C("hourly_count") > some) & (C("unique_merchants") > merchants), C("hourly_amount") > amount]
    out = h.filter((C("hourly_count") > at_least) | (C("hourly_amount") > at_amount)).withColumns({
        "fraud_risk_level": _cases(list(zip(tests, ["CRITICAL_VELOCITY", "SUSPICIOUS_PATTERN", "HIGH_VALUE_VELOCITY"], strict=True)), "NORMAL"),
        "recommended_action": _cases(list(zip(tests, ["BLOCK_CARD", "REVIEW_TRANSACTION", "FLAG_FOR_ANALYSIS"], strict=True)), "MONITOR"),
    })
    return out.orderBy(F.desc("hourly_amount"), F.desc("hourly_count"), "card_id", "txn_date", "txn_hour").limit(n)


def impossible_travel(t: DataFrame, n: int) -> DataFrame:
    """Consecutive transactions of a card at different merchants within an hour."""
    cols = ["transaction_id", "card_id", "customer_id", "merchant_name", AMOUNT, "transaction_date"]
    p = skew.neighbours(_posted(t).select(*cols), "card_id", ["transaction_date", "transaction_id"], previous={"transaction_date": "prev_txn_date", "merchant_name": "prev_merchant"})
    p = p.withColumn("minutes_between", X.minutes_between("prev_txn_date", "transaction_date"))
    m = C("minutes_between")
    out = p.filter((m < 60) & (C("merchant_name") != C("prev_merchant"))).withColumn("fraud_indicator", F.when(m < 30, "IMPOSSIBLE_TRAVEL").when(m < 5, "TOO_RAPID").otherwise("NORMAL"))
    return out.orderBy("minutes_between", "transaction_id").limit(n)


def card_testing(t: DataFrame, small: float, steps: Sequence[tuple[int, int]], at_least: int, n: int) -> DataFrame:
    """Days on which a card made many small purchases; ``steps`` are (count, merchants) from strict to lax."""
    d = _posted(t).filter((C(AMOUNT) < small) & (C("transaction_type") == "PURCHASE")).groupBy("card_id", "customer_id", _day().alias("txn_date")).agg(
        F.count("*").alias("small_txn_count"), X.dsum(AMOUNT).alias("total_small_amount"), F.countDistinct("merchant_name").alias("unique_merchants"), F.min(AMOUNT).alias("min_amount"), F.max(AMOUNT).alias("max_amount"), X.davg(AMOUNT).alias("avg_amount")
    )
    tests = [(C("small_txn_count") >= a) & (C("unique_merchants") >= m) for a, m in steps]
    out = d.filter(C("small_txn_count") >= at_least).withColumns({
        "risk_level": _cases(list(zip(tests, ["CONFIRMED_CARD_TESTING", "PROBABLE_CARD_TESTING", "SUSPICIOUS_PATTERN"], strict=True)), "MONITOR"),
        "recommended_action": _cases(list(zip(tests, ["BLOCK_CARD_IMMEDIATELY", "HOLD_NEXT_TRANSACTION", "SEND_ALERT_TO_CUSTOMER"], strict=True)), "LOG_FOR_REVIEW"),
    })
    return out.orderBy(F.desc("small_txn_count"), F.desc("unique_merchants"), "card_id", "txn_date").limit(n)


def customer_overview(t: DataFrame, scale: float, usage: Sequence[tuple[int, str]], n: int) -> DataFrame:
    s = t.groupBy("customer_id").agg(F.count("*").alias("total_transactions"), X.dsum(AMOUNT).alias("total_spend"), X.davg(AMOUNT).alias("avg_transaction"), F.countDistinct("merchant_category").alias("categories_used"))
    tier = X.band(C("total_spend"), [(1000000 * scale, "PLATINUM"), (500000 * scale, "GOLD"), (100000 * scale, "SILVER"), (10000 * scale, "BRONZE")], "NEW")
    s = s.withColumns({"customer_tier": tier, "usage_pattern": X.band(C("total_transactions"), usage, "NEW_USER")})
    out = s.withColumns({
        "service_level": _cases([(C("customer_tier") == "PLATINUM", "VIP_SERVICE"), (C("customer_tier") == "GOLD", "PRIORITY_SERVICE"), (C("usage_pattern") == "NEW_USER", "WELCOME_PROGRAM")], "STANDARD_SERVICE"),
        "marketing_action": _cases([((C("total_spend") > 500000 * scale) & (C("categories_used") > 4), "CROSS_SELL_OPPORTUNITY"), (C("customer_tier") == "PLATINUM", "RETENTION_PRIORITY")], "STANDARD"),
    })
    return out.orderBy(F.desc("total_spend"), "customer_id").limit(n)


def lifetime_value(t: DataFrame, scale: float, engaged: Sequence[tuple[int, str]], n: int) -> DataFrame:
    m = _posted(t).groupBy("customer_id").agg(F.count("*").alias("total_transactions"), X.dsum(AMOUNT).alias("total_revenue"), F.countDistinct(_day()).alias("active_days"), F.datediff(F.max(_day()), F.min(_day())).alias("customer_tenure_days"), F.countDistinct("merchant_category").alias("category_diversity"))
    out = m.withColumns({
        "estimated_annual_value": C("total_revenue") * 0.1, "estimated_3yr_value": C("total_revenue") * 0.1 * 3.0, "engagement_score": (C("total_transactions") * 3 + C("active_days") * 4 + C("category_diversity") * 3) / 10.0,
        "value_segment": X.band(C("total_revenue"), [(500000 * scale, "HIGH_VALUE"), (100000 * scale, "MEDIUM_VALUE"), (10000 * scale, "LOW_VALUE")], "PROSPECT"), "engagement_segment": X.band(C("active_days"), engaged, "AT_RISK"),
    })
    return out.orderBy(F.desc("total_revenue"), "customer_id").limit(n)


def basel_by_category(t: DataFrame) -> DataFrame:
    g = _posted(t).groupBy("merchant_category", "transaction_type").agg(*_base()).withColumn("risk_weight", _groups("merchant_category", BASEL_WEIGHTS, 0.75))
    w, a = C("risk_weight"), C("total_amount")
    return g.withColumns({
        "risk_weighted_asset": a * w, "minimum_capital": a * w * 0.08, "provision_required": F.when(w > 1, a * 0.15).when(w > 0.75, a * 0.10).otherwise(a * 0.05),
        "compliance_status": F.when(w > 1.5, "HIGH_RISK_REVIEW").when(w > 1, "ELEVATED_RISK").otherwise("STANDARD_RISK"),
    })


def inactivity_classes(t: DataFrame, as_of: str, steps: Sequence[tuple[int, str, float]], n: int) -> DataFrame:
    """Customers by days since the last transaction; ``steps`` are (days, class, rate) from long to short."""
    s = t.groupBy("customer_id").agg(F.count("*").alias("total_transactions"), X.dsum(AMOUNT).alias("total_spend"), F.datediff(F.lit(as_of).cast("date"), F.max(_day())).alias("days_since_last_txn"), F.count_if(C("status") == "DECLINED").alias("declined_count"))
    d, cls, rate = C("days_since_last_txn"), None, None
    for limit, name, r in steps:
        cls = F.when(d > limit, name) if cls is None else cls.when(d > limit, name)
        rate = F.when(d > limit, F.lit(r)) if rate is None else rate.when(d > limit, F.lit(r))
    out = s.withColumns({"decline_rate": X.pct("declined_count", "total_transactions"), "npa_classification": cls.otherwise("STANDARD"), "provision_rate": rate.otherwise(0.004)})
    return out.withColumn("estimated_provision", C("total_spend") * C("provision_rate")).filter(d > steps[-1][0]).orderBy(F.desc("days_since_last_txn"), "customer_id").limit(n)


def structuring(t: DataFrame, near: tuple[float, float], p: dict, n: int) -> DataFrame:
    """Card days with amounts just below the limit, high velocity or high value."""
    d = _posted(t).groupBy("card_id", "customer_id", _day().alias("txn_date")).agg(F.count("*").alias("daily_count"), X.dsum(AMOUNT).alias("daily_amount"), X.davg(AMOUNT).alias("avg_amount"), F.count_if(C(AMOUNT).between(*near)).alias("near_threshold_count"))
    a, k, c = C("daily_amount"), C("near_threshold_count"), C("daily_count")
    tests = [k >= p["near"], (c > p["count"]) & (a > p["volume"]), a > p["high"]]
    out = d.filter((k >= p["near"] - 1) | ((c > p["count"]) & (a > p["volume"] / 2)) | (a > p["high"] * 0.6)).withColumns({
        "aml_risk_flag": _cases(list(zip(tests, ["STRUCTURING_SUSPECTED", "VELOCITY_LAUNDERING", "HIGH_VALUE_ALERT"], strict=True)), "NORMAL"),
        "recommended_action": _cases(list(zip(tests, ["FILE_SAR", "ENHANCED_DUE_DILIGENCE", "MANUAL_REVIEW"], strict=True)), "MONITOR"),
        "suspicious_amount": F.when(tests[0], a * 0.3).when(tests[1], a * 0.2).otherwise(0.0),
    })
    return out.orderBy(F.desc("suspicious_amount"), F.desc("daily_amount"), "card_id", "txn_date").limit(n)


def merchant_performance(t: DataFrame, scale: float, at_least: int, n: int) -> DataFrame:
    s = C("status")
    m = t.groupBy("merchant_category", "merchant_name").agg(*_base(), F.countDistinct("card_id").alias("unique_customers"), F.count_if(s == "POSTED").alias("successful_count"), F.count_if(s == "DECLINED").alias("declined_count"), X.pct(F.count_if(s == "DECLINED"), F.count("*")).alias("decline_rate"))
    tier = X.band(C("total_amount"), [(1000000 * scale, "PLATINUM_MERCHANT"), (500000 * scale, "GOLD_MERCHANT"), (100000 * scale, "SILVER_MERCHANT")], "BRONZE_MERCHANT")
    return m.filter(C("transaction_count") >= at_least).withColumn("merchant_tier", tier).orderBy(F.desc("total_amount"), "merchant_category", "merchant_name").limit(n)


def settlement(t: DataFrame) -> DataFrame:
    k, s = C("transaction_type"), C("status")
    m = t.groupBy("merchant_category", _day().alias("txn_date")).agg(F.count("*").alias("transaction_count"), X.dsum(AMOUNT).alias("gross_amount"), X.sum_if(k == "PURCHASE", AMOUNT).alias("purchase_amount"), X.sum_if(k == "PAYMENT", AMOUNT).alias("payment_amount"), F.count_if(s == "POSTED").alias("settled_count"), F.count_if(s == "DECLINED").alias("declined_count"))
    r = C("settlement_rate")
    return m.withColumns({"settlement_rate": X.pct("settled_count", "transaction_count"), "net_settlement": C("purchase_amount") - C("payment_amount")}).withColumn("settlement_status", F.when(r > 99, "FULLY_SETTLED").when(r > 95, "MOSTLY_SETTLED").when(r > 90, "PARTIALLY_SETTLED").otherwise("SETTLEMENT_ISSUES"))


def loan_risk(t: DataFrame, large: float, declines: int) -> DataFrame:
    m = t.groupBy("customer_id").agg(F.count("*").alias("total_transactions"), X.dsum(AMOUNT).alias("total_spend"), X.davg(AMOUNT).alias("avg_spend"), X.dstd(AMOUNT).alias("spend_volatility"), F.count_if(C(AMOUNT) > large).alias("large_transactions"), F.count_if(C("status") == "DECLINED").alias("declined_count"), X.sum_if(C("transaction_type") == "PAYMENT", AMOUNT).alias("estimated_income"))
    tests = [C("spend_volatility") > C("avg_spend") * 2, C("declined_count") > declines, C("total_spend") > C("estimated_income") * 3]
    return m.withColumns({
        "dti_ratio": X.ratio("total_spend", "estimated_income"), "loan_risk_score": _cases(list(zip(tests, ["HIGH_RISK", "ELEVATED_RISK", "OVEREXTENDED"], strict=True)), "LOW_RISK"),
        "recommended_action": _cases(list(zip(tests, ["REQUIRE_ADDITIONAL_DOC", "MANUAL_UNDERWRITING", "REDUCE_LOAN_AMOUNT"], strict=True)), "STANDARD_APPROVAL"),
    })


def repayment(t: DataFrame, n: int) -> DataFrame:
    k = C("transaction_type")
    d = t.groupBy("customer_id", _day().alias("txn_date")).agg(F.sum(F.when(k == "PAYMENT", C(AMOUNT)).otherwise(0)).alias("p"), F.sum(F.when(k == "PURCHASE", C(AMOUNT)).otherwise(0)).alias("b"))
    m = d.groupBy("customer_id").agg(F.count("*").alias("active_days"), X.dsum("p").alias("total_payments"), X.dsum("b").alias("total_purchases"), F.count_if(C("p") > 0).alias("payment_days"))
    r = C("payment_consistency")
    out = m.withColumns({"payment_to_purchase_ratio": X.ratio("total_payments", "total_purchases"), "payment_consistency": X.pct("payment_days", "active_days")}).withColumns({
        "repayment_behavior": X.band(r, [(80, "EXCELLENT_PAYER"), (60, "GOOD_PAYER"), (40, "FAIR_PAYER"), (20, "POOR_PAYER")], "DELINQUENT"), "default_risk": X.band(r, [(80, "LOW_DEFAULT_RISK"), (60, "MODERATE_DEFAULT_RISK"), (40, "ELEVATED_DEFAULT_RISK")], "HIGH_DEFAULT_RISK"),
    })
    return out.orderBy(F.desc("payment_consistency"), "customer_id").limit(n)


def card_utilization(t: DataFrame, scale: float, n: int) -> DataFrame:
    k, h = C("transaction_type"), F.hour("transaction_date")
    m = _posted(t).groupBy("card_id", "customer_id").agg(*_base(), F.max(AMOUNT).alias("max_spend"), F.countDistinct("merchant_category").alias("categories_used"), F.countDistinct("merchant_name").alias("unique_merchants"), X.sum_if(k == "PURCHASE", AMOUNT).alias("total_purchases"), X.sum_if(k == "PAYMENT", AMOUNT).alias("total_payments"), F.count_if(h.between(9, 17)).alias("business_hours_count"), F.count_if(h >= 18).alias("evening_count"), F.count_if(h <= 8).alias("night_count"))
    tier = X.band(C("total_amount"), [(500000 * scale, "PREMIUM_CARD"), (100000 * scale, "GOLD_CARD"), (10000 * scale, "SILVER_CARD")], "BASIC_CARD")
    return m.withColumn("card_tier", tier).orderBy(F.desc("total_amount"), "card_id", "customer_id").limit(n)


def card_rewards(t: DataFrame, n: int) -> DataFrame:
    g = _posted(t).filter(C("transaction_type") == "PURCHASE").groupBy("card_id", "customer_id", "merchant_category").agg(X.dsum(AMOUNT).alias("category_spend"), F.count("*").alias("transaction_count"))
    g = g.withColumn("reward_multiplier", _groups("merchant_category", REWARDS, 1.0)).withColumn("points_earned", C("category_spend") * C("reward_multiplier") / 100.0)
    m = C("reward_multiplier")
    out = g.withColumns({"optimization_recommendation": _cases([(m < 1, "SWITCH_TO_BETTER_CARD"), (m >= 2, "MAXIMIZE_THIS_CATEGORY"), (C("transaction_count") > 10, "HIGH_FREQUENCY_BENEFIT")], "STANDARD_REWARDS"), "estimated_annual_points": C("points_earned") * 12.0})
    return out.orderBy(F.desc("points_earned"), "card_id", "merchant_category").limit(n)


def category_risk(t: DataFrame) -> DataFrame:
    g = t.groupBy("merchant_category").agg(F.count("*").alias("transaction_count"), X.dsum(AMOUNT).alias("total_volume"), X.davg(AMOUNT).alias("avg_amount"), F.countDistinct("card_id").alias("unique_cards"), F.count_if(C("status") == "DECLINED").alias("declined_count"))
    g = g.withColumn("risk_zone", _groups("merchant_category", RISK_ZONES, "STANDARD_RISK"))
    z, v, d = C("risk_zone"), C("total_volume"), C("declined_count")
    points = F.when(z == "HIGH_RISK", v * 0.3 + d * 1000.0).when(z == "MEDIUM_RISK", v * 0.15 + d * 500.0).otherwise(v * 0.05 + d * 100.0)
    return g.withColumns({"decline_rate": X.pct("declined_count", "transaction_count"), "volume_per_card": X.ratio("total_volume", "unique_cards"), "risk_score": X.ratio(points, "unique_cards"), "monitoring_level": F.when(z == "HIGH_RISK", "ENHANCED_MONITORING").when(z == "MEDIUM_RISK", "STANDARD_MONITORING").otherwise("BASIC_MONITORING")})


def daily_kpis(t: DataFrame, days: int) -> DataFrame:
    """Volume per day with change, growth, seven-day mean and trend; one row per day in the window."""
    s = C("status")
    d = t.groupBy(_day().alias("metric_date")).agg(F.count("*").alias("total_transactions"), X.dsum(AMOUNT).alias("total_volume"), F.countDistinct("card_id").alias("active_cards"), F.count_if(s == "POSTED").alias("successful_count"), F.count_if(s == "DECLINED").alias("declined_count"))
    w = Window.orderBy("metric_date")
    v, p, w7 = C("total_volume"), F.lag("total_volume").over(w), w.rowsBetween(-6, 0)
    out = d.withColumns({"success_rate": X.pct("successful_count", "total_transactions"), "volume_change": v - p, "volume_growth_pct": X.pct(v - p, p), "volume_7day_avg": F.sum(v.cast("decimal(28,2)")).over(w7).cast("double") / F.count(v).over(w7), "trend_indicator": F.when(v > p * 1.1, "GROWING").when(v < p * 0.9, "DECLINING").otherwise("STABLE")})
    return out.orderBy(F.desc("metric_date")).limit(days)


def hourly_monitor(t: DataFrame, large: float, n: int) -> DataFrame:
    """Each hour against the mean of the 24 hours before it; one row per hour in the window."""
    h = t.groupBy(_day().alias("txn_date"), F.hour("transaction_date").alias("txn_hour")).agg(F.count("*").alias("hourly_count"), X.dsum(AMOUNT).alias("hourly_volume"), F.countDistinct("card_id").alias("active_cards"), F.count_if(C("status") == "DECLINED").alias("declined_count"), F.count_if(C(AMOUNT) > large).alias("large_txn_count"))
    w = Window.orderBy("txn_date", "txn_hour").rowsBetween(-24, -1)
    mean = lambda c: F.sum(C(c).cast("decimal(28,2)")).over(w).cast("double") / F.nullif(F.count(c).over(w), F.lit(0))
    mv, mc = mean("hourly_volume"), mean("hourly_count")
    out = h.withColumns({"volume_vs_avg": X.ratio("hourly_volume", mv), "anomaly_status": F.when(C("hourly_count") > mc * 2, "SPIKE_DETECTED").when(C("hourly_count") < mc * 0.5, "DROP_DETECTED").otherwise("NORMAL"), "alert_level": F.when(C("hourly_volume") > mv * 3, "CRITICAL").when(C("hourly_volume") > mv * 2, "WARNING").otherwise("NORMAL")})
    return out.orderBy(F.desc("txn_date"), F.desc("txn_hour")).limit(n)


def branch_days(t: DataFrame, branches: int, scale: float) -> DataFrame:
    """Branches (card number modulo) per day with two ranks; a day holds one row per branch."""
    s = C("status")
    b = F.concat(F.lit("BRANCH-"), (F.substring("card_id", 6, 20).cast("bigint") % branches + 1).cast("string"))
    g = t.groupBy(b.alias("branch_id"), _day().alias("txn_date")).agg(F.count("*").alias("transaction_count"), X.dsum(AMOUNT).alias("total_volume"), F.countDistinct("card_id").alias("unique_customers"), F.count_if(s == "POSTED").alias("successful_count"), F.count_if(s == "DECLINED").alias("declined_count"))
    day = Window.partitionBy("txn_date")
    return g.withColumns({
        "success_rate": X.pct("successful_count", "transaction_count"), "revenue_per_customer": X.ratio("total_volume", "unique_customers"), "volume_rank": F.rank().over(day.orderBy(F.desc("total_volume"))).cast("bigint"), "count_rank": F.rank().over(day.orderBy(F.desc("transaction_count"))).cast("bigint"),
        "performance_tier": X.band(C("total_volume"), [(1000000 * scale, "TOP_PERFORMER"), (500000 * scale, "ABOVE_AVERAGE"), (100000 * scale, "AVERAGE")], "BELOW_AVERAGE"),
    })


def category_summary(t: DataFrame) -> DataFrame:
    return t.groupBy("merchant_category").agg(*_base(), F.max(AMOUNT).alias("max_amount"))


def day_summary(t: DataFrame, days: int) -> DataFrame:
    return t.groupBy(_day().alias("transaction_day")).agg(*_base(), F.countDistinct("card_id").alias("unique_cards")).orderBy(F.desc("transaction_day")).limit(days)


def spend_segments(t: DataFrame, scale: float, at_least: int, n: int) -> DataFrame:
    m = t.groupBy("customer_id").agg(*_base(), F.max(AMOUNT).alias("max_spend"), F.countDistinct("merchant_category").alias("unique_categories")).filter(C("transaction_count") >= at_least)
    return m.withColumn("customer_tier", X.band(C("total_amount"), [(100000 * scale, "PLATINUM"), (50000 * scale, "GOLD"), (10000 * scale, "SILVER")], "BRONZE")).orderBy(F.desc("total_amount"), "customer_id").limit(n)


def card_performance(t: DataFrame) -> DataFrame:
    d = F.count_if(C("status") == "DECLINED")
    return t.groupBy("card_type", "merchant_category").agg(*_base(), d.alias("declined_count"), X.pct(d, F.count("*")).alias("decline_rate"))


def daily_velocity(t: DataFrame, many: int, high: float, at_least: int, at_amount: float, n: int) -> DataFrame:
    d = t.groupBy("card_id", _day().alias("txn_date")).agg(F.count("*").alias("daily_count"), X.dsum(AMOUNT).alias("daily_amount"), X.davg(AMOUNT).alias("avg_amount"))
    out = d.filter((C("daily_count") > at_least) | (C("daily_amount") > at_amount)).withColumn("risk_flag", F.when(C("daily_count") > many, "HIGH_VELOCITY").when(C("daily_amount") > high, "HIGH_VALUE").otherwise("NORMAL"))
    return out.orderBy(F.desc("daily_amount"), "card_id", "txn_date").limit(n)


def spending_places(t: DataFrame) -> DataFrame:
    return t.groupBy("merchant_category").agg(*_base()).withColumn("spending_category", _groups("merchant_category", SPENDING, "OTHER"))


def hour_patterns(t: DataFrame) -> DataFrame:
    return t.groupBy(F.hour("transaction_date").alias("hour_of_day")).agg(*_base(), F.countDistinct("card_id").alias("unique_cards"))


def amount_distribution(t: DataFrame, at_least: int) -> DataFrame:
    """Spread and exact percentiles per category."""
    g = t.groupBy("merchant_category").agg(*_base(), F.min(AMOUNT).alias("min_amount"), F.max(AMOUNT).alias("max_amount"), X.dstd(AMOUNT).alias("stddev_amount"))
    return g.filter(C("transaction_count") >= at_least).join(skew.quantiles(t, "merchant_category", AMOUNT, {"p50": 0.5, "p95": 0.95}), "merchant_category")


def day_report(t: DataFrame) -> DataFrame:
    """Category share of each day and its change against the day before."""
    g = t.groupBy(_day().alias("txn_date"), "merchant_category").agg(F.count("*").alias("transaction_count"), F.sum(AMOUNT).alias("_a"))
    share = X.pct("_a", F.sum("_a").over(Window.partitionBy("txn_date")))
    prev = F.lag(X.dbl("_a")).over(Window.partitionBy("merchant_category").orderBy("txn_date"))  # one row per day
    a = X.dbl("_a")
    return g.select("txn_date", "merchant_category", "transaction_count", a.alias("total_amount"), share.alias("share_of_day"), X.pct(a - prev, prev).alias("day_over_day_pct"), F.when(a > prev, "UP").when(a < prev, "DOWN").otherwise("FLAT").alias("trend"))


def tier_dashboard(t: DataFrame, scale: float) -> DataFrame:
    m = t.groupBy("customer_id").agg(F.count("*").alias("n"), F.sum(AMOUNT).alias("a"))
    tier = X.band(X.dbl("a"), [(100000 * scale, "PLATINUM"), (50000 * scale, "GOLD"), (10000 * scale, "SILVER")], "BRONZE")
    return m.groupBy(tier.alias("customer_tier")).agg(F.count("*").alias("customers"), F.sum("n").alias("transactions"), X.dsum("a").alias("total_amount"), (F.sum("a").cast("double") / F.count("*")).alias("avg_per_customer"))


def hour_flags(t: DataFrame, many: int, high: float) -> DataFrame:
    h = t.groupBy("card_id", F.date_trunc("hour", C("transaction_date").cast("timestamp")).alias("hour")).agg(F.count("*").alias("n"), X.dsum(AMOUNT).alias("amount"))
    return h.withColumn("flag", F.when(C("n") > many, "HIGH_VELOCITY").when(C("amount") > high, "HIGH_VALUE").otherwise("NORMAL")).filter("flag <> 'NORMAL'")
