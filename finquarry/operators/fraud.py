"""Card fraud rules, scores and alerts; money-laundering monitoring.

Rules return rows of one alert schema, so they can be stacked; severities are ranked as
numbers, not compared as text. ``now`` is a parameter and results are repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import skew
from finquarry.operators.relational import first_per_key

ALERT = ["txn_id", "card_number", "customer_id", "merchant_name", "merchant_category", "amount", "txn_timestamp", "rule_name", "severity", "description"]
SEVERITY = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}


def _ntz(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def _since(now: str, hours: int) -> Column:
    t = F.col("txn_timestamp")
    return (t >= _ntz(now) - F.expr(f"interval {hours} hours")) & (t <= _ntz(now))


def _owned(txns: DataFrame, cards: DataFrame) -> DataFrame:
    return txns.join(cards.select("card_number", "customer_id"), "card_number")


def _alert(df: DataFrame, rule: str, severity: Column, description: Column) -> DataFrame:
    tagged = df.withColumns({"rule_name": F.lit(rule), "severity": severity, "description": description})
    missing = {c: F.lit(None) for c in ALERT if c not in tagged.columns}
    kinds = {"txn_id": "bigint", "merchant_name": "string", "merchant_category": "string", "txn_timestamp": "timestamp_ntz"}
    return tagged.withColumns({c: v.cast(kinds[c]) for c, v in missing.items()}).select(*ALERT)


def rule_high_value(txns: DataFrame, cards: DataFrame, limits: Sequence[tuple[float, str]]) -> DataFrame:
    """Successful transactions above the lowest limit."""
    low = min(v for v, _ in limits)
    rows = _owned(txns.filter((F.col("status") == "SUCCESS") & (F.col("amount") > low)), cards)
    return _alert(rows, "HIGH_VALUE", X.band(F.col("amount"), limits, "LOW"), F.concat(F.lit("Transaction amount VND "), F.format_number(F.floor("amount"), 0), F.lit(" exceeds threshold")))


def rule_velocity(txns: DataFrame, cards: DataFrame, now: str, short_hours: int, long_hours: int, limits: Sequence[tuple[int, str]], at_least: int) -> DataFrame:
    """Cards with more than ``at_least`` transactions in the short window before ``now``; one pass for both windows."""
    short = _since(now, short_hours)
    per = txns.filter(_since(now, long_hours)).groupBy("card_number").agg(
        F.count_if(short).alias("txn_count_short"), F.sum(F.when(short, F.col("amount"))).alias("amount"), F.countDistinct(F.when(short, F.col("merchant_category"))).alias("categories_short"), F.count("*").alias("txn_count_long")
    )
    rows = _owned(per.filter(F.col("txn_count_short") > at_least), cards)
    return _alert(rows, "VELOCITY", X.band(F.col("txn_count_short"), limits, "LOW"), F.concat(F.lit("Card has "), F.col("txn_count_short").cast("string"), F.lit(" transactions in window")))


def rule_unusual_time(txns: DataFrame, cards: DataFrame, min_amount: float) -> DataFrame:
    h = F.hour("txn_timestamp")
    rows = _owned(txns.filter((F.col("status") == "SUCCESS") & h.between(0, 5) & (F.col("amount") > min_amount)), cards)
    text = F.concat(F.lit("Transaction at "), h.cast("string"), F.lit(":"), F.minute("txn_timestamp").cast("string"), F.lit(" (unusual hours)"))
    return _alert(rows, "UNUSUAL_TIME", F.when(h <= 3, "HIGH").otherwise("MEDIUM"), text)


def rule_cnp(txns: DataFrame, cards: DataFrame, now: str, recent_hours: int, history_days: int, min_amount: float) -> DataFrame:
    """Recent online transactions against the card's own mean of the last days."""
    online = txns.filter(F.col("merchant_category") == "ONLINE")
    past = online.filter(F.col("txn_date") >= F.date_sub(F.lit(now[:10]).cast("date"), history_days)).groupBy("card_number").agg(X.davg("amount").alias("m"))
    recent = online.filter(_since(now, recent_hours) & (F.col("amount") > min_amount))
    rows = _owned(recent, cards).join(past, "card_number", "left")
    a, m = X.dbl("amount"), F.col("m")
    severity = F.when(m.isNull(), "HIGH").when(a > m * 3, "HIGH").when(a > m * 2, "MEDIUM").otherwise("LOW")
    text = F.when(m.isNull(), "No online transaction history").when(a > m * 3, "Amount 3x above average").when(a > m * 2, "Amount 2x above average").otherwise("Within normal range")
    return _alert(rows, "CNP_PATTERN", severity, text)


def rule_new_category(txns: DataFrame, cards: DataFrame, now: str, recent_hours: int) -> DataFrame:
    """The first transaction ever of a card in a category, if it is recent."""
    cols = ["txn_id", "card_number", "merchant_name", "merchant_category", "amount", "txn_timestamp"]
    first = first_per_key(txns.select(*cols), ["card_number", "merchant_category"], ["txn_timestamp", "txn_id"])
    rows = _owned(first.filter(_since(now, recent_hours)), cards)
    return _alert(rows, "GEO_ANOMALY", F.lit("MEDIUM"), F.concat(F.lit("First-time merchant category: "), F.col("merchant_category")))


def all_rules(txns: DataFrame, cards: DataFrame, now: str, high: dict, velocity: dict, time: dict, cnp: dict, geo: dict) -> DataFrame:
    """The alerts of all five rules, from three reads of the transactions instead of one or two for each rule.

    One aggregate per card and category serves velocity, the mean of online payments and the
    first use of a category; the rules on single transactions share one pass and the join
    with the cards. Arguments are those of the rules.
    """
    short, online = _since(now, velocity["short_hours"]), F.col("merchant_category") == "ONLINE"
    cols = ["txn_id", "merchant_name", "amount", "txn_timestamp"]
    past = online & (F.col("txn_date") >= F.date_sub(F.lit(now[:10]).cast("date"), cnp["history_days"]))
    per = txns.groupBy("card_number", "merchant_category").agg(
        F.count_if(short).alias("n"), F.sum(F.when(short, F.col("amount"))).alias("a"), F.min_by(F.struct(*cols), F.struct("txn_timestamp", "txn_id")).alias("first"),
        F.sum(F.when(past, F.col("amount"))).alias("online_sum"), F.count(F.when(past, F.col("amount"))).alias("online_n"),
    )
    wanted = {c: F.col(c) for c in ALERT if c != "customer_id"}
    shaped = lambda **kw: F.struct(*[(kw[c] if c in kw else wanted[c]).alias(c) for c in wanted if c != "card_number"])
    # a row per category is added up per card; a card's categories are few
    card = per.groupBy("card_number").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a"), F.count_if(F.col("n") > 0).alias("categories"),
        F.collect_list(F.struct("merchant_category", "first")).alias("firsts"),
    )
    nothing = {c: F.lit(None).cast(k) for c, k in (("txn_id", "bigint"), ("merchant_name", "string"), ("merchant_category", "string"), ("txn_timestamp", "timestamp_ntz"))}
    amount = txns.schema["amount"].dataType
    fast = F.when(F.col("n") > velocity["at_least"], shaped(**nothing, amount=F.col("a").cast(amount), rule_name=F.lit("VELOCITY"), severity=X.band(F.col("n"), velocity["limits"], "LOW"), description=F.concat(F.lit("Card has "), F.col("n").cast("string"), F.lit(" transactions in window"))))
    new = F.transform(
        F.filter("firsts", lambda x: (x["first"]["txn_timestamp"] >= _ntz(now) - F.expr(f"interval {geo['recent_hours']} hours")) & (x["first"]["txn_timestamp"] <= _ntz(now))),
        lambda x: shaped(**{c: x["first"][c] for c in cols if c != "amount"}, amount=x["first"]["amount"].cast(amount), merchant_category=x["merchant_category"], rule_name=F.lit("GEO_ANOMALY"), severity=F.lit("MEDIUM"), description=F.concat(F.lit("First-time merchant category: "), x["merchant_category"])),
    )
    by_card = card.select("card_number", F.inline(F.filter(F.concat(F.array(fast), new), lambda x: x.isNotNull())))
    means = per.filter(online & (F.col("online_n") > 0)).select(F.col("card_number").alias("_c"), (F.col("online_sum").cast("double") / F.col("online_n")).alias("m"))
    ok, h, a, m = F.col("status") == "SUCCESS", F.hour("txn_timestamp"), X.dbl("amount"), F.col("m")
    is_high = ok & (F.col("amount") > min(v for v, _ in high["limits"]))
    is_odd = ok & h.between(0, 5) & (F.col("amount") > time["min_amount"])
    is_cnp = online & _since(now, cnp["recent_hours"]) & (F.col("amount") > cnp["min_amount"])
    rows = txns.filter(is_high | is_odd | is_cnp).join(means, F.col("card_number") == F.col("_c"), "left")
    large = F.when(is_high, shaped(rule_name=F.lit("HIGH_VALUE"), severity=X.band(F.col("amount"), high["limits"], "LOW"), description=F.concat(F.lit("Transaction amount VND "), F.format_number(F.floor("amount"), 0), F.lit(" exceeds threshold"))))
    odd = F.when(is_odd, shaped(rule_name=F.lit("UNUSUAL_TIME"), severity=F.when(h <= 3, "HIGH").otherwise("MEDIUM"), description=F.concat(F.lit("Transaction at "), h.cast("string"), F.lit(":"), F.minute("txn_timestamp").cast("string"), F.lit(" (unusual hours)"))))
    severity = F.when(m.isNull(), "HIGH").when(a > m * 3, "HIGH").when(a > m * 2, "MEDIUM").otherwise("LOW")
    text = F.when(m.isNull(), "No online transaction history").when(a > m * 3, "Amount 3x above average").when(a > m * 2, "Amount 2x above average").otherwise("Within normal range")
    remote = F.when(is_cnp, shaped(rule_name=F.lit("CNP_PATTERN"), severity=severity, description=text))
    by_txn = rows.select("card_number", F.inline(F.filter(F.array(large, odd, remote), lambda x: x.isNotNull())))
    return _owned(by_txn.unionByName(by_card), cards).select(*ALERT)


def _rank(severity: Column, scale: dict[str, int]) -> Column:
    out = None
    for k, v in scale.items():
        out = F.when(severity == k, v) if out is None else out.when(severity == k, v)
    return out.otherwise(min(scale.values()))


def fraud_score(alerts: Sequence[DataFrame], now: str) -> DataFrame:
    """All alerts of a transaction in one row: rules, count, worst severity, score, action."""
    rows = reduce(lambda a, z: a.unionByName(z, allowMissingColumns=True), alerts)
    keys = ["txn_id", "card_number", "customer_id", "merchant_name", "merchant_category", "amount", "txn_timestamp"]
    # a transaction has at most one alert per rule, so the collected names are few
    out = rows.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list("rule_name")), ", ").alias("triggered_rules"), F.count("*").alias("rule_count"), F.max(_rank(F.col("severity"), SEVERITY)).alias("max_severity_score")
    )
    n, s = F.col("rule_count"), F.col("max_severity_score")
    return out.withColumns(
        {
            "fraud_score": n * 10 + s * 10,
            "recommended_action": F.when((n >= 3) | (s == 4), "BLOCK").when((n >= 2) | (s == 3), "REVIEW").otherwise("MONITOR"),
            "evaluated_at": F.coalesce(F.col("txn_timestamp") + F.expr("interval 10 minutes"), _ntz(now)),
        }
    )


def alert_summary(score: DataFrame, since: str) -> DataFrame:
    rows = score.filter(F.col("evaluated_at") >= _ntz(since))
    return rows.groupBy(F.col("txn_timestamp").cast("date").alias("alert_date"), F.hour("txn_timestamp").alias("alert_hour"), "triggered_rules", "recommended_action").agg(
        F.count("*").alias("alert_count"), X.dsum("amount").alias("total_amount_at_risk"), F.countDistinct("card_number").alias("affected_cards"), F.countDistinct("customer_id").alias("affected_customers")
    )


def txn_risk(txns: DataFrame, cards: DataFrame, velocity: int, amount: str = "amount") -> DataFrame:
    """Score of successful transactions from amount, hour, weekend and the card's own velocity.

    Both velocity windows come from one skew-safe pass over each card's history.
    """
    t = txns.withColumn("_s", X.epoch(F.date_trunc("second", F.col("txn_timestamp").cast("timestamp"))))
    t = skew.trailing_ranges(t, "card_number", "_s", {3600: {"txn_count_last_1hr": F.lit(1)}, 86400: {"txn_count_last_24hr": F.lit(1)}})
    daily = txns.groupBy("card_number", "txn_date").agg(X.dsum(amount).alias("daily_cumulative_amount"))
    rows = _owned(t.filter(F.col("status") == "SUCCESS"), cards).join(daily, ["card_number", "txn_date"])
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    score = points(F.col("high_value_flag"), 30) + points(F.col("unusual_time_flag"), 25) + points(F.col("weekend_flag"), 10) + points(F.col("txn_count_last_1hr") > velocity, 35)
    s = F.col("risk_score")
    return rows.withColumn("risk_score", score).filter(s >= 30).withColumns(
        {
            "alert_level": F.when(s >= 80, "CRITICAL").when(s >= 50, "HIGH").otherwise("MEDIUM"),
            "recommended_action": F.when(s >= 80, "BLOCK Transaction + Alert Customer + Alert Fraud Team").when(s >= 50, "FLAG for Review + Alert Customer").otherwise("LOG for Pattern Analysis"),
        }
    ).drop("_s")


def alerts_realtime(score: DataFrame, customers: DataFrame, now: str, hours: int) -> DataFrame:
    """Open alerts to act on, with age and contact."""
    e = F.col("evaluated_at")
    rows = score.filter((e >= _ntz(now) - F.expr(f"interval {hours} hours")) & F.col("recommended_action").isin("BLOCK", "REVIEW"))
    return rows.join(customers.select("customer_id", "customer_name", "phone", "email"), "customer_id").select(
        "txn_id", F.concat(F.lit("XXXX-"), F.right("card_number", F.lit(4))).alias("card_masked"), "customer_id", "customer_name", "amount", "triggered_rules", "rule_count", "fraud_score", "recommended_action",
        X.minutes_between("evaluated_at", _ntz(now)).alias("age_minutes"), "phone", "email",
    )


def alerts_critical(score: DataFrame, customers: DataFrame, now: str, hours: int, at_least: int) -> DataFrame:
    s = F.col("fraud_score")
    rows = score.filter((s >= at_least) & (F.col("evaluated_at") >= _ntz(now) - F.expr(f"interval {hours} hours"))).join(customers.select("customer_id", "phone", "email"), "customer_id")
    act = F.when(s >= 80, "AUTO_BLOCK").when(s >= 60, "MANUAL_REVIEW").otherwise("LOG_ONLY")
    return rows.select("txn_id", "card_number", "customer_id", "fraud_score", "triggered_rules", act.alias("action_required"), F.concat(F.lit("Contact "), F.coalesce("phone", F.lit("-")), F.lit(" or "), F.coalesce("email", F.lit("-"))).alias("customer_contact_info"))


def alerts_per_day(score: DataFrame) -> DataFrame:
    act, rules = F.col("recommended_action"), F.col("triggered_rules")
    flags = {"high_value_count": "HIGH_VALUE", "velocity_count": "VELOCITY", "unusual_time_count": "UNUSUAL_TIME", "cnp_count": "CNP_PATTERN", "geo_count": "GEO_ANOMALY"}
    return score.groupBy(F.col("txn_timestamp").cast("date").alias("report_date")).agg(
        F.count("*").alias("total_alerts"), F.countDistinct("card_number").alias("unique_cards_flagged"), X.dsum("amount").alias("total_amount_flagged"), F.max("amount").alias("max_amount_flagged"),
        *[F.count_if(act == a).alias(f"{a.lower()}_count") for a in ("BLOCK", "REVIEW", "MONITOR")], *[F.count_if(rules.contains(r)).alias(n) for n, r in flags.items()],
        X.pct(F.count_if(act == "BLOCK"), F.count("*")).alias("block_rate_pct"),
    )


def risky_cards(score: DataFrame, at_least: int, n: int) -> DataFrame:
    out = score.groupBy("card_number", "customer_id").agg(F.count("*").alias("total_alerts"), F.countDistinct("triggered_rules").alias("distinct_rules_triggered"), X.dsum("amount").alias("total_flagged_amount"), X.davg("fraud_score").alias("avg_fraud_score"), F.max("fraud_score").alias("max_fraud_score"))
    level = F.when((F.col("total_alerts") >= 10) | (F.col("max_fraud_score") >= 80), "HIGH_RISK").when((F.col("total_alerts") >= 5) | (F.col("max_fraud_score") >= 60), "MEDIUM_RISK").otherwise("LOW_RISK")
    return out.filter(F.col("total_alerts") >= at_least).withColumn("card_risk_level", level).orderBy(F.desc("total_alerts"), F.desc("avg_fraud_score"), "card_number").limit(n)


def alert_heatmap(score: DataFrame) -> DataFrame:
    out = score.groupBy(F.hour("txn_timestamp").alias("hour_of_day"), F.dayofweek("txn_timestamp").alias("day_of_week")).agg(F.count("*").alias("alert_count"), X.dsum("amount").alias("total_amount"), X.davg("fraud_score").alias("avg_fraud_score"))
    return out.withColumn("frequency_band", X.band(F.col("alert_count"), [(10, "VERY_HIGH"), (5, "HIGH"), (2, "MEDIUM")], "LOW"))


def merchant_risk(score: DataFrame, at_least: int, levels: Sequence[int]) -> DataFrame:
    out = score.groupBy("merchant_name", "merchant_category").agg(F.count("*").alias("total_alerts"), F.countDistinct("card_number").alias("unique_cards_flagged"), X.dsum("amount").alias("total_flagged_amount"), X.davg("fraud_score").alias("avg_fraud_score"))
    n = F.col("total_alerts")
    return out.filter(n >= at_least).withColumns({
        "merchant_risk_level": X.band(n, [(levels[0], "HIGH_RISK_MERCHANT"), (levels[1], "MEDIUM_RISK_MERCHANT")], "LOW_RISK_MERCHANT"),
        "recommendation": X.band(n, [(levels[0], "Consider blocking this merchant"), (levels[1], "Monitor closely")], "Normal monitoring"),
    })


def alert_aging(score: DataFrame, now: str, hours: int) -> DataFrame:
    """Age of open alerts against 5 minutes (BLOCK) and 15 minutes (REVIEW), priority P1 to P4."""
    age, act = F.col("age_minutes"), F.col("recommended_action")
    rows = score.filter(act.isin("BLOCK", "REVIEW") & (F.col("evaluated_at") >= _ntz(now) - F.expr(f"interval {hours} hours")) & (F.col("evaluated_at") <= _ntz(now)))
    rows = rows.withColumn("age_minutes", X.minutes_between("evaluated_at", _ntz(now)))
    sla = F.when((act == "BLOCK") & (age > 5), "SLA_BREACH").when((act == "REVIEW") & (age > 15), "SLA_WARNING").otherwise("ON_TRACK")
    s = F.col("fraud_score")
    return rows.select("txn_id", "card_number", "fraud_score", "recommended_action", "age_minutes", sla.alias("sla_status"), F.when(s >= 80, "P1").when(s >= 60, "P2").when(s >= 40, "P3").otherwise("P4").alias("priority"))


# --- money laundering -------------------------------------------------------------------------------
def ctr(transactions: DataFrame, accounts: DataFrame, customers: DataFrame, since: str, report: float, mandatory: float) -> DataFrame:
    """Large withdrawals of the reporting period."""
    rows = transactions.filter((F.col("txn_type_standardized") == "DEBIT") & (F.col("amount") >= report) & (F.col("txn_date") >= F.lit(since).cast("date")))
    rows = rows.join(accounts.select("account_id", "customer_id"), "account_id").join(customers.select("customer_id", "customer_name", "pan_number"), "customer_id")
    need = F.when(F.col("amount") >= mandatory, "MANDATORY").otherwise("RECOMMENDED")
    return rows.select("txn_id", "account_id", "customer_id", "customer_name", "pan_number", "amount", "txn_date", F.lit("CTR").alias("report_type"), need.alias("reporting_requirement"))


def str_candidates(transactions: DataFrame, accounts: DataFrame, customers: DataFrame, since: str, p: dict) -> DataFrame:
    """Customers with suspicious patterns: one score decides class, action and reasons."""
    per = transactions.filter(F.col("txn_date") >= F.lit(since).cast("date")).join(accounts.select("account_id", "customer_id"), "account_id").groupBy("customer_id").agg(
        F.count("*").alias("total_txns_30d"), F.sum("amount").alias("_total"), F.max("amount").alias("_max"), F.sum(F.when(F.col("channel_standardized") == "BRANCH", F.col("amount")).otherwise(0)).alias("_cash"),
        F.count_if(F.col("channel_standardized") == "BRANCH").alias("cash_count_30d"), F.count_if(F.col("amount").between(p["near_low"], p["near_high"])).alias("near_threshold_count"),
    )
    tests = [("High cash volume", F.col("_cash") > p["cash"], 30), ("Potential structuring", F.col("near_threshold_count") > p["near_count"], 40), ("Unusual frequency", F.col("total_txns_30d") > p["txns"], 20), ("Large single transaction", F.col("_max") > p["single"], 25)]
    fired = reduce(lambda a, z: a | z, [c for _, c, _ in tests])
    round_sum = F.when(F.col("_total") % p["round"] == 0, 10).otherwise(0)
    score = reduce(lambda a, z: a + z, [F.when(c, n).otherwise(0) for _, c, n in tests]) + round_sum
    s = F.col("suspicion_score")
    reasons = F.concat_ws("; ", *[F.when(c, name) for name, c, _ in tests])
    out = per.filter(fired).withColumns({"suspicion_score": score, "suspicion_reasons": reasons}).join(customers.select("customer_id", "customer_name", "pan_number"), "customer_id")
    return out.select(
        "customer_id", "customer_name", "pan_number", "total_txns_30d", X.dbl("_total").alias("total_amount_30d"), X.dbl("_cash").alias("cash_amount_30d"), "cash_count_30d", "near_threshold_count", "suspicion_score",
        F.when(s >= 60, "HIGH").when(s >= 30, "MEDIUM").otherwise("LOW").alias("risk_classification"), F.when(s >= 60, "FILE_STR_IMMEDIATELY").when(s >= 30, "ENHANCED_MONITORING").otherwise("STANDARD_MONITORING").alias("recommended_action"), "suspicion_reasons",
    )


def pep_monitoring(customers: DataFrame, registry: DataFrame, accounts: DataFrame, transactions: DataFrame, since: str, high: float) -> DataFrame:
    """Politically exposed customers and their recent transactions, reached through their accounts."""
    per = transactions.filter(F.col("txn_date") >= F.lit(since).cast("date")).groupBy("account_id").agg(F.count("*").alias("n"), F.sum("amount").alias("a"), F.max("amount").alias("m"))
    per = per.join(accounts.select("account_id", "customer_id"), "account_id").groupBy("customer_id").agg(F.sum("n").alias("total_txns_30d"), X.dsum("a").alias("total_amount_30d"), F.max("m").alias("max_single_txn"))
    out = customers.select("customer_id", "customer_name", "pan_number").join(registry.filter("is_pep"), "customer_id").join(per, "customer_id", "left").fillna({"total_txns_30d": 0})
    return out.withColumns({"edd_requirement": F.lit("REQUIRED"), "risk_level": F.when(F.col("total_amount_30d") > high, "HIGH").otherwise("MEDIUM")})


def aml_day(ctr_rows: DataFrame, str_rows: DataFrame, pep_rows: DataFrame, as_of: str) -> DataFrame:
    """The day's counts in one row, one aggregate per report."""
    a = ctr_rows.agg(F.count("*").alias("ctr_count"), X.dsum("amount").alias("ctr_total_amount"))
    c = F.col("risk_classification")
    s = str_rows.agg(F.count_if(c == "HIGH").alias("h"), F.count_if(c == "MEDIUM").alias("m")).select(F.struct("h", "m").alias("s")).scalar()
    p = pep_rows.agg(F.count("*").alias("n"), X.dsum(F.col("total_amount_30d").cast("decimal(28,2)")).alias("t")).select(F.struct("n", "t").alias("p")).scalar()
    out = a.withColumns({"_s": s, "_p": p}).select("ctr_count", "ctr_total_amount", F.col("_s.h").alias("high_risk_str_count"), F.col("_s.m").alias("medium_risk_str_count"), F.col("_p.n").alias("pep_count"), F.col("_p.t").alias("pep_total_amount"))
    h = F.col("high_risk_str_count")
    return out.withColumns({"report_date": F.lit(as_of), "overall_risk_status": F.when(h > 5, "ELEVATED").when(h > 0, "WATCH").otherwise("NORMAL"), "ctr_status": F.when(F.col("ctr_count") > 0, "CTR_SUBMITTED").otherwise("CTR_PENDING")})


def str_aging(str_rows: DataFrame, report_date: str, as_of: str) -> DataFrame:
    age = F.datediff(F.lit(as_of).cast("date"), F.lit(report_date).cast("date"))
    c = F.col("risk_classification")
    sla = F.when((c == "HIGH") & (age > 1), "SLA_BREACH").when((c == "MEDIUM") & (age > 3), "SLA_WARNING").otherwise("ON_TRACK")
    return str_rows.filter(F.col("recommended_action").isin("FILE_STR_IMMEDIATELY", "ENHANCED_MONITORING")).select("customer_id", "suspicion_score", "risk_classification", "recommended_action", age.alias("age_days"), sla.alias("sla_status"))
