"""Customer and commerce analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import skew


def _zero_fill(df: DataFrame, skip: Sequence[str]) -> DataFrame:
    return df.withColumns({f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)) for f in df.schema.fields if f.name not in skip})


# --- one row per customer and source ---------------------------------------------------------------
def customer_accounts(accounts: DataFrame, active_only: bool = True) -> DataFrame:
    rows = accounts.filter("status_standardized = 'ACTIVE'") if active_only else accounts
    t = F.col("account_type_standardized")
    return rows.groupBy("customer_id").agg(
        F.count("*").alias("total_accounts"), F.count_if(t == "SAVINGS").alias("savings_accounts"), F.count_if(t == "CURRENT").alias("current_accounts"), F.count_if(t == "FIXED_DEPOSIT").alias("fd_accounts"),
        X.dsum("current_balance").alias("total_balance"), X.dsum("available_balance").alias("total_available_balance"), F.max("last_updated").alias("last_account_update"),
    )


def customer_cards(cards: DataFrame, active_only: bool = True) -> DataFrame:
    rows = cards.filter("status = 'ACTIVE'") if active_only else cards
    return rows.groupBy("customer_id").agg(
        F.count("*").alias("total_cards"), X.dsum("card_limit").alias("total_card_limit"), X.dsum("credit_used").alias("total_card_outstanding"), X.dsum("available_credit").alias("total_card_available"),
        X.pct(F.sum("credit_used"), F.sum("card_limit")).alias("avg_card_utilization_pct"), F.max("last_updated").alias("last_card_update"),
    )


def customer_loans(loans: DataFrame, active_only: bool = True) -> DataFrame:
    rows = loans.filter("loan_status = 'ACTIVE'") if active_only else loans
    return rows.groupBy("customer_id").agg(
        F.count("*").alias("total_loans"), X.dsum("principal_amount").alias("total_loan_amount"), X.dsum("principal_outstanding").alias("total_loan_outstanding"),
        X.dsum("emi_amount").alias("total_monthly_emi"), X.davg("interest_rate").alias("avg_interest_rate"), F.max("last_updated").alias("last_loan_update"),
    )


def customer_transactions(transactions: DataFrame, accounts: DataFrame, since: str) -> DataFrame:
    """Recent transactions per customer: summed per account before the account join."""
    t = F.col("txn_type_standardized")
    per = transactions.filter(F.col("txn_date") >= F.lit(since).cast("date")).groupBy("account_id").agg(
        F.count("*").alias("n"), F.sum(F.when(t == "CREDIT", F.col("amount"))).alias("c"), F.sum(F.when(t == "DEBIT", F.col("amount"))).alias("d")
    )
    return per.join(accounts.select("account_id", "customer_id"), "account_id").groupBy("customer_id").agg(F.sum("n").alias("txn_count_30d"), X.dsum("c").alias("total_credits_30d"), X.dsum("d").alias("total_debits_30d"))


def customer_360(customers: DataFrame, accounts: DataFrame, cards: DataFrame, loans: DataFrame, transactions: DataFrame, since: str, exposure: Sequence[tuple[float, str]], segments: Sequence[tuple[float, str]], activity: Sequence[tuple[float, str]]) -> DataFrame:
    """Everything known about a customer in one row.

    Each source is reduced to one row per customer before it is joined, so no join can
    multiply another source's amounts, and a customer with very many rows costs no more
    than its partial sums.
    """
    base = customers.select("customer_id", "customer_name", "email", "phone", "city", "region")
    out = base.join(customer_accounts(accounts, False), "customer_id", "left").join(customer_cards(cards, False), "customer_id", "left")
    out = out.join(customer_loans(loans, False), "customer_id", "left").join(customer_transactions(transactions, accounts, since), "customer_id", "left")
    out = out.drop("fd_accounts", "last_account_update", "last_card_update", "last_loan_update", "total_card_available", "avg_interest_rate")
    out = _zero_fill(out, base.columns)
    net = F.col("total_balance") + F.col("total_card_limit") - F.col("total_loan_outstanding")
    return out.withColumn("net_relationship_value", net).withColumns(
        {
            "credit_exposure_band": X.band(F.col("total_loan_outstanding"), exposure, "LOW"),
            "customer_segment": X.band(F.col("net_relationship_value"), segments, "STANDARD", inclusive=True),
            "engagement_level": X.band(F.col("txn_count_30d"), activity, "LOW"),
        }
    )


def segment_summary(c360: DataFrame) -> DataFrame:
    return c360.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"), *[X.dsum(F.col(c).cast("decimal(28,2)")).alias(n) for c, n in (("total_balance", "segment_total_balance"), ("total_card_outstanding", "segment_card_outstanding"), ("total_loan_outstanding", "segment_loan_outstanding"), ("net_relationship_value", "segment_net_value"))]
    )


def single_view(customers: DataFrame, accounts: DataFrame, loans: DataFrame, transactions: DataFrame, since: str) -> DataFrame:
    """Per customer the product lists as text and the movements of the last days.

    Lists hold products of one customer; texts are built after the rows were reduced to
    (customer, product type) so their length is bounded by the number of product types.
    """
    def listed(df, kind, amount, out):
        typed = df.groupBy("customer_id", F.col(kind).alias("k")).agg(F.count("*").alias("n"), F.sum(amount).alias("v"))
        text = F.concat(F.col("k"), F.lit(" x"), F.col("n").cast("string"), F.lit(": "), F.format_number(F.floor("v"), 0))
        return typed.groupBy("customer_id").agg(F.array_join(F.sort_array(F.collect_list(text)), "; ").alias(out))

    recent = transactions.filter(F.col("txn_date") >= F.lit(since).cast("date")).join(accounts.select("account_id", "customer_id"), "account_id")
    out = customers.select("customer_id", "customer_name")
    for df, kind, amount, name in ((accounts, "account_type_standardized", "current_balance", "accounts_summary"), (loans, "loan_type_standardized", "principal_outstanding", "loans_summary"), (recent, "txn_type_standardized", "amount", "recent_transactions")):
        out = out.join(listed(df, kind, amount, name), "customer_id", "left")
    return out


def clv(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, loans: DataFrame, as_of: str, risk: Sequence[tuple[float, str]]) -> DataFrame:
    """Fees and interest paid, tenure, yearly fee estimate, risk by debt. Customers of more than a year."""
    debit = F.col("txn_type_standardized") == "DEBIT"
    paid = lambda word: F.sum(F.when(debit & F.col("description").contains(word), F.col("amount")))
    per = transactions.groupBy("account_id").agg(paid("FEE").alias("f"), paid("INTEREST").alias("i"))
    acc = accounts.join(per, "account_id", "left").groupBy("customer_id").agg(X.dsum("f").alias("total_fees_paid"), X.dsum("i").alias("total_interest_paid"), X.davg("current_balance").alias("avg_daily_balance"))
    debt = loans.groupBy("customer_id").agg(X.dsum("principal_outstanding").alias("debt"))
    months = F.floor(F.months_between(F.lit(as_of).cast("date"), "created_date"))
    out = customers.select("customer_id", "customer_name", months.alias("tenure_months")).filter("tenure_months > 12")
    out = out.join(acc, "customer_id", "left").join(debt, "customer_id", "left").fillna({"total_fees_paid": 0.0, "total_interest_paid": 0.0, "debt": 0.0})
    return out.withColumns({"estimated_annual_fee_revenue": F.col("total_fees_paid") * 12.0 / F.col("tenure_months"), "risk_score": X.band(F.col("debt"), risk, "LOW_RISK")}).drop("debt")


def branch_performance(accounts: DataFrame, loans: DataFrame) -> DataFrame:
    """Accounts and loans per branch, each summed on its own."""
    a = accounts.groupBy("branch_code").agg(F.count("*").alias("accounts"), F.countDistinct("customer_id").alias("customers"), X.dsum("current_balance").alias("balance"))
    home = accounts.select("customer_id", "branch_code").distinct()
    l = customer_loans(loans).join(home, "customer_id").groupBy("branch_code").agg(F.sum("total_loans").alias("loans"), X.dsum(F.col("total_loan_outstanding").cast("decimal(28,2)")).alias("loan_outstanding"))
    return a.join(l, "branch_code", "left").fillna({"loans": 0, "loan_outstanding": 0.0})


def daily_summary(transactions: DataFrame, high_value: float) -> DataFrame:
    return transactions.groupBy("txn_date", F.col("channel_standardized").alias("channel"), F.col("txn_type_standardized").alias("txn_type")).agg(
        F.count("*").alias("transaction_count"), X.dsum("amount").alias("total_amount"), X.davg("amount").alias("avg_amount"), F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        F.countDistinct("account_id").alias("unique_accounts"), F.count_if(F.col("amount") > high_value).alias("high_value_count"), F.count_if("is_weekend").alias("weekend_count"), F.count_if(F.col("time_bucket") == "NIGHT").alias("night_count"),
    )


# --- commerce -------------------------------------------------------------------------------------------
def rfm(orders: DataFrame, customer: str, order: str, day: str, amount: str, as_of: str) -> DataFrame:
    """Recency, frequency, money and their quintiles over all customers."""
    per = orders.groupBy(customer).agg(F.datediff(F.lit(as_of).cast("date"), F.max(day)).alias("recency"), F.countDistinct(order).alias("frequency"), F.sum(amount).alias("monetary"))
    per = per.withColumn("_r", -F.col("recency"))
    out = per
    for col, score in (("_r", "r_score"), ("frequency", "f_score"), ("monetary", "m_score")):
        out = skew.ntiles(out, [], [col, customer], 5, score, base=per)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions").when((r >= 3) & (f >= 3), "Loyal Customers").when((r >= 4) & (f <= 2), "New Customers")
        .when((r <= 2) & (f >= 3), "At Risk").when((r <= 2) & (f <= 2), "Lost").otherwise("Potential")
    )
    return out.drop("_r").withColumns({"rfm_total": r + f + m, "customer_segment": seg})


def cohort_retention(orders: DataFrame, customer: str, day: str) -> DataFrame:
    """Share of each monthly cohort active N months after its first order."""
    month = F.trunc(day, "month")
    active = orders.select(customer, month.alias("m")).distinct()
    first = active.groupBy(customer).agg(F.min("m").alias("cohort_month"))
    since = F.months_between("m", "cohort_month").cast("int")
    activity = active.join(first, customer).groupBy("cohort_month", since.alias("months_since_first")).agg(F.count("*").alias("active_customers"))
    size = first.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    return activity.join(size, "cohort_month").withColumn("retention_pct", X.pct("active_customers", "cohort_size"))


def cohort_ltv(orders: DataFrame, customer: str, day: str, amount: str) -> DataFrame:
    """Cumulative spend per cohort and month since the first order."""
    first = orders.groupBy(customer).agg(F.min(F.trunc(day, "month")).alias("cohort_month"))
    since = F.months_between(F.trunc(day, "month"), "cohort_month").cast("int")
    spend = orders.join(first, customer).groupBy("cohort_month", since.alias("month_no")).agg(F.sum(amount).alias("spend"))
    w = Window.partitionBy("cohort_month").orderBy("month_no").rowsBetween(Window.unboundedPreceding, 0)
    return spend.select("cohort_month", "month_no", X.dbl("spend").alias("spend"), F.sum("spend").over(w).cast("double").alias("cumulative_spend"))


def funnel(events: DataFrame, user: str, step: str, ts: str, steps: Sequence[str]) -> DataFrame:
    """Users who reached each step after the step before it.

    Step by step: earliest time of the step later than the time the previous step was
    reached; one aggregate per step, nothing collected per user.
    """
    reached = events.filter(F.col(step) == steps[0]).groupBy(user).agg(F.min(ts).alias("_t"))
    counts = [reached.agg(F.count("*").alias("users")).select(F.lit(1).alias("step_no"), F.lit(steps[0]).alias("step"), "users")]
    for i, s in enumerate(steps[1:], start=2):
        nxt = events.filter(F.col(step) == s).join(reached, user).filter(F.col(ts) > F.col("_t"))
        reached = nxt.groupBy(user).agg(F.min(ts).alias("_t"))
        counts.append(reached.agg(F.count("*").alias("users")).select(F.lit(i).alias("step_no"), F.lit(s).alias("step"), "users"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def sessions(events: DataFrame, user: str, ts: str, tie: str, gap_seconds: int) -> DataFrame:
    """Sessions split at gaps, numbered per user. One cut of the rows serves both steps."""
    e = events.select(user, ts, tie, F.unix_micros(F.col(ts).cast("timestamp")).alias("_e"))
    c = skew.add_neighbours(skew.cut(e, user, ["_e", tie]), previous={"_e": "_p"})
    begins = F.when(F.col("_p").isNull() | (F.col("_e") - F.col("_p") > gap_seconds * 1000000), 1).otherwise(0)
    rows = skew.add_running(c, {"session_no": begins}).done()
    return rows.groupBy(user, "session_no").agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("events"))


BLOCK = 256  # products of one basket that meet one another in one group
ASIDE = 16  # the largest baskets that are looked up instead of paired, at most


def affinity(lines: DataFrame, order: str, product: str, min_count: int, block: int = BLOCK) -> DataFrame:
    """Pairs of products bought together in at least ``min_count`` orders, with their support.

    A pair can only be frequent if both products are, so rare products go first. Then the
    largest baskets, fewer than ``min_count`` of them, are set aside: every frequent pair
    still occurs in another basket, which names it; each product carries the numbers of the
    baskets aside that hold it, and a pair adds those that its two products share. The other
    baskets are joined with themselves in blocks: a basket's products are dealt into blocks of
    about ``block``, and each pair of blocks is a group of its own, so a large basket is spread
    over many tasks. The result is exact, and the plan the same at every size.
    """
    basket = lines.select(F.col(order).alias("o"), F.col(product).alias("p")).distinct()
    often = basket.groupBy("p").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_count).select("p")
    kept = basket.join(often, "p", "left_semi")
    sizes = kept.groupBy("o").agg(F.count("*").alias("_n"))
    aside = sizes.orderBy(F.desc("_n"), "o").limit(min(min_count - 1, ASIDE)).select(F.col("o").alias("_aside"))
    held = kept.join(F.broadcast(aside), F.col("o").eqNullSafe(F.col("_aside")))  # at most ASIDE rows
    held = held.groupBy(F.col("p").alias("_p")).agg(F.collect_set("o").alias("_in"))
    rest = kept.join(F.broadcast(aside), F.col("o").eqNullSafe(F.col("_aside")), "left_anti").join(held, F.col("p") == F.col("_p"), "left")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    dealt = rest.join(sizes.withColumnRenamed("o", "_o"), F.col("o") == F.col("_o")).select("o", "p", "_in", blocks.alias("_blocks"), F.pmod(F.xxhash64("p"), blocks).cast("int").alias("_i"))
    one = dealt.select("o", F.col("p").alias("a"), F.col("_in").alias("in_a"), F.col("_i").alias("i"), F.explode(F.sequence("_i", F.col("_blocks") - 1)).alias("j"))
    two = dealt.select("o", F.col("p").alias("b"), F.col("_in").alias("in_b"), F.explode(F.sequence(F.lit(0), "_i")).alias("i"), F.col("_i").alias("j"))
    met = one.join(two, ["o", "i", "j"]).filter((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    a_first = lambda x, y: F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y))
    shared = F.coalesce(F.size(F.array_intersect("in_a", "in_b")), F.lit(0))
    pairs = met.select(a_first("a", "b").alias("product_a"), a_first("b", "a").alias("product_b"), shared.alias("_more"))
    counted = pairs.groupBy("product_a", "product_b").agg((F.count("*") + F.max("_more")).alias("pair_count")).filter(F.col("pair_count") >= min_count)
    total = lines.agg(F.countDistinct(order)).scalar()
    return counted.withColumn("support_pct", X.pct("pair_count", total))


def risk_profile(transactions: DataFrame, key: str, amount: str, high: Sequence[float], freq: Sequence[int]) -> DataFrame:
    """Amount, frequency and consistency risk (1 to 3 each), their sum and a category."""
    three = lambda v, lo, hi: F.when(v > hi, 3).when(v > lo, 2).otherwise(1)
    out = transactions.groupBy(key).agg(F.count("*").alias("txn_count"), X.dsum(amount).alias("total_amount"), X.davg(amount).alias("avg_amount"), X.dstd(amount).alias("stddev_amount"))
    score = three(F.col("avg_amount"), high[0], high[1]) + three(F.col("txn_count"), freq[0], freq[1]) + three(F.coalesce("stddev_amount", F.lit(0.0)), F.col("avg_amount"), F.col("avg_amount") * 2)
    out = out.withColumn("total_risk_score", score)
    return out.withColumn("risk_category", F.when(F.col("total_risk_score") >= 7, "HIGH").when(F.col("total_risk_score") >= 4, "MEDIUM").otherwise("LOW"))


def price_changes(prices: DataFrame, product: str, at: str, tie: str, price: str, limit_pct: float) -> DataFrame:
    """Moves of more than ``limit_pct`` against the product's previous price."""
    p = skew.neighbours(prices, product, [at, tie], previous={price: "previous_price"})
    p = p.withColumn("change_pct", X.pct(X.dbl(price) - X.dbl("previous_price"), "previous_price"))
    return p.filter(F.abs("change_pct") > limit_pct)


def pnl_per_account(transactions: DataFrame) -> DataFrame:
    t = F.col("txn_type_standardized")
    return transactions.groupBy("account_id").agg(
        X.sum_if(t == "CREDIT", "amount").alias("credits"), X.sum_if(t == "DEBIT", "amount").alias("debits"), (X.sum_if(t == "CREDIT", "amount") - X.sum_if(t == "DEBIT", "amount")).alias("net")
    )


def net_change(events: DataFrame, bucket: Column, plus: Column, minus: Column, amount: Column) -> DataFrame:
    return events.groupBy(bucket.alias("bucket")).agg(F.sum(F.when(plus, amount).when(minus, -amount).otherwise(0)).alias("net_change"), F.count("*").alias("events"))


def monthly_commerce(lines: DataFrame, orders: DataFrame, cost_share: str) -> DataFrame:
    """Orders, customers, revenue, growth, three-month mean and margin per month."""
    per = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("revenue").alias("r"), F.sum(F.col("price") * F.lit(cost_share).cast("decimal(4,2)")).alias("c"))
    m = orders.join(per, "o_orderkey").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"), X.dsum("r").alias("revenue"), X.dsum("c").alias("cost"))
    w = Window.orderBy("month")  # one row per month
    prev = F.lag("revenue").over(w)
    return m.select(
        "month", "orders", "customers", "revenue", prev.alias("prev_month"), X.pct(F.col("revenue") - prev, prev).alias("mom_growth_pct"),
        (F.sum(F.col("revenue").cast("decimal(28,4)")).over(w.rowsBetween(-2, 0)).cast("double") / F.count("revenue").over(w.rowsBetween(-2, 0))).alias("moving_avg_3m"), X.pct(F.col("revenue") - F.col("cost"), "revenue").alias("margin_pct"),
    )
