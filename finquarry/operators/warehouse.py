"""Dimensions, facts and the vault model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import skew
from finquarry.operators.relational import calendar, latest_per_key


# --- dimensions ---------------------------------------------------------------------------------
def dim_date(spark, start: str, end: str) -> DataFrame:
    """Calendar with 22 attributes per day; week days count from 1 = Sunday."""
    d = F.col("full_date")
    last = lambda unit, months: d == F.date_sub(F.add_months(F.trunc(d, unit), months), 1)
    return calendar(spark, start, end, "full_date").select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d,
        F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        X.weekend(d).alias("is_weekend"), (~X.weekend(d)).alias("is_business_day"), F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_abbrev"),
        F.quarter(d).alias("quarter"), F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"), F.year(d).alias("year"),
        F.date_format(d, "yyyy-MM").alias("year_month"), F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("year_quarter"),
        F.year(d).alias("fiscal_year"), F.quarter(d).alias("fiscal_quarter"),
        last("month", 1).alias("is_month_end"), last("quarter", 3).alias("is_quarter_end"), last("year", 12).alias("is_year_end"),
    )


def age_years(born: Column, as_of: str) -> Column:
    return F.floor(F.months_between(F.lit(as_of).cast("date"), born) / 12)


def dim_customer(customers: DataFrame, as_of: str) -> DataFrame:
    age = age_years(F.col("date_of_birth"), as_of)
    group = F.when(age < 30, "YOUNG").when(age < 45, "ADULT").when(age < 60, "MIDDLE_AGE").otherwise("SENIOR")
    kind = F.when(F.col("segment") == "MACHINERY", "CORPORATE").otherwise("RETAIL")
    return customers.select(X.key_hash("customer_id").alias("customer_sk"), "customer_id", "customer_name", "city", "region", age.alias("age"), group.alias("age_group"), kind.alias("customer_segment"))


def dim_account(accounts: DataFrame) -> DataFrame:
    t = F.col("account_type_standardized")
    group = F.when(t.isin("SAVINGS", "FIXED_DEPOSIT", "RECURRING_DEPOSIT"), "DEPOSIT").when(t == "CURRENT", "CURRENT").otherwise("OTHER")
    return accounts.select(
        X.key_hash("account_id").alias("account_sk"), "account_id", "customer_id", t.alias("account_type"), group.alias("account_type_group"),
        F.col("status_standardized").alias("status"), (F.col("status_standardized") == "ACTIVE").alias("is_active"), "branch_code", "current_balance",
    )


def dim_branch(nations: DataFrame, regions: DataFrame) -> DataFrame:
    b = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    return b.select(X.key_hash("n_nationkey").alias("branch_sk"), F.col("n_nationkey").alias("branch_code"), F.col("n_name").alias("branch_name"), F.col("r_name").alias("region"))


def dim_product(parts: DataFrame) -> DataFrame:
    """One product row per distinct type and brand."""
    return parts.select("p_type", "p_brand").distinct().select(X.key_hash("p_type", "p_brand").alias("product_sk"), F.col("p_type").alias("product_category"), F.col("p_brand").alias("product_name"))


def dim_customer_mart(customers: DataFrame, accounts: DataFrame, limits: Sequence[tuple[float, str]]) -> DataFrame:
    """Customer with account aggregates and a balance segment; accounts are summed first."""
    t = F.col("account_type_standardized")
    per = accounts.groupBy("customer_id").agg(
        F.count("*").alias("total_accounts"), F.sum("current_balance").alias("total_balance"), F.max("current_balance").alias("max_account_balance"),
        F.min("current_balance").alias("min_account_balance"), F.count_if(t == "SAVINGS").alias("savings_accounts"), F.count_if(t == "CURRENT").alias("current_accounts"),
    )
    out = customers.join(per, "customer_id", "left").fillna({"total_accounts": 0, "savings_accounts": 0, "current_accounts": 0})
    return out.select(
        X.key_hash("customer_id").alias("customer_sk"), "customer_id", "customer_name", "total_accounts", "total_balance", "max_account_balance", "min_account_balance",
        "savings_accounts", "current_accounts", X.band(F.coalesce(F.col("total_balance"), F.lit(0)), limits, "STANDARD", inclusive=True).alias("customer_segment"),
    )


def junk_dimension(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.select(*flags).distinct().withColumn("junk_sk", X.key_hash(*flags))


def with_unknown_member(fact: DataFrame, dim: DataFrame, key: str, sk: str, unknown: str = "-1") -> DataFrame:
    """Surrogate key lookup; rows without a dimension row point at the unknown member."""
    return fact.join(dim.select(key, sk), key, "left").withColumn(sk, F.coalesce(sk, F.lit(unknown)))


def role_playing(df: DataFrame, dates: DataFrame, roles: dict[str, str], attributes: Sequence[str]) -> DataFrame:
    """The calendar joined once per role: ``{"order": "order_date"}`` adds ``order_year`` and so on."""
    out = df
    for role, column in roles.items():
        d = dates.select(F.col("full_date").alias(f"_{role}"), *[F.col(a).alias(f"{role}_{a}") for a in attributes])
        out = out.join(d, F.col(column) == F.col(f"_{role}"), "left").drop(f"_{role}")
    return out


def flatten_levels(paths: DataFrame, levels: int) -> DataFrame:
    """``(node, path)`` with the path from the root into one column per level."""
    return paths.select("node", *[F.get("path", F.lit(i)).alias(f"level_{i + 1}") for i in range(levels)])


def node_levels(paths: DataFrame) -> DataFrame:
    """``(node, path)`` as one row per node and level of its path, from the root (1) to the node itself, at any depth."""
    return paths.select("node", F.posexplode("path").alias("pos", "ancestor")).select("node", (F.col("pos") + 1).cast("bigint").alias("level"), "ancestor")


# --- facts ------------------------------------------------------------------------------------------
def fact_transactions(transactions: DataFrame, accounts: DataFrame, customers: DataFrame, branches: DataFrame, high_value: float, loaded: DataFrame | None = None) -> DataFrame:
    """One row per transaction with surrogate keys; ids already ``loaded`` are skipped."""
    t = transactions.join(loaded.select("txn_id"), "txn_id", "left_anti") if loaded is not None else transactions
    out = t.join(accounts.select("account_id", "account_sk", "customer_id", "branch_code"), "account_id")
    out = out.join(customers.select("customer_id", "customer_sk"), "customer_id").join(branches.select("branch_code", "branch_sk"), "branch_code")
    return out.select(
        F.date_format("txn_date", "yyyyMMdd").cast("int").alias("date_key"), "customer_sk", "account_sk", "branch_sk", "txn_id", F.col("txn_type_standardized").alias("txn_type"),
        F.col("channel_standardized").alias("channel"), F.col("amount").alias("transaction_amount"), (F.col("amount") > high_value).alias("is_high_value"), "is_weekend",
    )


def fact_transactions_incremental(transactions: DataFrame, accounts: DataFrame, last_day: str | None, limits: Sequence[tuple[float, str]]) -> DataFrame:
    """Rows after ``last_day`` with amount class; the running total covers the delivered rows."""
    t = transactions.filter(F.col("txn_date") > F.lit(last_day).cast("date")) if last_day else transactions
    cls = None
    for limit, label in limits:
        cls = F.when(F.col("amount") < limit, label) if cls is None else cls.when(F.col("amount") < limit, label)
    rows = t.select("txn_id", "account_id", "txn_date", "amount", cls.otherwise("VERY_LARGE").alias("amount_category"), F.year("txn_date").alias("transaction_year"), F.month("txn_date").alias("transaction_month"))
    rows = skew.running_sum(rows, "account_id", ["txn_date", "txn_id"], "amount", "running_balance")
    return rows.join(accounts.select("account_id", "account_sk"), "account_id", "left")


def signed_amount() -> Column:
    return F.when(F.col("txn_type_standardized") == "CREDIT", F.col("amount")).otherwise(-F.col("amount"))


def fact_account_balance(transactions: DataFrame, opening: DataFrame) -> DataFrame:
    """One row per account and active day: flows, opening and closing balance.

    Days are summed first, then the running balance moves over the daily rows.
    ``opening (account_id, opening_balance)`` is the balance before the first day.
    """
    credit = F.col("txn_type_standardized") == "CREDIT"
    daily = transactions.groupBy("account_id", F.col("txn_date").alias("day")).agg(
        F.count_if(credit).alias("credit_count"), F.count_if(~credit).alias("debit_count"),
        F.sum(F.when(credit, F.col("amount")).otherwise(0)).cast("decimal(28,2)").alias("total_credits"),
        F.sum(F.when(~credit, F.col("amount")).otherwise(0)).cast("decimal(28,2)").alias("total_debits"),
        F.sum(signed_amount()).cast("decimal(28,2)").alias("net_flow"),
    )
    moved = skew.running_sum(daily, "account_id", ["day"], "net_flow", "_run")
    out = moved.join(opening, "account_id", "left")
    closing = F.coalesce("opening_balance", F.lit(0)) + F.col("_run")
    return out.withColumns({"closing_balance": closing, "opening_balance": closing - F.col("net_flow")}).drop("_run")


def month_end_balances(daily: DataFrame, first: str, last: str) -> DataFrame:
    """Closing balance per account and month end, carried over months without activity.

    Only the last active day of a month matters, so a month holds one row per account
    before the dense month spine is laid under it.
    """
    month = F.trunc("day", "month")
    per_month = daily.groupBy("account_id", month.alias("month")).agg(F.max_by("closing_balance", "day").alias("closing_balance"))
    spine = daily.groupBy("account_id").agg(F.min("day").alias("_f")).select(
        "account_id", F.explode(F.expr(f"sequence(trunc(_f, 'month'), date'{last}', interval 1 month)")).alias("month")
    )
    laid = spine.join(per_month, ["account_id", "month"], "left")
    return skew.carry_last(laid, "account_id", ["month"], "closing_balance", "balance").select("account_id", "month", "balance")


def fact_loan_payment(payments: DataFrame, loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Payments with the principal and interest parts of the instalment."""
    l = loans.join(customers.select("customer_id", "customer_sk"), "customer_id").select("loan_id", "customer_sk", F.col("loan_type_standardized").alias("loan_type"), "principal_outstanding", "interest_rate", "emi_amount", "tenure_months")
    principal = X.dbl("principal_outstanding") / X.dbl("tenure_months")
    return payments.join(l, "loan_id").select(
        F.date_format("payment_date", "yyyyMMdd").cast("int").alias("date_key"), "customer_sk", "loan_id", "loan_type", "payment_id", F.col("amount").alias("payment_amount"),
        principal.alias("principal_amount"), (X.dbl("amount") - principal).alias("interest_amount"), "principal_outstanding", "tenure_months", (F.col("status_standardized") == "SUCCESS").alias("payment_success"),
    )


def accumulating_snapshot(events: DataFrame, key: str, stage: str, ts: str, stages: Sequence[str]) -> DataFrame:
    """One row per process: first time of each stage and seconds between consecutive stages."""
    firsts = events.groupBy(key).agg(*[F.min(F.when(F.col(stage) == s, F.col(ts))).alias(f"{s}_at") for s in stages])
    lags = [(X.epoch(f"{z}_at") - X.epoch(f"{a}_at")).alias(f"{a}_to_{z}_s") for a, z in zip(stages, stages[1:], strict=False)]
    return firsts.select("*", *lags)


def factless(df: DataFrame, keys: Sequence[str], count_of: str) -> DataFrame:
    """Coverage: how many distinct ``count_of`` met each combination of dimension keys."""
    return df.select(*keys, count_of).distinct().groupBy(*keys).agg(F.count("*").alias(f"{count_of}_count"))


def customer_daily_activity(events: DataFrame, key: str, day: Column, kind: str, kinds: Sequence[str], amount: str) -> DataFrame:
    return events.groupBy(key, day.alias("day")).agg(*[F.count_if(F.col(kind) == k).alias(f"{k}_count") for k in kinds], X.dsum(amount).alias("total"))


def low_stock(daily: DataFrame, stock: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days of stock left from the mean daily sale."""
    v = daily.groupBy(*keys).agg((F.sum("quantity").cast("double") / F.count("*")).alias("avg_daily_sales"))
    days = X.ratio("stock_level", "avg_daily_sales")
    out = stock.join(v, list(keys)).withColumn("days_of_stock", days)
    return out.withColumn("stock_status", F.when(F.col("days_of_stock") < 3, "CRITICAL").when(F.col("days_of_stock") < 7, "LOW").otherwise("OK"))


# --- vault ----------------------------------------------------------------------------------------------
def hub(existing: DataFrame | None, source: DataFrame, key: str, load_date: str, origin: str) -> DataFrame:
    """Business keys with their hash; keys already in the hub are not loaded again."""
    rows = source.select(X.key_hash(key).alias("hub_key"), F.col(key).alias("business_key"), F.lit(load_date).alias("load_date"), F.lit(origin).alias("record_source")).dropDuplicates(["hub_key"])
    return rows if existing is None else existing.unionByName(rows.join(existing.select("hub_key"), "hub_key", "left_anti"))


def link(source: DataFrame, keys: Sequence[str], load_date: str) -> DataFrame:
    return source.select(*keys).distinct().select(X.key_hash(*keys).alias("link_key"), *[X.key_hash(k).alias(f"{k}_hk") for k in keys], F.lit(load_date).alias("load_date"))


def satellite(existing: DataFrame | None, source: DataFrame, key: str, attributes: Sequence[str], load_date: str) -> DataFrame:
    """Attribute versions; a row is added only where the hash of its attributes differs from the latest one."""
    rows = source.select(X.key_hash(key).alias("hub_key"), F.lit(load_date).alias("load_date"), X.row_hash(*attributes).alias("hash_diff"), *attributes)
    if existing is None:
        return rows
    latest = existing.groupBy(F.col("hub_key").alias("_k")).agg(F.max_by("hash_diff", "load_date").alias("_h"))
    changed = rows.join(latest, F.col("hub_key").eqNullSafe(F.col("_k")), "left").filter(F.col("_h").isNull() | (F.col("hash_diff") != F.col("_h"))).drop("_k", "_h")
    return existing.unionByName(changed)


def current_satellite(sat: DataFrame) -> DataFrame:
    return latest_per_key(sat, ["hub_key"], ["load_date"])


def end_dated(sat: DataFrame) -> DataFrame:
    """Each version with the load date of the next one as its end."""
    return skew.neighbours(sat, "hub_key", ["load_date"], following={"load_date": "load_end_date"})
