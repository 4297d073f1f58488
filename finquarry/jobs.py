"""The batch jobs: raw to clean layer, clean layer to marts, with a quality gate between them.

Each table is written once; its row count is observed by the write itself, so nothing is
read back to be counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finquarry.operators import customer, quality, risk
from finquarry.operators.layout import write_partitioned
from finquarry.sources.banking import Bank
from finquarry.sources.clean import Clean

CLEAN_TABLES = ("customers", "accounts", "transactions", "cards", "loans", "payments", "card_transactions")
PARTITIONS = {"transactions": ["txn_month"], "card_transactions": ["txn_month"], "daily_transaction_summary": ["txn_month"]}

CLEAN_RULES = [
    quality.Rule("customer_unique", "customers", "uniqueness", "customer_id", severity="CRITICAL", action="BLOCK"),
    quality.Rule("account_owner", "accounts", "referential", "customer_id", parent="customers", parent_key="customer_id", severity="CRITICAL", action="BLOCK"),
    quality.Rule("balance_not_negative", "accounts", "range", "current_balance", low=0, severity="CRITICAL", action="BLOCK"),
    quality.Rule("email_filled", "customers", "completeness", "email", threshold=95),
    quality.Rule("transaction_account", "transactions", "referential", "account_id", parent="accounts", parent_key="account_id", threshold=90),
]


def save(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """Write a table and return its row count, taken while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if by:
        write_partitioned(counted, path, by)
    else:
        counted.write.mode("overwrite").parquet(path)
    return seen.get["n"]


def build_clean(bank: Bank, target: str) -> dict[str, int]:
    """Clean every banking table into ``target/<table>``; facts are partitioned by month."""
    clean, counts = Clean(bank), {}
    for name in CLEAN_TABLES:
        df, by = getattr(clean, name), PARTITIONS.get(name, [])
        if by:
            df = df.withColumn("txn_month", F.date_format("txn_date", "yyyy-MM"))
        counts[name] = save(df, f"{target}/{name}", by)
    return counts


def read_clean(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in CLEAN_TABLES}


def check_clean(spark: SparkSession, path: str, rules: Sequence[quality.Rule] = CLEAN_RULES) -> DataFrame:
    """Run the rules over the stored clean layer; a failed blocking rule raises."""
    results = quality.run_rules(read_clean(spark, path), rules)
    quality.enforce(results)
    return results


def build_marts(spark: SparkSession, source: str, target: str, as_of: str, since: str) -> dict[str, int]:
    """The marts from the stored clean layer."""
    t = read_clean(spark, source)
    daily = customer.daily_summary(t["transactions"], 100_000).withColumn("txn_month", F.date_format("txn_date", "yyyy-MM"))
    marts = {
        "customer_360": customer.customer_360(t["customers"], t["accounts"], t["cards"], t["loans"], t["transactions"], since, [(1e10, "HIGH"), (5e9, "MEDIUM")], [(1e10, "PLATINUM"), (5e9, "GOLD"), (1e9, "SILVER")], [(100, "HIGH"), (20, "MEDIUM")]),
        "daily_transaction_summary": daily,
        "credit_risk_dashboard": risk.credit_dashboard(t["loans"], t["customers"], t["payments"], as_of),
    }
    return {name: save(df, f"{target}/{name}", PARTITIONS.get(name, [])) for name, df in marts.items()}
