"""Raw to clean: one function per banking table, plus the general cleaning operators.

Fixed values: the code groups below are the accepted raw codes of the source systems.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators.relational import first_per_key, latest_per_key

ACCOUNT_TYPES = {"SAVINGS": ["SAV", "SAVINGS"], "CURRENT": ["CUR", "CURRENT"], "FIXED_DEPOSIT": ["FD", "FIXED"], "RECURRING_DEPOSIT": ["RD", "RECURRING"]}
ACCOUNT_STATUS = {"ACTIVE": ["ACTIVE", "A"], "CLOSED": ["CLOSED", "C"], "DORMANT": ["DORMANT", "D"], "FROZEN": ["FROZEN", "F"]}
TXN_TYPES = {"CREDIT": ["CR", "CREDIT", "DEPOSIT"], "DEBIT": ["DR", "DEBIT", "WITHDRAWAL"], "TRANSFER": ["TRF", "TRANSFER"]}
CHANNELS = {"ATM": ["ATM"], "MOBILE": ["MOBILE", "APP"], "ONLINE": ["WEB", "ONLINE"], "BRANCH": ["BRANCH", "COUNTER"], "UPI": ["UPI"], "BANK_TRANSFER": ["NEFT", "RTGS", "IMPS"]}
CARD_BRANDS = {"VISA": ["VISA"], "MASTERCARD": ["MASTERCARD", "MC"], "AMEX": ["AMEX"], "RUPAY": ["RUPAY"]}
LOAN_TYPES = {"HOME_LOAN": ["HL", "HOME"], "PERSONAL_LOAN": ["PL", "PERSONAL"], "CAR_LOAN": ["CL", "CAR", "AUTO"], "BUSINESS_LOAN": ["BL", "BUSINESS"], "EDUCATION_LOAN": ["ED", "EDUCATION"], "GOLD_LOAN": ["GL", "GOLD"]}
CARD_TXN_TYPES = {"PURCHASE": ["PURCHASE", "SALE"], "REFUND": ["REFUND"], "CASHBACK": ["CASHBACK"]}
PAYMENT_MODES = {"AUTO_DEBIT": ["AUTO-DEBIT", "AUTO_DEBIT"], "BANK_TRANSFER": ["NEFT", "RTGS", "IMPS"], "CHEQUE": ["CHEQUE", "CHQ"], "CASH": ["CASH"], "UPI": ["UPI"]}
PAYMENT_STATUS = {"SUCCESS": ["SUCCESS", "COMPLETED", "CLEARED"], "PENDING": ["PENDING", "PROCESSING"], "FAILED": ["FAILED", "BOUNCED", "REJECTED"]}
GENDERS = {"MALE": ["M", "MALE"], "FEMALE": ["F", "FEMALE"]}


def _zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _day(d: str) -> Column:
    return F.lit(d).cast("date")


def clean_customers(raw: DataFrame) -> DataFrame:
    """Latest row per customer, standard text, unusable contact data set to NULL."""
    known = raw.filter(F.col("customer_id").isNotNull() & (F.col("customer_id").cast("string") != ""))
    latest = latest_per_key(known, ["customer_id"], ["last_updated", "customer_name"])
    return latest.withColumns(
        {
            "customer_name": F.upper(F.trim("customer_name")),
            "gender": X.standardize("gender", GENDERS, "OTHER"),
            "nationality": F.upper(F.trim("nationality")),
            "email": F.when(X.valid_email("email"), F.lower(F.trim("email"))),
            "phone": F.when(X.valid_phone("phone"), F.col("phone")),
            "city": F.trim("city"),
        }
    ).withColumnRenamed("dob", "date_of_birth")


def clean_accounts(raw: DataFrame, as_of: str) -> DataFrame:
    """Balances are not negative, the available part never exceeds the whole, no account opens in the future."""
    kept = raw.filter(F.col("account_id").isNotNull() & F.col("customer_id").isNotNull() & F.col("current_balance").isNotNull() & (F.col("opening_date") <= _day(as_of)))
    current = F.greatest("current_balance", _zero())
    return kept.withColumns(
        {
            "account_type": F.upper(F.trim("account_type")),
            "account_type_standardized": X.standardize("account_type", ACCOUNT_TYPES, "OTHER"),
            "currency": F.upper(F.trim("currency")),
            "status_standardized": X.standardize("status", ACCOUNT_STATUS, "UNKNOWN"),
            "status": F.upper(F.trim("status")),
            "available_balance_safe": F.least("available_balance", current),
            "available_balance": F.greatest("available_balance", _zero()),
            "current_balance": current,
        }
    )


def clean_transactions(raw: DataFrame, as_of: str, min_date: str = "2020-01-01") -> DataFrame:
    kept = raw.filter(F.col("txn_id").isNotNull() & F.col("account_id").isNotNull() & (F.col("amount") > 0) & F.col("txn_date").between(_day(min_date), _day(as_of)))
    return kept.withColumns(
        {
            "txn_type_standardized": X.standardize("txn_type", TXN_TYPES, "OTHER"),
            "channel_standardized": X.standardize("channel", CHANNELS, "OTHER"),
            "txn_type": F.upper(F.trim("txn_type")),
            "channel": F.upper(F.trim("channel")),
            "currency": F.upper(F.trim("currency")),
            "status": F.upper(F.trim("status")),
            "is_weekend": X.weekend("txn_date"),
            "time_bucket": X.time_bucket_label("txn_timestamp"),
        }
    )


def clean_cards(raw: DataFrame, as_of: str) -> DataFrame:
    """Unexpired cards with brand, masked number, free credit and utilisation in percent."""
    kept = raw.filter(F.col("card_number").isNotNull() & F.col("customer_id").isNotNull() & (F.col("card_limit") > 0) & (F.col("expiry_date") > _day(as_of)))
    return kept.withColumns(
        {
            "card_brand": X.standardize("card_type", CARD_BRANDS, "OTHER"),
            "card_type": F.upper(F.trim("card_type")),
            "card_number_masked": X.mask_card("card_number"),
            "available_credit": F.greatest(F.col("card_limit") - F.col("credit_used"), _zero()),
            "utilization_pct": X.pct("credit_used", "card_limit"),
            "status": F.upper(F.trim("status")),
        }
    )


def clean_loans(raw: DataFrame, as_of: str) -> DataFrame:
    rate = F.col("interest_rate")
    kept = raw.filter(F.col("loan_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("principal_amount") > 0) & (rate > 0) & (rate < 30))
    return kept.withColumns(
        {
            "loan_type_standardized": X.standardize("loan_type", LOAN_TYPES, "OTHER"),
            "loan_type": F.upper(F.trim("loan_type")),
            "principal_outstanding": F.greatest("principal_outstanding", _zero()),
            "interest_rate_band": F.when(rate < 8, "LOW").when(rate <= 12, "MEDIUM").when(rate > 12, "HIGH").otherwise("UNKNOWN"),
            "loan_status": F.when(F.col("maturity_date") >= _day(as_of), "ACTIVE").when(F.col("maturity_date") < _day(as_of), "MATURED").otherwise("UNKNOWN"),
        }
    )


def clean_card_transactions(raw: DataFrame, as_of: str, high_value: float = 50000, min_date: str = "2020-01-01") -> DataFrame:
    kept = raw.filter(F.col("txn_id").isNotNull() & F.col("card_number").isNotNull() & (F.col("amount") > 0) & F.col("txn_date").between(_day(min_date), _day(as_of)))
    return kept.withColumns(
        {
            "merchant_name": F.trim("merchant_name"),
            "merchant_category": F.upper(F.trim("merchant_category")),
            "currency": F.upper(F.trim("currency")),
            "txn_type_standardized": X.standardize("txn_type", CARD_TXN_TYPES, "OTHER"),
            "high_value_flag": F.col("amount") > high_value,
            "unusual_time_flag": F.hour("txn_timestamp").between(0, 5),
            "weekend_flag": X.weekend("txn_date"),
            "status": F.upper(F.trim("status")),
        }
    )


def clean_loan_payments(raw: DataFrame, as_of: str, min_date: str = "2020-01-01") -> DataFrame:
    kept = raw.filter(F.col("payment_id").isNotNull() & F.col("loan_id").isNotNull() & (F.col("amount") > 0) & F.col("payment_date").between(_day(min_date), _day(as_of)))
    return kept.withColumns({"payment_mode_standardized": X.standardize("payment_mode", PAYMENT_MODES, "OTHER"), "status_standardized": X.standardize("status", PAYMENT_STATUS, "UNKNOWN")})


# --- general cleaning -----------------------------------------------------------------------------------
def staged(raw: DataFrame, columns: dict[str, tuple[str, str]], upper: Sequence[str] = ()) -> DataFrame:
    """Rename and cast: ``{"new": ("old", "type")}``; ``upper`` columns are trimmed and upper-cased."""
    return raw.select(*[(F.upper(F.trim(F.col(old).cast(kind))) if new in upper else F.col(old).cast(kind)).alias(new) for new, (old, kind) in columns.items()])


def dedup_keep_min(df: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """Rows equal in ``columns`` collapse to the one with the smallest id."""
    return first_per_key(df, list(columns), [id_col])


def flag_quality(df: DataFrame, rules: dict[str, Column], out: str = "quality_flag") -> DataFrame:
    """PASS, or the name of the first rule the row violates; a rule is the condition of violation."""
    flag = F.lit("PASS")
    for name, broken in reversed(rules.items()):
        flag = F.when(F.coalesce(broken, F.lit(False)), f"FAIL_{name}").otherwise(flag)
    return df.withColumn(out, flag)


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows list every broken rule."""
    reasons = F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]), lambda r: r.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    return tagged.filter(F.size("reasons") == 0).drop("reasons"), tagged.filter(F.size("reasons") > 0)


def impute(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults)


def enrich_orders(orders: DataFrame, lines: DataFrame, customers: DataFrame, cost_share: str, as_of: str) -> DataFrame:
    """Per order: revenue, cost, profit, margin and age; lines are summed before they meet the order."""
    per = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("revenue").alias("revenue"), F.sum(F.col("price") * F.lit(cost_share).cast("decimal(4,2)")).alias("cost"))
    out = orders.join(per, "o_orderkey", "left").join(customers.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey", "left")
    profit = X.dbl("revenue") - X.dbl("cost")
    return out.select(
        "o_orderkey", "c_mktsegment", X.dbl("revenue").alias("revenue"), profit.alias("profit"), X.pct(profit, "revenue").alias("margin_pct"),
        F.datediff(_day(as_of), F.col("o_orderdate").cast("date")).alias("age_days"),
    )


def split_dimension(dim: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Snowflake a column out of a dimension: (sub-dimension, dimension with the key)."""
    sub = dim.select(column).distinct().withColumn(key, X.key_hash(column))
    return sub, dim.withColumn(key, X.key_hash(column)).drop(column)
