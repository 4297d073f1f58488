"""Masking, row filters, erasure, retention and audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finquarry.functions import exprs as X

FULL_ACCESS = ("ADMIN", "COMPLIANCE")


def mask_by_name(df: DataFrame) -> DataFrame:
    """Mask every column whose name says what it holds."""
    rules = {"email": X.mask_email, "phone": X.mask_tail, "card_number": X.mask_card, "pan_number": X.mask_tail, "customer_name": X.mask_name}
    return df.select(*[rules[c](c).alias(c) if c in rules else F.col(c) for c in df.columns])


def mask_for_role(df: DataFrame, role: str) -> DataFrame:
    """Full view for privileged roles, last digits for managers, masked for everybody else.

    The role is known on the driver, so only one variant is planned.
    """
    if role in FULL_ACCESS:
        return df
    if role == "BRANCH_MANAGER":
        return df.select(*[X.mask_tail(c).alias(c) if c in ("phone", "pan_number") else F.col(c) for c in df.columns])
    return mask_by_name(df)


def mask_static(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``{"column": "kind"}`` with kind one of name, email, card, tail."""
    kinds = {"name": X.mask_name, "email": X.mask_email, "card": X.mask_card, "tail": X.mask_tail}
    return df.select(*[kinds[rules[c]](c).alias(c) if c in rules else F.col(c) for c in df.columns])


def tokenize(df: DataFrame, column: str, salt: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a token instead of the value, token map for the vault)."""
    token = F.sha2(F.concat(F.lit(salt), F.col(column).cast("string")), 256)
    return df.withColumn(column, token), df.select(token.alias("token"), F.col(column).alias("value")).distinct()


def detokenize(df: DataFrame, column: str, token_map: DataFrame) -> DataFrame:
    m = token_map.withColumnRenamed("token", column)
    return df.join(m, column, "left").withColumn(column, F.col("value")).drop("value")


def pseudonymise(df: DataFrame, key: str, secret: str, drop: Sequence[str] = ()) -> DataFrame:
    """Keyed hash instead of the identifier (NULL stays NULL), columns not needed left out.

    The secret is hashed in before and after, each time with the length of what follows, so
    that no other secret and identifier give the same text and nothing can be appended.
    """
    text = F.col(key).cast("string")
    inner = F.sha2(F.concat(F.lit(f"{len(secret)}:{secret}"), F.length(text).cast("string"), F.lit(":"), text), 256)
    return df.withColumn(key, F.sha2(F.concat(F.lit(f"{len(secret)}:{secret}"), inner), 256)).drop(*drop)


def encrypt_columns(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """AES-GCM with a random IV, base64 text."""
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string"), F.lit(key))) for c in cols})


def decrypt_columns(df: DataFrame, cols: Sequence[str], key: str, marker: str = "[DECRYPTION_ERROR]") -> DataFrame:
    plain = lambda c: F.try_aes_decrypt(F.unbase64(c), F.lit(key)).cast("string")
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.coalesce(plain(c), F.lit(marker))) for c in cols})


# --- row filters ---------------------------------------------------------------------------------
def rows_for_branch(df: DataFrame, grants: DataFrame, user: str, branch: str = "branch_code", region: str = "region") -> DataFrame:
    """``grants (user_id, scope, branch_code, region)`` with scope ENTERPRISE, REGION or BRANCH."""
    mine = grants.filter(F.col("user_id") == user)
    allowed = lambda scope, col: mine.filter(F.col("scope") == scope).select(F.col(col).alias("_g")).distinct()
    everything = mine.filter(F.col("scope") == "ENTERPRISE").agg(F.count("*") > 0).scalar()
    in_region = df.join(allowed("REGION", region).withColumn("_r", F.lit(True)), F.col(region) == F.col("_g"), "left").drop("_g")
    marked = in_region.join(allowed("BRANCH", branch).withColumn("_b", F.lit(True)), F.col(branch) == F.col("_g"), "left").drop("_g")
    return marked.filter(everything | F.col("_r") | F.col("_b")).drop("_r", "_b")


def rows_for_customer(df: DataFrame, assignments: DataFrame, user: str, roles: Sequence[str], as_of: str, key: str = "customer_id") -> DataFrame:
    """All rows for privileged roles, else those of customers with an active assignment."""
    if set(roles) & set(FULL_ACCESS):
        return df
    day = F.lit(as_of).cast("date")
    mine = assignments.filter((F.col("user_id") == user) & (F.col("start_date") <= day) & (F.col("end_date").isNull() | (F.col("end_date") >= day)))
    return df.join(mine.select(key).distinct(), key, "left_semi")


def rows_for_transactions(transactions: DataFrame, accounts: DataFrame, grants: DataFrame, assignments: DataFrame, user: str, as_of: str) -> DataFrame:
    """Transactions on accounts the user may see by branch or by customer assignment."""
    visible = rows_for_branch(accounts, grants, user).select("account_id").unionByName(rows_for_customer(accounts, assignments, user, [], as_of).select("account_id"))
    return transactions.join(visible.distinct(), "account_id", "left_semi")


def rows_for_role(df: DataFrame, matrix: DataFrame, role: str, classification: str = "classification") -> DataFrame:
    """``matrix (role, classification)`` lists what a role may read."""
    return df.join(matrix.filter(F.col("role") == role).select(classification).distinct(), classification, "left_semi")


def rows_by_attributes(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """Attribute-based access: every predicate must hold."""
    out = df
    for p in predicates:
        out = out.filter(p)
    return out


# --- erasure, export, consent, retention -------------------------------------------------------------
def erase(tables: dict[str, tuple[DataFrame, str]], ids: DataFrame) -> dict[str, DataFrame]:
    """Each ``{name: (table, key)}`` without the rows of the requested ids (one column ``id``)."""
    return {name: df.join(ids.select(F.col("id").alias("_id")), df[key] == F.col("_id"), "left_anti") for name, (df, key) in tables.items()}


def export_subject(df: DataFrame, key: str, subject) -> DataFrame:
    return df.filter(F.col(key) == subject).select(F.col(key), F.to_json(F.struct(*df.columns)).alias("payload"))


def with_consent(df: DataFrame, consents: DataFrame, purpose: str, as_of: str, key: str = "customer_id") -> DataFrame:
    day = F.lit(as_of).cast("date")
    active = consents.filter((F.col("purpose") == purpose) & F.col("granted") & (F.col("expires_on").isNull() | (F.col("expires_on") > day)))
    return df.join(active.select(key).distinct(), key, "left_semi")


def retention_action(day: Column, as_of: str, archive_days: int, delete_days: int) -> Column:
    age = F.datediff(F.lit(as_of).cast("date"), day)
    return F.when(age > delete_days, "DELETE").when(age > archive_days, "ARCHIVE").otherwise("KEEP")


def storage_tier(day: Column, as_of: str, warm_days: int, cold_days: int) -> Column:
    age = F.datediff(F.lit(as_of).cast("date"), day)
    return F.when(age > cold_days, "COLD").when(age > warm_days, "WARM").otherwise("HOT")


# --- audit -------------------------------------------------------------------------------------------
def audit_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row per inserted, updated or deleted key with both versions as JSON."""
    rest = [c for c in before.columns if c != key]
    pack = lambda df, name: df.select(key, F.struct(*rest).alias(name))
    both = pack(before, "_old").join(pack(after, "_new"), key, "full").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    op = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").otherwise("UPDATE")
    return both.select(key, op.alias("operation"), F.to_json("_old").alias("old_values"), F.to_json("_new").alias("new_values"))


def access_per_day(log: DataFrame) -> DataFrame:
    """``log (user_id, ts, object, action, ok)`` per user and day."""
    day = F.col("ts").cast("date").alias("day")
    return log.groupBy("user_id", day).agg(
        F.count("*").alias("accesses"),
        F.array_join(F.sort_array(F.collect_set("action")), ", ").alias("actions"),
        F.count_if(~F.col("ok")).alias("failed"),
    ).withColumn("volume_level", F.when(F.col("accesses") > 10, "HIGH").when(F.col("accesses") > 3, "MEDIUM").otherwise("LOW"))


def access_per_hour(log: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")
    return log.groupBy(hour, "action").agg(F.count("*").alias("accesses"), F.countDistinct("user_id").alias("users"))


def failed_attempts(log: DataFrame, at_least: int) -> DataFrame:
    return log.filter(~F.col("ok")).groupBy("user_id").agg(F.count("*").alias("failed"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).filter(F.col("failed") >= at_least)


def compliance_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("action").agg(F.count("*").alias("accesses"), X.pct(F.count_if("ok"), F.count("*")).alias("success_pct"))
