"""Banking tables derived from the star-schema tables, row by row and without sampling.

The raw layer keeps deliberate dirt (mixed-case codes, padded names, superseded rows,
negative balances, bad e-mail addresses) so that the cleaning operators have work to do.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-02"  # one day after the last order
EVENTS_AS_OF = "2024-01-31"  # one day after the last event
MIN_DATE = "1995-01-01"


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def choose(key: str, n: int, values: list[str]) -> str:
    """SQL that spreads ``values`` over rows by ``key % n``."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({key} % {n} + 1 as int))"


def decode(column: str, mapping: dict[str, str], default: str) -> str:
    """SQL that translates the values of a column."""
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE '{default}' END"


@dataclass
class Bank:
    spark: SparkSession
    sf_dir: str

    schemas: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A source table; its schema is read from a file footer once per Bank."""
        path = f"{self.sf_dir}/{name}.parquet"
        if name in self.schemas:
            return self.spark.read.schema(self.schemas[name]).parquet(path)
        df = self.spark.read.parquet(path)
        self.schemas[name] = df.schema
        return df

    # --- raw layer; one SQL projection per table -------------------------------------------
    def customers(self) -> DataFrame:
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        wide = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
        return wide.selectExpr(
            "c_custkey AS customer_id",
            "concat(' ', c_name, ' ') AS customer_name",
            "date_add(date'1950-01-01', cast(c_custkey % 18000 AS int)) AS dob",
            choose("c_custkey", 3, ["m", "FEMALE", "x"]) + " AS gender",
            "lower(n_name) AS nationality",
            "concat('PAN', lpad(cast(c_custkey AS string), 9, '0')) AS pan_number",
            "CASE WHEN c_custkey % 10 = 0 THEN 'no-address' ELSE concat(replace(c_name, '#', '.'), '@Bank.example ') END AS email",
            "CASE WHEN c_custkey % 9 = 0 THEN '12-34' ELSE concat('09', lpad(cast(c_custkey AS string), 9, '0')) END AS phone",
            "n_name AS city",
            "r_name AS region",
            "c_mktsegment AS segment",
            "date_add(date'1995-01-01', cast(c_custkey % 2400 AS int)) AS created_date",
            "date_add(date'2001-01-01', cast(c_custkey % 200 AS int)) AS last_updated",
        )

    def customers_with_old_rows(self) -> DataFrame:
        """The current rows plus, for every fifth customer, a superseded one."""
        now = self.customers()
        old = now.filter(F.col("customer_id") % 5 == 0).withColumns(
            {"customer_name": F.lower("customer_name"), "last_updated": F.date_sub("last_updated", 30)}
        )
        return now.unionByName(old)

    def accounts(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS account_id",
            "c_custkey AS customer_id",
            decode("c_mktsegment", {"AUTOMOBILE": " sav", "BUILDING": "CURRENT", "FURNITURE": "fd", "HOUSEHOLD": "RD"}, "NRI") + " AS account_type",
            "'vnd ' AS currency",
            "date_add(date'1995-01-01', cast(c_custkey % 2400 AS int)) AS opening_date",
            "cast(c_acctbal AS decimal(18,2)) AS current_balance",
            "cast(cast(c_acctbal AS decimal(18,2)) - 50.00BD AS decimal(18,2)) AS available_balance",
            "CASE c_custkey % 10 WHEN 0 THEN 'C' WHEN 1 THEN 'd' WHEN 2 THEN 'frozen' WHEN 3 THEN '?' ELSE ' Active' END AS status",
            "c_nationkey AS branch_code",
            "date_add(date'2001-01-01', cast(c_custkey % 200 AS int)) AS last_updated",
        )

    def transactions(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS txn_id",
            "o_custkey AS account_id",
            decode("o_orderstatus", {"F": "cr", "O": "WITHDRAWAL ", "P": "TRF"}, "?") + " AS txn_type",
            "cast(o_totalprice AS decimal(18,2)) AS amount",
            "'vnd' AS currency",
            "cast(o_orderdate AS date) AS txn_date",
            "o_orderdate AS txn_timestamp",
            "CASE o_orderkey % 50 WHEN 0 THEN 'ANNUAL FEE' WHEN 1 THEN 'LOAN INTEREST' ELSE 'PAYMENT' END AS description",
            decode("o_orderpriority", {"1-URGENT": "atm", "2-HIGH": "APP", "3-MEDIUM": "web", "4-NOT SPECIFIED": "counter"}, "upi") + " AS channel",
            "CASE WHEN o_orderkey % 20 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        )

    def loans(self) -> DataFrame:
        tenure = "cast(12 * (o_orderkey % 5 + 1) AS int)"
        return self.table("orders").filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").selectExpr(
            "o_orderkey AS loan_id",
            "o_custkey AS customer_id",
            choose("o_orderkey", 7, ["hl", "PERSONAL", "Car", "BL", "ED", "GOLD", "other"]) + " AS loan_type",
            "cast(o_totalprice AS decimal(18,2)) AS principal_amount",
            "cast(cast(o_totalprice AS decimal(18,2)) - cast(o_orderkey % 100 AS decimal(18,2)) * 1000 AS decimal(18,2)) AS principal_outstanding",
            "cast(o_orderkey % 20 + 5 AS decimal(5,2)) AS interest_rate",
            f"{tenure} AS tenure_months",
            f"cast(floor(o_totalprice / {tenure}) AS decimal(18,2)) AS emi_amount",
            "cast(o_orderdate AS date) AS disbursement_date",
            f"add_months(cast(o_orderdate AS date), {tenure}) AS maturity_date",
            "cast(o_orderdate AS date) AS last_updated",
        )

    def loan_payments(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payment_id",
            "l_orderkey AS loan_id",
            "cast(l_shipdate AS date) AS payment_date",
            "cast(l_extendedprice AS decimal(18,2)) AS amount",
            choose("l_linenumber", 6, ["auto-debit", "NEFT", "CHQ", "cash", "UPI", "wire"]) + " AS payment_mode",
            decode("l_returnflag", {"A": "cleared", "N": "PROCESSING", "R": "bounced"}, "?") + " AS status",
        )

    def cards(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "lpad(cast(c_custkey AS string), 16, '0') AS card_number",
            "c_custkey AS customer_id",
            choose("c_custkey", 5, ["visa", " MC", "Amex", "RUPAY", "diners"]) + " AS card_type",
            "cast(20000 + (c_custkey % 10) * 5000 AS decimal(18,2)) AS card_limit",
            "greatest(cast(c_acctbal AS decimal(18,2)), cast(0 AS decimal(18,2))) AS credit_used",
            "date_add(date'2001-01-01', cast(c_custkey % 1000 AS int)) AS expiry_date",
            "CASE WHEN c_custkey % 17 = 0 THEN 'blocked' ELSE 'active ' END AS status",
            "date_add(date'2001-01-01', cast(c_custkey % 200 AS int)) AS last_updated",
        )

    def card_transactions(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS txn_id",
            "lpad(cast(user_id AS string), 16, '0') AS card_number",
            "concat(' M', cast(event_id % 20 AS string)) AS merchant_name",
            decode("event_type", {"view": "online", "purchase": "grocery", "click": "travel ", "signup": "fuel"}, "electronics") + " AS merchant_category",
            "cast(value AS decimal(18,2)) AS amount",
            "'vnd' AS currency",
            "cast(ts AS date) AS txn_date",
            "ts AS txn_timestamp",
            decode("event_type", {"purchase": "SALE", "click": "refund", "signup": "CASHBACK"}, "x") + " AS txn_type",
            "CASE WHEN event_type = 'error' THEN 'declined' ELSE 'success' END AS status",
        )

    def benchmark_transactions(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS transaction_id",
            "concat('CARD-', cast(user_id AS string)) AS card_id",
            "user_id % 100 AS customer_id",
            "cast(value AS decimal(18,2)) AS transaction_amount",
            "CASE WHEN event_id % 4 = 0 THEN 'PAYMENT' ELSE 'PURCHASE' END AS transaction_type",
            "concat('M', cast(event_id % 20 AS string)) AS merchant_name",
            decode("event_type", {"view": "ELECTRONICS", "purchase": "GROCERY", "click": "TRAVEL", "signup": "GAMBLING"}, "FUEL") + " AS merchant_category",
            choose("user_id", 3, ["VISA", "MASTERCARD", "AMEX"]) + " AS card_type",
            "ts AS transaction_date",
            "CASE WHEN event_type = 'error' THEN 'DECLINED' ELSE 'POSTED' END AS status",
        )

    def order_lines(self) -> DataFrame:
        """Order lines with exact money columns."""
        price, disc = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
        return self.table("lineitem").withColumns(
            {"price": price, "revenue": (price * (F.lit(1).cast("decimal(3,0)") - disc)).cast("decimal(18,4)"), "ship_date": F.col("l_shipdate").cast("date")}
        )

    # --- two snapshots of the customer table, for change capture and history -----------
    def snapshot_old(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").cast("int").alias("nation"),
            money("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        )

    def snapshot_new(self) -> DataFrame:
        k = F.col("customer_id")
        kept = self.snapshot_old().filter(k % 13 != 0).withColumns(
            {
                "nation": F.when(k % 7 == 0, (F.col("nation") + 1) % 25).otherwise(F.col("nation")),
                "balance": F.when(k % 11 != 0, F.col("balance")),
            }
        )
        added = self.snapshot_old().filter(k % 17 == 0).withColumns({"customer_id": k + 100000000, "name": F.concat(F.lit("New "), "name")})
        return kept.unionByName(added)
