"""Scalar functions and user-defined functions."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finquarry.functions import exprs as X
from finquarry.functions import tables as U
from finquarry.plans.registry import query
from finquarry.sources.banking import AS_OF, money


@query("str_case_trim", "SELECT customer_id, trim(customer_name) AS name, upper(trim(nationality)) AS up, lower(region) AS low FROM b_customers")
def _(b):
    return b.customers().select("customer_id", F.trim("customer_name").alias("name"), F.upper(F.trim("nationality")).alias("up"), F.lower("region").alias("low"))


@query("str_initcap", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM part")
def _(b):
    return b.table("part").select("p_partkey", F.initcap("p_name").alias("name"))


@query("str_substr", "SELECT c_custkey, left(c_name, 4) AS l, right(c_name, 4) AS r, substring(c_name, 5, 3) AS m, position('#' IN c_name)::BIGINT AS p FROM customer")
def _(b):
    n = F.col("c_name")
    return b.table("customer").select("c_custkey", F.left(n, F.lit(4)).alias("l"), F.right(n, F.lit(4)).alias("r"), F.substring(n, 5, 3).alias("m"), F.locate("#", n).alias("p"))


@query("str_split_part", "SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS second FROM part")
def _(b):
    n = F.col("p_name")
    return b.table("part").select("p_partkey", F.split_part(n, F.lit(" "), F.lit(1)).alias("first"), F.split_part(n, F.lit(" "), F.lit(2)).alias("second"))


@query("str_replace", "SELECT doc_id, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits FROM documents")
def _(b):
    return b.table("documents").select("doc_id", F.length(F.regexp_replace("text", "[^0-9]", "")).alias("digits"))


@query("str_concat", "SELECT c_custkey, c_name || '/' || c_mktsegment AS a, concat_ws('-', c_name, c_mktsegment) AS w, length(c_name) AS n FROM customer")
def _(b):
    return b.table("customer").select("c_custkey", F.concat("c_name", F.lit("/"), "c_mktsegment").alias("a"), F.concat_ws("-", "c_name", "c_mktsegment").alias("w"), F.length("c_name").alias("n"))


@query("str_parse_messy_customer", """SELECT customer_id, split_part(trim(customer_name), '#', 1) AS first_part, split_part(trim(email), '@', 1) AS mail_user, lower(split_part(trim(email), '@', 2)) AS mail_domain,
    regexp_replace(phone, '[^0-9]', '', 'g') AS phone_digits, split_part(city || ', ' || region, ', ', 1) AS town FROM b_customers""")
def _(b):
    part = lambda c, sep, i: F.split_part(c, F.lit(sep), F.lit(i))
    mail = F.trim("email")
    return b.customers().select(
        "customer_id", part(F.trim("customer_name"), "#", 1).alias("first_part"), part(mail, "@", 1).alias("mail_user"), F.lower(part(mail, "@", 2)).alias("mail_domain"),
        F.regexp_replace("phone", "[^0-9]", "").alias("phone_digits"), part(F.concat_ws(", ", "city", "region"), ", ", 1).alias("town"),
    )


@query("str_format_number", "SELECT o_orderkey, 'VND ' || format('{:,}', floor(o_totalprice)::BIGINT) AS shown FROM orders")
def _(b):
    return b.table("orders").select("o_orderkey", F.concat(F.lit("VND "), F.format_number(F.floor("o_totalprice"), 0)).alias("shown"))


@query("str_validity", """SELECT customer_id, regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$') AS email_ok, regexp_matches(phone, '^[0-9]{10,15}$') AS phone_ok, regexp_matches(pan_number, '^PAN[0-9]{9}$') AS pan_ok FROM b_customers""")
def _(b):
    return b.customers().select("customer_id", X.valid_email("email").alias("email_ok"), X.valid_phone("phone").alias("phone_ok"), F.col("pan_number").rlike("^PAN[0-9]{9}$").alias("pan_ok"))


@query("date_trunc", "SELECT event_id, date_trunc('month', ts)::DATE::VARCHAR AS m, date_trunc('quarter', ts)::DATE::VARCHAR AS q, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS h FROM events")
def _(b):
    ts = F.col("ts").cast("timestamp")
    return b.table("events").select("event_id", F.date_trunc("month", ts).cast("date").alias("m"), F.date_trunc("quarter", ts).cast("date").alias("q"), F.date_trunc("hour", ts).alias("h"))


@query("date_extract", "SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d, dayofweek(o_orderdate) + 1 AS dow, dayofyear(o_orderdate) AS doy, weekofyear(o_orderdate) AS w FROM orders")
def _(b):
    d = F.col("o_orderdate")
    return b.table("orders").select("o_orderkey", F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"), F.dayofweek(d).alias("dow"), F.dayofyear(d).alias("doy"), F.weekofyear(d).alias("w"))


@query("date_add", "SELECT o_orderkey, (o_orderdate + INTERVAL 45 DAY)::DATE::VARCHAR AS d45, (o_orderdate + INTERVAL 1 MONTH)::DATE::VARCHAR AS m1, (o_orderdate - INTERVAL 1 YEAR)::DATE::VARCHAR AS y1 FROM orders")
def _(b):
    d = F.col("o_orderdate").cast("date")
    return b.table("orders").select("o_orderkey", F.date_add(d, 45).alias("d45"), F.add_months(d, 1).alias("m1"), F.add_months(d, -12).alias("y1"))


@query("date_diff", """SELECT event_id, (DATE '2024-01-31' - ts::DATE)::BIGINT AS days, datesub('month', ts::DATE, DATE '2024-06-15') AS months, ((epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', ts))::BIGINT) // 60) AS minutes FROM events""")
def _(b):
    d = F.col("ts").cast("date")
    end = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    months = F.expr("timestampdiff(MONTH, cast(ts as date), date'2024-06-15')")
    return b.table("events").select("event_id", F.datediff(F.lit("2024-01-31").cast("date"), d).alias("days"), months.alias("months"), X.minutes_between("ts", end).alias("minutes"))


@query("date_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%A') AS day_name, strftime(o_orderdate, '%B') AS month_name, epoch(o_orderdate)::BIGINT AS e FROM orders")
def _(b):
    d = F.col("o_orderdate")
    return b.table("orders").select("o_orderkey", F.date_format(d, "yyyy-MM").alias("ym"), F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"), X.epoch(d).alias("e"))


@query("date_parse_multi", "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS parsed FROM orders")
def _(b):
    d = F.col("o_orderdate")
    shown = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd-MMM-yyyy"))
    return b.table("orders").select("o_orderkey", X.parse_dates(shown).alias("parsed"))


@query("date_time_bucket", "SELECT strftime(time_bucket(INTERVAL 15 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1")
def _(b):
    e = b.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "15 minutes").start.alias("bucket")).agg(F.count("*").alias("n"), X.dsum(money("value")).alias("total"))


@query("time_of_day", "SELECT event_id, CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'MORNING' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'AFTERNOON' WHEN hour(ts) BETWEEN 18 AND 22 THEN 'EVENING' ELSE 'NIGHT' END AS part, dayofweek(ts) IN (0, 6) AS is_weekend FROM events")
def _(b):
    return b.table("events").select("event_id", X.time_bucket_label("ts").alias("part"), X.weekend("ts").alias("is_weekend"))


@query("math_basic", "SELECT s_suppkey, greatest(s_acctbal, 0) AS g, least(s_acctbal, 1000) AS l, abs(s_acctbal) AS a, round(s_acctbal::DECIMAL(18,2), 1)::DOUBLE AS r, s_suppkey % 7 AS m, power(s_suppkey % 10, 2) AS p FROM supplier")
def _(b):
    x = F.col("s_acctbal")
    return b.table("supplier").select("s_suppkey", F.greatest(x, F.lit(0.0)).alias("g"), F.least(x, F.lit(1000.0)).alias("l"), F.abs(x).alias("a"), F.round(money(x), 1).alias("r"), (F.col("s_suppkey") % 7).alias("m"), F.pow(F.col("s_suppkey") % 10, F.lit(2)).alias("p"))


@query("math_emi", """SELECT loan_id, (principal_amount::DOUBLE * r * g / (g - 1))::DECIMAL(18,4)::DOUBLE AS emi FROM (SELECT *, interest_rate::DOUBLE / 1200.0::DOUBLE AS r, power(1.0::DOUBLE + interest_rate::DOUBLE / 1200.0::DOUBLE, tenure_months::DOUBLE) AS g FROM b_loans)""")
def _(b):
    return b.loans().select("loan_id", X.emi("principal_amount", "interest_rate", "tenure_months").cast("decimal(18,4)").alias("emi"))


@query("arr_length", "SELECT vec_id, len(embedding) AS n FROM embeddings")
def _(b):
    return b.table("embeddings").select("vec_id", F.size("embedding").alias("n"))


@query("arr_contains", "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS has_ring, list_position(string_split(p_name, ' '), 'ring')::BIGINT AS pos FROM part")
def _(b):
    words = F.split("p_name", " ")
    return b.table("part").select("p_partkey", F.array_contains(words, "ring").alias("has_ring"), F.nullif(F.array_position(words, "ring"), F.lit(0)).alias("pos"))


@query("arr_unnest_ordinality", "SELECT word, idx, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS idx FROM part) GROUP BY ALL")
def _(b):
    return b.table("part").select(F.posexplode(F.split("p_name", " ")).alias("i", "word")).groupBy("word", (F.col("i") + 1).cast("bigint").alias("idx")).agg(F.count("*").alias("n"))


@query("json_path", "SELECT event_id, (props::JSON ->> '$.k') AS k FROM events")
def _(b):
    return b.table("events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("json_containment", "SELECT count(*) AS n, count(*) FILTER (WHERE (props::JSON ->> '$.k')::BIGINT > 50) AS over_50, count(*) FILTER (WHERE json_exists(props, '$.missing')) AS missing FROM events")
def _(b):
    k = F.get_json_object("props", "$.k")
    return b.table("events").agg(F.count("*").alias("n"), F.count_if(k.cast("bigint") > 50).alias("over_50"), F.count_if(F.get_json_object("props", "$.missing").isNotNull()).alias("missing"))


@query("json_cast", "SELECT event_type, sum((props::JSON ->> '$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1")
def _(b):
    return b.table("events").groupBy("event_type").agg(F.sum(F.from_json("props", "k bigint")["k"]).alias("total"))


@query("json_variant", "SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def _(b):
    return b.table("events").select("event_id", F.try_variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@query("json_nested", "SELECT l_orderkey, count(*) FILTER (WHERE l_quantity > 45) > 0 AS has_large, count(*) FILTER (WHERE l_quantity > 45) AS large_items FROM lineitem GROUP BY 1")
def _(b):
    """Per line an order document with its items as JSON; the items are searched inside the text."""
    doc = F.to_json(F.struct("l_orderkey", F.array(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("qty"))).alias("items")))
    parsed = F.from_json("doc", "l_orderkey bigint, items array<struct<part:bigint,qty:double>>")
    rows = b.table("lineitem").select(doc.alias("doc")).select(parsed.alias("d"))
    hit = F.exists("d.items", lambda x: x["qty"] > 45)
    return rows.groupBy("d.l_orderkey").agg(F.bool_or(hit).alias("has_large"), F.count_if(hit).alias("large_items"))


@query("hash_md5", "SELECT customer_id, md5(coalesce(length(customer_id::VARCHAR) || ':' || customer_id::VARCHAR, '-') || coalesce(length(name) || ':' || name, '-')) AS h FROM b_snap_old")
def _(b):
    return b.snapshot_old().select("customer_id", X.key_hash("customer_id", "name").alias("h"))


@query("hash_diff", "SELECT customer_id, md5(coalesce(length(nation::VARCHAR) || ':' || nation::VARCHAR, '-') || coalesce(length(balance::VARCHAR) || ':' || balance::VARCHAR, '-')) AS h FROM b_snap_new")
def _(b):
    return b.snapshot_new().select("customer_id", X.row_hash("nation", "balance").alias("h"))


@query("cast_typed", "SELECT o_orderkey, o_totalprice::DECIMAL(15,2)::DOUBLE AS price, o_orderdate::DATE::VARCHAR AS day, TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS prio, TRY_CAST(o_orderstatus AS BIGINT) AS not_a_number FROM orders")
def _(b):
    return b.table("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"), F.col("o_orderdate").cast("date").alias("day"), F.left("o_orderpriority", F.lit(1)).try_cast("bigint").alias("prio"), F.col("o_orderstatus").try_cast("bigint").alias("not_a_number"))


# --- user-defined functions ---------------------------------------------------------------------------


@F.pandas_udf(T.StringType())
def amount_category(v: pd.Series) -> pd.Series:
    """Arrow-batched form, for logic that has no column expression; here it must equal the native one."""
    return pd.cut(v, [-float("inf"), 100, 1000, float("inf")], labels=["small", "medium", "large"], right=False).astype(str)


_CATEGORY = "SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END AS category FROM orders"


@query("udf_scalar", _CATEGORY)
def _(b):
    p = F.col("o_totalprice")
    return b.table("orders").select("o_orderkey", F.when(p < 100000, "small").when(p < 300000, "medium").otherwise("large").alias("category"))


@query("udf_pandas", _CATEGORY.replace("100000", "100").replace("300000", "1000").replace("o_orderkey", "event_id").replace("o_totalprice", "value").replace("orders", "events"))
def _(b):
    return b.table("events").select("event_id", amount_category("value").alias("category"))


@query("udf_tax", "SELECT event_id, CASE WHEN value > 0 THEN (value::DECIMAL(18,2) * 0.10)::DOUBLE ELSE 0 END AS tax FROM events")
def _(b):
    return b.table("events").select("event_id", F.when(F.col("value") > 0, (money("value") * F.lit("0.10").cast("decimal(3,2)")).cast("double")).otherwise(0.0).alias("tax"))


@query("udaf_total_count", "SELECT user_id, sum(value::DECIMAL(18,2))::DOUBLE AS total, count(*) AS n FROM events GROUP BY 1")
def _(b):
    return b.table("events").groupBy("user_id").agg(X.dsum(money("value")).alias("total"), F.count("*").alias("n"))


_STATUS = """SELECT event_type AS table_name, max(event_id) AS last_lsn, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - max(epoch(date_trunc('second', ts))::BIGINT)) // 60 AS minutes_since_sync,
    CASE WHEN epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - max(epoch(date_trunc('second', ts))::BIGINT) < 300 THEN 'Healthy' WHEN epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - max(epoch(date_trunc('second', ts))::BIGINT) < 3600 THEN 'Stale' ELSE 'Critical' END AS status
    FROM events GROUP BY 1"""


def _positions(b):
    """What each table has loaded, an event type standing for a table: position and time."""
    return b.table("events").select(F.col("event_type").alias("table_name"), F.col("event_id").alias("lsn"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("synced_at"))


@query("udtf_status", _STATUS)
def _(b):
    """A registered table function over a table argument, a partition for each table, called from SQL by LATERAL join."""
    U.register(b.spark)
    now = int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp())
    tables = _positions(b).select("table_name").distinct()
    call = "SELECT s.* FROM {tables} t JOIN LATERAL cdc_table_status(TABLE({log}) PARTITION BY (table_name), {now}) s ON s.table_name = t.table_name"
    return b.spark.sql(call, tables=tables, log=U.positions(_positions(b)), now=now)


@query("udtf_status_call", _STATUS)
def _(b):
    """The same function called on a DataFrame."""
    now = int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp())
    return U.CdcTableStatus(U.positions(_positions(b)).asTable().partitionBy("table_name"), F.lit(now))


@query("udtf_branch_status", "SELECT c_nationkey::BIGINT AS branch, count(*) AS accounts, max((DATE '2001-08-02' - (DATE '2001-01-01' + (c_custkey % 200)::INT)))::BIGINT AS oldest_days FROM customer GROUP BY 1")
def _(b):
    """A parameterised function that returns a table, as a plain function on DataFrames."""

    def branch_status(as_of):
        age = F.datediff(F.lit(as_of).cast("date"), F.col("last_updated"))
        return b.accounts().groupBy(F.col("branch_code").alias("branch")).agg(F.count("*").alias("accounts"), F.max(age).alias("oldest_days"))

    return branch_status(AS_OF)


@query("udf_mask", """SELECT customer_id, CASE WHEN position('@' IN trim(email)) > 3 THEN left(trim(email), 2) || '***' || substring(trim(email), position('@' IN trim(email))) WHEN position('@' IN email) > 0 THEN '***' || substring(trim(email), position('@' IN trim(email))) ELSE '***' END AS email,
    repeat('X', greatest(length(phone) - 4, 0)) || right(phone, 4) AS phone FROM b_customers """)
def _(b):
    from finquarry.operators.governance import mask_by_name

    return mask_by_name(b.customers().select("customer_id", "email", "phone"))
