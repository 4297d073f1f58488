"""Operators on literal rows, including the edge rows."""

import datetime as dt
import itertools
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import customer, fraud, governance, history, ingest, lineage, quality, relational, risk, silver, vectors, warehouse
from finquarry.plans import q_fraud
from finquarry.sources import files


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


D = dt.date


# --- cleaning ---------------------------------------------------------------------------------
CUSTOMER = "customer_id string, customer_name string, dob date, gender string, nationality string, email string, phone string, city string, last_updated date"


def test_customers_latest_row_and_contacts(rows):
    raw = rows(CUSTOMER, [
        ("C001", "  ann lee ", D(1990, 1, 1), "f", "vn ", " Ann@Mail.com", "0912345678", " hue ", D(2024, 1, 1)), ("C001", "old", D(1990, 1, 1), "f", "vn", "x@y.zz", "0912345678", "hue", D(2023, 1, 1)),
        ("C002", "bob", None, "Male", "us", "not-an-address", "12-34", "hcm", D(2024, 1, 1)), ("", "nobody", None, None, None, None, None, None, D(2024, 1, 1)), (None, "nobody", None, None, None, None, None, None, D(2024, 1, 1)),
    ])
    got = values(silver.clean_customers(raw), "customer_id", "customer_name", "gender", "email", "phone", "city")
    assert got == [("C001", "ANN LEE", "FEMALE", "ann@mail.com", "0912345678", "hue"), ("C002", "BOB", "MALE", None, None, "hcm")]


def test_gold_loans_have_a_code_of_their_own(rows):
    raw = rows("loan_id int, customer_id int, loan_type string, principal_amount int, principal_outstanding decimal(18,2), interest_rate double, maturity_date date", [(1, 1, "GL", 10, Decimal(-5), 7.9, D(2024, 1, 1)), (2, 1, "bl", 10, Decimal(5), 8.0, D(2025, 1, 1)), (3, 1, "HL", 10, Decimal(5), 30.0, D(2025, 1, 1)), (4, 1, "gold ", 10, Decimal(5), 12.5, D(2023, 12, 31))])
    got = values(silver.clean_loans(raw, "2024-01-01"), "loan_id", "loan_type_standardized", "interest_rate_band", "loan_status", "principal_outstanding")
    assert got == [(1, "GOLD_LOAN", "LOW", "ACTIVE", Decimal("0.00")), (2, "BUSINESS_LOAN", "MEDIUM", "ACTIVE", Decimal("5.00")), (4, "GOLD_LOAN", "HIGH", "MATURED", Decimal("5.00"))]


def test_dates_in_three_formats(rows):
    got = rows("s string", [("2024-01-15",), ("01/15/2024",), ("15-Jan-2024",), ("nonsense",), (None,)]).select(X.parse_dates("s").alias("d"))
    assert [r.d for r in got.collect()] == [D(2024, 1, 15)] * 3 + [None, None]


def test_quarantine_lists_every_reason(rows):
    ok, bad = silver.quarantine(rows("id int, name string, age int", [(1, "a", 5), (2, None, -5), (3, "c", 200), (4, "d", None)]), {"no_name": F.col("name").isNull(), "bad_age": ~F.col("age").between(0, 150)})
    assert values(ok, "id") == [(1,), (4,)]
    assert values(bad, "id", "reasons") == [(2, ["no_name", "bad_age"]), (3, ["bad_age"])]


def test_latest_per_order(rows):
    data = [(1, 100, 1), (1, 150, 2), (2, 200, 1), (3, 300, 1), (3, 350, 2), (3, 400, 3)]
    assert values(relational.latest_per_key(rows("order_id int, amount int, load_ts int", data), ["order_id"], ["load_ts"]), "order_id", "amount") == [(1, 150), (2, 200), (3, 400)]


# --- history ------------------------------------------------------------------------------------
def test_scd2_sees_nulls_and_repeats_change_nothing(rows):
    first = history.first_versions(rows("id int, city string", [(1, "a"), (2, None), (3, "c"), (4, "d")]), "id", "2024-01-01")
    new = rows("id int, city string", [(1, "b"), (2, "x"), (3, "c"), (5, None)])
    once = history.scd2(first, new, "id", ["city"], "2024-02-01")
    old, now = D(2024, 1, 1), D(2024, 2, 1)
    want = [(1, "a", old, now, False), (1, "b", now, None, True), (2, "x", now, None, True), (2, None, old, now, False), (3, "c", old, None, True), (4, "d", old, None, True), (5, None, now, None, True)]
    cols = ("id", "city", "valid_from", "valid_to", "is_current")
    assert values(once, *cols) == sorted(want, key=str)
    assert values(history.scd2(once, new, "id", ["city"], "2024-03-01"), *cols) == sorted(want, key=str)
    closed = history.scd2(first, new, "id", ["city"], "2024-02-01", close_missing=True)
    assert values(closed.filter("id = 4"), "is_current", "valid_to") == [(False, now)]


def test_scd2_from_changes_skips_repeats(rows, tiny_chunks):
    data = [(1, "a", t) for t in range(0, 40)] + [(1, "b", t) for t in range(40, 80)] + [(1, "a", 90)]
    got = values(history.scd2_from_changes(rows("k int, v string, at int", data), "k", ["v"], "at"), "v", "valid_from", "valid_to", "is_current")
    assert got == [("a", 0, 40, False), ("a", 90, None, True), ("b", 40, 90, False)]


def test_point_in_time_join_is_half_open(rows):
    dim = rows("id int, city string, valid_from date, valid_to date", [(1, "a", D(2024, 1, 1), D(2024, 2, 1)), (1, "b", D(2024, 2, 1), None)])
    fact = rows("id int, day date", [(1, D(2024, 1, 31)), (1, D(2024, 2, 1)), (1, D(2023, 1, 1))])
    assert values(relational.join_versions(fact, dim, "id", "day", "valid_from", "valid_to"), "day", "city") == [(D(2024, 1, 31), "a"), (D(2024, 2, 1), "b")]


# --- change capture -------------------------------------------------------------------------------
def test_cdc_apply_out_of_order_and_duplicated(rows):
    target = rows("id int, v string", [(1, "a"), (2, "b"), (3, "c")])
    log = rows("op string, id int, v string, ts_ms bigint, lsn bigint", [("U", 1, "new", 20, 5), ("U", 1, "stale", 10, 9), ("D", 2, None, 30, 7), ("I", 4, "d", 5, 1), ("I", 4, "d", 5, 1), ("D", 3, None, 10, 2), ("I", 3, "again", 11, 3)])
    assert values(ingest.cdc_apply(target, log, "id"), "id", "v") == [(1, "new"), (3, "again"), (4, "d")]
    assert values(ingest.cdc_apply(target, log, "id", applied=6), "id", "v") == [(1, "stale"), (3, "c")]


def test_blocked_load_publishes_nothing(rows):
    published = []
    df = rows("id int, amount int, parent int", [(1, 5, 1), (2, -5, 9)])
    checks = ingest.check_load(df, "id", "amount", {"parent": (rows("id int", [(1,)]), "id")})
    with pytest.raises(ingest.LoadRejected, match="negative_amounts.*orphans_parent"):
        ingest.load_or_reject(df, checks, published.append)
    assert not published


def test_event_replay(rows):
    log = rows("account string, kind string, amount int, version int", [("A", "open", 1000, 1), ("A", "deposit", 500, 2), ("A", "withdraw", 300, 3), ("A", "deposit", 100, 4)])
    delta = F.when(F.col("kind") == "withdraw", -F.col("amount")).otherwise(F.col("amount"))
    assert values(ingest.replay(log, "account", "version", delta), "state", "events") == [(1300, 4)]


def test_versions_read_as_of(spark, rows, tmp_path):
    v = files.Versions(spark, str(tmp_path))
    v.commit(rows("id int", [(1,), (2,)]), 1, "2024-01-01 00:00:00")
    v.commit(rows("id int", [(2,), (3,)]), 2, "2024-01-02 00:00:00")
    assert values(v.read_as_of("2024-01-01 12:00:00"), "id") == [(1,), (2,)]
    assert values(v.deleted_between(1, 2, "id"), "id") == [(1,)]
    with pytest.raises(ValueError, match="no version"):
        v.version_as_of("2023-01-01 00:00:00")


# --- commerce -----------------------------------------------------------------------------------------
def test_affinity_equals_brute_force_with_huge_baskets(rows):
    rng = random.Random(7)
    baskets = {o: set(rng.sample(range(40), rng.randint(1, 5))) for o in range(60)} | {100: set(range(40)), 101: set(range(5, 38))}
    data = [(o, p) for o, ps in baskets.items() for p in ps]
    for m in (1, 2, 3, 4):
        want = Counter(pair for ps in baskets.values() for pair in itertools.combinations(sorted(ps), 2))
        got = {(r.product_a, r.product_b): r.pair_count for r in customer.affinity(rows("o int, p int", data + data[:20]), "o", "p", m, block=6).collect()}
        assert got == {k: n for k, n in want.items() if n >= m}


def test_affinity_with_a_basket_of_fifty_thousand_products(spark):
    """The huge basket holds every product twice sold; the small ones name the pairs."""
    huge = spark.range(50_000).selectExpr("0L AS o", "id AS p")
    small = spark.range(50_000).selectExpr("1 + id DIV 5 AS o", "id AS p")
    got = customer.affinity(huge.unionByName(small), "o", "p", 2)
    assert got.count() == 10_000 * 10 and got.agg(F.min("pair_count"), F.max("pair_count")).first() == (2, 2)


def test_affinity_joins_large_baskets_in_blocks(spark):
    both = spark.range(3000).selectExpr("id % 1500 AS p", "id DIV 1500 AS o")
    assert customer.affinity(both, "o", "p", 1, block=64).agg(F.count("*"), F.min("pair_count")).first() == (1500 * 1499 // 2, 2)


def test_sessions_and_islands(rows, tiny_chunks):
    base = dt.datetime(2024, 1, 1)
    data = [(1, base + dt.timedelta(minutes=m), i) for i, m in enumerate([0, 10, 20, 60, 61, 200])] + [(2, base + dt.timedelta(minutes=25 * i), 100 + i) for i in range(60)]
    got = values(customer.sessions(rows("u int, ts timestamp, i int", data), "u", "ts", "i", 1800), "u", "session_no", "events")
    assert got == [(1, 1, 3), (1, 2, 2), (1, 3, 1), (2, 1, 60)]
    days = rows("u int, d date", [(1, D(2024, 1, n)) for n in (1, 2, 3, 5, 6, 9)])
    assert values(relational.islands(days, "u", "d"), "start_date", "days") == [(D(2024, 1, 1), 3), (D(2024, 1, 5), 2), (D(2024, 1, 9), 1)]


def test_cohort_retention(rows):
    data = [(1, D(2024, 1, 1)), (1, D(2024, 2, 15)), (1, D(2024, 3, 20)), (2, D(2024, 1, 15)), (2, D(2024, 3, 10)), (3, D(2024, 2, 1)), (4, D(2024, 2, 15)), (4, D(2024, 3, 5))]
    got = values(customer.cohort_retention(rows("c int, day date", data), "c", "day"), "cohort_month", "months_since_first", "active_customers", "retention_pct")
    assert got == [(D(2024, 1, 1), 0, 2, 100.0), (D(2024, 1, 1), 1, 1, 50.0), (D(2024, 1, 1), 2, 2, 100.0), (D(2024, 2, 1), 0, 2, 100.0), (D(2024, 2, 1), 1, 1, 50.0)]


def test_customer_sources_do_not_multiply_each_other(rows):
    acc = rows("account_id int, customer_id int, account_type_standardized string, status_standardized string, current_balance decimal(18,2), available_balance decimal(18,2), last_updated date", [(i, 1, "SAVINGS", "ACTIVE", Decimal(100), Decimal(90), None) for i in range(3)])
    cards = rows("customer_id int, card_limit decimal(18,2), credit_used decimal(18,2), available_credit decimal(18,2), status string, last_updated date", [(1, Decimal(50), Decimal(5), Decimal(45), "ACTIVE", None)] * 2)
    loans = rows("customer_id int, loan_status string, principal_amount decimal(18,2), principal_outstanding decimal(18,2), emi_amount decimal(18,2), interest_rate double, last_updated date", [(1, "ACTIVE", Decimal(10), Decimal(8), Decimal(1), 5.0, None)])
    txn = rows("account_id int, txn_date date, txn_type_standardized string, amount decimal(18,2)", [(0, D(2024, 1, 2), "CREDIT", Decimal(7))] * 4)
    cust = rows("customer_id int, customer_name string, email string, phone string, city string, region string", [(1, "a", None, None, None, None), (2, "b", None, None, None, None)])
    out = customer.customer_360(cust, acc, cards, loans, txn, "2024-01-01", [(5, "HIGH")], [(300, "GOLD")], [(3, "HIGH")])
    got = values(out, "customer_id", "total_balance", "total_card_limit", "total_loan_outstanding", "txn_count_30d", "net_relationship_value", "customer_segment")
    assert got == [(1, 300.0, 100.0, 8.0, 4, 392.0, "GOLD"), (2, 0.0, 0.0, 0.0, 0, 0.0, "STANDARD")]


# --- fraud and risk ------------------------------------------------------------------------------------
def test_worst_severity_is_not_compared_as_text(rows):
    cols = "txn_id bigint, card_number string, customer_id int, merchant_name string, merchant_category string, amount decimal(18,2), txn_timestamp timestamp_ntz, rule_name string, severity string, description string"
    at = dt.datetime(2024, 1, 1)
    alerts = rows(cols, [(1, "c", 1, "m", "x", Decimal(1), at, "A", "MEDIUM", ""), (1, "c", 1, "m", "x", Decimal(1), at, "B", "CRITICAL", ""), (2, "c", 1, "m", "x", Decimal(1), at, "A", "MEDIUM", "")])
    assert values(fraud.fraud_score([alerts], "2024-01-02 00:00:00"), "txn_id", "triggered_rules", "max_severity_score", "recommended_action") == [(1, "A, B", 4, "BLOCK"), (2, "A", 2, "MONITOR")]


def test_days_past_due_use_the_largest_threshold(rows):
    loans = rows("loan_id int, customer_id int, loan_type_standardized string, loan_status string", [(i, 1, "HOME_LOAN", "ACTIVE") for i in range(1, 6)] + [(6, 1, "HOME_LOAN", "MATURED")])
    cust = rows("customer_id int, customer_name string, phone string, email string", [(1, "a", None, None)])
    pay = rows("loan_id int, payment_date date, status_standardized string", [(1, D(2024, 4, 1), "SUCCESS"), (2, D(2024, 2, 20), "FAILED"), (3, D(2024, 1, 20), "SUCCESS"), (4, D(2023, 1, 1), "SUCCESS"), (6, D(2023, 1, 1), "SUCCESS")])
    got = values(risk.credit_dashboard(loans, cust, pay, "2024-04-01"), "loan_id", "estimated_dpd", "risk_classification")
    assert got == [(1, 0, "STANDARD"), (2, 30, "SPECIAL_MENTION"), (3, 60, "SUB_STANDARD"), (4, 90, "NPA"), (5, 0, "STANDARD"), (6, None, "CLOSED")]


def test_all_rules_equal_the_rules_one_by_one(spark):
    rng = random.Random(9)
    at = lambda: dt.datetime(2024, 1, 31) - dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
    times = [at() for _ in range(600)]
    data = [(i, f"c{rng.randrange(12)}", rng.choice(["m", None]), rng.choice(["ONLINE", "FOOD", "FUEL"]), Decimal(rng.randrange(400)), t, t.date(), rng.choice(["SUCCESS", "SUCCESS", "FAILED"])) for i, t in enumerate(times)]
    txns = spark.createDataFrame(data, "txn_id bigint, card_number string, merchant_name string, merchant_category string, amount decimal(18,2), txn_timestamp timestamp_ntz, txn_date date, status string")
    cards = spark.createDataFrame([(f"c{i}", i) for i in range(10)], "card_number string, customer_id int")
    now, x = "2024-01-31 00:00:00", q_fraud._LIMITS
    one = [fraud.rule_high_value(txns, cards, **x["high"]), fraud.rule_velocity(txns, cards, now, **x["velocity"]), fraud.rule_unusual_time(txns, cards, **x["time"]), fraud.rule_cnp(txns, cards, now, **x["cnp"]), fraud.rule_new_category(txns, cards, now, **x["geo"])]
    want = sorted(str(tuple(r[c] for c in fraud.ALERT)) for df in one for r in df.collect())
    got = sorted(str(tuple(r)) for r in fraud.all_rules(txns, cards, now, **x).collect())
    assert got == want and len({r.split("'")[-4] for r in got}) > 2


def test_nearest_for_more_queries_than_a_block(spark):
    rng = random.Random(2)
    vec = lambda: [float(rng.randint(-9, 9)) + 0.5 for _ in range(3)]
    rows, queries = {i: vec() for i in range(40)}, {i: vec() for i in range(300)}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    df = spark.createDataFrame([(i, v) for i, v in rows.items()], "id bigint, v array<float>")
    q = spark.createDataFrame([(i, v) for i, v in queries.items()], "query_id bigint, vector array<double>")
    got = {}
    for r in vectors.nearest(df, q, "id", "v", 3, block=16).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.id
    assert len(got) == 300
    for i, best in got.items():
        want = sorted(rows, key=lambda j: (-round(cos(queries[i], rows[j]), 12), j))[:3]
        assert [round(cos(queries[i], rows[best[k]]), 9) for k in (1, 2, 3)] == [round(cos(queries[i], rows[j]), 9) for j in want]
    assert vectors.nearest(df, q.limit(0), "id", "v", 3).count() == 0


def test_encryption_round_trip(rows):
    df = rows("id int, a string, b string", [(1, "x", None), (2, "", "ü"), (3, None, "z" * 300)])
    key, other = "0123456789abcdef", "fedcba9876543210"
    e = governance.encrypt_columns(df, ["a", "b"], key)
    assert values(governance.decrypt_columns(e, ["a", "b"], key), "id", "a", "b") == values(df, "id", "a", "b")
    assert not {r.a for r in e.collect() if r.a} & {r.a for r in governance.encrypt_columns(df, ["a", "b"], key).collect()}  # a new vector each time
    assert values(governance.decrypt_columns(e, ["a"], other), "id", "a") == [(1, "[DECRYPTION_ERROR]"), (2, "[DECRYPTION_ERROR]"), (3, None)]


# --- quality -----------------------------------------------------------------------------------------------
def test_rules_results_and_gate(rows):
    df = rows("id int, name string, age int, status string", [(1, "a", 30, "ok"), (2, None, -5, "ok"), (2, "c", 200, "invalid"), (3, "d", None, "ok")])
    R = quality.Rule
    rules = [R("id", "t", "uniqueness", "id", severity="CRITICAL", action="BLOCK"), R("name", "t", "completeness", "name", threshold=70), R("age", "t", "range", "age", low=0, high=150), R("status", "t", "accepted_values", "status", values=("ok",), action="LOG")]
    res = quality.run_rules({"t": df}, rules)
    assert values(res, "rule_name", "failed_rows", "pass_rate", "status") == [("age", 2, 50.0, "FAIL"), ("id", 1, 75.0, "FAIL"), ("name", 1, 75.0, "PASS"), ("status", 1, 75.0, "FAIL")]
    assert values(quality.gate(res), "rule_name", "decision") == [("age", "ALERT"), ("id", "BLOCK"), ("name", "PASS"), ("status", "LOG")]
    with pytest.raises(quality.GateClosed, match="t.id"):
        quality.enforce(res)


def test_empty_table_passes(rows):
    df = rows("id int", [])
    res = quality.run_rules({"t": df}, [quality.Rule("n", "t", "completeness", "id"), quality.Rule("u", "t", "uniqueness", "id")])
    assert values(res, "rule_name", "total_rows", "status") == [("n", 0, "PASS"), ("u", 0, "PASS")]


# --- governance -----------------------------------------------------------------------------------------------
def test_masks(rows):
    got = rows("e string, c string, n string", [("ann@mail.com", "1234567890123456", "Ann")]).select(X.mask_email("e"), X.mask_card("c"), X.mask_name("n"), X.mask_tail("c")).first()
    assert tuple(got) == ("an***@mail.com", "XXXX-XXXX-XXXX-3456", "A**", "XXXXXXXXXXXX3456")
    short = rows("e string, t string, n string", [("ab@c.de", "123", "A")]).select(X.mask_email("e"), X.mask_tail("t"), X.mask_name("n")).first()
    assert tuple(short) == ("***@c.de", "XXXX", "*")


def test_wrong_key_yields_the_marker(rows):
    e = governance.encrypt_columns(rows("id int, s string", [(1, "secret"), (2, None)]), ["s"], "0123456789abcdef")
    assert values(governance.decrypt_columns(e, ["s"], "0123456789abcdef"), "id", "s") == [(1, "secret"), (2, None)]
    assert values(governance.decrypt_columns(e, ["s"], "fedcba9876543210"), "id", "s") == [(1, "[DECRYPTION_ERROR]"), (2, None)]


def test_lineage_finds_a_real_cycle(rows):
    nodes = rows("node_id int, status string", [(i, "ACTIVE") for i in range(1, 8)])
    edges = rows("edge_id int, source_node_id int, target_node_id int, status string", [(1, 1, 2, "ACTIVE"), (2, 2, 3, "ACTIVE"), (3, 3, 1, "ACTIVE"), (4, 3, 4, "ACTIVE"), (5, 4, 99, "ACTIVE"), (6, 5, 6, "RETIRED")])
    assert values(lineage.on_cycles(edges), "node_id") == [(1,), (2,), (3,)]
    assert values(lineage.validate(nodes, edges), "orphan_nodes", "broken_edges", "nodes_on_cycles") == [(3, 1, 3)]
    ring = [(i, i, i % 25 + 1, "ACTIVE") for i in range(1, 26)] + [(30, 25, 40, "ACTIVE"), (31, 40, 41, "ACTIVE"), (32, 41, 40, "ACTIVE"), (33, 41, 50, "ACTIVE"), (34, 60, 60, "ACTIVE")]
    assert {r.node_id for r in lineage.on_cycles(rows("edge_id int, source_node_id int, target_node_id int, status string", ring)).collect()} == {*range(1, 26), 40, 41, 60}
    up = lineage.reach(nodes, edges, nodes.filter("node_id = 4"), upstream=True)
    assert values(up, "node", "depth") == [(1, 3), (2, 2), (3, 1), (4, 0)]


def test_closure_of_any_depth_with_several_parents(rows):
    chain = [(i, i + 1) for i in range(14)] + [(0, 2), (2, 4), (14, 0)]
    got = {(r.root, r.node): r.distance for r in lineage.closure(rows("child int, parent int", chain), "child", "parent").collect()}
    assert len(got) == 15 * 14 and got[0, 14] == 12 and got[0, 1] == 1 and got[14, 13] == 12


def test_balances_one_row_per_account_day(rows):
    t = rows("account_id int, txn_date date, txn_type_standardized string, amount decimal(18,2)", [(1, D(2024, 1, 1), "CREDIT", Decimal(10)), (1, D(2024, 1, 1), "DEBIT", Decimal(4)), (1, D(2024, 3, 5), "CREDIT", Decimal(1))])
    daily = warehouse.fact_account_balance(t, rows("account_id int, opening_balance decimal(18,2)", [(1, Decimal(100))]))
    assert values(daily, "day", "opening_balance", "closing_balance") == [(D(2024, 1, 1), Decimal(100), Decimal(106)), (D(2024, 3, 5), Decimal(106), Decimal(107))]
    months = warehouse.month_end_balances(daily, "2024-01-01", "2024-04-01")
    assert values(months, "month", "balance") == [(D(2024, 1, 1), Decimal(106)), (D(2024, 2, 1), Decimal(106)), (D(2024, 3, 1), Decimal(107)), (D(2024, 4, 1), Decimal(107))]


def test_levels_below_the_fourth_are_kept(rows):
    deep = rows("node int, path array<int>", [(7, [1, 2, 3, 4, 5, 6, 7]), (1, [1])])
    assert values(warehouse.node_levels(deep), "node", "level", "ancestor") == [(1, 1, 1), *((7, i, i) for i in range(1, 8))]
