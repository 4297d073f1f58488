"""The banking tables once more, in the SQL of the check engine."""

VIEWS: dict[str, str] = {
    "b_customers": """
        SELECT c_custkey AS customer_id, ' ' || c_name || ' ' AS customer_name,
               DATE '1950-01-01' + (c_custkey % 18000)::INT AS dob,
               CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'FEMALE' ELSE 'x' END AS gender,
               lower(n_name) AS nationality, 'PAN' || lpad(c_custkey::VARCHAR, 9, '0') AS pan_number,
               CASE WHEN c_custkey % 10 = 0 THEN 'no-address' ELSE replace(c_name, '#', '.') || '@Bank.example ' END AS email,
               CASE WHEN c_custkey % 9 = 0 THEN '12-34' ELSE '09' || lpad(c_custkey::VARCHAR, 9, '0') END AS phone,
               n_name AS city, r_name AS region, c_mktsegment AS segment,
               DATE '1995-01-01' + (c_custkey % 2400)::INT AS created_date,
               DATE '2001-01-01' + (c_custkey % 200)::INT AS last_updated
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "b_customers_old": """
        SELECT * FROM b_customers UNION ALL
        SELECT * REPLACE (lower(customer_name) AS customer_name, last_updated - 30 AS last_updated)
        FROM b_customers WHERE customer_id % 5 = 0""",
    "b_accounts": """
        SELECT c_custkey AS account_id, c_custkey AS customer_id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' sav' WHEN 'BUILDING' THEN 'CURRENT' WHEN 'FURNITURE' THEN 'fd' WHEN 'HOUSEHOLD' THEN 'RD' ELSE 'NRI' END AS account_type,
               'vnd ' AS currency, DATE '1995-01-01' + (c_custkey % 2400)::INT AS opening_date,
               c_acctbal::DECIMAL(18,2) AS current_balance, (c_acctbal::DECIMAL(18,2) - 50.00)::DECIMAL(18,2) AS available_balance,
               CASE c_custkey % 10 WHEN 0 THEN 'C' WHEN 1 THEN 'd' WHEN 2 THEN 'frozen' WHEN 3 THEN '?' ELSE ' Active' END AS status,
               c_nationkey AS branch_code, DATE '2001-01-01' + (c_custkey % 200)::INT AS last_updated
        FROM customer""",
    "b_transactions": """
        SELECT o_orderkey AS txn_id, o_custkey AS account_id,
               CASE o_orderstatus WHEN 'F' THEN 'cr' WHEN 'O' THEN 'WITHDRAWAL ' WHEN 'P' THEN 'TRF' ELSE '?' END AS txn_type,
               o_totalprice::DECIMAL(18,2) AS amount, 'vnd' AS currency, o_orderdate::DATE AS txn_date, o_orderdate AS txn_timestamp,
               CASE o_orderkey % 50 WHEN 0 THEN 'ANNUAL FEE' WHEN 1 THEN 'LOAN INTEREST' ELSE 'PAYMENT' END AS description,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'atm' WHEN '2-HIGH' THEN 'APP' WHEN '3-MEDIUM' THEN 'web' WHEN '4-NOT SPECIFIED' THEN 'counter' ELSE 'upi' END AS channel,
               CASE WHEN o_orderkey % 20 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
        FROM orders""",
    "b_loans": """
        SELECT o_orderkey AS loan_id, o_custkey AS customer_id,
               CASE o_orderkey % 7 WHEN 0 THEN 'hl' WHEN 1 THEN 'PERSONAL' WHEN 2 THEN 'Car' WHEN 3 THEN 'BL' WHEN 4 THEN 'ED' WHEN 5 THEN 'GOLD' ELSE 'other' END AS loan_type,
               o_totalprice::DECIMAL(18,2) AS principal_amount,
               (o_totalprice::DECIMAL(18,2) - (o_orderkey % 100) * 1000)::DECIMAL(18,2) AS principal_outstanding,
               (o_orderkey % 20 + 5)::DECIMAL(5,2) AS interest_rate, (12 * (o_orderkey % 5 + 1))::INT AS tenure_months,
               floor(o_totalprice / (12 * (o_orderkey % 5 + 1)))::DECIMAL(18,2) AS emi_amount,
               o_orderdate::DATE AS disbursement_date,
               (o_orderdate + to_months((12 * (o_orderkey % 5 + 1))::INT))::DATE AS maturity_date,
               o_orderdate::DATE AS last_updated
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "b_loan_payments": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payment_id, l_orderkey AS loan_id,
               l_shipdate::DATE AS payment_date, l_extendedprice::DECIMAL(18,2) AS amount,
               CASE l_linenumber % 6 WHEN 0 THEN 'auto-debit' WHEN 1 THEN 'NEFT' WHEN 2 THEN 'CHQ' WHEN 3 THEN 'cash' WHEN 4 THEN 'UPI' ELSE 'wire' END AS payment_mode,
               CASE l_returnflag WHEN 'A' THEN 'cleared' WHEN 'N' THEN 'PROCESSING' WHEN 'R' THEN 'bounced' ELSE '?' END AS status
        FROM lineitem""",
    "b_cards": """
        SELECT lpad(c_custkey::VARCHAR, 16, '0') AS card_number, c_custkey AS customer_id,
               CASE c_custkey % 5 WHEN 0 THEN 'visa' WHEN 1 THEN ' MC' WHEN 2 THEN 'Amex' WHEN 3 THEN 'RUPAY' ELSE 'diners' END AS card_type,
               (20000 + (c_custkey % 10) * 5000)::DECIMAL(18,2) AS card_limit, greatest(c_acctbal::DECIMAL(18,2), 0::DECIMAL(18,2)) AS credit_used,
               DATE '2001-01-01' + (c_custkey % 1000)::INT AS expiry_date,
               CASE WHEN c_custkey % 17 = 0 THEN 'blocked' ELSE 'active ' END AS status,
               DATE '2001-01-01' + (c_custkey % 200)::INT AS last_updated
        FROM customer""",
    "b_card_txns": """
        SELECT event_id AS txn_id, lpad(user_id::VARCHAR, 16, '0') AS card_number, ' M' || (event_id % 20)::VARCHAR AS merchant_name,
               CASE event_type WHEN 'view' THEN 'online' WHEN 'purchase' THEN 'grocery' WHEN 'click' THEN 'travel ' WHEN 'signup' THEN 'fuel' ELSE 'electronics' END AS merchant_category,
               value::DECIMAL(18,2) AS amount, 'vnd' AS currency, ts::DATE AS txn_date, ts AS txn_timestamp,
               CASE event_type WHEN 'purchase' THEN 'SALE' WHEN 'click' THEN 'refund' WHEN 'signup' THEN 'CASHBACK' ELSE 'x' END AS txn_type,
               CASE WHEN event_type = 'error' THEN 'declined' ELSE 'success' END AS status
        FROM events""",
    "b_bench": """
        SELECT event_id AS transaction_id, 'CARD-' || user_id::VARCHAR AS card_id, user_id % 100 AS customer_id,
               value::DECIMAL(18,2) AS transaction_amount,
               CASE WHEN event_id % 4 = 0 THEN 'PAYMENT' ELSE 'PURCHASE' END AS transaction_type,
               'M' || (event_id % 20)::VARCHAR AS merchant_name,
               CASE event_type WHEN 'view' THEN 'ELECTRONICS' WHEN 'purchase' THEN 'GROCERY' WHEN 'click' THEN 'TRAVEL' WHEN 'signup' THEN 'GAMBLING' ELSE 'FUEL' END AS merchant_category,
               CASE user_id % 3 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' ELSE 'AMEX' END AS card_type,
               ts AS transaction_date, CASE WHEN event_type = 'error' THEN 'DECLINED' ELSE 'POSTED' END AS status
        FROM events""",
    "b_lines": """
        SELECT *, l_extendedprice::DECIMAL(12,2) AS price,
               (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(18,4) AS revenue, l_shipdate::DATE AS ship_date
        FROM lineitem""",
    "b_snap_old": """
        SELECT c_custkey AS customer_id, c_name AS name, c_nationkey::INT AS nation, c_acctbal::DECIMAL(18,2) AS balance, c_mktsegment AS segment FROM customer""",
    "b_snap_new": """
        SELECT customer_id, name, CASE WHEN customer_id % 7 = 0 THEN (nation + 1) % 25 ELSE nation END AS nation,
               CASE WHEN customer_id % 11 <> 0 THEN balance END AS balance, segment
        FROM b_snap_old WHERE customer_id % 13 <> 0
        UNION ALL SELECT customer_id + 100000000, 'New ' || name, nation, balance, segment FROM b_snap_old WHERE customer_id % 17 = 0""",
    "s_customers": """
        SELECT customer_id, upper(trim(customer_name)) AS customer_name, dob AS date_of_birth,
               CASE upper(gender) WHEN 'M' THEN 'MALE' WHEN 'FEMALE' THEN 'FEMALE' ELSE 'OTHER' END AS gender,
               upper(nationality) AS nationality, pan_number,
               CASE WHEN regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$') THEN lower(trim(email)) END AS email,
               CASE WHEN regexp_matches(phone, '^[0-9]{10,15}$') THEN phone END AS phone, city, region, segment, created_date, last_updated
        FROM b_customers""",
    "s_accounts": """
        SELECT account_id, customer_id,
               CASE upper(trim(account_type)) WHEN 'SAV' THEN 'SAVINGS' WHEN 'CURRENT' THEN 'CURRENT' WHEN 'FD' THEN 'FIXED_DEPOSIT' WHEN 'RD' THEN 'RECURRING_DEPOSIT' ELSE 'OTHER' END AS account_type_standardized,
               opening_date, greatest(current_balance, 0::DECIMAL(18,2)) AS current_balance, greatest(available_balance, 0::DECIMAL(18,2)) AS available_balance,
               least(available_balance, greatest(current_balance, 0::DECIMAL(18,2))) AS available_balance_safe,
               CASE upper(trim(status)) WHEN 'ACTIVE' THEN 'ACTIVE' WHEN 'C' THEN 'CLOSED' WHEN 'D' THEN 'DORMANT' WHEN 'FROZEN' THEN 'FROZEN' ELSE 'UNKNOWN' END AS status_standardized,
               branch_code, last_updated
        FROM b_accounts WHERE opening_date <= DATE '2001-08-02'""",
    "s_transactions": """
        SELECT txn_id, account_id, CASE upper(trim(txn_type)) WHEN 'CR' THEN 'CREDIT' WHEN 'WITHDRAWAL' THEN 'DEBIT' WHEN 'TRF' THEN 'TRANSFER' ELSE 'OTHER' END AS txn_type_standardized,
               amount, txn_date, txn_timestamp, description,
               CASE upper(channel) WHEN 'ATM' THEN 'ATM' WHEN 'APP' THEN 'MOBILE' WHEN 'WEB' THEN 'ONLINE' WHEN 'COUNTER' THEN 'BRANCH' WHEN 'UPI' THEN 'UPI' ELSE 'OTHER' END AS channel_standardized,
               status, dayofweek(txn_date) IN (0, 6) AS is_weekend,
               CASE WHEN hour(txn_timestamp) BETWEEN 6 AND 11 THEN 'MORNING' WHEN hour(txn_timestamp) BETWEEN 12 AND 17 THEN 'AFTERNOON' WHEN hour(txn_timestamp) BETWEEN 18 AND 22 THEN 'EVENING' ELSE 'NIGHT' END AS time_bucket
        FROM b_transactions WHERE amount > 0 AND txn_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-02'""",
    "s_cards": """
        SELECT card_number, customer_id, CASE upper(trim(card_type)) WHEN 'VISA' THEN 'VISA' WHEN 'MC' THEN 'MASTERCARD' WHEN 'AMEX' THEN 'AMEX' WHEN 'RUPAY' THEN 'RUPAY' ELSE 'OTHER' END AS card_brand,
               card_limit, credit_used, 'XXXX-XXXX-XXXX-' || right(card_number, 4) AS card_number_masked, greatest(card_limit - credit_used, 0) AS available_credit,
               credit_used::DOUBLE * 100.0::DOUBLE / nullif(card_limit::DOUBLE, 0) AS utilization_pct, expiry_date, upper(trim(status)) AS status, last_updated
        FROM b_cards WHERE card_limit > 0 AND expiry_date > DATE '2001-08-02'""",
    "s_loans": """
        SELECT loan_id, customer_id,
               CASE upper(loan_type) WHEN 'HL' THEN 'HOME_LOAN' WHEN 'PERSONAL' THEN 'PERSONAL_LOAN' WHEN 'CAR' THEN 'CAR_LOAN' WHEN 'BL' THEN 'BUSINESS_LOAN' WHEN 'ED' THEN 'EDUCATION_LOAN' WHEN 'GOLD' THEN 'GOLD_LOAN' ELSE 'OTHER' END AS loan_type_standardized,
               principal_amount, greatest(principal_outstanding, 0::DECIMAL(18,2)) AS principal_outstanding, interest_rate,
               CASE WHEN interest_rate < 8 THEN 'LOW' WHEN interest_rate <= 12 THEN 'MEDIUM' ELSE 'HIGH' END AS interest_rate_band,
               tenure_months, emi_amount, disbursement_date, maturity_date, CASE WHEN maturity_date >= DATE '2001-08-02' THEN 'ACTIVE' ELSE 'MATURED' END AS loan_status, last_updated
        FROM b_loans WHERE principal_amount > 0 AND interest_rate > 0 AND interest_rate < 30""",
    "s_payments": """
        SELECT payment_id, loan_id, payment_date, amount,
               CASE upper(payment_mode) WHEN 'AUTO-DEBIT' THEN 'AUTO_DEBIT' WHEN 'NEFT' THEN 'BANK_TRANSFER' WHEN 'CHQ' THEN 'CHEQUE' WHEN 'CASH' THEN 'CASH' WHEN 'UPI' THEN 'UPI' ELSE 'OTHER' END AS payment_mode_standardized,
               CASE upper(status) WHEN 'CLEARED' THEN 'SUCCESS' WHEN 'PROCESSING' THEN 'PENDING' WHEN 'BOUNCED' THEN 'FAILED' ELSE 'UNKNOWN' END AS status_standardized
        FROM b_loan_payments WHERE amount > 0 AND payment_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-02'""",
    "s_card_txns": """
        SELECT txn_id, card_number, trim(merchant_name) AS merchant_name, upper(trim(merchant_category)) AS merchant_category, amount, txn_date, txn_timestamp,
               CASE upper(txn_type) WHEN 'SALE' THEN 'PURCHASE' WHEN 'REFUND' THEN 'REFUND' WHEN 'CASHBACK' THEN 'CASHBACK' ELSE 'OTHER' END AS txn_type_standardized,
               amount > 150 AS high_value_flag, hour(txn_timestamp) BETWEEN 0 AND 5 AS unusual_time_flag, dayofweek(txn_date) IN (0, 6) AS weekend_flag, upper(status) AS status
        FROM b_card_txns WHERE amount > 0 AND txn_date BETWEEN DATE '2020-01-01' AND DATE '2024-01-31'""",
    "m_c360": """
        SELECT customer_id, customer_name, email, phone, city, region, coalesce(an, 0) AS total_accounts, coalesce(sv, 0) AS savings_accounts, coalesce(cu, 0) AS current_accounts, coalesce(bal, 0) AS total_balance, coalesce(av, 0) AS total_available_balance,
               coalesce(kn, 0) AS total_cards, coalesce(lim, 0) AS total_card_limit, coalesce(used, 0) AS total_card_outstanding, coalesce(used * 100.0::DOUBLE / lim, 0) AS avg_card_utilization_pct,
               coalesce(ln, 0) AS total_loans, coalesce(la, 0) AS total_loan_amount, coalesce(lo, 0) AS total_loan_outstanding, coalesce(emi, 0) AS total_monthly_emi,
               coalesce(tn, 0) AS txn_count_30d, coalesce(tc, 0) AS total_credits_30d, coalesce(td, 0) AS total_debits_30d,
               coalesce(bal, 0) + coalesce(lim, 0) - coalesce(lo, 0) AS net_relationship_value,
               CASE WHEN coalesce(lo, 0) > 500000 THEN 'HIGH' WHEN coalesce(lo, 0) > 200000 THEN 'MEDIUM' ELSE 'LOW' END AS credit_exposure_band,
               CASE WHEN coalesce(bal, 0) + coalesce(lim, 0) - coalesce(lo, 0) >= 60000 THEN 'PLATINUM' WHEN coalesce(bal, 0) + coalesce(lim, 0) - coalesce(lo, 0) >= 40000 THEN 'GOLD' WHEN coalesce(bal, 0) + coalesce(lim, 0) - coalesce(lo, 0) >= 10000 THEN 'SILVER' ELSE 'STANDARD' END AS customer_segment,
               CASE WHEN coalesce(tn, 0) > 1 THEN 'HIGH' WHEN coalesce(tn, 0) > 0 THEN 'MEDIUM' ELSE 'LOW' END AS engagement_level
        FROM s_customers
        LEFT JOIN (SELECT customer_id, count(*) AS an, count(*) FILTER (WHERE account_type_standardized = 'SAVINGS') AS sv, count(*) FILTER (WHERE account_type_standardized = 'CURRENT') AS cu, sum(current_balance)::DOUBLE AS bal, sum(available_balance)::DOUBLE AS av FROM s_accounts GROUP BY 1) USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) AS kn, sum(card_limit)::DOUBLE AS lim, sum(credit_used)::DOUBLE AS used FROM s_cards GROUP BY 1) USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) AS ln, sum(principal_amount)::DOUBLE AS la, sum(principal_outstanding)::DOUBLE AS lo, sum(emi_amount)::DOUBLE AS emi FROM s_loans GROUP BY 1) USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) AS tn, (sum(amount) FILTER (WHERE txn_type_standardized = 'CREDIT'))::DOUBLE AS tc, (sum(amount) FILTER (WHERE txn_type_standardized = 'DEBIT'))::DOUBLE AS td FROM s_transactions JOIN s_accounts USING (account_id) WHERE txn_date >= DATE '2001-07-03' GROUP BY 1) USING (customer_id)""",
    "f_high": """
        SELECT txn_id, card_number, customer_id, merchant_name, merchant_category, amount, txn_timestamp, 'HIGH_VALUE' AS rule_name, CASE WHEN amount > 300 THEN 'CRITICAL' WHEN amount > 200 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               'Transaction amount VND ' || format('{:,}', floor(amount)::BIGINT) || ' exceeds threshold' AS description
        FROM s_card_txns t JOIN b_cards USING (card_number) WHERE t.status = 'SUCCESS' AND amount > 150""",
    "f_velocity": """
        SELECT NULL::BIGINT AS txn_id, card_number, customer_id, NULL::VARCHAR AS merchant_name, NULL::VARCHAR AS merchant_category, amt AS amount, NULL::TIMESTAMP AS txn_timestamp, 'VELOCITY' AS rule_name,
               CASE WHEN n > 4 THEN 'CRITICAL' WHEN n > 3 THEN 'HIGH' WHEN n > 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity, 'Card has ' || n || ' transactions in window' AS description
        FROM (SELECT card_number, count(*) AS n, sum(amount) AS amt FROM s_card_txns WHERE txn_timestamp BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1 HAVING count(*) > 1) JOIN b_cards USING (card_number)""",
    "f_time": """
        SELECT txn_id, card_number, customer_id, merchant_name, merchant_category, amount, txn_timestamp, 'UNUSUAL_TIME' AS rule_name, CASE WHEN hour(txn_timestamp) <= 3 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               'Transaction at ' || hour(txn_timestamp) || ':' || minute(txn_timestamp) || ' (unusual hours)' AS description
        FROM s_card_txns t JOIN b_cards USING (card_number) WHERE t.status = 'SUCCESS' AND hour(txn_timestamp) BETWEEN 0 AND 5 AND amount > 50""",
    "f_cnp": """
        SELECT txn_id, card_number, customer_id, merchant_name, merchant_category, amount, txn_timestamp, 'CNP_PATTERN' AS rule_name,
               CASE WHEN m IS NULL OR amount::DOUBLE > m * 3 THEN 'HIGH' WHEN amount::DOUBLE > m * 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
               CASE WHEN m IS NULL THEN 'No online transaction history' WHEN amount::DOUBLE > m * 3 THEN 'Amount 3x above average' WHEN amount::DOUBLE > m * 2 THEN 'Amount 2x above average' ELSE 'Within normal range' END AS description
        FROM s_card_txns JOIN b_cards USING (card_number) LEFT JOIN (SELECT card_number, sum(amount)::DOUBLE / count(*) AS m FROM s_card_txns WHERE merchant_category = 'ONLINE' AND txn_date >= DATE '2024-01-01' GROUP BY 1) USING (card_number)
        WHERE merchant_category = 'ONLINE' AND amount > 30 AND txn_timestamp BETWEEN TIMESTAMP '2024-01-21 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'""",
    "f_geo": """
        SELECT txn_id, card_number, customer_id, merchant_name, merchant_category, amount, txn_timestamp, 'GEO_ANOMALY' AS rule_name, 'MEDIUM' AS severity, 'First-time merchant category: ' || merchant_category AS description
        FROM s_card_txns t JOIN b_cards USING (card_number) WHERE txn_timestamp BETWEEN TIMESTAMP '2024-01-11 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'
          AND NOT EXISTS (SELECT 1 FROM s_card_txns z WHERE z.card_number = t.card_number AND z.merchant_category = t.merchant_category AND (z.txn_timestamp < t.txn_timestamp OR (z.txn_timestamp = t.txn_timestamp AND z.txn_id < t.txn_id)))""",
    "f_score": """
        SELECT *, CASE WHEN rule_count >= 3 OR max_severity_score = 4 THEN 'BLOCK' WHEN rule_count >= 2 OR max_severity_score = 3 THEN 'REVIEW' ELSE 'MONITOR' END AS recommended_action, rule_count * 10 + max_severity_score * 10 AS fraud_score,
               coalesce(txn_timestamp + INTERVAL 10 MINUTES, TIMESTAMP '2024-01-31 00:00:00') AS evaluated_at
        FROM (SELECT txn_id, card_number, customer_id, merchant_name, merchant_category, amount, txn_timestamp, string_agg(rule_name, ', ' ORDER BY rule_name) AS triggered_rules, count(*) AS rule_count,
                     max(CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END)::BIGINT AS max_severity_score
              FROM (SELECT * FROM f_high UNION ALL SELECT * FROM f_velocity UNION ALL SELECT * FROM f_time UNION ALL SELECT * FROM f_cnp UNION ALL SELECT * FROM f_geo) GROUP BY ALL)""",
}
