"""Masking, access, erasure, audit, lineage, layout and platform tables."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import governance as G
from finquarry.operators import layout as L
from finquarry.operators import lineage as N
from finquarry.operators import quality as Q
from finquarry.operators import relational as R
from finquarry.operators import skew
from finquarry.operators import vectors as V
from finquarry.plans import q_customer
from finquarry.plans.q_quality import daily_scores
from finquarry.plans.registry import query
from finquarry.session import run_folder
from finquarry.sources import files
from finquarry.sources.banking import AS_OF, EVENTS_AS_OF, money
from finquarry.sources.clean import Clean

# --- masking -----------------------------------------------------------------------------------------


def people(b):
    return Clean(b).customers.select("customer_id", "customer_name", "pan_number", "email", "phone")


_TAIL = "repeat('X', greatest(length({c}) - 4, 0)) || right({c}, 4)"
_MAIL = "CASE WHEN position('@' IN email) > 0 THEN left(email, 2) || '***' || substring(email, position('@' IN email)) WHEN email IS NULL THEN '***' ELSE '***' END"
_NAME = "left(customer_name, 1) || repeat('*', length(customer_name) - 1)"


@query("mask_for_analyst", f"SELECT customer_id, {_NAME} AS customer_name, {_TAIL.format(c='pan_number')} AS pan_number, {_MAIL} AS email, {_TAIL.format(c='phone')} AS phone FROM s_customers")
def _(b):
    return G.mask_for_role(people(b), "ANALYST")


@query("mask_for_manager", f"SELECT customer_id, customer_name, {_TAIL.format(c='pan_number')} AS pan_number, email, {_TAIL.format(c='phone')} AS phone FROM s_customers")
def _(b):
    return G.mask_for_role(people(b), "BRANCH_MANAGER")


@query("mask_for_compliance", "SELECT customer_id, customer_name, pan_number, email, phone FROM s_customers")
def _(b):
    return G.mask_for_role(people(b), "COMPLIANCE")


@query("mask_static", f"SELECT customer_id, {_NAME} AS customer_name, {_TAIL.format(c='pan_number')} AS pan_number, {_MAIL} AS email, {_TAIL.format(c='phone')} AS phone FROM s_customers")
def _(b):
    return G.mask_static(people(b), {"customer_name": "name", "pan_number": "tail", "email": "email", "phone": "tail"})


@query("mask_card_number", "SELECT customer_id, 'XXXX-XXXX-XXXX-' || right(card_number, 4) AS card FROM b_cards")
def _(b):
    return b.cards().select("customer_id", X.mask_card("card_number").alias("card"))


@query("mask_document_emails", "SELECT doc_id, regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+', '[EMAIL]', 'g') AS text FROM documents")
def _(b):
    return b.table("documents").select("doc_id", F.regexp_replace("text", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+", "[EMAIL]").alias("text"))


@query("tokenize", "SELECT customer_id, sha256('s1' || pan_number) AS pan_number FROM s_customers")
def _(b):
    return G.tokenize(people(b), "pan_number", "s1")[0].select("customer_id", "pan_number")


@query("detokenize", "SELECT customer_id, pan_number FROM s_customers")
def _(b):
    rows, vault = G.tokenize(people(b), "pan_number", "s1")
    return G.detokenize(rows, "pan_number", vault).select("customer_id", "pan_number")


@query("pseudonymise", "SELECT sha256('2:k1' || sha256('2:k1' || length(customer_id::VARCHAR) || ':' || customer_id::VARCHAR)) AS customer_id, customer_name FROM s_customers")
def _(b):
    return G.pseudonymise(people(b), "customer_id", "k1", ["pan_number", "email", "phone"])


_KEY = "0123456789abcdef"


@query("encrypt_column")
def _(b):
    """Random initialisation vectors: the cipher text differs from run to run."""
    return G.encrypt_columns(people(b), ["pan_number"], _KEY).select("customer_id", "pan_number")


@query("decrypt_column", "SELECT customer_id, pan_number, '[DECRYPTION_ERROR]' AS wrong_key FROM s_customers")
def _(b):
    e = G.encrypt_columns(people(b).withColumn("wrong_key", F.col("pan_number")), ["pan_number", "wrong_key"], _KEY)
    return G.decrypt_columns(G.decrypt_columns(e, ["pan_number"], _KEY), ["wrong_key"], "fedcba9876543210").select("customer_id", "pan_number", "wrong_key")


# --- row filters -------------------------------------------------------------------------------------------


def grants(b):
    """One user per kind of grant, from the branch table."""
    n, r = b.table("nation"), b.table("region")
    br = n.join(r, n.n_regionkey == r.r_regionkey)
    mk = lambda user, scope, rows: rows.select(F.lit(user).alias("user_id"), F.lit(scope).alias("scope"), F.col("n_nationkey").alias("branch_code"), F.col("r_name").alias("region"))
    return mk("u_branch", "BRANCH", br.filter("n_nationkey = 4")).unionByName(mk("u_region", "REGION", br.filter("r_name = 'ASIA'"))).unionByName(mk("u_all", "ENTERPRISE", br.filter("n_nationkey = 0")))


def assignments(b):
    k = F.col("c_custkey")
    return b.table("customer").select(F.concat(F.lit("rm"), (k % 5).cast("string")).alias("user_id"), k.alias("customer_id"), F.lit("2000-01-01").cast("date").alias("start_date"), F.when(k % 3 == 0, F.lit("2001-01-01").cast("date")).alias("end_date"))


def located(b):
    n, r = b.table("nation"), b.table("region")
    place = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("branch_code"), F.col("r_name").alias("region"))
    return Clean(b).accounts.select("account_id", "customer_id", "branch_code").join(place, "branch_code")


_LOC = "SELECT account_id, customer_id, branch_code::BIGINT AS branch_code, r_name AS region FROM s_accounts JOIN nation ON branch_code = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _branch(name, user, where):
    @query(name, f"{_LOC} WHERE {where}")
    def _(b):
        return G.rows_for_branch(located(b), grants(b), user)


for _n, _u, _w in (("rls_branch", "u_branch", "branch_code = 4"), ("rls_region", "u_region", "r_name = 'ASIA'"), ("rls_enterprise", "u_all", "true")):
    _branch(_n, _u, _w)


@query("rls_customer_assignment", "SELECT customer_id FROM s_customers WHERE customer_id % 5 = 2 AND customer_id % 3 <> 0")
def _(b):
    return G.rows_for_customer(Clean(b).customers.select("customer_id"), assignments(b), "rm2", ["RELATIONSHIP_MANAGER"], AS_OF)


@query("rls_transactions", "SELECT txn_id FROM s_transactions JOIN s_accounts USING (account_id) WHERE customer_id % 5 = 1 AND customer_id % 3 <> 0")
def _(b):
    return G.rows_for_transactions(Clean(b).transactions, located(b), grants(b), assignments(b), "rm1", AS_OF).select("txn_id")


@query("rbac_classification", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'INTERNAL' WHEN 2 THEN 'CONFIDENTIAL' ELSE 'RESTRICTED' END AS classification FROM documents WHERE doc_id % 4 < 2")
def _(b):
    names = ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"]
    docs = b.table("documents").select("doc_id", F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("doc_id") % 4 + 1).cast("int")).alias("classification"))
    allowed = {"ANALYST": names[:2], "OFFICER": names}
    matrix = docs.select("classification").distinct().withColumn("role", F.explode(F.array(*[F.lit(r) for r in allowed])))
    matrix = matrix.filter(F.when(F.col("role") == "ANALYST", F.col("classification").isin(*allowed["ANALYST"])).otherwise(True))
    return G.rows_for_role(docs, matrix, "ANALYST")


@query("abac_predicate", "SELECT doc_id, source FROM documents WHERE lang = 'en' AND n_chars < 5000 AND source <> 'src1'")
def _(b):
    return G.rows_by_attributes(b.table("documents"), [F.col("lang") == "en", F.col("n_chars") < 5000, F.col("source") != "src1"]).select("doc_id", "source")


@query("role_inheritance", "WITH RECURSIVE e AS (SELECT c_custkey AS child, c_custkey // 8 AS parent FROM customer WHERE c_custkey > 0), w AS (SELECT child AS root, parent AS node, 1 AS d FROM e UNION ALL SELECT root, parent, d + 1 FROM w JOIN e ON w.node = e.child) SELECT root, node, min(d)::BIGINT AS distance FROM w GROUP BY ALL")
def _(b):
    """Staff tree by number: everybody inherits the grants of the people above."""
    k = F.col("c_custkey")
    e = b.table("customer").filter(k > 0).select(k.alias("child"), F.floor(k / 8).alias("parent"))
    return N.closure(e, "child", "parent")


# --- erasure, consent, retention, audit ----------------------------------------------------------------------


@query("erasure_request", "SELECT 'customer' AS table_name, count(*) AS kept FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def _(b):
    ids = b.table("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    left = G.erase({"customer": (b.table("customer"), "c_custkey"), "orders": (b.table("orders"), "o_custkey")}, ids)
    count = lambda n: left[n].agg(F.count("*").alias("kept")).select(F.lit(n).alias("table_name"), "kept")
    return count("customer").unionByName(count("orders"))


@query("export_subject", "SELECT c_custkey, '{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"c_mktsegment\":\"' || c_mktsegment || '\"}' AS payload FROM customer")
def _(b):
    """Every customer's own export at once."""
    c = b.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey", F.to_json(F.struct(*c.columns)).alias("payload"))


@query("consent_filter", "SELECT customer_id FROM s_customers WHERE customer_id % 2 = 0 AND customer_id % 5 <> 0")
def _(b):
    k = F.col("c_custkey")
    consents = b.table("customer").select(k.alias("customer_id"), F.lit("marketing").alias("purpose"), (k % 2 == 0).alias("granted"), F.when(k % 5 == 0, F.lit("2001-01-01")).otherwise(F.lit("2003-01-01")).cast("date").alias("expires_on"))
    return G.with_consent(Clean(b).customers.select("customer_id"), consents, "marketing", AS_OF)


def _aged(name, labels, small_d, large_d, fn):
    @query(name, f"SELECT o_orderkey, CASE WHEN DATE '2001-08-02' - o_orderdate::DATE > {large_d} THEN '{labels[2]}' WHEN DATE '2001-08-02' - o_orderdate::DATE > {small_d} THEN '{labels[1]}' ELSE '{labels[0]}' END AS label FROM orders")
    def _(b):
        return b.table("orders").select("o_orderkey", fn(F.col("o_orderdate").cast("date"), AS_OF, small_d, large_d).alias("label"))


_aged("retention_due", ("KEEP", "ARCHIVE", "DELETE"), 730, 1825, G.retention_action)
_aged("tier_storage", ("HOT", "WARM", "COLD"), 90, 365, G.storage_tier)


@query("audit_row_changes", "SELECT coalesce(o.customer_id, n.customer_id) AS customer_id, CASE WHEN o.customer_id IS NULL THEN 'INSERT' WHEN n.customer_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation, '{\"nation\":' || o.nation || '}' AS old_values, '{\"nation\":' || n.nation || '}' AS new_values FROM b_snap_old o FULL JOIN b_snap_new n ON o.customer_id = n.customer_id WHERE o.nation IS DISTINCT FROM n.nation")
def _(b):
    cols = ["customer_id", "nation"]
    return G.audit_changes(b.snapshot_old().select(*cols), b.snapshot_new().select(*cols), "customer_id")


def access_log(b):
    return b.table("events").select("user_id", "ts", F.col("event_type").alias("action"), F.concat(F.lit("obj"), (F.col("event_id") % 7).cast("string")).alias("object"), (F.col("event_id") % 10 != 0).alias("ok"))


@query("audit_daily_access", "SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS accesses, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS actions, count(*) FILTER (WHERE event_id % 10 = 0) AS failed, CASE WHEN count(*) > 10 THEN 'HIGH' WHEN count(*) > 3 THEN 'MEDIUM' ELSE 'LOW' END AS volume_level FROM events GROUP BY 1, 2")
def _(b):
    return G.access_per_day(access_log(b))


@query("audit_hourly_summary", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type AS action, count(*) AS accesses, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2")
def _(b):
    return G.access_per_hour(access_log(b))


@query("audit_failed_attempts", "SELECT user_id, count(*) AS failed, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts FROM events WHERE event_id % 10 = 0 GROUP BY 1 HAVING count(*) >= 5")
def _(b):
    return G.failed_attempts(access_log(b), 5)


@query("audit_compliance", "SELECT event_type AS action, count(*) AS accesses, count(*) FILTER (WHERE event_id % 10 <> 0) * 100.0::DOUBLE / count(*) AS success_pct FROM events GROUP BY 1")
def _(b):
    return G.compliance_summary(access_log(b))


@query("audit_pii_report", "SELECT 'obj' || (event_id % 7) AS object, count(*) AS accesses, count(DISTINCT user_id) AS users FROM events WHERE event_id % 7 < 3 GROUP BY 1")
def _(b):
    return access_log(b).filter(F.col("object").isin("obj0", "obj1", "obj2")).groupBy("object").agg(F.count("*").alias("accesses"), F.countDistinct("user_id").alias("users"))


@query("audit_trail", "SELECT user_id, 'obj' || (event_id % 7) AS object, count(*) AS accesses, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_access FROM events GROUP BY ALL")
def _(b):
    return access_log(b).groupBy("user_id", "object").agg(F.count("*").alias("accesses"), F.max("ts").alias("last_access"))


# --- lineage --------------------------------------------------------------------------------------------------


def nodes(b):
    k = F.col("p_partkey")
    return b.table("part").select(k.alias("node_id"), F.concat(F.lit("n"), k.cast("string")).alias("node_name"), F.element_at(F.array(*[F.lit(x) for x in ("TABLE", "VIEW", "REPORT", "DASHBOARD")]), (k % 4 + 1).cast("int")).alias("node_type"), F.col("p_brand").alias("table_name"), F.col("p_type").alias("column_name"), F.concat(F.lit("S"), (k % 3).cast("string")).alias("source_system"), (F.col("p_size") < 5).alias("is_pii"), F.when(k % 50 == 7, "INACTIVE").otherwise("ACTIVE").alias("status"))


def edges(b):
    """A forest over the parts, cross links, a few back links (cycles) and a few broken ones."""
    k = F.col("p_partkey")
    p = b.table("part")
    mk = lambda rows, off, s, t: rows.select((k * 4 + off).alias("edge_id"), s.alias("source_node_id"), t.alias("target_node_id"))
    e = mk(p.filter(k >= 4), 0, F.floor(k / 4), k).unionByName(mk(p.filter((k >= 7) & (k % 3 == 0)), 1, F.floor(k / 7), k))
    e = e.unionByName(mk(p.filter((k >= 4) & (k % 97 == 13)), 2, k, F.floor(k / 4))).unionByName(mk(p.filter(k % 200 == 5), 3, k, k + 1000000000))
    i = F.col("edge_id")
    return e.withColumns({"edge_type": F.concat(F.lit("T"), (i % 3).cast("string")), "lineage_level": F.when(i % 8 < 4, "COLUMN").otherwise("TABLE"), "process_name": F.concat(F.lit("P"), (F.floor(i / 4) % 10).cast("string")), "status": F.when(F.floor(i / 4) % 40 == 11, "DEPRECATED").otherwise("ACTIVE")})


GRAPH = """nd AS (SELECT p_partkey AS node_id, 'n' || p_partkey AS node_name, CASE p_partkey % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'REPORT' ELSE 'DASHBOARD' END AS node_type, p_brand AS table_name, p_type AS column_name, 'S' || (p_partkey % 3) AS source_system, p_size < 5 AS is_pii, CASE WHEN p_partkey % 50 = 7 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status FROM part),
    ed0 AS (SELECT p_partkey * 4 AS edge_id, p_partkey // 4 AS s, p_partkey AS t FROM part WHERE p_partkey >= 4 UNION ALL SELECT p_partkey * 4 + 1, p_partkey // 7, p_partkey FROM part WHERE p_partkey >= 7 AND p_partkey % 3 = 0 UNION ALL SELECT p_partkey * 4 + 2, p_partkey, p_partkey // 4 FROM part WHERE p_partkey >= 4 AND p_partkey % 97 = 13 UNION ALL SELECT p_partkey * 4 + 3, p_partkey, p_partkey + 1000000000 FROM part WHERE p_partkey % 200 = 5),
    ed AS (SELECT *, 'T' || (edge_id % 3) AS edge_type, CASE WHEN edge_id % 8 < 4 THEN 'COLUMN' ELSE 'TABLE' END AS lineage_level, 'P' || (edge_id // 4 % 10) AS process_name, CASE WHEN edge_id // 4 % 40 = 11 THEN 'DEPRECATED' ELSE 'ACTIVE' END AS status FROM ed0),
    an AS (SELECT * FROM nd WHERE status = 'ACTIVE'), ae AS (SELECT * FROM ed WHERE status = 'ACTIVE'), cx AS (SELECT ae.*, a.node_name AS sn, a.table_name AS st, a.column_name AS sc, a.source_system AS ss, a.is_pii AS sp, z.node_name AS tn, z.node_type AS ty, z.table_name AS tt, z.column_name AS tc, z.is_pii AS tp FROM ae JOIN an a ON s = a.node_id JOIN an z ON t = z.node_id) """


@query("lineage_complete", f"WITH {GRAPH} SELECT edge_id, sn AS source_node_name, st AS source_table_name, edge_type, lineage_level, tn AS target_node_name, tt AS target_table_name FROM cx")
def _(b):
    return N.connections(nodes(b), edges(b)).select("edge_id", "source_node_name", "source_table_name", "edge_type", "lineage_level", "target_node_name", "target_table_name")


def _reach(name, upstream, most=None):
    a, z = ("t", "s") if upstream else ("s", "t")

    @query(name, f"WITH RECURSIVE {GRAPH}, w AS (SELECT node_id AS root, node_id AS node, 0::BIGINT AS depth, [node_id] AS path FROM an WHERE table_name = 'Brand#2' UNION ALL SELECT root, {z}, depth + 1, list_append(path, {z}) FROM w JOIN ae ON w.node = {a} JOIN an ON an.node_id = {z} WHERE NOT list_contains(path, {z}){f' AND depth < {most}' if most else ''}) SELECT root, node, depth, list_aggregate(path, 'string_agg', '>') AS path FROM w")
    def _(b):
        start = nodes(b).filter("status = 'ACTIVE' AND table_name = 'Brand#2'")
        out = N.reach(nodes(b), edges(b), start, upstream, most)
        return out.select("root", "node", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


_reach("lineage_upstream", True, 10)
_reach("lineage_downstream", False)


def _nearest_sql(start, upstream, columns, tail=""):
    a, z = ("t", "s") if upstream else ("s", "t")
    # all simple paths, of which the shortest and then the smallest counts; deep enough for the given graph
    walk = f"w AS (SELECT node_id AS root, node_id AS node, 0::BIGINT AS depth, [node_id] AS path FROM an WHERE {start} UNION ALL SELECT root, {z}, depth + 1, list_append(path, {z}) FROM w JOIN ae ON w.node = {a} JOIN an ON an.node_id = {z} WHERE NOT list_contains(path, {z}))"
    return f"WITH RECURSIVE {GRAPH}, {walk}, b AS (SELECT root, node, min(depth) AS depth, min_by(path, (depth, path)) AS path FROM w GROUP BY ALL) SELECT {columns} FROM b {tail}"


def _nearest(name, upstream):
    @query(name, _nearest_sql("table_name = 'Brand#2'", upstream, "root, node, depth, path[-2] AS parent, list_aggregate(path, 'string_agg', '>') AS path"))
    def _(b):
        """One row for everything the table's columns reach, with its distance and the node before it."""
        out = N.nearest(nodes(b), edges(b), nodes(b).filter("status = 'ACTIVE' AND table_name = 'Brand#2'"), upstream)
        return out.select("root", "node", "depth", "parent", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


_nearest("lineage_upstream_nearest", True)
_nearest("lineage_downstream_nearest", False)


@query("lineage_impact_nearest", _nearest_sql("column_name = 'ECONOMY'", False, "CASE depth WHEN 1 THEN 'DIRECT IMPACT' WHEN 2 THEN 'SECONDARY IMPACT' ELSE 'TERTIARY IMPACT' END AS impact, table_name, count(*) AS nodes", "JOIN an ON node = node_id WHERE depth > 0 GROUP BY ALL"))
def _(b):
    n = nodes(b)
    out = N.nearest(n, edges(b), n.filter("status = 'ACTIVE' AND column_name = 'ECONOMY'"), False).filter("depth > 0")
    return N.described(out, n, "table_name").groupBy(N.impact_label(F.col("depth")).alias("impact"), "table_name").agg(F.count("*").alias("nodes"))


@query("lineage_root_cause_nearest", _nearest_sql("table_name = 'Brand#3'", True, "root, node, depth, source_system, CASE depth WHEN 0 THEN 'PROBLEMATIC DATA' WHEN 1 THEN 'DIRECT SOURCE' WHEN 2 THEN 'ROOT SOURCE' ELSE 'ORIGIN' END AS source_type", "JOIN an ON node = node_id"))
def _(b):
    n = nodes(b)
    out = N.nearest(n, edges(b), n.filter("status = 'ACTIVE' AND table_name = 'Brand#3'"), True)
    return N.described(out, n, "source_system").select("root", "node", "depth", "source_system", N.depth_label(F.col("depth")).alias("source_type"))


@query("lineage_impact_chain", f"WITH RECURSIVE {GRAPH}, w AS (SELECT node_id AS root, node_id AS node, 0::BIGINT AS depth, [node_id] AS path FROM an WHERE column_name = 'ECONOMY' UNION ALL SELECT root, t, depth + 1, list_append(path, t) FROM w JOIN ae ON w.node = s JOIN an ON an.node_id = t WHERE NOT list_contains(path, t)) SELECT CASE depth WHEN 1 THEN 'DIRECT IMPACT' WHEN 2 THEN 'SECONDARY IMPACT' ELSE 'TERTIARY IMPACT' END AS impact, table_name, count(*) AS paths FROM w JOIN an ON node = node_id WHERE depth > 0 GROUP BY ALL")
def _(b):
    n = nodes(b)
    out = N.reach(n, edges(b), n.filter("status = 'ACTIVE' AND column_name = 'ECONOMY'"), False).filter("depth > 0")
    return N.described(out, n, "table_name").groupBy(N.impact_label(F.col("depth")).alias("impact"), "table_name").agg(F.count("*").alias("paths"))


@query("lineage_impact", f"WITH {GRAPH} SELECT edge_id, st AS source_table_name, tt AS target_table_name, CASE lineage_level WHEN 'COLUMN' THEN 'COLUMN-LEVEL CHANGE REQUIRED' ELSE 'TABLE-LEVEL CHANGE REQUIRED' END AS change_requirement, CASE WHEN tp THEN 'PII DATA - SPECIAL HANDLING REQUIRED' ELSE 'Standard change' END AS pii_warning FROM cx")
def _(b):
    return N.impact(N.connections(nodes(b), edges(b)))


@query("lineage_impact_reports", f"WITH {GRAPH} SELECT st AS source_table_name, tt AS affected_report, count(*) AS affected_columns, bool_or(sp) AS pii_affected FROM cx WHERE ty IN ('VIEW','REPORT','DASHBOARD') GROUP BY 1, 2")
def _(b):
    return N.report_impact(N.connections(nodes(b), edges(b)), ["VIEW", "REPORT", "DASHBOARD"])


@query("lineage_process_impact", f"WITH {GRAPH} SELECT process_name, count(DISTINCT st) AS source_tables_count, string_agg(DISTINCT st, ', ' ORDER BY st) AS source_tables, count(DISTINCT tt) AS target_tables_count, string_agg(DISTINCT tt, ', ' ORDER BY tt) AS target_tables, bool_or(sp) AS involves_pii FROM cx GROUP BY 1")
def _(b):
    return N.process_impact(N.connections(nodes(b), edges(b)))


@query("lineage_risk", f"WITH {GRAPH} SELECT st AS changed_table, sc AS changed_column, count(DISTINCT tt) AS downstream_tables_count, count(DISTINCT process_name) AS affected_processes, count(*) FILTER (WHERE tp) AS pii_affected_count, CASE WHEN count(DISTINCT tt) > 10 THEN 'HIGH RISK' WHEN count(DISTINCT tt) > 5 THEN 'MEDIUM RISK' ELSE 'LOW RISK' END AS risk_level, CASE WHEN count(*) FILTER (WHERE tp) > 0 THEN 'PII COMPLIANCE REVIEW REQUIRED' ELSE 'No PII impact' END AS compliance_requirement FROM cx GROUP BY 1, 2")
def _(b):
    return N.risk_assessment(N.connections(nodes(b), edges(b)))


@query("lineage_root_cause", f"WITH RECURSIVE {GRAPH}, w AS (SELECT node_id AS root, node_id AS node, 0::BIGINT AS depth, [node_id] AS path FROM an WHERE table_name = 'Brand#3' UNION ALL SELECT root, s, depth + 1, list_append(path, s) FROM w JOIN ae ON w.node = t JOIN an ON an.node_id = s WHERE NOT list_contains(path, s) AND depth < 10) SELECT root, node, depth, source_system, CASE depth WHEN 0 THEN 'PROBLEMATIC DATA' WHEN 1 THEN 'DIRECT SOURCE' WHEN 2 THEN 'ROOT SOURCE' ELSE 'ORIGIN' END AS source_type FROM w JOIN an ON node = node_id")
def _(b):
    n = nodes(b)
    out = N.reach(n, edges(b), n.filter("status = 'ACTIVE' AND table_name = 'Brand#3'"), True, 10)
    return N.described(out, n, "source_system").select("root", "node", "depth", "source_system", N.depth_label(F.col("depth")).alias("source_type"))


@query("lineage_transformation_chain", f"WITH {GRAPH} SELECT edge_id, process_name, edge_type, tt AS target_table_name, tc AS target_column_name, st AS source_table_name, row_number() OVER (PARTITION BY tt, tc ORDER BY edge_id) AS transformation_step FROM cx WHERE lineage_level = 'COLUMN'")
def _(b):
    return N.transformation_chain(N.connections(nodes(b), edges(b)))


@query("lineage_column_report", f"WITH {GRAPH} SELECT tt AS table_name, tc AS column_name, count(*) AS sources, count(DISTINCT ss) AS source_systems, bool_or(sp) AS fed_by_pii FROM cx GROUP BY 1, 2")
def _(b):
    return N.column_report(N.connections(nodes(b), edges(b)))


@query("lineage_schema_change", f"WITH {GRAPH} SELECT sc AS changed_column, tt AS affected_table, count(*) AS affected_columns FROM cx WHERE lineage_level = 'COLUMN' GROUP BY 1, 2")
def _(b):
    return N.connections(nodes(b), edges(b)).filter("lineage_level = 'COLUMN'").groupBy(F.col("source_column_name").alias("changed_column"), F.col("target_table_name").alias("affected_table")).agg(F.count("*").alias("affected_columns"))


@query("lineage_record_trace", "SELECT customer_id AS record_id, 'raw' AS layer, 1::BIGINT AS layer_order, customer_name AS value FROM b_customers UNION ALL SELECT customer_id, 'clean', 2, customer_name FROM s_customers UNION ALL SELECT customer_id, 'mart', 3, customer_segment FROM m_c360")
def _(b):
    rename = q_customer.c360(b).select("customer_id", F.col("customer_segment").alias("customer_name"))
    return N.record_trace({"raw": b.customers(), "clean": Clean(b).customers, "mart": rename}, "customer_id", "customer_name")


@query("lineage_pii_flow", f"WITH {GRAPH} SELECT edge_id, st AS source_table_name, sc AS source_column_name, tt AS target_table_name, tc AS target_column_name, CASE WHEN tp THEN 'PII PROPAGATED' ELSE 'PII NOT PROPAGATED' END AS pii_status FROM cx WHERE sp")
def _(b):
    return N.pii_flow(N.connections(nodes(b), edges(b)))


@query("lineage_summary", f"WITH {GRAPH}, i AS (SELECT t AS node_id, count(*) AS i, count(*) FILTER (WHERE lineage_level = 'COLUMN') AS ci FROM ae GROUP BY 1), o AS (SELECT s AS node_id, count(*) AS o, count(*) FILTER (WHERE lineage_level = 'COLUMN') AS co FROM ae GROUP BY 1) SELECT table_name, count(*) AS columns, coalesce(sum(i), 0)::BIGINT AS inbound_edges, coalesce(sum(o), 0)::BIGINT AS outbound_edges, coalesce(sum(ci), 0)::BIGINT AS column_level_in, coalesce(sum(co), 0)::BIGINT AS column_level_out, bool_or(is_pii) AS contains_pii FROM an LEFT JOIN i USING (node_id) LEFT JOIN o USING (node_id) GROUP BY 1")
def _(b):
    return N.summary(nodes(b), edges(b))


@query("lineage_graph", f"WITH {GRAPH} SELECT 'node' AS element_type, node_id AS id, node_name AS label, NULL::VARCHAR AS source, NULL::VARCHAR AS target FROM an UNION ALL SELECT 'edge', edge_id, edge_type, sn, tn FROM cx")
def _(b):
    return N.graph(nodes(b), edges(b))


@query("lineage_validate", f"WITH RECURSIVE {GRAPH}, r AS (SELECT DISTINCT s AS root, t AS node FROM ae WHERE t < 1000000000 UNION SELECT root, t FROM r JOIN ae ON r.node = s WHERE root <> r.node AND t < 1000000000) SELECT (SELECT count(*) FROM nd WHERE node_id NOT IN (SELECT s FROM ae UNION SELECT t FROM ae)) AS orphan_nodes, (SELECT count(DISTINCT edge_id) FROM ed WHERE s NOT IN (SELECT node_id FROM nd) OR t NOT IN (SELECT node_id FROM nd)) AS broken_edges, (SELECT count(DISTINCT root) FROM r WHERE root = node) AS nodes_on_cycles")
def _(b):
    return N.validate(nodes(b), edges(b))


# --- layout and platform tables --------------------------------------------------------------------------------


def _daily(b):
    return L.build_summary(b.table("events"), [F.col("ts").cast("date").alias("day"), "event_type"], [F.count("*").alias("n"), X.dsum(money("value")).alias("total")])


_DAYS = "SELECT ts::DATE::VARCHAR AS day, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2"


@query("preagg_table", _DAYS)
def _(b):
    path = run_folder(b.spark, "preagg")
    files.write(_daily(b), path)
    return files.read(b.spark, path)


@query("preagg_incremental_refresh", _DAYS)
def _(b):
    """A summary with two wrong days; only those days are computed again and replaced."""
    path = run_folder(b.spark, "refresh")
    changed = F.col("day").isin("2024-01-05", "2024-01-06")
    L.write_partitioned(_daily(b).withColumn("total", F.when(~changed, F.col("total"))), path, ["day"])
    L.refresh_partitions(b.spark, path, _daily(b), _daily(b).filter(changed), "day")
    return files.read(b.spark, path).select("day", "event_type", "n", "total")


def _partitioned(name, cols):
    @query(name, f"SELECT {', '.join(c if c != 'y' else 'year(o_orderdate) AS y' for c in cols)}, count(*) AS n FROM orders GROUP BY ALL")
    def _(b):
        path = run_folder(b.spark, "layout")
        L.write_partitioned(b.table("orders").withColumn("y", F.year("o_orderdate")), path, cols)
        return files.read(b.spark, path).groupBy(*cols).agg(F.count("*").alias("n"))


for _n, _c in (("partition_by_date", ["y"]), ("partition_by_list", ["o_orderstatus"]), ("partition_composite", ["y", "o_orderstatus"])):
    _partitioned(_n, _c)


@query("partition_archive", "SELECT year(o_orderdate) < 1998 AS archived, count(*) AS n FROM orders GROUP BY 1")
def _(b):
    rows = b.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    kept, old = L.archive_split(rows, "day", "1998-01-01")
    base = run_folder(b.spark, "archive")
    files.write(kept, base + "/live")
    files.write(old, base + "/cold")
    n = lambda p, flag: files.read(b.spark, base + p).agg(F.count("*").alias("n")).select(F.lit(flag).alias("archived"), "n")
    return n("/live", False).unionByName(n("/cold", True))


@query("partition_compact", "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, true AS fewer_files FROM orders GROUP BY 1")
def _(b):
    base = run_folder(b.spark, "compact")
    b.table("orders").repartition(12).write.partitionBy("o_orderstatus").parquet(base + "/many")
    after = L.compact(b.spark, base + "/many", base + "/few", ["o_orderstatus"])
    before = files.folder_size(files.read(b.spark, base + "/many")).select("files").scalar()
    now = files.folder_size(after).select("files").scalar()
    out = after.groupBy("o_orderstatus").agg(F.count("*").alias("n"), X.dsum(money("o_totalprice")).alias("total"))
    return out.withColumn("fewer_files", now < before)


@query("partition_stats", "SELECT l_suppkey, count(*) AS row_count, count(*) / avg(count(*)) OVER () AS skew_ratio FROM lineitem GROUP BY 1")
def _(b):
    return L.partition_stats(b.table("lineitem"), "l_suppkey")


@query("cluster_sort", "SELECT o_orderkey, o_custkey FROM orders")
def _(b):
    path = run_folder(b.spark, "sorted")
    files.write(L.cluster_sorted(b.table("orders").select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"]), path)
    return files.read(b.spark, path)


@query("repartition_cache", "SELECT o_custkey, o_orderstatus, n, total, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY o_custkey)::DOUBLE AS share FROM (SELECT o_custkey, o_orderstatus, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1, 2)")
def _(b):
    """Dealt by key once and held: both aggregates read the same partitions, without another shuffle."""
    held = L.held(b.table("orders").select("o_custkey", "o_orderstatus", money("o_totalprice").alias("v")), ["o_custkey"])
    per = held.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"), X.dsum("v").alias("total"))
    whole = held.groupBy("o_custkey").agg(F.count("*").alias("_all"))
    return per.join(whole, "o_custkey").select("o_custkey", "o_orderstatus", "n", "total", X.ratio("n", "_all", 100.0).alias("share"))


@query("coalesce_output", "SELECT count(*) AS n, true AS few_files FROM orders WHERE o_orderstatus = 'P'")
def _(b):
    """A filter leaves little in many partitions; they are put together without a shuffle before they are written."""
    rows = b.table("orders").repartition(24).filter("o_orderstatus = 'P'")
    path = run_folder(b.spark, "coalesced")
    files.write(L.coalesced(rows, 3), path)
    out = files.read(b.spark, path)
    return out.agg(F.count("*").alias("n")).withColumn("few_files", files.folder_size(out).select("files").scalar() <= 3)


@query("skew_two_stage_agg", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(b):
    per = b.table("events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return per.groupBy("event_type").agg(F.sum("n").alias("n"), F.count("*").alias("users"))


def query_log(b):
    e = b.table("events")
    return e.select(F.col("event_type").alias("dataset"), F.col("user_id"), (F.col("event_id") % 5000).alias("duration_ms"), (F.col("event_id") % 3 == 0).alias("cache_hit"), (F.col("event_id") % 1000).alias("rows_scanned"))


@query("query_log_stats", "SELECT event_type AS dataset, count(*) AS runs, sum(event_id % 5000)::DOUBLE / count(*) AS avg_ms, max(event_id % 5000) AS max_ms, count(*) FILTER (WHERE event_id % 5000 > 3000) AS slow_runs, count(*) FILTER (WHERE event_id % 3 = 0) * 100.0::DOUBLE / count(*) AS hit_rate_pct, sum(event_id % 1000)::BIGINT AS rows_scanned FROM events GROUP BY 1")
def _(b):
    return L.query_log_stats(query_log(b), ["dataset"], 3000)


@query("query_log_slowest", "SELECT event_id, event_type AS dataset, event_id % 5000 AS duration_ms FROM events ORDER BY 3 DESC, 1 LIMIT 20")
def _(b):
    return b.table("events").select("event_id", F.col("event_type").alias("dataset"), (F.col("event_id") % 5000).alias("duration_ms")).orderBy(F.desc("duration_ms"), "event_id").limit(20)


@query("query_log_cost", "SELECT user_id, sum(event_id % 1000)::BIGINT AS rows_scanned, sum(event_id % 1000)::DOUBLE * 0.000005::DOUBLE AS cost FROM events GROUP BY 1")
def _(b):
    return query_log(b).groupBy("user_id").agg(F.sum("rows_scanned").alias("rows_scanned"), (F.sum("rows_scanned").cast("double") * 0.000005).alias("cost"))


@query("monitor_freshness_report", "SELECT 'events' AS table_name, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT)::DOUBLE / 3600 AS age_hours, 'FRESH' AS status FROM events UNION ALL SELECT 'orders', (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(max(o_orderdate))::BIGINT)::DOUBLE / 3600, 'CRITICAL' FROM orders")
def _(b):
    mk = lambda t, c: b.table(t).agg(F.max(c).alias("last_update")).withColumn("table_name", F.lit(t))
    out = L.freshness_report(mk("events", "ts").unionByName(mk("orders", "o_orderdate")), {"events": 24, "orders": 24}, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    return out.select("table_name", "age_hours", "status")


@query("monitor_sla_breach", "SELECT event_type AS job, count(*) FILTER (WHERE event_id % 5000 > 4000) AS breaches, count(*) FILTER (WHERE event_id % 5000 > 4000) * 100.0::DOUBLE / count(*) AS breach_pct FROM events GROUP BY 1")
def _(b):
    late = F.count_if(F.col("duration_ms") > 4000)
    return query_log(b).groupBy(F.col("dataset").alias("job")).agg(late.alias("breaches"), X.pct(late, F.count("*")).alias("breach_pct"))


@query("monitor_run_summary", "SELECT event_type AS job, count(*) AS total_runs, count(*) FILTER (WHERE event_id % 20 <> 0) AS successful_runs, count(*) FILTER (WHERE event_id % 20 <> 0) * 100.0::DOUBLE / count(*) AS success_rate, sum(event_id % 900)::DOUBLE / count(*) AS avg_duration_s, sum(user_id % 10)::BIGINT AS rows_processed FROM events GROUP BY 1")
def _(b):
    runs = b.table("events").select(F.col("event_type").alias("job"), F.when(F.col("event_id") % 20 == 0, "failed").otherwise("success").alias("status"), (F.col("event_id") % 900).alias("duration_s"), (F.col("user_id") % 10).alias("row_count"))
    return L.run_summary(runs)


@query("monitor_alerts_by_severity", "SELECT CASE WHEN value > 150 THEN 'CRITICAL' WHEN value > 80 THEN 'HIGH' WHEN value > 30 THEN 'MEDIUM' ELSE 'LOW' END AS severity, count(*) AS alerts FROM events WHERE event_type = 'error' GROUP BY 1")
def _(b):
    return b.table("events").filter("event_type = 'error'").groupBy(X.band(F.col("value"), [(150, "CRITICAL"), (80, "HIGH"), (30, "MEDIUM")], "LOW").alias("severity")).agg(F.count("*").alias("alerts"))


@query("monitor_volume", "SELECT ts::DATE::VARCHAR AS day, count(*) AS row_count, CASE WHEN count(*) < 320 THEN 'LOW' WHEN count(*) > 350 THEN 'HIGH' ELSE 'OK' END AS status FROM events GROUP BY 1")
def _(b):
    return L.volume_check(b.table("events"), F.col("ts").cast("date"), 320, 350)


@query("monitor_completeness", "SELECT 'balance' AS column_name, count(balance) * 100.0::DOUBLE / count(*) AS filled_pct, count(balance) * 100.0::DOUBLE / count(*) >= 95 AS ok FROM b_snap_new")
def _(b):
    out = b.snapshot_new().agg(X.pct(F.count("balance"), F.count("*")).alias("filled_pct"))
    return out.select(F.lit("balance").alias("column_name"), "filled_pct", (F.col("filled_pct") >= 95).alias("ok"))


# --- topics named without code -------------------------------------------------------------------------------


@query("mdm_golden_record", """WITH s AS (SELECT customer_id, lower(trim(customer_name)) AS k, phone, email, last_updated, 1 AS p FROM b_customers_old UNION ALL SELECT customer_id, lower('  ' || trim(customer_name)), NULL, email, last_updated + 10, 2 FROM b_customers WHERE customer_id % 4 = 0),
    g AS (SELECT trim(k) AS match_key, max_by(phone, (last_updated, p)) FILTER (WHERE phone IS NOT NULL) AS phone, max_by(email, (last_updated, p)) FILTER (WHERE email IS NOT NULL) AS email, count(*) AS sources FROM s GROUP BY 1) SELECT * FROM g""")
def _(b):
    """Sources matched on a normalised name; per attribute the latest value that is not NULL survives."""
    cols = ["customer_name", "phone", "email", "last_updated"]
    a = b.customers_with_old_rows().select(*cols).withColumn("p", F.lit(1))
    z = b.customers().filter("customer_id % 4 = 0").select(*cols).withColumns({"customer_name": F.concat(F.lit("  "), "customer_name"), "phone": F.lit(None).cast("string"), "last_updated": F.date_add("last_updated", 10), "p": F.lit(2)})
    s = a.unionByName(z).withColumn("match_key", F.lower(F.trim("customer_name")))
    at = F.struct("last_updated", "p")
    keep = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)
    return s.groupBy("match_key").agg(keep("phone"), keep("email"), F.count("*").alias("sources"))


@query("dp_noisy_count")
def _(b):
    return V.noisy_counts(b.table("events"), ["event_type"], 0.5)


@query("feature_point_in_time", "SELECT l.event_id, f.cnt AS orders_before FROM (SELECT * FROM events WHERE event_type = 'signup') l ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS cnt FROM events WHERE event_type = 'click' GROUP BY 1, 2) f ON l.user_id = f.user_id AND l.ts >= f.ts")
def _(b):
    """Features as they were known at the time of the label."""
    e = b.table("events")
    labels = e.filter("event_type = 'signup'").select("event_id", "user_id", "ts")
    feats = e.filter("event_type = 'click'").select("user_id", F.col("ts").alias("known_at"), F.col("event_id").alias("cnt"))
    return R.join_as_of(labels, feats, "user_id", "ts", "known_at", "cnt", "orders_before", "event_id").select("event_id", "orders_before")


@query("vector_topk", """WITH x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DECIMAL(18,8) AS v FROM embeddings), c AS (SELECT label AS q, i, (sum(v)::DOUBLE / count(*)) AS v FROM x GROUP BY ALL), d AS (SELECT q, vec_id, sum((x.v::DOUBLE * c.v)::DECIMAL(28,12))::DOUBLE AS dot FROM x JOIN c USING (i) GROUP BY ALL),
    nx AS (SELECT vec_id, sqrt(sum((v::DOUBLE * v::DOUBLE)::DECIMAL(28,12))::DOUBLE) AS n FROM x GROUP BY 1), nc AS (SELECT q, sqrt(sum((v * v)::DECIMAL(28,12))::DOUBLE) AS n FROM c GROUP BY 1)
    SELECT q::BIGINT AS query_id, vec_id, row_number() OVER (PARTITION BY q ORDER BY dot / (nx.n * nc.n) DESC, vec_id) AS rank FROM d JOIN nx USING (vec_id) JOIN nc USING (q) QUALIFY rank <= 5""")
def _(b):
    """The five nearest vectors to the centre of each label."""
    v = b.table("embeddings")
    return V.nearest(v, V.centroids(v, "label", "embedding"), "vec_id", "embedding", 5)
