"""Sources, sinks, incremental loading, change capture, reconciliation."""

from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import ingest as I
from finquarry.operators import layout as L
from finquarry.operators.relational import latest_per_key
from finquarry.plans.registry import query
from finquarry.session import run_folder
from finquarry.sources import files
from finquarry.sources.keyed import KeyedTable
from finquarry.sources.banking import AS_OF, money
from finquarry.sources.clean import Clean

# --- sources and sinks -----------------------------------------------------------------------------


def _orders(b):
    return b.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))


_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE::VARCHAR AS day FROM orders"
_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day date"


@query("src_parquet", _ORDERS + " WHERE o_orderstatus = 'F'")
def _(b):
    path = run_folder(b.spark, "src")
    files.write(_orders(b), path, by=["o_orderstatus"])
    return files.read(b.spark, path).filter("o_orderstatus = 'F'")


def _round_trip(name, fmt):
    @query(name, _ORDERS)
    def _(b):
        path = run_folder(b.spark, fmt)
        files.write(_orders(b), path, fmt)
        return files.read(b.spark, path, fmt, _SCHEMA)


for _name, _fmt in (("src_json", "json"), ("src_csv", "csv"), ("src_xml", "xml"), ("src_orc", "orc"), ("sink_overwrite", "parquet")):
    _round_trip(_name, _fmt)


@query("convert_format", _ORDERS)
def _(b):
    base = run_folder(b.spark, "convert")
    files.write(_orders(b), base + "/a", "json")
    files.convert(b.spark, base + "/a", base + "/b", "json", "csv", _SCHEMA)
    return files.convert(b.spark, base + "/b", base + "/c", "csv", "parquet", _SCHEMA)


@query("src_external_partitioned", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(b):
    path = run_folder(b.spark, "ext")
    files.write(_orders(b), path, by=["o_orderstatus"])
    name = "ext_" + path.rsplit("-", 1)[-1]
    b.spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, day DATE, o_orderstatus STRING) USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{path}'")
    b.spark.catalog.recoverPartitions(name)
    return b.spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("load_files_into_table", _ORDERS)
def _(b):
    base = run_folder(b.spark, "load")
    files.write(_orders(b).filter("day < '1998-01-01'"), base + "/a")
    files.write(_orders(b).filter("day >= '1998-01-01'"), base + "/b")
    b.spark.read.parquet(base + "/a", base + "/b").write.mode("append").parquet(base + "/t")
    return files.read(b.spark, base + "/t")


@query("sink_partitioned", _ORDERS)
def _(b):
    """Dynamic overwrite: the second write replaces one partition only."""
    path = run_folder(b.spark, "part")
    L.write_partitioned(_orders(b).withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).otherwise(F.col("o_totalprice"))), path, ["o_orderstatus"])
    L.write_partitioned(_orders(b).filter("o_orderstatus = 'P'"), path, ["o_orderstatus"])
    return files.read(b.spark, path)


@query("sink_append", _ORDERS + " UNION ALL " + _ORDERS)
def _(b):
    path = run_folder(b.spark, "append")
    files.write(_orders(b), path, mode="append")
    files.write(_orders(b), path, mode="append")
    return files.read(b.spark, path)


@query("sink_insert_overwrite_partition", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 100000")
def _(b):
    path = run_folder(b.spark, "iop")
    rows = _orders(b).select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write(rows, path, by=["o_orderstatus"])
    name = "iop_" + path.rsplit("-", 1)[-1]
    b.spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING) USING parquet PARTITIONED BY (o_orderstatus) LOCATION '{path}'")
    b.spark.catalog.recoverPartitions(name)
    rows.filter("o_orderstatus = 'F' AND o_totalprice > 100000").createOrReplaceTempView(name + "_src")
    b.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (o_orderstatus = 'F') SELECT o_orderkey, o_totalprice FROM {name}_src")
    return b.spark.table(name)


@query("sink_bucketed", "SELECT o_orderpriority, sum(l_quantity::DECIMAL(9,0))::DOUBLE AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(b):
    """Two tables bucketed alike on the order key join without a shuffle of either."""
    base = run_folder(b.spark, "buckets")
    tag = base.rsplit("-", 1)[-1]
    save = lambda df, t, key: df.write.mode("overwrite").bucketBy(8, key).sortBy(key).option("path", f"{base}/{t}").saveAsTable(f"{t}_{tag}")
    save(b.table("orders").select("o_orderkey", "o_orderpriority"), "bo", "o_orderkey")
    save(b.table("lineitem").select("l_orderkey", "l_quantity"), "bl", "l_orderkey")
    o, l = b.spark.table(f"bo_{tag}"), b.spark.table(f"bl_{tag}")
    return l.join(o, l.l_orderkey == o.o_orderkey).groupBy("o_orderpriority").agg(X.dsum(F.col("l_quantity").cast("decimal(9,0)")).alias("quantity"))


@query("sink_compression")
def _(b):
    base, out = run_folder(b.spark, "codec"), None
    for codec in ("none", "snappy", "gzip", "zstd", "lz4"):
        files.write(b.table("lineitem"), f"{base}/{codec}", compression=codec)
        size = files.folder_size(files.read(b.spark, f"{base}/{codec}")).withColumn("codec", F.lit(codec))
        out = size if out is None else out.unionByName(size)
    return out


@query("sink_csv_report", "SELECT channel_standardized AS channel, count(*) AS n, sum(amount)::DOUBLE AS total FROM s_transactions WHERE txn_date = DATE '2000-06-15' GROUP BY 1")
def _(b):
    path = run_folder(b.spark, "report")
    day = Clean(b).transactions.filter("txn_date = '2000-06-15'")
    files.write(day.groupBy(F.col("channel_standardized").alias("channel")).agg(F.count("*").alias("n"), X.dsum("amount").alias("total")), path, "csv")
    return files.read(b.spark, path, "csv", "channel string, n bigint, total double")


@query("schema_evolution_read", "SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders")
def _(b):
    path = run_folder(b.spark, "evolve")
    o, cutoff = b.table("orders"), F.lit("1998-01-01").cast("date")
    files.write(o.filter(F.col("o_orderdate").cast("date") < cutoff).select("o_orderkey"), path, mode="append")
    files.write(o.filter(F.col("o_orderdate").cast("date") >= cutoff).select("o_orderkey", "o_orderpriority"), path, mode="append")
    return files.read(b.spark, path, mergeSchema="true").select("o_orderkey", "o_orderpriority")


@query("bronze_lineage_columns", "SELECT event_id, 'core' AS source_system, 'b-1' AS batch_id, '2024-01-31 00:00:00' AS ingestion_timestamp, true AS has_file FROM events")
def _(b):
    out = files.with_origin(b.table("events"), "core", "b-1", "2024-01-31 00:00:00")
    return out.select("event_id", "source_system", "batch_id", "ingestion_timestamp", (F.length("source_file") > 0).alias("has_file"))


@query("schema_conformance", "SELECT column_name, expected_type, actual_type, state, null_count FROM (VALUES ('balance','decimal(18,2)','decimal(18,2)','ok',(SELECT count(*) FROM b_snap_new WHERE balance IS NULL)), ('customer_id','string','bigint','type_mismatch',0), ('name','string','string','ok',0), ('nation',NULL,'int','unexpected',0), ('opened','date',NULL,'missing',NULL), ('segment','string','string','ok',0)) t(column_name, expected_type, actual_type, state, null_count)")
def _(b):
    return files.schema_report(b.snapshot_new(), {"customer_id": "string", "name": "string", "balance": "decimal(18,2)", "segment": "string", "opened": "date"})


@query("obs_schema_drift", "SELECT column_name, change, old_type, new_type, null_count FROM (VALUES ('nation','retyped','int','string',0), ('segment','removed','string',NULL,NULL), ('tier','added',NULL,'string',(SELECT count(*) FROM b_snap_new WHERE balance IS NULL))) t(column_name, change, old_type, new_type, null_count)")
def _(b):
    new = b.snapshot_new().withColumns({"nation": F.col("nation").cast("string"), "tier": F.when(F.col("balance").isNotNull(), "A")}).drop("segment")
    return files.schema_drift(b.snapshot_old(), new)


def _versions(b, name="versions"):
    old, new = b.snapshot_old(), b.snapshot_new()
    v = KeyedTable(b.spark, run_folder(b.spark, name), "customer_id", old.schema)
    v.commit(old, "2001-08-01 00:00:00")
    v.commit(new, "2001-08-02 00:00:00")
    return v


@query("snapshot_read_as_of", "SELECT customer_id, nation::BIGINT AS nation FROM b_snap_old")
def _(b):
    return _versions(b).read_as_of("2001-08-01 12:00:00").select("customer_id", "nation")


@query("snapshot_recover_deleted", "SELECT customer_id, name FROM b_snap_old WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_new)")
def _(b):
    return _versions(b).deleted_between(1, 2).select("customer_id", "name")


@query("snapshot_clone", "SELECT customer_id, nation::BIGINT AS nation FROM b_snap_new")
def _(b):
    return _versions(b).clone(2, run_folder(b.spark, "clone"), "2001-08-03 00:00:00").read(1).select("customer_id", "nation")


# --- incremental -------------------------------------------------------------------------------------


@query("inc_timestamp", "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def _(b):
    return I.since(b.table("events"), "ts", F.lit("2024-01-20").cast("timestamp_ntz")).select("event_id", "user_id")


@query("inc_new_mark", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS mark, count(*) AS row_count FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def _(b):
    return I.new_mark(I.since(b.table("events"), "ts", F.lit("2024-01-20").cast("timestamp_ntz")), "ts")


@query("inc_watermark_id", "SELECT event_id, user_id FROM events WHERE event_id > 2000 ORDER BY event_id LIMIT 500")
def _(b):
    return I.after_id(b.table("events"), "event_id", 2000, 500).select("event_id", "user_id")


@query("inc_hash_diff", "SELECT n.customer_id, CASE WHEN o.customer_id IS NULL THEN 'NEW' ELSE 'CHANGED' END AS change FROM b_snap_new n LEFT JOIN b_snap_old o ON n.customer_id = o.customer_id WHERE o.customer_id IS NULL OR o.nation <> n.nation OR o.balance IS DISTINCT FROM n.balance")
def _(b):
    return I.changed_by_hash(b.snapshot_new(), b.snapshot_old(), "customer_id").select("customer_id", "change")


def _per_day(df):
    return df.groupBy("day").agg(F.count("*").alias("n"), X.dsum("amount").alias("total"))


@query("inc_late_data", "SELECT o_orderdate::DATE::VARCHAR AS day, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1")
def _(b):
    """Orders with a total over 450,000 arrive late; only their days are computed again."""
    rows = b.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), money("o_totalprice").alias("amount"))
    on_time, late = rows.filter("amount <= 450000"), rows.filter("amount > 450000")
    return I.recompute_days(_per_day(on_time), on_time, late, "day", _per_day)


@query("load_idempotent", "SELECT (SELECT count(*) FROM b_snap_old) + (SELECT count(*) FROM b_snap_new WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_old)) AS row_count, true AS same_after_rerun")
def _(b):
    once = I.upsert(b.snapshot_old(), b.snapshot_new(), "customer_id")
    twice = I.upsert(once, b.snapshot_new(), "customer_id")
    second = I.checksum(twice).select("checksum").scalar()
    return I.checksum(once).select("row_count", (F.col("checksum") == second).alias("same_after_rerun"))


@query("inc_control_table", "SELECT event_type AS table_name, max(event_id) AS last_id, count(*) FILTER (WHERE event_id > 5000) > 0 AS advanced FROM events GROUP BY 1")
def _(b):
    e = b.table("events")
    mark = lambda df, run: df.groupBy(F.col("event_type").alias("table_name")).agg(F.max("event_id").alias("last_id")).withColumn("run", F.lit(run))
    merged = I.ledger_update(mark(e.filter("event_id <= 5000"), 1), mark(e.filter("event_id > 5000"), 2), ["table_name"], ["run"])
    return merged.select("table_name", "last_id", (F.col("run") == 2).alias("advanced"))


# --- change capture and merging ----------------------------------------------------------------------


def change_log(b):
    """The changes between the two snapshots, each delivered twice and preceded by an older version."""
    c = I.changes_between(b.snapshot_old(), b.snapshot_new(), "customer_id")
    log = c.withColumns({"ts_ms": F.lit(2).cast("bigint"), "lsn": F.col("customer_id") + 1000000000})
    older = log.filter("op <> 'D'").withColumns({"op": F.lit("U"), "name": F.lit("stale"), "ts_ms": F.lit(1).cast("bigint"), "lsn": F.col("lsn") - 500000000})
    return log.unionByName(older).unionByName(log)


_NEW = "SELECT customer_id, name, nation::BIGINT AS nation, balance::DOUBLE AS balance FROM b_snap_new"


@query("cdc_apply", _NEW)
def _(b):
    return I.cdc_apply(b.snapshot_old(), change_log(b), "customer_id").select("customer_id", "name", "nation", "balance")


@query("cdc_soft_delete", "SELECT customer_id, customer_id NOT IN (SELECT customer_id FROM b_snap_new) AS is_deleted, CASE WHEN customer_id NOT IN (SELECT customer_id FROM b_snap_new) THEN '2001-08-02' END AS deleted_at FROM b_snap_old")
def _(b):
    gone = I.changes_between(b.snapshot_old(), b.snapshot_new(), "customer_id").filter("op = 'D'")
    return I.soft_delete(b.snapshot_old(), gone, "customer_id", AS_OF).select("customer_id", "is_deleted", "deleted_at")


_CHANGES = "SELECT coalesce(o.customer_id, n.customer_id) AS customer_id, CASE WHEN o.customer_id IS NULL THEN 'I' WHEN n.customer_id IS NULL THEN 'D' ELSE 'U' END AS op FROM b_snap_old o FULL JOIN b_snap_new n ON o.customer_id = n.customer_id WHERE o.customer_id IS NULL OR n.customer_id IS NULL OR o.nation <> n.nation OR o.balance IS DISTINCT FROM n.balance"


@query("cdc_stream_of_table_changes", _CHANGES)
def _(b):
    return I.changes_between(b.snapshot_old(), b.snapshot_new(), "customer_id").select("customer_id", "op")


def envelopes(b):
    c = I.changes_between(b.snapshot_old(), b.snapshot_new(), "customer_id")
    image = F.to_json(F.struct("customer_id", "name", "nation"))
    op = F.when(F.col("op") == "I", "c").when(F.col("op") == "U", "u").otherwise("d")
    body = F.struct(op.alias("op"), F.lit(1700000000000).alias("ts_ms"), F.struct(F.lit("customers").alias("table"), F.col("customer_id").alias("lsn")).alias("source"), F.when(F.col("op") == "D", image).alias("before"), F.when(F.col("op") != "D", image).alias("after"))
    events = c.select(F.to_json(body).alias("value"))
    tombstones = c.filter("op = 'D'").select(F.lit(None).cast("string").alias("value"))
    return events.unionByName(tombstones)


@query("cdc_envelope_parse", "SELECT op, 'customers' AS \"table\", customer_id AS lsn, customer_id FROM (" + _CHANGES + ")")
def _(b):
    return I.parse_envelope(envelopes(b), "customer_id bigint, name string, nation int").select("op", "table", "lsn", F.col("r.customer_id").alias("customer_id"))


def _merged(b):
    """The old snapshot as a table of small files, and the new one merged into it."""
    old = b.snapshot_old().withColumn("updated_at", F.lit(None).cast("timestamp"))
    t = KeyedTable(b.spark, run_folder(b.spark, "merged"), "customer_id", old.schema, file_rows=500, stamp="updated_at")
    t.commit(old, "2001-08-01 00:00:00")
    t.merge(b.snapshot_new().withColumn("updated_at", F.lit(None).cast("timestamp")), "2001-08-02 00:00:00")
    return t


@query("merge_upsert", "SELECT customer_id, nation::BIGINT AS nation, balance::DOUBLE AS balance FROM b_snap_new UNION ALL SELECT customer_id, nation, balance FROM b_snap_old WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_new)")
def _(b):
    return _merged(b).read().select("customer_id", "nation", "balance")


@query("merge_guarded", """SELECT customer_id, CASE WHEN n.customer_id IS NOT NULL AND (o.customer_id IS NULL OR o.nation <> n.nation OR o.balance IS DISTINCT FROM n.balance) THEN '2001-08-02 00:00:00' ELSE '2001-08-01 00:00:00' END AS updated_at
    FROM b_snap_old o FULL JOIN b_snap_new n USING (customer_id)""")
def _(b):
    """Only rows whose content differs are touched by the merge; the others keep the time of their last change."""
    return _merged(b).read().select("customer_id", "updated_at")


@query("merge_full_state", "SELECT customer_id, nation::BIGINT AS nation, balance::DOUBLE AS balance FROM b_snap_new UNION ALL SELECT customer_id, nation, balance FROM b_snap_old WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_new)")
def _(b):
    """The merge as one DataFrame, without a stored table."""
    return I.upsert(b.snapshot_old(), b.snapshot_new(), "customer_id").select("customer_id", "nation", "balance")


@query("insert_ignore", "SELECT customer_id, nation::BIGINT AS nation FROM b_snap_old UNION ALL SELECT customer_id, nation FROM b_snap_new WHERE customer_id NOT IN (SELECT customer_id FROM b_snap_old)")
def _(b):
    return I.insert_ignore(b.snapshot_old(), b.snapshot_new(), "customer_id").select("customer_id", "nation")


@query("update_where", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer")
def _(b):
    return I.update_where(b.table("customer"), F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)}).select("c_custkey", "c_acctbal")


@query("delete_where", "SELECT customer_id FROM b_snap_new WHERE balance >= 0 OR balance IS NULL")
def _(b):
    return I.delete_where(b.snapshot_new(), F.col("balance") < 0).select("customer_id")


@query("insert_select_archive", "SELECT o_orderkey, o_orderdate < TIMESTAMP '1998-01-01' AS archived FROM orders")
def _(b):
    kept, old = L.archive_split(_orders(b), "day", "1998-01-01")
    return kept.select("o_orderkey", F.lit(False).alias("archived")).unionByName(old.select("o_orderkey", F.lit(True).alias("archived")))


def _sync_log(b):
    """One run per event: the job is the event type, its times and sizes come from the row."""
    e = b.table("events")
    return e.select(F.col("event_type").alias("table_name"), F.col("ts").alias("started_at"), (F.col("user_id") % 10).alias("records_inserted"), (F.col("user_id") % 5).alias("records_updated"), (F.col("user_id") % 2).alias("records_deleted"), (F.col("event_id") % 900).alias("duration_ms"), F.when(F.col("event_id") % 20 == 0, "failed").otherwise("success").alias("status"))


def _marks(b):
    return b.table("events").groupBy(F.col("event_type").alias("table_name")).agg(F.max("event_id").alias("last_lsn"), F.max("ts").alias("last_sync_at"))


@query("cdc_monitoring", """SELECT event_type AS table_name, max(event_id) AS last_lsn, count(*) FILTER (WHERE ts::DATE = DATE '2024-01-30' AND event_id % 20 = 0) AS errors_today,
    CASE WHEN epoch(TIMESTAMP '2024-01-30 23:59:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT < 300 THEN 'Healthy' WHEN epoch(TIMESTAMP '2024-01-30 23:59:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT < 3600 THEN 'Stale' ELSE 'Critical' END AS status FROM events GROUP BY 1""")
def _(b):
    config = b.table("events").select(F.col("event_type").alias("table_name")).distinct().withColumn("enabled", F.lit(True))
    errors = b.table("events").filter("event_id % 20 = 0").select(F.col("event_type").alias("table_name"), F.col("ts").cast("date").alias("error_date"))
    return I.cdc_monitoring(config, _marks(b), errors, "2024-01-30 23:59:00").select("table_name", "last_lsn", "errors_today", "status")


@query("cdc_performance", """SELECT event_type AS table_name, ts::DATE::VARCHAR AS sync_date, count(*) AS sync_count, sum(user_id % 10)::BIGINT AS total_inserts, sum(user_id % 5)::BIGINT AS total_updates, sum(user_id % 2)::BIGINT AS total_deletes,
    sum(event_id % 900)::DOUBLE / count(*) AS avg_duration_ms, max(event_id % 900) AS max_duration_ms, count(*) FILTER (WHERE event_id % 20 = 0) AS failed_count FROM events WHERE ts::DATE >= DATE '2024-01-24' GROUP BY ALL""")
def _(b):
    return I.cdc_performance(_sync_log(b), "2024-01-24")


@query("cdc_table_status", "SELECT event_type AS table_name, max(event_id) AS last_lsn, (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT) // 60 AS minutes_since_sync FROM events WHERE event_type = 'click' GROUP BY 1")
def _(b):
    return I.table_status(_marks(b), "click", "2024-01-31 00:00:00").drop("status")


@query("event_replay", "SELECT user_id, sum(CASE WHEN event_type = 'purchase' THEN -value::DECIMAL(18,2) ELSE value::DECIMAL(18,2) END)::DOUBLE AS state, count(*) AS events, max(event_id) AS version FROM events GROUP BY 1")
def _(b):
    return I.replay(b.table("events"), "user_id", "event_id", F.when(F.col("event_type") == "purchase", -money("value")).otherwise(money("value")))


@query("event_replay_latest", "SELECT user_id, (event_id * 7919) % 1000003 AS version, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_id * 7919) % 1000003 DESC) = 1")
def _(b):
    """State from the stored payload of each key's latest version, in two folds; versions arrive in no order."""
    log = b.table("events").select("event_id", "user_id", ((F.col("event_id") * 7919) % 1000003).alias("version"), "event_type", "value")
    state = KeyedTable(b.spark, run_folder(b.spark, "state"), "user_id", log.drop("event_id").schema)
    I.fold_events(state, log.filter("event_id <= 5000"), "event_id", "version", "2024-01-15 00:00:00")
    I.fold_events(state, log, "event_id", "version", "2024-01-31 00:00:00")
    return state.read()


@query("cqrs_read_model", "SELECT o_orderkey, c_name, o_orderstatus, coalesce(n, 0) AS items, coalesce(r, 0) AS revenue FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(revenue)::DOUBLE AS r FROM b_lines GROUP BY 1) ON o_orderkey = l_orderkey")
def _(b):
    return I.read_model(b.table("orders"), b.order_lines(), b.table("customer"))


@query("lambda_merge", "SELECT event_id, CASE WHEN event_id < 8000 THEN 'batch' ELSE 'speed' END AS layer FROM events")
def _(b):
    e = b.table("events").select("event_id", "value")
    return I.lambda_view(e.filter("event_id < 8000"), e.filter("event_id >= 7000"), "event_id").select("event_id", "layer")


@query("backfill_replay", "SELECT ts::DATE::VARCHAR AS day, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1")
def _(b):
    """A first load with a faulty day range, then those days computed again and swapped in."""
    rows = b.table("events").select(F.col("ts").cast("date").alias("day"), money("value").alias("amount"))
    path = run_folder(b.spark, "backfill")
    wrong = F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    L.write_partitioned(_per_day(rows.withColumn("amount", F.when(~wrong, F.col("amount")))), path, ["day"])
    L.refresh_partitions(b.spark, path, _per_day(rows), rows.filter(wrong), "day")
    return files.read(b.spark, path).select("day", "n", "total")


@query("validate_then_load", "SELECT (SELECT count(*) FROM labels) AS row_count, 0::BIGINT AS null_keys, 0::BIGINT AS negative_amounts, (SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)) AS orphans_doc_id")
def _(b):
    labels = b.table("labels")
    return I.check_load(labels, "doc_id", "quality", {"doc_id": (b.table("documents"), "doc_id")})


@query("load_verify", "SELECT (SELECT count(*) FROM b_snap_new) AS row_count, (SELECT count(*) FROM b_snap_new WHERE balance IS NULL) AS null_keys, (SELECT count(*) FROM b_snap_new WHERE balance < 0) AS negative_amounts")
def _(b):
    return I.check_load(b.snapshot_new(), "balance", "balance", {})


@query("reconcile_totals", "SELECT (SELECT count(*) FROM b_snap_old) AS source_count, (SELECT count(*) FROM b_snap_new) AS target_count, (SELECT sum(balance)::DOUBLE FROM b_snap_old) AS source_total, (SELECT sum(balance)::DOUBLE FROM b_snap_new) AS target_total, false AS matches")
def _(b):
    return I.reconcile_totals(b.snapshot_old(), b.snapshot_new(), "balance")


_VAR = "SELECT customer_id, expected, actual, coalesce(expected, 0) - coalesce(actual, 0) AS variance FROM (SELECT customer_id, o.balance::DOUBLE AS expected, n.balance::DOUBLE AS actual FROM b_snap_old o FULL JOIN b_snap_new n USING (customer_id)) WHERE abs(coalesce(expected, 0) - coalesce(actual, 0)) > 0.01"


@query("reconcile_gl_vs_statement", _VAR)
def _(b):
    return I.reconcile_by_key(b.snapshot_old(), b.snapshot_new(), "customer_id", "balance", "balance")


@query("reconcile_daily_balance", """WITH t AS (SELECT o_orderkey, o_totalprice FROM orders), l AS (SELECT l_orderkey, sum(price) AS s FROM b_lines GROUP BY 1)
    SELECT coalesce(o_orderkey, l_orderkey) AS k, o_totalprice AS expected, s::DOUBLE AS actual, coalesce(o_totalprice, 0) - coalesce(s::DOUBLE, 0) AS variance FROM t FULL JOIN l ON o_orderkey = l_orderkey WHERE abs(coalesce(o_totalprice, 0) - coalesce(s::DOUBLE, 0)) > 0.01""")
def _(b):
    o = b.table("orders").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("x"))
    l = b.order_lines().select(F.col("l_orderkey").alias("k"), F.col("price").alias("y"))
    return I.reconcile_by_key(o, l, "k", "x", "y")


@query("sync_catalog", "SELECT p_partkey, upper(p_name) AS name, round(p_retailprice::DECIMAL(18,2), 1)::DOUBLE AS price, true AS is_active FROM part")
def _(b):
    shape = lambda df: df.select("p_partkey", F.upper("p_name").alias("name"), F.round(money("p_retailprice"), 1).alias("price"), F.lit(True).alias("is_active"))
    stale = shape(b.table("part").withColumn("p_retailprice", F.lit(0.0)))
    return I.upsert(stale, shape(b.table("part")), "p_partkey")
