"""Incremental loading, change capture, merging, replay and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators.relational import anti_orphans, latest_per_key
from finquarry.session import cut_lineage
from finquarry.sources.keyed import KeyedTable


# --- incremental reads -------------------------------------------------------------------------------
def since(df: DataFrame, ts: str, last: Column) -> DataFrame:
    return df.filter(F.col(ts) > last)


def new_mark(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("mark"), F.count("*").alias("row_count"))


def after_id(df: DataFrame, id_col: str, last: int, n: int) -> DataFrame:
    """The next ``n`` rows in id order (keyset paging)."""
    return df.filter(F.col(id_col) > last).orderBy(id_col).limit(n)


def changed_by_hash(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows that are new or whose content hash differs from the target's. NULL keys match NULL keys."""
    cols = [c for c in source.columns if c != key]
    known = target.select(F.col(key).alias("_k"), X.row_hash(*cols).alias("_h"), F.lit(True).alias("_found"))
    rows = source.join(known, F.col(key).eqNullSafe(F.col("_k")), "left")
    state = F.when(F.col("_found").isNull(), "NEW").when(X.row_hash(*cols) != F.col("_h"), "CHANGED")
    return rows.withColumn("change", state).filter(F.col("change").isNotNull()).drop("_k", "_h", "_found")


def touched_days(late: DataFrame, day: str) -> DataFrame:
    return late.select(day).distinct()


def recompute_days(target: DataFrame, all_rows: DataFrame, late: DataFrame, day: str, aggregate) -> DataFrame:
    """The target with the partitions touched by late rows computed afresh, the others untouched."""
    days = touched_days(late, day)
    fresh = aggregate(all_rows.unionByName(late).join(days, day, "left_semi"))
    return target.join(days, day, "left_anti").unionByName(fresh)


def checksum(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a table: equal tables have equal sums. NULLs count in their place."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    return df.agg(F.count("*").alias("row_count"), F.sum(F.xxhash64(row).cast("decimal(38,0)")).cast("string").alias("checksum"))


def ledger_update(ledger: DataFrame, runs: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest mark per table after merging the marks of new runs."""
    return latest_per_key(ledger.unionByName(runs), list(keys), list(order))


# --- merging --------------------------------------------------------------------------------------------
def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full new state: source rows replace target rows of the same key.

    Rows that did not change come out as they were, so writing only the partitions that
    differ stays possible. One full-outer equi-join, no window.
    """
    cols = [c for c in target.columns if c != key]
    t = target.select(key, F.struct(*cols).alias("t"))
    s = source.select(key, F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols]).alias("s"))
    new = F.coalesce("s", "t")
    return t.join(s, key, "full").select(key, new.alias("r")).select(key, "r.*")


def insert_ignore(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    return target.unionByName(source.select(*target.columns).join(target.select(key), key, "left_anti"))


def update_where(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in assignments.items()})


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows where the predicate is not true (NULL counts as not true, as in SQL DELETE)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


# --- change data capture ----------------------------------------------------------------------------------
def changes_between(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Insert, update and delete rows that turn ``old`` into ``new``; deletes carry the old values."""
    cols = [c for c in old.columns if c != key]
    o, n = old.select(key, F.struct(*cols).alias("o")), new.select(key, F.struct(*cols).alias("n"))
    op = F.when(F.col("o").isNull(), "I").when(F.col("n").isNull(), "D").otherwise("U")
    both = o.join(n, key, "full").filter(~F.col("o").eqNullSafe(F.col("n")))
    return both.select(key, op.alias("op"), F.coalesce("n", "o").alias("r")).select(key, "op", "r.*")


def cdc_latest(log: DataFrame, key: str, order: Sequence[str] = ("ts_ms", "lsn")) -> DataFrame:
    """The decisive operation per key. Duplicates and rows out of order do no harm."""
    return latest_per_key(log, [key], list(order))


def cdc_apply(target: DataFrame, log: DataFrame, key: str, order: Sequence[str] = ("ts_ms", "lsn"), applied: int | None = None) -> DataFrame:
    """Target state after the log (op I/U/D). Entries at or below the ``applied`` lsn are ignored."""
    fresh = log.filter(F.col("lsn") > applied) if applied is not None else log
    cols = [c for c in target.columns if c != key]
    last = cdc_latest(fresh, key, order).select(key, F.col("op").alias("_op"), F.struct(*cols).alias("s"))
    t = target.select(key, F.struct(*cols).alias("t"))
    merged = t.join(last, key, "full").filter(F.col("_op").isNull() | (F.col("_op") != "D"))
    return merged.select(key, F.when(F.col("_op").isNull(), F.col("t")).otherwise(F.col("s")).alias("r")).select(key, "r.*")


def soft_delete(target: DataFrame, keys: DataFrame, key: str, at: str) -> DataFrame:
    gone = keys.select(key).distinct().withColumn("_d", F.lit(True))
    hit = F.col("_d").isNotNull()
    return target.join(gone, key, "left").withColumns({"is_deleted": hit, "deleted_at": F.when(hit, F.lit(at).cast("date"))}).drop("_d")


ENVELOPE = "op string, ts_ms bigint, source struct<table:string,lsn:bigint>, before string, after string"
ENVELOPE_OPS = {"c": "I", "r": "I", "u": "U", "d": "D"}  # fixed values of the change-event envelope


def parse_envelope(messages: DataFrame, row_schema: str, value: str = "value") -> DataFrame:
    """Change events as rows: operation, table, position, and the row image as a struct.

    Tombstones (NULL values) are dropped; a delete shows the image before it.
    """
    e = messages.filter(F.col(value).isNotNull()).select(F.from_json(value, ENVELOPE).alias("e")).select("e.*")
    op = None
    for k, v in ENVELOPE_OPS.items():
        op = F.when(F.col("op") == k, v) if op is None else op.when(F.col("op") == k, v)
    image = F.from_json(F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")), row_schema)
    return e.select(op.alias("op"), F.col("source.table").alias("table"), F.col("source.lsn").alias("lsn"), "ts_ms", image.alias("r"))


def cdc_monitoring(config: DataFrame, marks: DataFrame, errors: DataFrame, as_of: str) -> DataFrame:
    """Per enabled table: position, errors of the day and a status by lag (5 minutes, 1 hour)."""
    now = F.lit(as_of).cast("timestamp")
    today = errors.filter(F.col("error_date") == now.cast("date")).groupBy("table_name").agg(F.count("*").alias("errors_today"))
    out = config.filter("enabled").join(marks, "table_name", "left").join(today, "table_name", "left").fillna({"errors_today": 0})
    return out.withColumn("status", lag_status(F.col("last_sync_at"), now))


def lag_status(last: Column, now: Column) -> Column:
    lag = F.unix_timestamp(now) - F.unix_timestamp(last.cast("timestamp"))
    return F.when(lag < 300, "Healthy").when(lag < 3600, "Stale").otherwise("Critical")


def cdc_performance(log: DataFrame, since_day: str) -> DataFrame:
    rows = log.filter(F.col("started_at").cast("date") >= F.lit(since_day).cast("date"))
    return rows.groupBy("table_name", F.col("started_at").cast("date").alias("sync_date")).agg(
        F.count("*").alias("sync_count"), F.sum("records_inserted").alias("total_inserts"), F.sum("records_updated").alias("total_updates"), F.sum("records_deleted").alias("total_deletes"),
        X.davg("duration_ms").alias("avg_duration_ms"), F.max("duration_ms").alias("max_duration_ms"), F.count_if(F.col("status") == "failed").alias("failed_count"),
    )


def table_status(marks: DataFrame, table: str, as_of: str) -> DataFrame:
    now = F.lit(as_of).cast("timestamp")
    return marks.filter(F.col("table_name") == table).select("table_name", "last_lsn", X.minutes_between("last_sync_at", now).alias("minutes_since_sync"), lag_status(F.col("last_sync_at"), now).alias("status"))


# --- event log, read models -----------------------------------------------------------------------------
def replay(log: DataFrame, key: str, version: str, delta: Column) -> DataFrame:
    """State per key from its events: sum of changes, number of events, latest version."""
    return log.groupBy(key).agg(F.sum(delta).alias("state"), F.count("*").alias("events"), F.max(version).alias("version"))


def fold_events(table: KeyedTable, log: DataFrame, position: str, version: str, at: str) -> int:
    """Carry a kept state (the payload of each key's latest version) forward by the events after its mark.

    ``table`` holds the state, a row per key with the event's ``version`` and payload columns; the
    mark is the greatest ``position`` (order of arrival) folded so far, kept with the state's
    version. Only later events are read. An event that arrives late, with a lower version than
    the state has, changes nothing; of equal versions the first to arrive stays.
    """
    _, mark = table.latest()
    later = log.filter(F.col(position) > mark) if mark is not None else log
    key = table.keys
    last = later.groupBy(*key).agg(F.max_by(F.struct(*table.values), F.struct(F.col(version), -F.col(position))).alias("_r"), F.max(position).alias("_upto"))
    rows = cut_lineage(last.select(*key, "_r.*", "_upto"))
    upto = rows.agg(F.max("_upto")).first()[0]
    if upto is None:
        return table.latest()[0]
    return table.merge(rows.drop("_upto"), at, newer=version, mark=upto)


def read_model(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with item count, value and customer in one row."""
    per = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("items"), X.dsum("revenue").alias("revenue"))
    return orders.join(per, "o_orderkey", "left").join(customers.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left").select("o_orderkey", "c_name", "o_orderstatus", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("revenue", F.lit(0.0)).alias("revenue"))


def lambda_view(batch: DataFrame, speed: DataFrame, key: str) -> DataFrame:
    """Batch rows first; recent rows only where the batch does not know the key yet."""
    return batch.withColumn("layer", F.lit("batch")).unionByName(speed.join(batch.select(key), key, "left_anti").withColumn("layer", F.lit("speed")))


# --- checks around a load --------------------------------------------------------------------------------
class LoadRejected(ValueError):
    """A load was blocked by its checks."""


def check_load(df: DataFrame, key: str, amount: str, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row of counts: rows, NULL keys, negative amounts, orphans per parent."""
    out = df.agg(F.count("*").alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(F.col(amount) < 0).alias("negative_amounts"))
    for child_key, (parent, parent_key) in parents.items():
        out = out.withColumn(f"orphans_{child_key}", anti_orphans(df, parent, child_key, parent_key).agg(F.count("*")).scalar())
    return out


def load_or_reject(df: DataFrame, checks: DataFrame, publish) -> DataFrame:
    """Publish only if every count but ``row_count`` is zero."""
    row = checks.first().asDict()
    bad = {k: v for k, v in row.items() if k != "row_count" and v}
    if bad:
        raise LoadRejected(f"load blocked: {bad}")
    publish(df)
    return df


def reconcile_totals(a: DataFrame, b: DataFrame, amount: str, tolerance: float = 0.01) -> DataFrame:
    """Counts and sums of two tables side by side."""
    x = a.agg(F.count("*").alias("source_count"), X.dsum(amount).alias("source_total"))
    y = b.agg(F.count("*").alias("n"), X.dsum(amount).alias("t")).select(F.struct("n", "t").alias("y")).scalar()
    out = x.withColumn("y", y).select("source_count", F.col("y.n").alias("target_count"), "source_total", F.col("y.t").alias("target_total"))
    ok = (F.col("source_count") == F.col("target_count")) & (F.abs(F.col("source_total") - F.col("target_total")) <= tolerance)
    return out.withColumn("matches", F.coalesce(ok, F.lit(False)))


def reconcile_by_key(a: DataFrame, b: DataFrame, key: str, x: str, y: str, tolerance: float = 0.01) -> DataFrame:
    """Keys whose amounts differ by more than the tolerance, or that one side lacks."""
    per = lambda df, col, name: df.groupBy(key).agg(F.sum(col).alias(name))
    both = per(a, x, "expected").join(per(b, y, "actual"), key, "full")
    variance = X.dbl(F.coalesce("expected", F.lit(0))) - X.dbl(F.coalesce("actual", F.lit(0)))
    return both.select(key, X.dbl("expected").alias("expected"), X.dbl("actual").alias("actual"), variance.alias("variance")).filter(F.abs("variance") > tolerance)
