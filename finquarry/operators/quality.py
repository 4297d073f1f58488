"""Data quality: rules compiled to one aggregate per table, results, scores, gates, reports.

Result rows: rule_name, table_name, column_name, rule_type, severity, action, total_rows,
failed_rows, pass_rate, threshold, threshold_met, status.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finquarry.functions import exprs as X
from finquarry.operators import skew

SEVERITY_ORDER = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
ESCALATION_HOURS = {"CRITICAL": 1, "HIGH": 4}


@dataclass(frozen=True)
class Rule:
    """One check. ``kind`` decides which of the other fields count.

    completeness, uniqueness (``columns``), range (``low``/``high``), accepted_values
    (``values``), pattern, expression (a condition that must hold), referential
    (``parent`` table and ``parent_key``), zscore (``high`` = limit), freshness
    (``high`` = hours), custom (``sql`` with ``low``/``high`` bounds for its one number).
    """

    name: str
    table: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    low: float | str | None = None
    high: float | str | None = None
    values: tuple = ()
    pattern: str | None = None
    expression: str | None = None
    parent: str | None = None
    parent_key: str | None = None
    sql: str | None = None
    threshold: float = 100.0
    severity: str = "HIGH"
    action: str = "ALERT"


ROW_KINDS = ("completeness", "range", "accepted_values", "pattern", "expression")


def violated(rule: Rule) -> Column:
    """Condition of a row-level violation. NULLs violate completeness only."""
    c = F.col(rule.column) if rule.column else None
    if rule.kind == "completeness":
        return c.isNull()
    if rule.kind == "range":
        tests = ([c < F.lit(rule.low)] if rule.low is not None else []) + ([c > F.lit(rule.high)] if rule.high is not None else [])
        return reduce(lambda a, z: a | z, tests)
    if rule.kind == "accepted_values":
        return ~c.isin(*rule.values)
    if rule.kind == "pattern":
        return ~c.rlike(rule.pattern)
    if rule.kind == "expression":
        return ~F.coalesce(F.expr(rule.expression), F.lit(True))
    raise ValueError(f"{rule.kind} is not a row rule")


def _result(rule: Rule, total: Column, failed: Column) -> Column:
    rate = F.coalesce(X.pct(total - failed, total), F.lit(100.0))
    met = rate >= rule.threshold
    return F.struct(
        F.lit(rule.name).alias("rule_name"), F.lit(rule.table).alias("table_name"), F.lit(rule.column or ",".join(rule.columns)).alias("column_name"), F.lit(rule.kind).alias("rule_type"), F.lit(rule.severity).alias("severity"), F.lit(rule.action).alias("action"),
        total.cast("bigint").alias("total_rows"), failed.cast("bigint").alias("failed_rows"), rate.alias("pass_rate"), F.lit(float(rule.threshold)).alias("threshold"), met.alias("threshold_met"), F.when(met, "PASS").otherwise("FAIL").alias("status"),
    )


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules of a table in a single pass."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(violated(r)).alias(f"_f{i}") for i, r in enumerate(rules)])
    return counts.select(F.inline(F.array(*[_result(r, F.col("_n"), F.col(f"_f{i}")) for i, r in enumerate(rules)])))


def _uniqueness(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows beyond the first of each key: counted per key first, so hot keys shrink on the map side."""
    cols = rule.columns or (rule.column,)
    per = df.groupBy(*cols).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.count("*").alias("d")).select(F.inline(F.array(_result(rule, F.col("t"), F.col("t") - F.col("d")))))


def _referential(df: DataFrame, parent: DataFrame, rule: Rule) -> DataFrame:
    per = df.filter(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("_k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(rule.parent_key).alias("_k")).distinct().withColumn("_p", F.lit(True))
    out = per.join(known, "_k", "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("n"))), F.lit(0)).alias("f"))
    return out.select(F.inline(F.array(_result(rule, F.col("t"), F.col("f")))))


def mean_and_spread(df: DataFrame, column: str) -> DataFrame:
    """One row (n, mean, sd) from exact sums."""
    x = F.col(column).cast("decimal(18,4)")
    return df.agg(F.count(x).alias("n"), X.davg(x).alias("mean"), X.dstd(x).alias("sd"))


def zscore_outliers(df: DataFrame, column: str, limit: float = 3.0, min_rows: int = 30) -> DataFrame:
    """Rows further than ``limit`` deviations from the mean; none below ``min_rows`` values."""
    s = mean_and_spread(df, column).select(F.struct("n", "mean", "sd")).scalar()
    out = df.withColumn("_s", s).withColumn("zscore", X.ratio(X.dbl(column) - F.col("_s.mean"), F.col("_s.sd")))
    return out.filter((F.col("_s.n") >= min_rows) & (F.abs("zscore") > limit)).drop("_s")


def _zscore(df: DataFrame, rule: Rule) -> DataFrame:
    bad = zscore_outliers(df, rule.column, float(rule.high or 3.0)).agg(F.count("*")).scalar()
    return df.agg(F.count("*").alias("t")).withColumn("f", bad).select(F.inline(F.array(_result(rule, F.col("t"), F.col("f")))))


def _freshness(df: DataFrame, rule: Rule, as_of: str) -> DataFrame:
    age = df.agg((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.max(rule.column).cast("timestamp"))).alias("s"))
    return age.select(F.inline(F.array(_result(rule, F.lit(1), F.when(F.col("s") / 3600 <= rule.high, 0).otherwise(1)))))


def _custom(spark, rule: Rule) -> DataFrame:
    v = spark.sql(rule.sql)
    x = X.dbl(v.columns[0])
    ok = (x >= rule.low if rule.low is not None else F.lit(True)) & (x <= rule.high if rule.high is not None else F.lit(True))
    return v.select(F.inline(F.array(_result(rule, F.lit(1), F.when(ok, 0).otherwise(1)))))


def run_rules(tables: dict[str, DataFrame], rules: Sequence[Rule], as_of: str | None = None) -> DataFrame:
    """All rules over all tables; one result row per rule."""
    parts = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if r.kind in ROW_KINDS:
            by_table.setdefault(r.table, []).append(r)
    parts += [_row_rules(tables[t], rs) for t, rs in by_table.items()]
    for r in rules:
        if r.kind == "uniqueness":
            parts.append(_uniqueness(tables[r.table], r))
        elif r.kind == "referential":
            parts.append(_referential(tables[r.table], tables[r.parent], r))
        elif r.kind == "zscore":
            parts.append(_zscore(tables[r.table], r))
        elif r.kind == "freshness":
            parts.append(_freshness(tables[r.table], r, as_of))
        elif r.kind == "custom":
            parts.append(_custom(tables[r.table].sparkSession, r))
    return reduce(lambda a, z: a.unionByName(z), parts)


# --- preset rule lists ------------------------------------------------------------------------------
def order_rules(table: str, key: str, customer: str, amount: str, status: str, statuses: Sequence[str], day: str, first_day: str) -> list[Rule]:
    return [
        Rule("order_id_not_null", table, "completeness", key, severity="CRITICAL", action="BLOCK"), Rule("order_id_unique", table, "uniqueness", key, severity="CRITICAL", action="BLOCK"), Rule("customer_not_null", table, "completeness", customer),
        Rule("amount_range", table, "range", amount, low=0, high=1000000), Rule("status_valid", table, "accepted_values", status, values=tuple(statuses)), Rule("date_range", table, "expression", day, expression=f"{day} >= date'{first_day}'", severity="LOW", action="LOG"),
    ]


def table_tests(table: str, unique: Sequence[str] = (), not_null: Sequence[str] = (), accepted: dict[str, Sequence] | None = None, parents: dict[str, tuple[str, str]] | None = None, holds: dict[str, str] | None = None) -> list[Rule]:
    """The declarative tests of a model: unique, not_null, accepted_values, relationships, expressions."""
    out = [Rule(f"unique_{c}", table, "uniqueness", c) for c in unique] + [Rule(f"not_null_{c}", table, "completeness", c) for c in not_null]
    out += [Rule(f"accepted_values_{c}", table, "accepted_values", c, values=tuple(v)) for c, v in (accepted or {}).items()]
    out += [Rule(f"relationships_{c}", table, "referential", c, parent=p, parent_key=k) for c, (p, k) in (parents or {}).items()]
    return out + [Rule(f"expression_{n}", table, "expression", n, expression=e) for n, e in (holds or {}).items()]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


# --- decisions and scores ------------------------------------------------------------------------------
class GateClosed(RuntimeError):
    """A blocking rule failed."""


def gate(results: DataFrame) -> DataFrame:
    """What each result leads to: BLOCK, ALERT, LOG or PASS."""
    return results.withColumn("decision", F.when(F.col("status") == "PASS", "PASS").otherwise(F.col("action")))


def enforce(results: DataFrame) -> None:
    failed = gate(results).filter("decision = 'BLOCK'").select("table_name", "rule_name").limit(20).collect()
    if failed:
        raise GateClosed(", ".join(f"{r.table_name}.{r.rule_name}" for r in failed))


def grade(score: Column) -> Column:
    return F.when(score >= 99, "EXCELLENT").when(score >= 95, "GOOD").when(score >= 90, "POOR").otherwise("CRITICAL")


def score(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean pass rate of the completeness, uniqueness and freshness checks, their mean and a grade."""
    dim = lambda kind: F.coalesce(F.sum(F.when(F.col("rule_type") == kind, F.col("pass_rate").cast("decimal(28,10)"))).cast("double") / F.nullif(F.count_if(F.col("rule_type") == kind), F.lit(0)), F.lit(100.0))
    aggs = [dim("completeness").alias("completeness_score"), dim("uniqueness").alias("uniqueness_score"), dim("freshness").alias("timeliness_score"), F.count("*").alias("total_checks"), F.count_if(F.col("status") == "PASS").alias("passed_checks")]
    out = results.groupBy(*by).agg(*aggs) if by else results.agg(*aggs)
    overall = (F.col("completeness_score") + F.col("uniqueness_score") + F.col("timeliness_score")) / 3
    return out.withColumn("overall_score", overall).withColumn("grade", grade(F.col("overall_score"))).withColumn("failed_checks", F.col("total_checks") - F.col("passed_checks"))


def weighted_score(uniqueness: Column, completeness: Column, freshness: Column, validity: Column) -> Column:
    return (uniqueness + completeness + freshness + validity) * 0.25


def timeliness(age_hours: Column, limit_hours: float) -> Column:
    return F.greatest(F.lit(0.0), F.lit(100.0) - age_hours / limit_hours * 100.0)


def table_metrics(df: DataFrame, name: str, key: str, required: str, valid: Column) -> DataFrame:
    keys = df.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col(required).isNotNull()).alias("r"), F.count_if(valid).alias("v"))
    t = keys.agg(F.sum("n").alias("total_rows"), F.count(key).alias("unique_primary_keys"), F.sum("r").alias("_r"), F.sum("v").alias("_v"))
    return t.select(F.lit(name).alias("table_name"), "total_rows", "unique_primary_keys", X.pct("unique_primary_keys", "total_rows").alias("uniqueness_pct"), X.pct("_r", "total_rows").alias("completeness_pct"), X.pct("_v", "total_rows").alias("validity_pct"))


def profile(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Per column: NULL share, distinct values, least and greatest value (text), mean (numbers).

    Each column is read by itself and its values are counted before they are shuffled, so no
    row is multiplied by the number of columns.
    """
    parts = []
    for c in [*numeric, *text]:
        per = df.groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n"))
        total = F.sum(F.col("v").cast("decimal(18,4)") * F.col("n")).cast("double") / F.sum(F.when(F.col("v").isNotNull(), F.col("n"))) if c in numeric else F.lit(None).cast("double")
        one = per.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("_z"), F.count("v").alias("distinct_count"),
            F.min("v").cast("string").alias("min_value"), F.max("v").cast("string").alias("max_value"), total.alias("mean_value"),
        )
        parts.append(one.select(F.lit(c).alias("column_name"), "row_count", X.pct("_z", "row_count").alias("null_pct"), "distinct_count", "min_value", "max_value", "mean_value"))
    return reduce(DataFrame.unionByName, parts)


# --- series and reports ------------------------------------------------------------------------------
def score_trend(scores: DataFrame) -> DataFrame:
    """Daily score against the day before, a week and a month ago (one row per day)."""
    w = Window.orderBy("score_date")
    s = F.col("overall_score")
    seven = w.rowsBetween(-6, 0)
    return scores.select(
        "score_date", s, F.lag(s).over(w).alias("previous_day_score"), (s - F.lag(s).over(w)).alias("score_change"), (F.sum(s.cast("decimal(28,10)")).over(seven).cast("double") / F.count(s).over(seven)).alias("moving_avg_7d"),
        (s - F.lag(s, 7).over(w)).alias("week_over_week"), (s - F.lag(s, 30).over(w)).alias("month_over_month"), F.when(s > F.lag(s).over(w), "IMPROVING").when(s < F.lag(s).over(w), "DECLINING").otherwise("STABLE").alias("trend"),
    )


def consecutive_failures(history: DataFrame, key: str, order: Sequence[str], failed: str, at_least: int = 3) -> DataFrame:
    """Runs of failures: rows between two passes form an island, numbered by the passes before it."""
    rows = skew.running_sum(history, key, list(order), F.when(F.col(failed), 0).otherwise(1), "_island")
    runs = rows.filter(F.col(failed)).groupBy(key, "_island").agg(F.count("*").alias("run_length"), F.min(order[0]).alias("first_failure"))
    return runs.filter(F.col("run_length") >= at_least).drop("_island")


def volume_rule(daily: DataFrame, low: int, high: int, limit_pct: float) -> DataFrame:
    """``daily (day, row_count)``: outside the bounds, or off by more than the limit from the day before."""
    prev = F.lag("row_count").over(Window.orderBy("day"))
    out = daily.withColumn("change_pct", X.pct(F.col("row_count") - prev, prev))
    bad = (F.col("row_count") < low) | (F.col("row_count") > high) | (F.abs(F.coalesce("change_pct", F.lit(0.0))) > limit_pct)
    return out.withColumn("status", F.when(bad, "FAIL").otherwise("PASS"))


def sequence_gaps(df: DataFrame, key: str, day: str, tie: str, max_days: int) -> DataFrame:
    """Pauses of more than ``max_days`` between consecutive rows of a key."""
    rows = skew.neighbours(df, key, [day, tie], previous={day: "previous_date"})
    return rows.withColumn("gap_days", F.datediff(day, "previous_date")).filter(F.col("gap_days") > max_days).select(key, tie, "previous_date", day, "gap_days")


def open_anomalies(anomalies: DataFrame, catalog: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("status").isin("OPEN", "INVESTIGATING")).join(catalog.select("rule_id", "rule_name", "owner"), "rule_id", "left").withColumn("severity_rank", severity_rank())


def severity_rank() -> Column:
    out = None
    for k, v in SEVERITY_ORDER.items():
        out = F.when(F.col("severity") == k, v) if out is None else out.when(F.col("severity") == k, v)
    return out.otherwise(9)


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(F.col("detected_at").cast("date").alias("detection_date"), "table_name", "severity").agg(F.count("*").alias("anomaly_count"), F.sum("affected_rows").alias("total_affected_rows"))


def anomaly_trend(anomalies: DataFrame) -> DataFrame:
    sev, st = F.col("severity"), F.col("status")
    return anomalies.groupBy(F.col("detected_at").cast("date").alias("detection_date")).agg(
        F.count("*").alias("total_anomalies"), *[F.count_if(sev == s).alias(f"{s.lower()}_count") for s in SEVERITY_ORDER], F.count_if(st == "RESOLVED").alias("resolved_count"), F.count_if(st == "OPEN").alias("open_count")
    )


def status_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    a, z = old.select(key, F.col("status").alias("old_status")), new.select(key, F.col("status").alias("new_status"))
    return a.join(z, key).filter(~F.col("old_status").eqNullSafe(F.col("new_status")))


def critical_failures(runs: DataFrame, catalog: DataFrame, as_of: str, hours: int) -> DataFrame:
    """Failed critical and high rules of the last hours, with the need to escalate."""
    now = F.lit(as_of).cast("timestamp")
    out = runs.filter("status = 'FAIL'").join(catalog, "rule_id").filter(F.col("severity").isin("CRITICAL", "HIGH"))
    out = out.withColumn("hours_since_failure", X.ratio(F.unix_timestamp(now) - F.unix_timestamp(F.col("completed_at").cast("timestamp")), F.lit(3600))).filter(F.col("hours_since_failure").between(0, hours))
    late = reduce(lambda a, z: a | z, [(F.col("severity") == s) & (F.col("hours_since_failure") > h) for s, h in ESCALATION_HOURS.items()])
    return out.withColumn("escalation_needed", F.when(late, "YES - ESCALATE").otherwise("NO"))


def failed_tests(runs: DataFrame, catalog: DataFrame) -> DataFrame:
    return runs.filter("status = 'FAIL'").join(catalog, "rule_id").groupBy("rule_id", "rule_name", "severity", "owner").agg(F.count("*").alias("failures"), F.max("completed_at").alias("last_failure"))


def issues_by_owner(runs: DataFrame, catalog: DataFrame) -> DataFrame:
    bad = runs.filter("status = 'FAIL'").groupBy("rule_id").agg(F.count("*").alias("n")).join(catalog, "rule_id")
    return bad.groupBy("owner").agg(F.sum("n").alias("failed_checks"), F.count("*").alias("rules"), F.array_join(F.sort_array(F.collect_set("severity")), ", ").alias("severities"))


def main_dashboard(scores: DataFrame, anomalies: DataFrame, runs: DataFrame) -> DataFrame:
    """``scores`` is the one-row current score; the other tables are counted in one pass each."""
    a = anomalies.agg(F.count("*").alias("anomalies_detected"), F.count_if(F.col("severity") == "CRITICAL").alias("critical_anomalies"), F.count_if(F.col("status") == "OPEN").alias("open_anomalies"))
    t = runs.agg(F.count_if(F.col("status") == "PASS").alias("tests_passed"), F.count_if(F.col("status") == "FAIL").alias("tests_failed"), (X.davg("duration_ms") / 1000.0).alias("avg_test_duration_sec"))
    from finquarry.operators.risk import one_row

    out = one_row(scores.select(F.col("overall_score").alias("current_quality_score"), F.col("grade").alias("quality_grade")), a, t)
    s = F.col("current_quality_score")
    return out.withColumn("system_health", F.when(s >= 99, "HEALTHY").when(s >= 95, "WARNING").when(s >= 90, "DEGRADED").otherwise("CRITICAL"))


def table_dashboard(results: DataFrame) -> DataFrame:
    out = score(results, ["table_name"]).join(results.groupBy("table_name").agg(F.count_if((F.col("status") == "FAIL") & (F.col("severity") == "CRITICAL")).alias("critical_failures")), "table_name")
    return out.withColumn("status", F.when(F.col("critical_failures") > 0, "CRITICAL").when(F.col("failed_checks") > 0, "WARNING").otherwise("HEALTHY"))


def null_trace(layers: dict[str, DataFrame], column: str) -> DataFrame:
    """NULLs of a column through the layers, in order."""
    parts = [df.agg(F.count("*").alias("row_count"), F.count_if(F.col(column).isNull()).alias("null_count")).select(F.lit(i).alias("layer_order"), F.lit(n).alias("layer"), "row_count", "null_count", X.pct("null_count", "row_count").alias("null_pct")) for i, (n, df) in enumerate(layers.items(), start=1)]
    return reduce(lambda a, z: a.unionByName(z), parts)


# --- drift ------------------------------------------------------------------------------------------------
def population_stability(a: DataFrame, b: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """PSI of a column between two snapshots over fixed bins; empty bins count as half a row."""
    bin_of = reduce(lambda acc, e: acc + F.when(F.col(column) > e, 1).otherwise(0), edges, F.lit(0))
    per = lambda df, n: df.groupBy(bin_of.alias("bin")).agg(F.count("*").alias(n))
    na, nb = a.agg(F.count("*")).scalar(), b.agg(F.count("*")).scalar()
    both = per(a, "x").join(per(b, "y"), "bin", "full").withColumns({"p": F.coalesce(X.dbl("x"), F.lit(0.5)) / na, "q": F.coalesce(X.dbl("y"), F.lit(0.5)) / nb})
    out = both.agg(F.sum(((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).cast("decimal(28,12)")).cast("double").alias("psi"), F.count("*").alias("bins"))
    return out.withColumn("drift", F.when(F.col("psi") > 0.25, "MAJOR").when(F.col("psi") > 0.1, "MODERATE").otherwise("NONE"))


def trailing_band(daily: DataFrame, day: str, value: str, rows_back: int, limit: float) -> DataFrame:
    """Days outside the mean plus or minus ``limit`` deviations of the days before (one row per day)."""
    w = Window.orderBy(day).rowsBetween(-rows_back, -1)
    x = F.col(value).cast("decimal(18,2)")
    n, s, q = F.count(x).over(w), F.sum(x).over(w).cast("double"), F.sum((x * x).cast("decimal(38,4)")).over(w).cast("double")
    out = daily.withColumns({"_n": n, "_m": s / F.nullif(n, F.lit(0)), "_s": F.sqrt(F.greatest((q - s * s / F.nullif(n, F.lit(0))) / F.nullif(n - 1, F.lit(0)), F.lit(0.0)))})
    return out.withColumn("is_anomaly", F.coalesce((F.col("_n") >= 3) & (F.abs(X.dbl(value) - F.col("_m")) > F.col("_s") * limit), F.lit(False))).drop("_n", "_m", "_s")
