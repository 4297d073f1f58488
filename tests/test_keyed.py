"""Keyed tables: versions, merges that touch only what changes, and states folded from events."""

import random

import pytest
from pyspark.sql import functions as F

from finquarry.operators import ingest
from finquarry.sources.keyed import DuplicateKeys, KeyedTable


@pytest.fixture
def people(spark, tmp_path):
    """Ten files of a hundred rows."""
    df = spark.range(0, 2000, 2).selectExpr("id", "concat('n', id) AS name", "CAST(NULL AS timestamp) AS at")
    t = KeyedTable(spark, str(tmp_path / "t"), "id", df.schema, file_rows=100, stamp="at")
    t.commit(df, "2024-01-01 00:00:00")
    return t


def content(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_files_own_ranges_that_do_not_overlap(people):
    rows = sorted((r.low.id, r.high.id, r.rows) for r in people.manifest(1).collect())
    assert len(rows) >= 10 and all(n <= 100 for _, _, n in rows) and all(a[1] < b[0] for a, b in zip(rows, rows[1:]))
    assert people.read().count() == 1000


def test_a_merge_rewrites_only_files_whose_rows_change(spark, people):
    """1 % of the keys: some changed, some equal to what is stored, one new."""
    source = spark.range(400, 420).selectExpr("id", "CASE WHEN id < 410 THEN concat('x', id) ELSE concat('n', id) END AS name", "CAST(NULL AS timestamp) AS at").filter("id % 2 = 0 OR id = 401")
    equal = spark.createDataFrame([(1800, "n1800", None), (2, "n2", None)], source.schema)
    owners = {r.file for r in people.manifest(1).filter("low.id <= 410 AND high.id >= 400").collect()}
    before = set(people.files(1))
    people.merge(source.unionByName(equal), "2024-01-02 00:00:00")
    after = set(people.files(2))
    assert before - after == owners and len(owners) <= 2
    got = {r.id: (r.name, str(r.at)) for r in people.read().collect()}
    assert len(got) == 1001 and got[401] == ("x401", "2024-01-02 00:00:00") and got[404] == ("x404", "2024-01-02 00:00:00")
    assert got[412] == ("n412", "2024-01-01 00:00:00") and got[2] == ("n2", "2024-01-01 00:00:00")
    assert people.read(1).filter("name LIKE 'x%'").isEmpty() and people.read_as_of("2024-01-01 12:00:00").count() == 1000


def test_a_merge_without_changes_takes_all_files_over(people):
    people.merge(people.read(), "2024-01-02 00:00:00")
    assert people.files(2) == people.files(1)


def test_two_rows_of_a_key_and_missing_keys_are_errors(spark, people):
    for rows in ([(2, "a", None), (2, "a", None)], [(None, "a", None)]):
        with pytest.raises(DuplicateKeys):
            people.merge(spark.createDataFrame(rows, people.schema), "2024-01-02 00:00:00")
    assert people.latest()[0] == 1


def test_null_content_is_content(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "id", spark.createDataFrame([], "id int, a string, b string").schema)
    t.commit(spark.createDataFrame([(1, None, "x"), (2, "x", None)], t.schema), "2024-01-01 00:00:00")
    t.merge(spark.createDataFrame([(1, "x", None), (2, None, None), (3, None, None)], t.schema), "2024-01-02 00:00:00")
    assert {tuple(r) for r in t.read().collect()} == {(1, "x", None), (2, None, None), (3, None, None)}


def test_random_merges_of_composite_keys_equal_a_dict(spark, tmp_path):
    rnd, want = random.Random(4), {}
    t = KeyedTable(spark, str(tmp_path / "t"), ["day", "k"], spark.createDataFrame([], "day date, k string, v int").schema, file_rows=7)
    day = lambda: rnd.choice(["2024-01-01", "2024-01-02", "2024-02-01"])
    for i in range(6):
        rows = {(day(), rnd.choice("abcdefghij") + str(rnd.randrange(3))): (rnd.randrange(4), rnd.random() < 0.2) for _ in range(25)}
        source = spark.createDataFrame([(*k, *v) for k, v in rows.items()], "day string, k string, v int, gone boolean")
        t.merge(source, f"2024-01-0{i + 1} 00:00:00", deleted="gone")
        for k, (v, gone) in rows.items():
            want.pop(k, None) if gone else want.__setitem__(k, v)
        assert {(str(r.day), r.k): r.v for r in t.read().collect()} == want
        spans = sorted((r.low, r.high, r.rows) for r in t.manifest(t.latest()[0]).collect())
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and all(n <= 7 for _, _, n in spans)
    assert t.clone(2, str(tmp_path / "c"), "2024-03-01 00:00:00").read().count() == t.read(2).count()
    gone = t.vacuum(2)
    assert gone and not set(gone) & {*t.files(5), *t.files(6)} and {(str(r.day), r.k): r.v for r in t.read().collect()} == want


def test_growing_owners_are_split(spark, people):
    people.merge(spark.range(2001, 3001).selectExpr("id", "'new' AS name", "CAST(NULL AS timestamp) AS at"), "2024-01-02 00:00:00")
    assert all(r.rows <= 100 for r in people.manifest(2).collect()) and people.read().count() == 2000
    assert len(set(people.files(1)) - set(people.files(2))) == 1


# --- event log ----------------------------------------------------------------------------------------------
EVENTS = "account string, version int, balance int, event_id bigint"


def test_state_is_the_payload_of_the_latest_version(spark, tmp_path):
    log = [("A", 1, 0, 1), ("A", 2, 1000, 2), ("A", 4, 1300, 3), ("B", 1, 7, 4), ("A", 3, 800, 5)]  # version 3 arrives after version 4
    state = KeyedTable(spark, str(tmp_path / "s"), "account", spark.createDataFrame([], "account string, version int, balance int").schema)
    ingest.fold_events(state, spark.createDataFrame(log, EVENTS), "event_id", "version", "2024-01-01 00:00:00")
    assert content(state.read(), "account", "version", "balance") == [("A", 4, 1300), ("B", 1, 7)] and state.latest() == (1, 5)


def test_a_second_fold_reads_only_events_after_the_mark(spark, tmp_path):
    state = KeyedTable(spark, str(tmp_path / "s"), "account", spark.createDataFrame([], "account string, version int, balance int").schema)
    path = str(tmp_path / "log")
    spark.createDataFrame([("A", 5, 50, 1), ("B", 2, 20, 2)], EVENTS).write.parquet(path)
    ingest.fold_events(state, spark.read.parquet(path), "event_id", "version", "2024-01-01 00:00:00")
    spark.createDataFrame([("A", 4, 40, 3), ("B", 3, 30, 4), ("C", 1, 10, 5), ("B", 3, 31, 6)], EVENTS).write.mode("append").parquet(path)
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(balance):
        read.add(1)
        return balance

    counted = spark.read.parquet(path).withColumn("balance", seen("balance"))
    ingest.fold_events(state, counted, "event_id", "version", "2024-01-02 00:00:00")
    assert content(state.read(), "account", "version", "balance") == [("A", 5, 50), ("B", 3, 30), ("C", 1, 10)] and state.latest() == (2, 6)
    assert read.value == 4
    ingest.fold_events(state, counted, "event_id", "version", "2024-01-03 00:00:00")
    assert state.latest() == (2, 6) and read.value == 4


def test_rows_with_null_content_are_neither_lost_nor_taken_for_new(rows):
    old = rows("id int, v string", [(1, None), (2, "a"), (3, None), (5, "x")])
    new = rows("id int, v string", [(1, None), (2, None), (3, "b"), (4, None), (5, "x")])
    got = {r.id: r.change for r in ingest.changed_by_hash(new, old, "id").collect()}
    assert got == {2: "CHANGED", 3: "CHANGED", 4: "NEW"}
    wide = lambda df: df.withColumn("w", F.lit("1:-"))
    assert {r.id: r.change for r in ingest.changed_by_hash(wide(new), wide(old), "id").collect()} == got
