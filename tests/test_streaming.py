"""Streams across several deliveries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from finquarry.streaming import core, stateful, transforms

BASE = dt.datetime(2024, 1, 1, 10)


def deliver(spark, box, schema, data):
    box.deliver(spark.createDataFrame(data, schema))


def brute_matches(data, steps, limit):
    want = {}
    for u in {d[0] for d in data}:
        at, began, n = 0, None, 0
        for _, t, s, _ in sorted((d for d in data if d[0] == u and d[2] in steps), key=lambda d: (d[1], d[3])):
            if at and (t - began).total_seconds() > limit:
                at = 0
            if s == steps[at]:
                began = t if at == 0 else began
                at += 1
                if at == len(steps):
                    at, n = 0, n + 1
            elif s == steps[0]:
                at, began = 1, t
        want[u] = n
    return want


END = dt.datetime(2100, 1, 1)


def test_a_pattern_key_makes_few_calls_to_its_store():
    """Events on a hundred days in one batch: one timer and a handful of calls, and what the watermark has not passed stays."""
    calls, held, store = [], {"buffer": [], "progress": None}, type("Store", (), {})

    class State:
        def __init__(self, name):
            self.name = name

        def __getattr__(self, op):
            def call(value=None):
                calls.append(op)
                if op == "get":
                    return iter(held["buffer"]) if self.name == "buffer" else held["progress"]
                held[self.name] = [*held["buffer"], *value] if op == "appendList" else value if op in ("put", "update") else []

            return call

    timers = set()
    handle = store()
    handle.getListState = handle.getValueState = handle.getMapState = lambda name, *_: State(name)
    handle.registerTimer = lambda at: calls.append("register") or timers.add(at)
    handle.deleteTimer = lambda at: calls.append("delete") or timers.discard(at)
    p = stateful.OrderedPattern(["a", "b"], 2 * 86_400_000_000, 86_400_000_000)
    p.init(handle)
    day = lambda d, step: {"_t": d * 86_400_000_000, "_tie": d, "_step": step}
    list(p.handleInputRows(("k",), iter([day(d, d % 2) for d in reversed(range(100))]), None))
    assert timers == {86_400_000} and len(calls) <= 6
    values = store()
    values.getCurrentWatermarkInMs = lambda: 60 * 86_400_000
    timers.clear()
    assert [r.matches for r in p.handleExpiredTimer(("k",), values, None)] == [30]
    assert len(held["buffer"]) == 40 and timers == {61 * 86_400_000} and len(calls) <= 12
    list(p.handleInputRows(("k",), iter([day(60.5, 0) | {"_t": 60 * 86_400_000_000 + 5}]), None))
    assert timers == {61 * 86_400_000}
    values.getCurrentWatermarkInMs = lambda: 1000 * 86_400_000
    assert [r.matches for r in p.handleExpiredTimer(("k",), values, None)] == [50] and not held["buffer"]


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_pattern_of_events_out_of_order_across_batches(spark, parts):
    """Events arrive shuffled within the watermark's delay, over deliveries that cut patterns apart: the batch result."""
    rng = random.Random(3)
    data = [(rng.randint(1, 4), BASE + dt.timedelta(minutes=(i // 2) * 7), rng.choice(["signup", "view", "buy", "noise"]), i) for i in range(300)]
    arrival = sorted(data, key=lambda d: d[1] + dt.timedelta(minutes=rng.randint(0, 170)))
    schema = "u bigint, ts timestamp, s string, id bigint"
    box = core.Inbox(spark, "pattern", spark.createDataFrame([], schema).schema)
    with stateful.with_state_store(spark):
        job = stateful.pattern_matches(core.timed(box.stream(), "ts", "3 hours"), "u", "ts", "s", "id", ["signup", "view", "buy"], 3600, 600)
        for i in range(parts):
            deliver(spark, box, schema, arrival[i * 300 // parts : (i + 1) * 300 // parts])
            box.run(job, "update")
        deliver(spark, box, schema, [(None, END, None, None)])
        out = box.run(job, "update")
    want = brute_matches(data, ["signup", "view", "buy"], 3600)
    assert {r.u: r.matches for r in core.upserted(out, ["u"]).collect()} == want and sum(want.values()) > 0


def test_aggregator_survives_restarts_and_lets_idle_keys_go(spark):
    schema = "u bigint, v double, ts timestamp"
    box = core.Inbox(spark, "aggregator", spark.createDataFrame([], schema).schema)
    m = lambda k: BASE + dt.timedelta(minutes=k)
    with stateful.with_state_store(spark):
        job = stateful.aggregated(box.stream(), "u", "v", "ts", 3600, "10 minutes")
        deliver(spark, box, schema, [(1, 1.25, m(0)), (1, 2.5, m(5)), (2, 4.0, m(0))])
        assert box.run(job).isEmpty()
        deliver(spark, box, schema, [(1, 0.25, m(50)), (1, 9.0, m(40))])  # after a stop; out of order within the delay
        assert box.run(job).isEmpty()
        deliver(spark, box, schema, [(3, 1.0, m(90))])  # key 2 has been idle since the start
        got = [tuple(r) for r in box.run(job).drop("batch_id").collect()]
        assert got == [(2, 4.0, 1, 4.0)]
        deliver(spark, box, schema, [(2, 8.0, m(95)), (1, 1.0, m(100))])  # key 2 begins anew, key 1 goes on
        box.run(job)
        deliver(spark, box, schema, [(-1, 0.0, END)])
        got = sorted(tuple(r) for r in box.run(job).drop("batch_id").collect())
    assert got == [(1, 14.0, 5, 9.0), (2, 4.0, 1, 4.0), (2, 8.0, 1, 8.0), (3, 1.0, 1, 1.0)]


def test_a_batch_into_a_table_costs_what_it_changes(spark):
    schema = "k int, v int"
    box = core.Inbox(spark, "table", spark.createDataFrame([], schema).schema)
    job = box.stream().groupBy("k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    deliver(spark, box, schema, [(k, 1) for k in range(1000)] + [(None, 5)])
    table = core.run_to_table(job, box.folder, ["k"], file_rows=100)
    files = [set(table.files(1))]
    for i in range(5):
        deliver(spark, box, schema, [(i * 3, 10), (None, 1)])
        table = core.run_to_table(job, box.folder, ["k"], file_rows=100)
        files.append(set(table.files(table.latest()[0])))
    assert len(files[0]) >= 10 and all(len(b - a) <= 2 and len(b) == len(a) for a, b in zip(files, files[1:]))
    got = {r.k: (r.v, r.n) for r in table.read().collect()}
    assert len(got) == 1001 and got[None] == (10, 6) and got[3] == (11, 2) and got[999] == (1, 1)
    data = spark.read.option("recursiveFileLookup", "true").parquet(f"{box.folder}/table/data").inputFiles()
    assert len(data) <= len(files[-1]) + 2  # what older versions alone named is gone


def test_a_repeated_batch_changes_nothing(spark):
    schema = "k int, v int"
    box = core.Inbox(spark, "table", spark.createDataFrame([], schema).schema)
    deliver(spark, box, schema, [(1, 1), (2, 2)])
    job = box.stream().groupBy("k").agg(F.sum("v").alias("v"))
    table = core.run_to_table(job, box.folder, ["k"])
    before = table.latest()
    core.run_to_table(job, box.folder, ["k"])
    assert table.latest() == before and sorted(map(tuple, table.read().collect())) == [(1, 1), (2, 2)]


def test_a_replay_closes_windows_after_all_files(spark, tmp_path):
    """Files come in several batches; the sentinel comes after the last."""
    path = str(tmp_path / "in")
    rows = [(i, BASE + dt.timedelta(minutes=i)) for i in range(60)]
    for i in range(3):
        spark.createDataFrame(rows[i * 20 : (i + 1) * 20], "id int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    r = core.Replay(spark, path, spark.read.parquet(path).schema, "ts", "30 minutes")
    out = r.run(r.stream().groupBy(F.window("ts", "10 minutes").alias("w")).agg(F.count("id").alias("n")).filter("n > 0"))
    assert sorted(x.n for x in out.collect()) == [10] * 6


def test_late_rows_within_the_delay_count_and_later_ones_do_not(spark):
    schema = "id int, ts timestamp"
    box = core.Inbox(spark, "late", spark.createDataFrame([], schema).schema)
    job = transforms.windowed(core.timed(box.stream(), "ts", "10 minutes"), "ts", "5 minutes", [], [F.count("*").alias("n")])
    m = lambda k: BASE + dt.timedelta(minutes=k)
    deliver(spark, box, schema, [(1, m(0)), (2, m(20))])
    box.run(job, "update")
    deliver(spark, box, schema, [(3, m(12)), (4, m(-60))])  # the first is late but inside the delay
    out = core.upserted(box.run(job, "update"), ["window_start"])
    assert sorted((r.window_start, r.n) for r in out.collect()) == [(m(0), 1), (m(10), 1), (m(20), 1)]


def test_dead_letters_keep_the_original_text(spark):
    raw = spark.createDataFrame([('{"id": 1}',), ("{broken",), ('{"id": "x"}',)], "value string")
    out = transforms.split_unparsed(raw, "id bigint")
    assert sorted(r.dead for r in out.filter("dead IS NOT NULL").collect()) == ['{"id": "x"}', "{broken"]
    assert [r.id for r in out.filter("dead IS NULL").select("m.id").collect()] == [1]
