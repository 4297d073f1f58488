"""Reachability and cycles on graphs of awkward shapes."""

import random

import duckdb
import pytest

from finquarry.operators import lineage
from finquarry.plans import QUERIES


def graph(spark, pairs):
    edges = spark.createDataFrame([(i, a, b, "ACTIVE") for i, (a, b) in enumerate(pairs)], "edge_id bigint, source_node_id bigint, target_node_id bigint, status string")
    nodes = spark.createDataFrame([(n, "ACTIVE") for n in sorted({x for p in pairs for x in p if x is not None})], "node_id bigint, status string")
    return nodes, edges


def brute_cycles(pairs):
    follow = {}
    for a, b in pairs:
        if a is not None and b is not None:
            follow.setdefault(a, set()).add(b)
    out = set()
    for start in follow:
        seen, todo = set(), list(follow[start])
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += follow.get(n, ())
        if start in seen:
            out.add(start)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_nodes_on_cycles_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = rnd.choice([8, 15, 30])
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(rnd.choice([n // 2, n, n + 8]))]
    pairs += [(100 + i, 101 + i) for i in range(rnd.randrange(6))] + [(100, 1), (None, 3), (4, None)]
    ring = rnd.randrange(1, 5)
    pairs += [(200 + i, 200 + (i + 1) % ring) for i in range(ring)] + [(0, 300), (300, 301), (301, 302), (302, 0)][: rnd.randrange(5)]
    _, edges = graph(spark, pairs)
    got = {r.node_id for r in lineage.on_cycles(edges).collect()}
    assert got == brute_cycles(pairs)


def test_a_loop_beside_a_node_between_cycles(spark):
    """10 and 11 are a loop; without it, 10 is a chain between two components, which must not take 11 along."""
    three = lambda a: [(a + i, a + j) for i in range(3) for j in range(3) if i != j]
    pairs = [*three(1), *three(4), (3, 10), (10, 11), (11, 10), (10, 4), (11, 12), (12, 11)]
    _, edges = graph(spark, pairs)
    assert {r.node_id for r in lineage.on_cycles(edges).collect()} == brute_cycles(pairs) == {1, 2, 3, 4, 5, 6, 10, 11, 12}


@pytest.mark.parametrize("closed", [False, True])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, closed):
    rounds = []
    kept = lineage.cut_lineage
    monkeypatch.setattr(lineage, "cut_lineage", lambda df: rounds.append(1) or kept(df))
    pairs = [(i, i + 1) for i in range(2000)] + ([(2000, 500)] if closed else [])
    _, edges = graph(spark, pairs)
    assert lineage.on_cycles(edges).count() == (1501 if closed else 0)
    assert len(rounds) <= 30


@pytest.mark.parametrize("follow", [lineage.reach, lineage.nearest])
def test_levels_send_nothing_to_the_driver(spark, monkeypatch, follow):
    """No level broadcasts the graph, which each would collect on the driver again."""
    from finquarry.operators import relational

    plans = []
    for module in (lineage, relational):
        kept = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, kept=kept: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    nodes, edges = graph(spark, [(1, 2), (2, 3), (3, 4), (4, 2), (9, 1)])
    out = lineage.described(follow(nodes, edges, nodes.filter("node_id = 1"), False), nodes, "status")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert {(r.node, r.depth) for r in out.collect()} == {(1, 0), (2, 1), (3, 2), (4, 3)}
    assert len(plans) > 4 and not any("Broadcast" in p for p in plans)


def test_paths_go_on_to_their_end(spark):
    """Forty steps, past a cycle: every path, and one plan of few tables for them."""
    nodes, edges = graph(spark, [(i, i + 1) for i in range(40)] + [(40, 20), (30, 3)])
    down = lineage.reach(nodes, edges, nodes.filter("node_id = 0"), False)
    assert sorted((r.node, r.depth, r.path) for r in down.collect()) == [(i, i, [*range(i + 1)]) for i in range(41)]
    assert down._jdf.queryExecution().analyzed().toString().count("LogicalRDD") <= 17
    assert {r.depth for r in lineage.reach(nodes, edges, nodes.filter("node_id = 0"), False, 4).collect()} == {0, 1, 2, 3, 4}


@pytest.fixture
def deep_parts(spark, tmp_path):
    """Parts 1, 4, 16 ... 4^12: a chain of twelve edges in the graph of the queries, and three parts beside it."""
    rows = [(4**i, f"n{i}", "Brand#2" if i in (0, 12) else "Brand#3", "ECONOMY" if i == 0 else "SMALL", 9, 1.0) for i in range(13)] + [(2, "x", "Brand#9", "PROMO", 9, 1.0), (8, "y", "Brand#8", "PROMO", 9, 1.0), (34, "z", "Brand#7", "PROMO", 9, 1.0)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def checked_by_sql(spark, name, sf):
    """What the query returns, after it was held against what its SQL returns."""
    engine = duckdb.connect()
    engine.sql(f"CREATE VIEW part AS FROM '{sf}/part.parquet/*.parquet'")
    got = sorted(tuple(r) for r in QUERIES[name].run(spark, sf).collect())
    assert got == sorted(engine.sql(QUERIES[name].sql).fetchall())
    return got


def test_downstream_query_has_no_last_step(spark, deep_parts):
    got = checked_by_sql(spark, "lineage_downstream", deep_parts)
    assert [r[2] for r in got if r[0] == 1] == [*range(13)] and got[12][1] == 4**12
    assert max(r[2] for r in checked_by_sql(spark, "lineage_upstream", deep_parts)) == 10


def test_impact_chain_counts_paths_of_any_length(spark, deep_parts):
    assert sorted(checked_by_sql(spark, "lineage_impact_chain", deep_parts)) == [("DIRECT IMPACT", "Brand#3", 1), ("SECONDARY IMPACT", "Brand#3", 1), ("TERTIARY IMPACT", "Brand#2", 1), ("TERTIARY IMPACT", "Brand#3", 9)]


def test_validate_sends_nothing_to_the_driver(spark, monkeypatch):
    """Ends, rings, crossing cycles and what hangs between them: no round and no count broadcasts the graph."""
    plans = []
    kept = lineage.cut_lineage
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(lineage, "cut_lineage", lambda df: kept(seen(df)))
    pairs = [(1, 2), (2, 3), (3, 1), (2, 1), (3, 4), (4, 5), (5, 6), (6, 4), (5, 4), (7, 8), (8, 9), (9, 7), (10, 1), (6, 11), (12, 12), (13, 99)]
    nodes, edges = graph(spark, pairs)
    nodes = nodes.filter("node_id < 99").union(spark.createDataFrame([(50, "ACTIVE")], "node_id bigint, status string"))
    assert {r.node_id for r in seen(lineage.on_cycles(edges)).collect()} == {*range(1, 10), 12}
    assert [r.node_id for r in seen(lineage.orphans(nodes, edges)).collect()] == [50]
    assert [r.edge_id for r in seen(lineage.broken_edges(nodes, edges)).collect()] == [15]
    assert lineage.validate(nodes, edges).first().asDict() == {"orphan_nodes": 1, "broken_edges": 1, "nodes_on_cycles": 10}
    assert len(plans) > 20 and not any("Broadcast" in p for p in plans)


def test_rounds_do_not_lengthen_the_plans(spark, monkeypatch):
    """Two rows of nodes, each tied to the next both ways: no chains, many rounds, short plans."""
    sizes = []
    kept = lineage.cut_lineage
    monkeypatch.setattr(lineage, "cut_lineage", lambda df: sizes.append(df._jdf.queryExecution().analyzed().toString().count("Relation")) or kept(df))
    _, edges = graph(spark, [p for i in range(14) for p in ((i, i + 1), (i + 1, i))])
    assert {r.node_id for r in lineage.on_cycles(edges).collect()} == {*range(15)}
    assert len(sizes) > 20 and max(sizes) <= 12


def test_nearest_on_a_ladder_ends(spark):
    """Thirty levels of two nodes, each with both nodes of the level before as parents: 2^30 paths, 61 rows."""
    pairs = [(0, 2), (0, 3)] + [(2 * i + a, 2 * i + 2 + b) for i in range(1, 30) for a in (0, 1) for b in (0, 1)]
    nodes, edges = graph(spark, pairs)
    start = nodes.filter("node_id = 0")
    got = {r.node: (r.depth, r.parent, r.path) for r in lineage.nearest(nodes, edges, start, upstream=False).collect()}
    assert len(got) == 61 and got[61] == (30, 58, [0, *range(2, 60, 2), 61]) and got[0] == (0, None, [0])


def test_nearest_with_cycles_and_inactive_nodes(spark):
    nodes, edges = graph(spark, [(1, 2), (2, 3), (3, 1), (1, 3), (3, 4), (4, 5)])
    nodes = nodes.selectExpr("node_id", "CASE WHEN node_id = 5 THEN 'OLD' ELSE status END AS status")
    got = sorted((r.root, r.node, r.depth) for r in lineage.nearest(nodes, edges, nodes.filter("node_id IN (1, 4)"), upstream=False).collect())
    assert got == [(1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 2), (4, 4, 0)]
    up = sorted((r.node, r.depth, r.parent) for r in lineage.nearest(nodes, edges, nodes.filter("node_id = 4"), upstream=True).collect())
    assert up == [(1, 2, 3), (2, 2, 3), (3, 1, 4), (4, 0, None)]
