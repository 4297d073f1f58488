"""Lineage over ``nodes`` and ``edges`` tables.

nodes: node_id, node_name, node_type, table_name, column_name, source_system, is_pii, status
edges: edge_id, source_node_id, target_node_id, edge_type, lineage_level, process_name, status
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finquarry.operators import skew
from finquarry.operators.relational import walk
from finquarry.session import written as cut_lineage

ACTIVE = "ACTIVE"


def _prefixed(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{side}_{c}") for c in nodes.columns])


def connections(nodes: DataFrame, edges: DataFrame, active_nodes: bool = True) -> DataFrame:
    """Active edges with both ends; the base of every report."""
    live = nodes.filter(F.col("status") == ACTIVE) if active_nodes else nodes
    e = edges.filter(F.col("status") == ACTIVE).drop("status")
    s, t = _prefixed(live, "source"), _prefixed(live, "target")
    e = e.withColumnsRenamed({"source_node_id": "_s", "target_node_id": "_t"})
    return e.join(s, e._s == s.source_node_id).join(t, F.col("_t") == t.target_node_id).drop("_s", "_t")


def reach(nodes: DataFrame, edges: DataFrame, start: DataFrame, upstream: bool, max_depth: int | None = None) -> DataFrame:
    """Every path from the start nodes (column ``node_id``) against or along the edges, to any depth; cycles end a path.

    Only a report that is defined to a number of steps gives ``max_depth``.
    """
    live = nodes.filter(F.col("status") == ACTIVE).select("node_id")
    e = edges.filter(F.col("status") == ACTIVE)
    src, dst = ("target_node_id", "source_node_id") if upstream else ("source_node_id", "target_node_id")
    steps = cut_lineage(e.join(live.hint("merge"), e[dst] == live.node_id, "left_semi").select(F.col(src).alias("src"), F.col(dst).alias("dst")))
    return walk(start.select(F.col("node_id").alias("root"), F.col("node_id").alias("node")), steps, max_depth)


def nearest(nodes: DataFrame, edges: DataFrame, start: DataFrame, upstream: bool) -> DataFrame:
    """What the start nodes (column ``node_id``) reach, to any depth: root, node, depth (the smallest), parent, path.

    One row per root and node: the frontier holds what was not reached before, so paths don't
    multiply and cycles end. Of the shortest paths the smallest in order is kept; the parent is
    the node before on it. Joins sort: what grows with the graph is never sent to the driver for a broadcast, level by level.
    """
    live = nodes.filter(F.col("status") == ACTIVE).select("node_id")
    e = edges.filter(F.col("status") == ACTIVE)
    src, dst = ("target_node_id", "source_node_id") if upstream else ("source_node_id", "target_node_id")
    steps = cut_lineage(e.join(live.hint("merge"), e[dst] == live.node_id, "left_semi").select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct())
    reached = start.select(F.col("node_id").alias("root"), F.col("node_id").alias("node"), F.lit(0).alias("depth"), F.lit(None).cast("bigint").alias("parent"), F.array("node_id").alias("path")).distinct()
    levels, frontier, depth = [cut_lineage(reached)], reached, 0
    while True:
        depth += 1
        come = frontier.join(steps.hint("merge"), frontier.node == steps.src).select("root", F.col("dst").alias("node"), F.col("src").alias("parent"), F.concat("path", F.array("dst")).alias("path"))
        best = come.groupBy("root", "node").agg(F.min(F.struct("path", "parent")).alias("b"))
        for level in levels:
            best = best.join(level.select("root", "node").hint("merge"), ["root", "node"], "left_anti")
        frontier = cut_lineage(best.select("root", "node", F.lit(depth).alias("depth"), "b.parent", "b.path"))
        if frontier.isEmpty():
            break
        levels.append(frontier)
        if len(levels) > 8:  # what was reached, as one table again
            levels = [cut_lineage(reduce(DataFrame.unionByName, levels))]
    return reduce(DataFrame.unionByName, levels)


def described(reached: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """``reached`` with a column of each row's node; sorted, as both sides grow with the graph."""
    return reached.join(nodes.select("node_id", column).hint("merge"), F.col("node") == F.col("node_id"))


def depth_label(depth: Column) -> Column:
    return F.when(depth == 0, "PROBLEMATIC DATA").when(depth == 1, "DIRECT SOURCE").when(depth == 2, "ROOT SOURCE").otherwise("ORIGIN")


def impact_label(depth: Column) -> Column:
    return F.when(depth == 1, "DIRECT IMPACT").when(depth == 2, "SECONDARY IMPACT").otherwise("TERTIARY IMPACT")


def change_requirement(level: Column) -> Column:
    return F.when(level == "COLUMN", "COLUMN-LEVEL CHANGE REQUIRED").when(level == "TABLE", "TABLE-LEVEL CHANGE REQUIRED").otherwise("MANUAL REVIEW REQUIRED")


def impact(conn: DataFrame) -> DataFrame:
    return conn.select("edge_id", "source_table_name", "target_table_name", change_requirement(F.col("lineage_level")).alias("change_requirement"), F.when(F.col("target_is_pii"), "PII DATA - SPECIAL HANDLING REQUIRED").otherwise("Standard change").alias("pii_warning"))


def report_impact(conn: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Reports and views fed by each table."""
    return conn.filter(F.col("target_node_type").isin(*kinds)).groupBy("source_table_name", F.col("target_table_name").alias("affected_report")).agg(F.count("*").alias("affected_columns"), F.bool_or("source_is_pii").alias("pii_affected"))


def process_impact(conn: DataFrame) -> DataFrame:
    """Per process the tables it reads and writes. Table names are made distinct before they are listed."""
    names = lambda c, out: conn.select("process_name", c).distinct().groupBy("process_name").agg(F.count("*").alias(f"{out}_count"), F.array_join(F.sort_array(F.collect_list(c)), ", ").alias(out))
    pii = conn.groupBy("process_name").agg(F.bool_or("source_is_pii").alias("involves_pii"))
    return names("source_table_name", "source_tables").join(names("target_table_name", "target_tables"), "process_name").join(pii, "process_name")


def risk_assessment(conn: DataFrame) -> DataFrame:
    out = conn.groupBy(F.col("source_table_name").alias("changed_table"), F.col("source_column_name").alias("changed_column")).agg(F.countDistinct("target_table_name").alias("downstream_tables_count"), F.countDistinct("process_name").alias("affected_processes"), F.count_if("target_is_pii").alias("pii_affected_count"))
    n = F.col("downstream_tables_count")
    return out.withColumns({"risk_level": F.when(n > 10, "HIGH RISK").when(n > 5, "MEDIUM RISK").otherwise("LOW RISK"), "compliance_requirement": F.when(F.col("pii_affected_count") > 0, "PII COMPLIANCE REVIEW REQUIRED").otherwise("No PII impact")})


def pii_flow(conn: DataFrame) -> DataFrame:
    return conn.filter("source_is_pii").select("edge_id", "source_table_name", "source_column_name", "target_table_name", "target_column_name", F.when(F.col("target_is_pii"), "PII PROPAGATED").otherwise("PII NOT PROPAGATED").alias("pii_status"))


def transformation_chain(conn: DataFrame) -> DataFrame:
    """Column-level steps into each target column, numbered in edge order."""
    rows = conn.filter(F.col("lineage_level") == "COLUMN").select("edge_id", "process_name", "edge_type", "target_table_name", "target_column_name", "source_table_name")
    return skew.row_numbers(rows, ["target_table_name", "target_column_name"], ["edge_id"], "transformation_step")


def column_report(conn: DataFrame) -> DataFrame:
    return conn.groupBy(F.col("target_table_name").alias("table_name"), F.col("target_column_name").alias("column_name")).agg(F.count("*").alias("sources"), F.countDistinct("source_source_system").alias("source_systems"), F.bool_or("source_is_pii").alias("fed_by_pii"))


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges into and out of each table; counted per node first, so nothing multiplies."""
    e = edges.filter(F.col("status") == ACTIVE)
    col_level = F.count_if(F.col("lineage_level") == "COLUMN")
    i = e.groupBy(F.col("target_node_id").alias("node_id")).agg(F.count("*").alias("i"), col_level.alias("ci"))
    o = e.groupBy(F.col("source_node_id").alias("node_id")).agg(F.count("*").alias("o"), col_level.alias("co"))
    n = nodes.filter(F.col("status") == ACTIVE).join(i, "node_id", "left").join(o, "node_id", "left")
    z = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return n.groupBy("table_name").agg(F.count("*").alias("columns"), z("i").alias("inbound_edges"), z("o").alias("outbound_edges"), z("ci").alias("column_level_in"), z("co").alias("column_level_out"), F.bool_or("is_pii").alias("contains_pii"))


def graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes and edges as one element list for drawing."""
    n = nodes.filter(F.col("status") == ACTIVE).select(F.lit("node").alias("element_type"), F.col("node_id").alias("id"), F.col("node_name").alias("label"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("target"))
    e = connections(nodes, edges).select(F.lit("edge").alias("element_type"), F.col("edge_id").alias("id"), F.col("edge_type").alias("label"), F.col("source_node_name").alias("source"), F.col("target_node_name").alias("target"))
    return n.unionByName(e)


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes on no active edge."""
    e = edges.filter(F.col("status") == ACTIVE)
    used = e.select(F.col("source_node_id").alias("node_id")).union(e.select("target_node_id")).distinct()
    return nodes.join(used.hint("merge"), "node_id", "left_anti")


def broken_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that does not exist."""
    ids = nodes.select("node_id").hint("merge")
    lost = lambda c: edges.join(ids, edges[c] == ids.node_id, "left_anti").select("edge_id")
    return lost("source_node_id").union(lost("target_node_id")).distinct()


def _few(tables: list[DataFrame]) -> list[DataFrame]:
    """``tables``, written as one once there are more than eight: plans don't grow with the rounds."""
    return [cut_lineage(reduce(DataFrame.union, tables))] if len(tables) > 8 else tables


def _trimmed(core: DataFrame) -> DataFrame:
    """``core`` (src, dst) without the edges that lead nowhere or come from nowhere."""
    heads, tails = core.select(F.col("dst").alias("src")).distinct().hint("merge"), core.select(F.col("src").alias("dst")).distinct().hint("merge")
    return cut_lineage(core.join(heads, "src", "left_semi").join(tails, "dst", "left_semi").select("src", "dst"))


def _chains(core: DataFrame) -> DataFrame:
    """(node, up, down, ring): the nodes with one edge in and one out, and the first nodes of another kind before and after them.

    Pointer doubling, so the rounds grow with the logarithm of the longest chain. A chain
    that ends in itself never meets another kind of node: its nodes come out as a ring named
    by its smallest node.
    """
    into = core.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n_in"), F.min("src").alias("up"))
    out = core.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n_out"), F.min("dst").alias("down"))
    single = cut_lineage(into.join(out.hint("merge"), "node").filter("n_in = 1 AND n_out = 1").select("node", "up", "down"))
    n = single.count()
    inner = single.select(F.col("node").alias("_n")).hint("merge")
    at = single.join(inner, F.col("up") == F.col("_n"), "left").withColumn("up_open", F.col("_n").isNotNull()).drop("_n")
    at = at.join(inner, F.col("down") == F.col("_n"), "left").withColumn("down_open", F.col("_n").isNotNull()).drop("_n").withColumn("low", F.col("node"))
    reached = 1
    while reached <= n and not at.filter("up_open OR down_open").isEmpty():
        ahead = at.select(F.col("node").alias("_d"), F.col("down").alias("_down"), F.col("down_open").alias("_down_open"), F.col("low").alias("_low")).hint("merge")
        back = at.select(F.col("node").alias("_u"), F.col("up").alias("_up"), F.col("up_open").alias("_up_open")).hint("merge")
        met = at.join(ahead, F.col("down_open") & (F.col("down") == F.col("_d")), "left").join(back, F.col("up_open") & (F.col("up") == F.col("_u")), "left")
        at = cut_lineage(met.select("node", F.coalesce("_up", "up").alias("up"), F.coalesce("_down", "down").alias("down"), F.coalesce("_up_open", F.lit(False)).alias("up_open"), F.coalesce("_down_open", F.lit(False)).alias("down_open"), F.least("low", "_low").alias("low")))
        reached *= 2
    return at.select("node", "up", "down", F.when(F.col("down_open"), F.col("low")).alias("ring"))


def _coloured(core: DataFrame) -> DataFrame:
    """(node, colour): the largest node from which each node can be reached, itself included."""
    colour = core.select(F.col("src").alias("node")).union(core.select("dst")).distinct().withColumn("colour", F.col("node"))
    while True:
        come = core.join(colour.hint("merge"), core.src == colour.node).select(F.col("dst").alias("node"), "colour", F.lit(None).alias("old"))
        both = colour.select("node", "colour", F.col("colour").alias("old")).union(come)
        new = cut_lineage(both.groupBy("node").agg(F.max("colour").alias("colour"), F.max("old").alias("old")))
        colour = new.select("node", "colour")
        if new.filter("colour <> old").isEmpty():
            return colour


def _members(core: DataFrame, colour: DataFrame) -> DataFrame:
    """(node, colour): the nodes that reach the node their colour is named after, by edges of one colour."""
    one, two = colour.toDF("src", "colour").hint("merge"), colour.toDF("dst", "_colour").hint("merge")
    same = cut_lineage(core.join(one, "src").join(two, "dst").filter("colour = _colour").select("src", "dst", "colour"))
    frontier = colour.filter("node = colour")
    members = [frontier]
    while True:
        step = same.join(frontier.select(F.col("node").alias("dst")).hint("merge"), "dst").select(F.col("src").alias("node"), "colour").distinct()
        frontier = cut_lineage(step.join(reduce(DataFrame.union, members).hint("merge"), "node", "left_anti"))
        if frontier.isEmpty():
            return reduce(DataFrame.union, members)
        members = _few([*members, frontier])


def on_cycles(edges: DataFrame) -> DataFrame:
    """Nodes on a cycle of any length.

    First the graph shrinks: edges that lead nowhere go, and a chain of nodes with one edge in
    and one out becomes a single edge, its nodes noted beside it; both again until nothing
    changes. In what is left, strongly connected components by colours: the node that names
    a colour reaches all nodes of that colour; those that also reach it form a component with it
    and leave the graph. A node noted beside an edge is on a cycle if both ends of the edge
    are in one component. Only one row per node is carried, never pairs of nodes. Every round meets
    tables that grow with the graph, so they join by sorting; none is sent to the driver for a broadcast.
    """
    core = edges.filter(F.col("status") == ACTIVE).select(F.col("source_node_id").alias("src"), F.col("target_node_id").alias("dst")).dropna().distinct()
    core = cut_lineage(core)
    # (node, group): nodes of one group are on one cycle
    found = [core.filter("src = dst").select(F.col("src").alias("node"), F.col("src").alias("group"))]
    core = core.filter("src <> dst")
    inside = core.sparkSession.createDataFrame([], "node bigint, a bigint, b bigint")
    size = core.count()
    while size:
        core = _trimmed(core)
        chains = cut_lineage(_chains(core))
        rings = chains.filter("ring IS NOT NULL").select("node", F.col("ring").alias("group"))
        ends = chains.filter("ring IS NULL").select(F.col("node").alias("_n"), "up", "down")
        # edges noted before that are now part of a longer one
        inside = inside.join(ends.select("_n", "up").hint("merge"), F.col("a") == F.col("_n"), "left").withColumn("a", F.coalesce("up", "a")).drop("_n", "up")
        inside = inside.join(ends.select("_n", "down").hint("merge"), F.col("b") == F.col("_n"), "left").withColumn("b", F.coalesce("down", "b")).drop("_n", "down")
        noted = cut_lineage(inside.union(ends.select("_n", "up", "down")))
        # an edge back to its own node is a cycle whatever becomes of that node, which may join a chain later
        inside, closed = noted.filter("a <> b"), noted.filter("a = b").select("node", F.col("a").alias("group"))
        gone = chains.select(F.col("node").alias("_n")).hint("merge")
        left = core.join(gone, F.col("src") == F.col("_n"), "left_anti").join(gone, F.col("dst") == F.col("_n"), "left_anti")
        core = cut_lineage(left.union(ends.select("up", "down")).distinct())
        found = _few([*found, rings, closed, core.filter("src = dst").select(F.col("src").alias("node"), F.col("src").alias("group"))])
        core = core.filter("src <> dst")
        before, size = size, core.count()
        if size == before:
            break
    while not core.isEmpty():
        members = cut_lineage(_members(core, _coloured(core)))
        several = members.groupBy("colour").agg(F.count("*").alias("n")).filter("n > 1").select("colour")
        found = _few([*found, members.join(several.hint("merge"), "colour", "left_semi").select("node", F.col("colour").alias("group"))])
        gone = members.select("node").hint("merge")
        core = cut_lineage(core.join(gone, core.src == gone.node, "left_anti").join(gone, core.dst == gone.node, "left_anti"))
    found = cut_lineage(reduce(DataFrame.union, found).distinct())
    one, two = found.toDF("a", "_g").hint("merge"), found.toDF("b", "_h").hint("merge")
    beside = inside.join(one, "a").join(two, "b").filter("_g = _h").select("node")
    return found.select("node").union(beside).distinct().withColumnRenamed("node", "node_id")


def validate(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    from finquarry.operators.risk import one_row

    n = lambda df, name: df.agg(F.count("*").alias(name))
    return one_row(n(orphans(nodes, edges), "orphan_nodes"), n(broken_edges(nodes, edges), "broken_edges"), n(on_cycles(edges), "nodes_on_cycles"))


def record_trace(layers: dict[str, DataFrame], key: str, shown: str) -> DataFrame:
    """Every record through the layers: one row per key and layer it reaches."""
    parts = [df.select(F.col(key).alias("record_id"), F.lit(n).alias("layer"), F.lit(i).alias("layer_order"), F.col(shown).cast("string").alias("value")) for i, (n, df) in enumerate(layers.items(), start=1)]
    return reduce(lambda a, z: a.unionByName(z), parts)


def closure(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Each name with everything it inherits, directly or not, and the smallest distance; any depth.

    One row per (root, node): what was reached before is not followed again, so several
    parents don't multiply paths and cycles end.
    """
    e = cut_lineage(edges.select(F.col(child).alias("src"), F.col(parent).alias("dst")).filter("src <> dst").distinct())
    frontier, distance = e.select(F.col("src").alias("root"), F.col("dst").alias("node")), 1
    reached = frontier.withColumn("distance", F.lit(distance))
    while True:
        step = frontier.join(e, frontier.node == e.src).select("root", F.col("dst").alias("node")).filter("root <> node").distinct()
        frontier, distance = cut_lineage(step.join(reached, ["root", "node"], "left_anti")), distance + 1
        if frontier.isEmpty():
            return reached
        reached = reached.union(frontier.withColumn("distance", F.lit(distance)))
