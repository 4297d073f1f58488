"""Ordered operators that hold when one key owns a large part of the rows.

A plain window sorts every row of a key in one task. Here the rows of a key are cut into
chunks of their order; each chunk is worked on alone, and a small table, one row per chunk,
carries totals forward. Keys without cut points are one chunk.

A row is a cut point if the hash of its key and order falls below a fixed share, one in
``finquarry.split.rows``; so a key has cut points in proportion to its rows, whatever the
size of the input, and they are the same on every attempt. Of all cut points the
``MAX_POINTS`` with the smallest hashes count, again an even share of every key's. The points
are part of the plan: nothing is counted, sampled or fetched while it is built, and the
same plan holds at every size. Where there are none, adaptive execution drops the tables
that carry totals.

``order`` columns are ascending; negate a number to sort it downwards.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT_KEY = "finquarry.split.rows"
SPLIT_ROWS = 500_000
MAX_POINTS = 1 << 16  # bounds what is broadcast: the points, and at most twice as many rows of carried totals
MIN_POINTS = 3  # a key with fewer is left whole; it has a few times the rows of a chunk at most


def split_rows(df: DataFrame) -> int:
    """Rows a chunk should hold; set ``finquarry.split.rows`` in the session to change it."""
    return int(df.sparkSession.conf.get(SPLIT_KEY, str(SPLIT_ROWS)))


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _same(keys: list[str], prefix: str) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]


@dataclass(frozen=True)
class Cut:
    """Rows with their ``_chunk``; ``points`` has a row for each key that was cut (without keys one row at most)."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    points: DataFrame

    @property
    def group(self) -> list[str]:
        return [*self.keys, "_chunk"]

    def window(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def spanning(self) -> DataFrame:
        """The rows of keys that were cut."""
        if not self.keys:  # a join with one row at most, which adaptive execution drops with its left side if there is none
            return self.rows.join(F.broadcast(self.points.select(F.lit(1).alias("_one"))), F.lit(True), "left_semi")
        return self.rows.join(F.broadcast(self.points.select(*[f"_p_{k}" for k in self.keys])), _same(self.keys, "_p_"), "left_semi")

    def across(self, first: int, last: int):
        return Window.partitionBy(*self.keys).orderBy("_chunk").rowsBetween(first, last)

    def attach(self, df: DataFrame, carried: DataFrame) -> DataFrame:
        """Join the bounded per-chunk table back to the rows."""
        renamed = carried.select(*[F.col(k).alias(f"_k_{k}") for k in self.group], *[c for c in carried.columns if c not in self.group])
        return df.join(F.broadcast(renamed), _same(self.group, "_k_"), "left").drop(*[f"_k_{k}" for k in self.group])

    def done(self) -> DataFrame:
        return self.rows.drop("_chunk")


def cut_points(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """The ordered tuples that begin a chunk, as one array ``_points`` for each key that is cut."""
    h = F.xxhash64(*keys, *order).bitwiseAND(F.lit((1 << 63) - 1))
    tuples = df.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.struct(*order).alias("_at"), h.alias("_h")).filter(F.col("_h") < ((1 << 63) - 1) // limit)
    chosen = tuples.distinct().orderBy("_h", "_at").limit(MAX_POINTS)
    return chosen.groupBy(*[f"_p_{k}" for k in keys]).agg(F.sort_array(F.collect_list("_at")).alias("_points")).filter(F.size("_points") >= MIN_POINTS)


def position(points: Column, me: Column) -> Column:
    """How many elements of a sorted array of less than 2^21 are not above ``me``, by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in range(20, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= F.size(points)) & (F.get(points, at + step - 1) <= me), at + step).otherwise(at))


def cut(df: DataFrame, keys, order, limit: int | None = None, base: DataFrame | None = None) -> Cut:
    """``base`` may name a frame with the same keys and order columns that is cheaper to read for the points."""
    keys, order = _names(keys), _names(order)
    points = cut_points(df if base is None else base, keys, order, limit or split_rows(df))
    if keys:
        rows = df.join(F.broadcast(points), _same(keys, "_p_"), "left").drop(*[f"_p_{k}" for k in keys])
    else:
        rows = df.withColumn("_points", points.scalar())
    chunk = F.when(F.col("_points").isNull(), 0).otherwise(position(F.col("_points"), F.struct(*order)))
    return Cut(rows.withColumn("_chunk", chunk).drop("_points"), keys, order, points)


# --- building blocks on a cut: each returns the cut with new columns ----------------------------------
def add_running(c: Cut, sums: dict[str, Column | str]) -> Cut:
    values = {f"_v{i}": F.col(v) if isinstance(v, str) else v for i, v in enumerate(sums.values())}
    c = replace(c, rows=c.rows.withColumns(values))
    w = c.window().rowsBetween(Window.unboundedPreceding, 0)
    out = c.rows.withColumns({o: F.sum(v).over(w) for o, v in zip(sums, values, strict=True)})
    kinds = {o: out.schema[o].dataType for o in sums}
    totals = c.spanning().groupBy(*c.group).agg(*[F.sum(v).alias(v) for v in values])
    before = c.across(Window.unboundedPreceding, -1)
    out = c.attach(out, totals.select(*c.group, *[F.sum(v).over(before).alias(f"_b{v}") for v in values]))
    whole = {o: F.when(F.col(f"_b{v}").isNull(), F.col(o)).otherwise(F.col(f"_b{v}") + F.coalesce(o, F.lit(0))).cast(kinds[o]) for o, v in zip(sums, values, strict=True)}
    return replace(c, rows=out.withColumns(whole).drop(*values, *[f"_b{v}" for v in values]))


def add_neighbours(c: Cut, previous: dict[str, str] | None = None, following: dict[str, str] | None = None) -> Cut:
    ordering = F.struct(*[F.col(o) for o in c.order])
    for wanted, step, pick in ((previous, F.lag, F.max_by), (following, F.lead, F.min_by)):
        if not wanted:
            continue
        w = c.window()
        out = c.rows.withColumns({name: step(src).over(w) for src, name in wanted.items()}).withColumn("_edge", step(F.lit(1)).over(w).isNull())
        ends = c.spanning().groupBy(*c.group).agg(pick(F.struct(*[F.col(s) for s in wanted]), ordering).alias("_end"))
        carried = ends.withColumn("_end", step("_end").over(Window.partitionBy(*c.keys).orderBy("_chunk")))
        out = c.attach(out, carried)
        out = out.withColumns({name: F.when(F.col("_edge"), F.col("_end")[src]).otherwise(F.col(name)) for src, name in wanted.items()}).drop("_end", "_edge")
        c = replace(c, rows=out)
    return c


# --- operators ---------------------------------------------------------------------------------------------
def running(df: DataFrame, keys, order, sums: dict[str, Column | str], **kw) -> DataFrame:
    """Running totals up to and including the row, several in one pass; ``keys + order`` must be unique."""
    return add_running(cut(df, keys, order, **kw), sums).done()


def running_sum(df: DataFrame, keys, order, value, out: str, **kw) -> DataFrame:
    return running(df, keys, order, {out: value}, **kw)


def row_numbers(df: DataFrame, keys, order, out: str = "rn", **kw) -> DataFrame:
    """Position of each row within its key; ``keys + order`` must be unique."""
    return running(df, keys, order, {out: F.lit(1).cast("bigint")}, **kw)


def neighbours(df: DataFrame, keys, order, previous: dict[str, str] | None = None, following: dict[str, str] | None = None, **kw) -> DataFrame:
    """``lag``/``lead`` by one row: ``previous={"amount": "prev_amount"}``."""
    return add_neighbours(cut(df, keys, order, **kw), previous, following).done()


def carry_last(df: DataFrame, keys, order, value: str, out: str, **kw) -> DataFrame:
    """Last non-null ``value`` at or before the row (the heart of the as-of join)."""
    c = cut(df, keys, order, **kw)
    local = c.rows.withColumn(out, F.last(value, ignorenulls=True).over(c.window().rowsBetween(Window.unboundedPreceding, 0)))
    ordering = F.struct(*[F.col(o) for o in c.order])
    # every chunk of a cut key needs a row, also one without any value
    at = F.when(F.col(value).isNotNull(), ordering)
    ends = c.spanning().groupBy(*c.group).agg(F.max_by(value, at).alias("_end"))
    carried = ends.withColumn("_end", F.last("_end", ignorenulls=True).over(c.across(Window.unboundedPreceding, -1)))
    return c.attach(local, carried).withColumn(out, F.coalesce(out, "_end")).drop("_end", "_chunk")


def row_frame(df: DataFrame, keys, order, before: int, after: int, columns: dict[str, Column], **kw) -> DataFrame:
    """Aggregates over ``before`` rows back to ``after`` rows ahead (negative ``after`` excludes the row).

    ``columns`` maps an output name to an aggregate such as ``F.avg("amount")``. The rows a
    chunk needs from its neighbours are found by their number within the key, sent along as
    context and dropped again: ``before + after`` rows a chunk.
    """
    c = cut(df, keys, order, **kw)
    numbered = add_running(replace(c, rows=c.spanning()), {"_rn": F.lit(1).cast("bigint")}).rows
    ends = numbered.groupBy(*c.group).agg(F.min("_rn").alias("_first"), F.max("_rn").alias("_last"))
    wanted = [F.sequence(F.col("_first") - before, F.col("_first") - 1)] if before > 0 else []
    wanted += [F.sequence(F.col("_last") + 1, F.col("_last") + after)] if after > 0 else []
    rows = c.rows.withColumn("_ctx", F.lit(False))
    if wanted:
        needs = ends.select(*[F.col(k).alias(f"_n_{k}") for k in c.keys], F.col("_chunk").alias("_to"), F.explode(F.concat(*wanted)).alias("_need"))
        context = numbered.join(needs, [*_same(c.keys, "_n_"), F.col("_rn") == F.col("_need")])
        rows = rows.unionByName(context.withColumn("_chunk", F.col("_to")).select(*c.rows.columns, F.lit(True).alias("_ctx")))
    out = rows.withColumns({n: a.over(c.window().rowsBetween(-before, after)) for n, a in columns.items()})
    return out.filter(~F.col("_ctx")).drop("_ctx", "_chunk")


def trailing_range(df: DataFrame, keys, ts: str, width, sums: dict[str, Column | str], **kw) -> DataFrame:
    """Sums over rows of the same key whose number ``ts`` lies in ``[t - width, t]``."""
    return trailing_ranges(df, keys, ts, {width: sums}, **kw)


def trailing_ranges(df: DataFrame, keys, ts: str, frames: dict, **kw) -> DataFrame:
    """Several trailing ranges in one pass: ``{3600: {"n_1h": F.lit(1)}, 86400: {"sum_1d": "v"}}``.

    Values are summed per instant first, so any number of rows at one time count as one. A
    frame is then the running total at its end less the one just before its start, read at a
    mark set there: the work doesn't depend on how many rows a frame spans. Totals must be
    exact for that: whole numbers or decimals. A frame without any value is NULL, as a sum is.
    """
    keys, values = _names(keys), {}
    for sums in frames.values():
        for o, v in sums.items():
            values[o] = F.col(v) if isinstance(v, str) else v
    kinds = {o: df.select(F.sum(v).alias("s")).schema["s"].dataType for o, v in values.items()}
    for o, kind in kinds.items():
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            raise ValueError(f"{o}: cast floating point numbers to decimals, differences of their running totals are not exact")
    per = df.groupBy(*keys, ts).agg(*[F.sum(v).alias(f"_s_{o}") for o, v in values.items()], *[F.count(v).alias(f"_n_{o}") for o, v in values.items()])
    totals = [f"_{x}_{o}" for o in values for x in "sn"]
    ends = per.select(*keys, ts, F.col(ts).alias("_t"), F.lit(None).cast(df.schema[ts].dataType).alias("_w"), *totals)
    marks = per.select(*keys, ts, F.explode(F.array(*[F.lit(w).cast(df.schema[ts].dataType) for w in frames])).alias("_w"))
    marks = marks.select(*keys, ts, (F.col(ts) - F.col("_w")).alias("_t"), "_w", *[F.lit(0).cast(per.schema[x].dataType).alias(x) for x in totals])
    # a mark stands before the rows of its instant
    both = ends.unionByName(marks).withColumn("_end", F.col("_w").isNull())
    up = running(both.withColumn("_wide", F.coalesce("_w", F.lit(0))), keys, ["_t", "_end", "_wide", ts], {f"_r{x}": F.coalesce(x, F.lit(0)) for x in totals}, **kw)
    at_end = lambda x: F.max(F.when(F.col("_end"), F.col(f"_r{x}")))
    before = lambda x, w: F.max(F.when(F.col("_w") == w, F.col(f"_r{x}")))
    out = []
    for w, sums in frames.items():
        for o in sums:
            found = (at_end(f"_s_{o}") - before(f"_s_{o}", w)).cast(kinds[o])
            out.append(F.when(at_end(f"_n_{o}") - before(f"_n_{o}", w) > 0, found).alias(o))
    found = up.groupBy(*[F.col(k).alias(f"_f_{k}") for k in [*keys, ts]]).agg(*out)
    return df.join(found, _same([*keys, ts], "_f_")).drop(*[f"_f_{k}" for k in [*keys, ts]])


def value_ranks(df: DataFrame, keys, value: str, **kw) -> DataFrame:
    """Adds ``rank``, ``dense_rank``, ``percent_rank``, ``cume_dist`` of ``value`` within ``keys``.

    Rows are first counted per distinct value, so equal values never pile up in one task.
    """
    keys = _names(keys)
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = running(counts, keys, [value], {"dense_rank": F.lit(1).cast("bigint"), "_upto": "_n"}, **kw)
    if keys:
        ranked = ranked.join(df.groupBy(*keys).agg(F.count("*").alias("_all")), keys)
    else:
        ranked = ranked.withColumn("_all", df.agg(F.count("*")).scalar())
    ranked = ranked.select(
        *keys,
        value,
        (F.col("_upto") - F.col("_n") + 1).alias("rank"),
        "dense_rank",
        F.when(F.col("_all") > 1, (F.col("_upto") - F.col("_n")).cast("double") / (F.col("_all") - 1)).otherwise(0.0).alias("percent_rank"),
        (F.col("_upto").cast("double") / F.col("_all")).alias("cume_dist"),
    )
    return df.join(ranked, [*keys, value])


def quantiles(df: DataFrame, keys, value: str, probabilities: dict[str, float], **kw) -> DataFrame:
    """Exact interpolated quantiles per key: ``{"p50": 0.5}``.

    Works on counts per distinct value and their running totals, so no task holds all values
    of a key, as the built-in exact aggregate does.
    """
    keys = _names(keys)
    v = F.col(value).cast("double")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, v.alias("_q")).agg(F.count("*").alias("_n"))
    upto = running(counts, keys, ["_q"], {"_upto": "_n"}, **kw)
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    rows = upto.join(totals, keys) if keys else upto.withColumn("_all", counts.agg(F.sum("_n")).scalar())
    at = {name: (F.col("_all") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    aggs = [F.first("_all").alias("_all")]
    for name, position in at.items():
        aggs += [F.min(F.when(F.col("_upto") > F.floor(position), F.col("_q"))).alias(f"_lo_{name}"), F.min(F.when(F.col("_upto") > F.ceil(position), F.col("_q"))).alias(f"_hi_{name}")]
    found = rows.groupBy(*keys).agg(*aggs)
    lerp = lambda name: F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (at[name] - F.floor(at[name]))
    return found.select(*keys, *[lerp(name).alias(name) for name in probabilities])


def ntiles(df: DataFrame, keys, order, n: int, out: str, base: DataFrame | None = None, **kw) -> DataFrame:
    """``ntile(n)``; ``keys + order`` must be unique. ``base`` has the same rows if it is cheaper to read."""
    keys, order, base = _names(keys), _names(order), df if base is None else base
    rows = row_numbers(df, keys, order, "_rn", base=base, **kw)
    if keys:
        sizes = base.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count("*").alias("_all"))
        rows = rows.join(sizes, _same(keys, "_k_")).drop(*[f"_k_{k}" for k in keys])
    else:
        rows = rows.withColumn("_all", base.agg(F.count("*")).scalar())
    size, longer = F.floor(F.col("_all") / n), F.col("_all") % n
    head = longer * (size + 1)
    tile = F.when(F.col("_rn") <= head, F.ceil(F.col("_rn") / (size + 1))).otherwise(longer + F.ceil((F.col("_rn") - head) / F.greatest(size, F.lit(1))))
    return rows.withColumn(out, tile.cast("bigint")).drop("_rn", "_all")


# --- joins --------------------------------------------------------------------------------------------------
def join_measured(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join whose right side is broadcast if it is small as measured, else sorted or hashed.

    The right side is shuffled by the keys first, which the join needs in any case unless it
    broadcasts; adaptive execution then decides by the bytes that were written, not by an
    estimate, and no job runs while the plan is built.
    """
    keys = _names(on)
    return left.join(right.repartition(*keys), keys, how)


def salted_join(left: DataFrame, right: DataFrame, key: str, buckets: int = 16, hot_share: float = 0.01, how: str = "inner") -> DataFrame:
    """Equi-join in which only the rows of hot keys are salted.

    A key is hot when it owns more than ``hot_share`` of the left rows, so there are at
    most ``1 / hot_share`` of them; only their right rows are copied ``buckets`` times.
    NULL keys match nothing and are spread as well.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would repeat unmatched right rows")
    total = left.agg(F.count("*")).scalar()
    hot = left.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > total * hot_share).select(F.col(key).alias("_hot"))
    mark = lambda df: df.join(F.broadcast(hot), df[key] == F.col("_hot"), "left")
    salted = F.col("_hot").isNotNull() | F.col(key).isNull()
    spread = mark(left).withColumn("_salt", F.when(salted, F.pmod(F.xxhash64(*left.columns), F.lit(buckets))).otherwise(F.lit(0)).cast("int"))
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    copied = mark(right).withColumn("_salt", F.explode(copies))
    return spread.drop("_hot").join(copied.drop("_hot"), [key, "_salt"], how).drop("_salt")
