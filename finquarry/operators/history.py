"""Slowly changing dimensions. Every function returns the full new state; nothing is updated in place.

Dimension columns: the natural key, the attributes, and for versioned tables
``valid_from``, ``valid_to`` (NULL while open), ``is_current`` and ``sk``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finquarry.functions.exprs import key_hash


def _day(d: str) -> Column:
    return F.lit(d).cast("date")


def _differs(cols: Sequence[str], a: str, b: str) -> Column:
    """NULL-safe: a value that appears or disappears counts as a change."""
    return ~F.struct(*[F.col(f"{a}.{c}") for c in cols]).eqNullSafe(F.struct(*[F.col(f"{b}.{c}") for c in cols]))


def _pair(dim: DataFrame, new: DataFrame, key: str) -> DataFrame:
    pack = lambda df, name: df.select(F.col(key), F.struct(*[c for c in df.columns if c != key]).alias(name))
    return pack(dim, "o").join(pack(new, "n"), key, "full")


def scd0(dim: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """First value wins for ever: only unknown keys are added."""
    return dim.unionByName(new.select(*dim.columns).join(dim.select(key), key, "left_anti"))


def scd1(dim: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Latest value wins; keys missing from the delivery stay."""
    cols = [c for c in dim.columns if c != key]
    newer = F.col("n").isNotNull()
    return _pair(dim, new.select(*dim.columns), key).select(key, *[F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in cols])


def first_versions(df: DataFrame, key: str, start: str) -> DataFrame:
    """A versioned dimension from its first delivery."""
    return df.withColumns({"valid_from": _day(start), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}).withColumn("sk", key_hash(key, "valid_from"))


def scd2(dim: DataFrame, new: DataFrame, key: str, tracked: Sequence[str], as_of: str, close_missing: bool = False) -> DataFrame:
    """Close the open version of changed keys at ``as_of`` and open a new one.

    Unchanged keys keep their version, so a repeated delivery changes nothing. With
    ``close_missing`` keys absent from a full delivery are closed too.
    """
    attrs = [c for c in new.columns if c != key]
    done, live = dim.filter(~F.col("is_current")), dim.filter("is_current")
    both = _pair(live, new, key)
    known, fresh = F.col("o").isNotNull(), F.col("n").isNotNull()
    changed = known & fresh & _differs(tracked, "o", "n")
    gone = known & ~fresh & F.lit(close_missing)
    meta = ["valid_from", "valid_to", "is_current", "sk"]
    kept = both.filter(known).select(
        key, *[F.col(f"o.{c}").alias(c) for c in attrs], F.col("o.valid_from").alias("valid_from"),
        F.when(changed | gone, _day(as_of)).alias("valid_to"), (~(changed | gone)).alias("is_current"), F.col("o.sk").alias("sk"),
    )
    opened = both.filter(fresh & (~known | changed)).select(key, *[F.col(f"n.{c}").alias(c) for c in attrs])
    opened = first_versions(opened, key, as_of)
    order = [key, *attrs, *meta]
    return done.select(*order).unionByName(kept.select(*order)).unionByName(opened.select(*order))


def scd2_from_changes(changes: DataFrame, key: str, tracked: Sequence[str], at: str) -> DataFrame:
    """Versions from a whole change history: several changes per key, repeats dropped.

    Uses the skew-safe neighbour lookup, as one key may own very many changes.
    """
    from finquarry.operators import skew

    c = skew.add_neighbours(skew.cut(changes.withColumn("_now", F.struct(*tracked)), key, [at]), previous={"_now": "_before"})
    real = c.rows.filter(F.col("_before").isNull() | ~F.col("_now").eqNullSafe(F.col("_before"))).drop("_before", "_now")
    ended = skew.add_neighbours(replace(c, rows=real), following={at: "valid_to"}).done()
    return ended.select(key, *tracked, F.col(at).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def scd3(dim: DataFrame, new: DataFrame, key: str, column: str, as_of: str) -> DataFrame:
    """The previous value in a column of its own."""
    both = _pair(dim, new, key)
    changed = F.col("o").isNotNull() & F.col("n").isNotNull() & _differs([column], "o", "n")
    now = F.when(F.col("n").isNotNull(), F.col(f"n.{column}")).otherwise(F.col(f"o.{column}"))
    return both.select(key, now.alias(column), F.when(changed, F.col(f"o.{column}")).alias(f"previous_{column}"), F.when(changed, _day(as_of)).alias("change_date"))


def scd4(dim: DataFrame, new: DataFrame, key: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(current table, history of the replaced rows)."""
    attrs = [c for c in dim.columns if c != key]
    replaced = _pair(dim, new.select(*dim.columns), key).filter(F.col("o").isNotNull() & F.col("n").isNotNull() & _differs(attrs, "o", "n"))
    history = replaced.select(key, *[F.col(f"o.{c}").alias(c) for c in attrs], _day(as_of).alias("valid_to"))
    return scd1(dim, new, key), history


def scd5(dim: DataFrame, new: DataFrame, key: str, as_of: str) -> DataFrame:
    """Type 1 current row next to the number and end of its archived versions."""
    current, history = scd4(dim, new, key, as_of)
    archived = history.groupBy(key).agg(F.count("*").alias("archived_versions"), F.max("valid_to").alias("last_change"))
    return current.join(archived, key, "left").fillna({"archived_versions": 0})


def scd6(dim: DataFrame, new: DataFrame, key: str, column: str, as_of: str) -> DataFrame:
    """Type 2 rows that also carry the previous and the current value of ``column``."""
    rows = scd2(dim, new, key, [column], as_of)
    w = Window.partitionBy(key).orderBy("valid_from")
    # versions per key of a conformed dimension are few; long histories go through scd2_from_changes
    current = rows.filter("is_current").select(key, F.col(column).alias(f"current_{column}"))
    return rows.withColumn(f"previous_{column}", F.lag(column).over(w)).join(current, key, "left")


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def history_rows(dim: DataFrame, key: str) -> DataFrame:
    """Versions per key in order, numbered."""
    return dim.withColumn("version", F.row_number().over(Window.partitionBy(key).orderBy("valid_from")))
