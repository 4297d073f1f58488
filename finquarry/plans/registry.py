"""The catalogue of named queries: a Spark callable and, where SQL can express it, a check query.

Every result is brought to plain types (bigint, double, string, boolean) so that
two engines can be compared value by value.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finquarry.plans.check_views import VIEWS

QUERIES: dict[str, "Query"] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str = ""


def plain_types(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(columns)


def with_views(sql: str) -> str:
    """Prefix the check query with the common views it names, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    stripped = sql.strip()
    if stripped[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{stripped[14:]}"
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{stripped}"


def query(name: str, sql: str | None = None):
    """Register ``fn(bank) -> DataFrame`` under ``name`` with its check query."""
    from finquarry.sources.banking import Bank

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_types(fn(Bank(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = Query(run, with_views(sql) if sql else None, fn.__module__.rsplit(".", 1)[-1])
        return fn

    return register
