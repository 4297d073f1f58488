"""Run registered queries and their check SQL side by side.

    python -m tests.compare [--sf DIR] [--split N] [name-or-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def check_engine(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


DIGITS = 9  # significant digits compared; --exact compares all


def cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (float(f"{v:.{DIGITS}g}") if DIGITS else v)
    return v


def kind(name: str) -> str:
    name = str(name).lower()
    return {"varchar": "string", "bigint": "bigint", "double": "double", "boolean": "boolean"}.get(name, name)


def plan_flags(df) -> list[str]:
    """Plan shapes that need a reason at scale."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    flags = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if w in plan]
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and any(" Window " in up or "Window [" in up for up in lines[max(0, i - 3) : i]):
            flags.append("single-task window")
    return sorted(set(flags))


def compare(spark, con, name, sf_dir, flags=None):
    """None when equal, else a text naming the first difference."""
    from finquarry.plans import QUERIES

    q = QUERIES[name]
    df = q.run(spark, sf_dir)
    if flags is not None:
        flags += plan_flags(df)
    rows = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    if q.sql is None:
        return None if rows else "no rows", len(rows)
    rel = con.sql(q.sql)
    names = list(rel.columns)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(rows)
    types = dict(zip(names, rel.types, strict=True))
    bad = [f"{c}: {df.schema[c].dataType.simpleString()} vs {types[c]}" for c in sorted(names) if df.schema[c].dataType.simpleString() != kind(types[c])]
    if bad:
        return f"types {bad}", len(rows)
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(r[i] for i in order) for r in rel.fetchall()]
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    a = sorted([tuple(cell(v) for v in r) for r in rows], key=key)
    b = sorted([tuple(cell(v) for v in r) for r in want], key=key)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}  e.g. {sorted(set(a) - set(b), key=key)[:1]} / {sorted(set(b) - set(a), key=key)[:1]}", len(a)
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{sorted(names)}\n   spark {x}\n   check {y}", len(a)
    return None if a else "both empty", len(a)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--split", help="rows per chunk of a cut key; small values force the paths for hot keys")
    ap.add_argument("--exact", action="store_true", help="compare doubles to the last bit")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.exact:
        globals()["DIGITS"] = 0
    from finquarry.plans import QUERIES
    from finquarry.session import build_session

    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    if args.split:
        spark.conf.set("finquarry.split.rows", args.split)
    con = check_engine(args.sf)
    chosen = [n for n in QUERIES if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) or QUERIES[n].run.__module__ == a or getattr(QUERIES[n], "section", "") == a for a in args.names)]
    bad = []
    for n in chosen:
        t = time.time()
        try:
            flags = []
            err, count = compare(spark, con, n, args.sf, flags)
            if flags:
                print(f"plan {n} {flags}", flush=True)
        except Exception as e:  # report and go on
            err, count = f"{type(e).__name__}: {str(e)[:700]}", -1
        took = time.time() - t
        flag = "ok  " if err is None else "FAIL"
        if err or took > 6:
            print(f"{flag} {n} rows={count} {took:.1f}s {'' if QUERIES[n].sql else '(no sql)'} {err or ''}", flush=True)
        if err:
            bad.append(n)
    print(f"{len(chosen) - len(bad)} of {len(chosen)} agree; failing: {bad}")


if __name__ == "__main__":
    main()
