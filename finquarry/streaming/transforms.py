"""Stream transformations; each also works on a batch DataFrame with the same columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from finquarry.functions import exprs as X


def windowed(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column], slide: str | None = None) -> DataFrame:
    """Tumbling or sliding window aggregate with flat window columns."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(w.alias("w"), *keys).agg(*aggs).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *_rest(df, keys, aggs))


def _rest(df: DataFrame, keys, aggs) -> list[str]:
    return [c for c in df.groupBy(*keys).agg(*aggs).columns if c not in keys]


def windowed_distinct(df: DataFrame, ts: str, size: str, keys: Sequence[str], member: str, parts: Sequence[Column], finals: Sequence[Column]) -> DataFrame:
    """Window aggregate with an exact count of distinct ``member`` values.

    Two chained aggregates: first per member, then per window. No set of members is held in
    one state row, however many a window sees.
    """
    first = df.groupBy(F.window(ts, size).alias("w"), *keys, member).agg(*parts)
    second = first.groupBy(F.window(F.window_time("w"), size).alias("w2"), *keys).agg(*finals, F.count("*").alias(f"unique_{member}"))
    cols = [c for c in second.columns if c not in ("w2", *keys)]
    return second.select(F.col("w2.start").alias("window_start"), *keys, *cols)


def sessions(df: DataFrame, ts: str, gap: str, key: str, aggs: Sequence[Column]) -> DataFrame:
    out = df.groupBy(F.session_window(ts, gap).alias("w"), key).agg(*aggs)
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, *[c for c in out.columns if c not in ("w", key)])


def velocity_score(left: DataFrame, right: DataFrame, key: str, txn: str, ts: str, amount: str, seconds: int, limits: dict) -> DataFrame:
    """Score each transaction by amount, velocity, hour and weekend.

    Velocity is an interval join of the stream with itself. Both sides carry a time bucket
    as wide as the interval, so the state of one busy card is spread over its buckets; the
    right side is sent to its own bucket and the next.
    """
    bucket = lambda c: F.floor(F.unix_seconds(c) / seconds)
    l = left.withColumn("b", bucket(F.col(ts)))
    r = right.select(F.col(key).alias("k2"), F.col(ts).alias("ts2"))
    r = r.withColumn("b2", F.explode(F.array(bucket(F.col("ts2")), bucket(F.col("ts2")) + 1)))
    hit = (F.col(key) == F.col("k2")) & (F.col("b") == F.col("b2")) & (F.col("ts2") <= F.col(ts)) & (F.col("ts2") >= F.col(ts) - F.expr(f"interval {seconds} seconds"))
    n = l.join(r, hit).groupBy(txn, key, amount, ts).agg(F.count("*").alias("velocity"))
    points = lambda cond, p: F.when(cond, p).otherwise(0)
    score = points(F.col(amount) > limits["amount"], 30) + points(F.col("velocity") > limits["velocity"], 40) + points(F.hour(ts).between(0, 5), 20) + points(X.weekend(ts), 10)
    s = F.col("fraud_score")
    return n.withColumn("fraud_score", score).filter(s > 0).withColumn("alert_level", F.when(s >= 80, "CRITICAL").when(s >= 50, "HIGH").when(s >= 30, "MEDIUM").otherwise("LOW"))


def split_unparsed(raw: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Parsed columns in ``m`` and the original text in ``dead`` where parsing failed."""
    full = f"{schema}, _corrupt_record string"
    m = F.from_json(value, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    out = raw.withColumn("m", m)
    return out.withColumn("dead", F.when(F.col("m").isNull() | F.col("m._corrupt_record").isNotNull(), F.col(value)))


def running_state(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Count and sum per key in a state of our own; one output row per key and micro-batch.

    Rows are summed per key before the shuffle, so a hot key sends a row per batch of rows.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(key).aggregate([([], "count_all"), ("cents", "sum")])
            yield from t.select([key, "count_all", "cents_sum"]).rename_columns([key, "n", "cents"]).combine_chunks().to_batches()

    def update(k: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, cents = state.get if state.exists else (0, 0)
        for c in chunks:
            n += int(c["n"].sum())
            cents += int(c["cents"].sum())
        state.update((n, cents))
        yield pd.DataFrame({key: [k[0]], "n": [n], "cents": [cents]})

    rows = df.select(F.col(key).cast("bigint"), F.coalesce(F.round(F.col(amount) * 100), F.lit(0)).cast("bigint").alias("cents"))
    kind = f"{key} bigint, n bigint, cents bigint"
    return rows.mapInArrow(reduce, kind).groupBy(key).applyInPandasWithState(update, kind, "n bigint, cents bigint", "update", GroupStateTimeout.NoTimeout)
