"""Keyed operators with states and event-time timers of their own.

State lives in the key-value store of the stream (``with_state_store`` names it), survives
restarts with the checkpoint, and is dropped by timers, so it doesn't grow with the keys
ever seen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def with_state_store(spark: SparkSession):
    """Streams started inside keep their state in the embedded store that timers and typed states need."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER_KEY) if before is None else spark.conf.set(PROVIDER_KEY, before)


# --- ordered patterns ---------------------------------------------------------------------------------------
class OrderedPattern(StatefulProcessor):
    """Counts how often steps follow one another in order of event time within a limit.

    Events wait in a list until the watermark has passed their time slice, when no earlier event
    can come any more; a timer at the end of the earliest slice then takes up all that has been
    passed, sorted by time and tie, and leaves the rest. So the result doesn't depend on the order
    of arrival, and what is held is a key's events of the watermark's delay. Each call to the
    store is a message to another process: a key makes a few for each batch and each time it
    wakes, however many slices it has.
    """

    def __init__(self, steps: Sequence[str], limit_us: int, slice_us: int):
        self.steps, self.limit, self.slice = list(steps), limit_us, slice_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "t bigint, tie bigint, step int")
        self.progress = handle.getValueState("progress", "at int, began bigint, matches bigint, wake bigint")

    def _passed(self, t: int) -> int:
        """When the slice of an event ends, in milliseconds."""
        return -(-(t // self.slice + 1) * self.slice // 1000)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events = [(r["_t"], r["_tie"], r["_step"]) for r in rows if r["_step"] is not None]
        if events:
            self.buffer.appendList(events)
            at, began, matches, wake = self.progress.get() or (0, 0, 0, None)
            first = self._passed(min(e[0] for e in events))
            if wake is None or first < wake:
                if wake is not None:
                    self.handle.deleteTimer(wake)
                self.handle.registerTimer(first)
                self.progress.update((at, began, matches, first))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        at, began, matches, _ = self.progress.get()
        due, rest = [], []
        for e in self.buffer.get():
            (due if self._passed(e[0]) <= now else rest).append(tuple(e))
        for t, _, step in sorted(due):
            if at and t - began > self.limit:
                at = 0
            if step == at:
                began = t if at == 0 else began
                at += 1
                if at == len(self.steps):
                    at, matches = 0, matches + 1
            elif step == 0:
                at, began = 1, t
        wake = self._passed(min(e[0] for e in rest)) if rest else None
        if rest:
            self.buffer.put(rest)
            self.handle.registerTimer(wake)
        else:
            self.buffer.clear()
        self.progress.update((at, began, matches, wake))
        yield Row(key=key[0], matches=matches)

    def close(self) -> None:
        pass


def pattern_matches(df: DataFrame, key: str, ts: str, step: str, tie: str, steps: Sequence[str], limit_seconds: int, slice_seconds: int = 3600) -> DataFrame:
    """Matches so far per key, whenever the watermark of ``ts`` lets events of the key be read; run in update mode.

    Events of one time are read in the order of ``tie``. Late events, which the watermark has
    passed, are dropped as in any window. Rows without a key pass the filter, so that they can move the watermark.
    """
    number = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(step)).cast("int") - 1
    rows = df.filter(F.col(step).isin(*steps) | F.col(key).isNull()).select(F.col(key).alias("_k"), F.col(ts), F.unix_micros(ts).alias("_t"), F.col(tie).cast("bigint").alias("_tie"), number.alias("_step"))
    kind = df.schema[key].dataType.simpleString()
    processor = OrderedPattern(steps, limit_seconds * 1_000_000, slice_seconds * 1_000_000)
    out = rows.groupBy("_k").transformWithState(processor, f"key {kind}, matches bigint", "update", "eventTime")
    return out.withColumnRenamed("key", key)


# --- aggregators ---------------------------------------------------------------------------------------------
class Aggregator:
    """An aggregate with a state of its own: total in cents, count, largest amount. Subclass for others.

    ``partial`` reduces the rows of many keys at once, before they are shuffled; ``merge`` adds
    a partial state to a key's state; ``result`` shows it.
    """

    state = "cents bigint, n bigint, most bigint"
    output = "total double, n bigint, largest double"

    def partial(self, rows: pd.DataFrame) -> pd.DataFrame:
        cents = rows.assign(cents=(rows["amount"] * 100).round().astype("int64"))
        return cents.groupby("key", dropna=False).agg(cents=("cents", "sum"), n=("cents", "size"), most=("cents", "max"), last=("at", "max")).reset_index()

    def merge(self, a: tuple | None, b: tuple) -> tuple:
        return b if a is None else (a[0] + b[0], a[1] + b[1], max(a[2], b[2]))

    def result(self, s: tuple) -> tuple:
        return s[0] / 100, s[1], s[2] / 100


class ExpiringState(StatefulProcessor):
    """An aggregator's state per key; it comes out and goes when the key has been idle for a while of event time."""

    def __init__(self, aggregator: Aggregator, idle_ms: int):
        self.aggregator, self.idle = aggregator, idle_ms
        self.names, self.shown = ([c.split()[0] for c in text.split(", ")] for text in (aggregator.state, aggregator.output))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.aggregator.state)
        self.seen = handle.getValueState("seen", "last_ms bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = tuple(self.held.get()) if self.held.exists() else None
        before = self.seen.get()[0] if self.seen.exists() else None
        last = before
        for r in rows:
            state = self.aggregator.merge(state, tuple(r[n] for n in self.names))
            at = int(r["at"].timestamp() * 1000)
            last = at if last is None else max(last, at)
        self.held.update(state)
        if last != before:
            if before is not None:
                self.handle.deleteTimer(before + self.idle)
            self.handle.registerTimer(last + self.idle)
            self.seen.update((last,))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(key=key[0], **dict(zip(self.shown, self.aggregator.result(tuple(self.held.get())))))
        self.held.clear()
        self.seen.clear()

    def close(self) -> None:
        pass


def aggregated(df: DataFrame, key: str, amount: str, ts: str, idle_seconds: int, delay: str, aggregator: Aggregator | None = None) -> DataFrame:
    """One row per key when it has been idle; a key that comes back begins anew.

    Rows are reduced per key before the shuffle, so a hot key sends a row per batch of rows.
    The time of a reduced row is its latest one, and carries the watermark.
    """
    aggregator = aggregator or Aggregator()
    kind = df.schema[key].dataType.simpleString()

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield aggregator.partial(b).rename(columns={"last": "at"})

    slim = df.select(F.col(key).alias("key"), F.col(amount).cast("double").alias("amount"), F.col(ts).cast("timestamp").alias("at"))
    small = slim.mapInPandas(reduce, f"key {kind}, {aggregator.state}, at timestamp").withWatermark("at", delay)
    out = small.groupBy("key").transformWithState(ExpiringState(aggregator, idle_seconds * 1000), f"key {kind}, {aggregator.output}", "append", "eventTime")
    return out.withColumnRenamed("key", key)
