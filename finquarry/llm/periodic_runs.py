"""Periodic stretches of words by maximal pairs.

A run is a stretch of words with smallest period q, at least ``min_exponent`` periods and
``min_length`` words long, that no neighbouring word extends. If a run begins at i and has
length L + q, the suffixes at i and i + q agree in exactly L words and the words before them
differ: (i, i + q, L) is a maximal pair. The other way round a maximal pair with
q <= L / (min_exponent - 1) and L + q >= min_length is a stretch of period q that nothing
extends, so no extension step is needed; a stretch found with several periods has the
smallest one as its own, the others are multiples of it.

The maximal pairs of a document come from a walk over its LCP-interval tree from the
leaves upwards. Each interval holds its positions in order and, in lists by the word to the
left of them, again. Where a child joins an interval of depth L, each position of the
smaller side looks among the larger side's within L / (min_exponent - 1) of it for those in
other lists. Stretches of positions in its own list are jumped over, so the work follows
the number of pairs found. Runs have repeated windows of ``_shortest`` words; documents without any
(tested with hashes, which can only let too many through) need no tree.

The work is one pass of a function over documents, without a shuffle; memory is that of a few
documents, about four bytes per word for each doubling of the longest repeated stretch.

Defined cases: null and empty texts have no words and no runs; a null id is kept and its
words are never rearranged; texts are read whole whatever their length; repeated rows give
a row each; an empty table gives none; other columns are not read. Of runs with equal
exponent the one that starts first, then the one with the smaller period comes first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import table, utf8

MIN_LENGTH, MIN_EXPONENT = 24, 3
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ROWS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
OUT_DOCS, OUT_BYTES = 256, 8 << 20  # rows and bytes of text handed back at once


def _shortest(min_length: int, min_exponent: int) -> int:
    """The least L of a pair that counts: q <= L / (e - 1) and L + q >= m hold together from ceil(m (e - 1) / e) on."""
    return max(1, -(-min_length * (min_exponent - 1) // min_exponent))


def _numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers, from 1 on; 0 stands for the end."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen) + 1) for w in words), np.int64, len(words))


def _may_repeat(ids: np.ndarray, width: int) -> bool:
    """Whether two windows of ``width`` words have the same hash."""
    if len(ids) <= width:
        return False
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    have = 1
    while have < width:
        step = min(have, width - have)
        h = (h[:-step] * np.uint64(0xBF58476D1CE4E5B9)) ^ h[step:]
        h ^= h >> np.uint64(31)
        have += step
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def suffixes(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and how many words each shares with the one before it.

    Prefix doubling; only suffixes that share ``least`` words with another are returned.
    """
    n, width, levels = len(ids), 1, [np.append(ids, 0).astype(np.int32)]
    while True:
        rank = levels[-1].astype(np.int64)
        key = rank[:n] * (n + 2)
        key[: max(0, n - width)] += rank[width:n]
        values, inverse = np.unique(key, return_inverse=True)
        levels.append(np.append(inverse + 1, 0).astype(np.int32))
        width *= 2
        if len(values) == n or width >= 2 * n:
            break
    order = np.argsort(levels[-1][:n], kind="stable")
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + shared, n), np.minimum(b + shared, n)
        shared += np.where(levels[k][x] == levels[k][y], 1 << k, 0)
    shared = np.concatenate([[0], shared])
    keep = (shared >= least) | np.append(shared[1:] >= least, False)
    return order[keep], shared[keep]


class _Interval:
    """Positions of an interval in order, and by the word to the left of them."""

    __slots__ = ("order", "classes")

    def __init__(self, position: int, left: int):
        self.order, self.classes = [position], {left: [position]}

    def near(self, p: int, left: int, reach: int) -> Iterator[int]:
        """Positions at most ``reach`` from p whose left word is another one."""
        order, own = self.order, self.classes.get(left, ())
        i, end = bisect_left(order, p - reach), bisect_right(order, p + reach)
        if not own:
            yield from order[i:end]
            return
        u, last = bisect_left(own, p - reach), bisect_right(own, p + reach)
        if last - u == end - i:
            return
        while i < end:
            if u == last or order[i] != own[u]:
                yield order[i]
                i += 1
                continue
            low, high = 1, min(end - i, last - u)  # how far both lists go on alike
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if order[i + middle - 1] == own[u + middle - 1] else (low, middle - 1)
            i, u = i + low, u + low

    def take(self, other: "_Interval") -> None:
        if len(other.order) > 16:
            self.order = sorted(self.order + other.order)
            for left, positions in other.classes.items():
                self.classes[left] = sorted(self.classes[left] + positions) if left in self.classes else positions
            return
        for left, positions in other.classes.items():
            mine = self.classes.setdefault(left, [])
            for p in positions:
                insort(mine, p)
                insort(self.order, p)


def word_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then by period."""
    least, most = _shortest(min_length, min_exponent), min_exponent - 1
    if not _may_repeat(ids, least):
        return []
    order, shared = suffixes(ids, least)
    left = [-1, *ids.tolist()]  # left[p] is the word before p
    found: dict[tuple[int, int], int] = {}

    def joined(a: _Interval, b: _Interval, depth: int) -> _Interval:
        if len(a.order) < len(b.order):
            a, b = b, a
        reach = depth // most
        for word, positions in b.classes.items():
            for p in positions:
                for x in a.near(p, word, reach):
                    q = abs(p - x)
                    if depth + q >= min_length:
                        at = (min(p, x), depth + q)
                        found[at] = min(q, found.get(at, q))
        a.take(b)
        return a

    stack: list[tuple[int, _Interval]] = []
    order, shared = order.tolist(), [*shared.tolist(), 0]
    for t, p in enumerate(order):
        node, depth = _Interval(p, left[p]), shared[t + 1]
        while stack and stack[-1][0] > depth:
            deep, held = stack.pop()
            node = joined(held, node, deep)
        if depth < least:
            stack = []
        elif stack and stack[-1][0] == depth:
            stack[-1] = (depth, joined(stack[-1][1], node, depth))
        else:
            stack.append((depth, node))
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def _found(min_length: int, min_exponent: int, rearranged: Callable[[int, int], np.ndarray | None] | None):
    names = [c.split()[0] for c in ROWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.list_(RUN), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0

        def batch():
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            columns[3] = columns[3].cast(pa.string())
            return pa.record_batch(columns, names=names)

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), utf8(b.column("text"))):
                words = text.split()
                ids = _numbered(words)
                at = rearranged(doc_id, len(words)) if rearranged and doc_id is not None and words else None
                if at is not None:
                    ids, words = ids[at], [words[i] for i in at.tolist()]
                runs = word_runs(ids, min_length, min_exponent)
                if runs:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for start, length, q in runs:
                        edges[start + q] += 1
                        edges[start + length] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
                out.append((doc_id, len(ids), [{"start": s, "length": n, "period": q} for s, n, q in runs], b" ".join(words)))
                held += len(out[-1][3])
                if len(out) == OUT_DOCS or held > OUT_BYTES:
                    yield batch()
                    out, held = [], 0
        if out:
            yield batch()

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
    rearranged: Callable[[int, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """Per document its number of words, its runs, and its text with each run cut down to one period.

    ``rearranged(doc_id, words)`` may give the numbers of the words to read instead, in their order; None leaves them.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and a word")
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_found(min_length, min_exponent, rearranged), ROWS)


def planted(doc_id: int, words: int) -> np.ndarray | None:
    """For one id in ten, words that repeat a stretch to the end of the text; which one depends on the id's hash."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g, at = h // 10, np.arange(words)
    a = g % words
    p = 1 + (words - a) // (3 + g % 8)
    return np.where(at < a, at, a + (at - a) % p)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; then the one that starts first, then the one with the smaller period."""

    def order(a: Column, b: Column) -> Column:
        more, less = b["length"] * a["period"], a["length"] * b["period"]
        return (
            F.when(less != more, F.when(less > more, -1).otherwise(1))
            .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
            .otherwise(F.signum(a["period"] - b["period"]).cast("int"))
        )

    return F.get(F.array_sort(runs, order), F.lit(0))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), rearranged=planted)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
