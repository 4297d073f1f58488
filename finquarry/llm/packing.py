"""Packing documents into windows by non-negative least squares.

A document is cut into whole windows and a rest. The rests make a histogram over the
lengths below the window. Shallow combinations of lengths that fill a window exactly
(two or three rests) are enumerated, and non-negative least squares finds how often to
use each so that the histogram is met. The counts are rounded down; what is left is
packed greedily, the longest that fits first, after cutting left-over rests of more than
half a window at half a window. Everything up to here needs the histogram only, so
the plan's size depends on the window, never on the corpus.

Rests then find their place by rank: the k-th rest of a length (counted per input part,
then over the parts) takes the k-th place that the plan has for this length.

Defined cases: null text is empty and has the end id only; null ids are carried; repeated
rows are packed each; an empty table has no pieces; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finquarry.llm.common import slices, stored, table, texts
from finquarry.llm.tokens import encoder

WINDOW = 1024


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, b, c), a <= b <= c, of present lengths that sum to the window; c is 0 in pairs (b <= a)."""
    here = np.zeros(window + 1, bool)
    here[lengths] = True
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    c = window - a - b
    ok = (a <= b) & (b <= c)
    ok[ok] = here[c[ok]]
    triples = np.stack([a[ok], b[ok], c[ok]], 1)
    half = lengths[(2 * lengths >= window)]
    half = half[here[window - half]]
    pairs = np.stack([half, window - half, np.zeros_like(half)], 1)
    return np.concatenate([pairs, triples])


def nnls(combos: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """argmin over x >= 0 of |A x - histogram|, A counting the lengths in each combination (accelerated projected gradient)."""
    size = len(histogram)

    def a_times(x):
        out = sum(np.bincount(combos[:, k], weights=x, minlength=size) for k in range(3))
        out[0] = 0
        return out

    def at_times(r):
        return r[combos[:, 0]] + r[combos[:, 1]] + r[combos[:, 2]]

    h = histogram.astype(np.float64)
    v = np.ones(len(combos))
    for _ in range(12):  # the largest eigenvalue of A'A, by power iteration
        v = at_times(a_times(v))
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (1.05 * top)
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * at_times(a_times(y) - h))
        if np.dot(y - new, new - x) > 0:  # restart where momentum points uphill
            t = 1.0
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / nt * (new - x), new, nt
    return x


@dataclass
class Plan:
    """Where the rests go. For each length, places in order of rank: from rank ``first`` on they lie in the
    sequences from ``sequence`` on, at ``offset``. Ranks from ``whole[length]`` on are cut at half a window."""

    window: int
    whole: np.ndarray
    cut_before: np.ndarray
    uncut: np.ndarray
    places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    sequences: int
    padding: int

    @classmethod
    def make(cls, histogram: np.ndarray, window: int = WINDOW) -> "Plan":
        """``histogram[n]``: rests of length n, 0 < n < window."""
        left = histogram.astype(np.int64).copy()
        used: list[tuple[list[int], int]] = []
        lengths = np.flatnonzero(left)
        combos = combinations(lengths, window) if len(lengths) else np.zeros((0, 3), int)
        if len(combos):
            x = nnls(combos, left)
            for k in np.argsort(-x, kind="stable"):
                need = Counter(int(v) for v in combos[k] if v)
                times = min(int(x[k] + 1e-6), *(int(left[v]) // m for v, m in need.items()))
                if times > 0:
                    used.append((sorted(need.elements(), reverse=True), times))
                    for v, m in need.items():
                        left[v] -= m * times
                if x[k] < 1:
                    break
        half = window // 2
        cut = np.zeros(window, np.int64)
        cut[half + 1 :] = left[half + 1 :]
        whole = histogram - cut
        uncut = left.copy()
        uncut[half + 1 :] = 0
        pool = uncut.copy()
        pool[half] += cut.sum()
        pool[1 : window - half] += cut[half + 1 :]
        while pool.any():
            room, take = window, []
            have = Counter()
            while room:
                fits = np.flatnonzero(pool[1 : room + 1]) + 1
                v = next((int(v) for v in fits[::-1] if pool[v] > have[int(v)]), 0)
                if not v:
                    break
                take.append(v)
                have[v] += 1
                room -= v
            times = min(int(pool[v]) // m for v, m in have.items())
            used.append((take, times))
            for v, m in have.items():
                pool[v] -= m * times
        at: dict[int, int] = {}
        rows: dict[int, list[tuple[int, int, int]]] = {}
        sequence = padding = 0
        for take, times in used:
            offset = 0
            for v in take:
                rows.setdefault(v, []).append((at.get(v, 0), sequence, offset))
                at[v] = at.get(v, 0) + times
                offset += v
            if offset & (offset - 1):
                padding += (window - offset) * times
            sequence += times
        places = {v: tuple(np.array(c, np.int64) for c in zip(*r)) for v, r in rows.items()}
        # pieces of a length: uncut rests first, then heads or tails by the length they were cut from
        return cls(window, whole, np.concatenate([[0], np.cumsum(cut)[:-1]]), whole, places, sequence, padding)

    def place(self, length: int, rank: int) -> tuple[int, int]:
        first, sequence, offset = self.places[length]
        k = int(np.searchsorted(first, rank, "right")) - 1
        return int(sequence[k]) + rank - int(first[k]), int(offset[k])

    def pieces(self, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) for the rest with this rank among those of its length."""
        if rank < self.whole[rest]:
            return [(0, rest, *self.place(rest, rank))]
        half, k = self.window // 2, rank - int(self.whole[rest])
        head = int(self.uncut[half]) + int(self.cut_before[rest]) + k
        tail = int(self.uncut[rest - half]) + k
        return [(0, half, *self.place(half, head)), (half, rest - half, *self.place(rest - half, tail))]


def _measured(path: str, end_id: int, window: int):
    """Per document: its tokens, checksums of its whole windows and of its rest, whole and cut, and its rank in this part."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, e, seen, full_before = TaskContext.get().partitionId(), encoder(path), Counter(), 0
        wide, half = 4 * window, 4 * (window // 2)
        kinds = [("part", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("full", pa.list_(pa.int64())), ("full_before", pa.int64()), ("rest", pa.int64()), ("rank", pa.int64()), ("crc", pa.int64()), ("head", pa.int64()), ("tail", pa.int64())]
        for b in slices(batches):
            out = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                ids = e.encode(text) + end
                cut = len(ids) // wide * wide
                full, rest = [zlib.crc32(ids[i : i + wide]) for i in range(0, cut, wide)], ids[cut:]
                n = len(rest) // 4
                out.append((part, doc_id, len(ids) // 4, full, full_before, n, seen[n], zlib.crc32(rest), zlib.crc32(rest[:half]), zlib.crc32(rest[half:])))
                seen[n] += 1
                full_before += len(full)
            yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*out), kinds)] if out else [pa.array([], k) for _, k in kinds], names=[c for c, _ in kinds])

    return run


def pack(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "part bigint, doc_id bigint, n bigint, full array<bigint>, full_before bigint, rest bigint, rank bigint, crc bigint, head bigint, tail bigint"
    rows = stored(slim.mapInArrow(_measured(path, end_id, window), schema), "packing")
    per_part = rows.groupBy("part", "rest").agg(F.count("*").alias("c"), F.sum(F.size("full")).alias("f"))
    found = per_part.filter("rest > 0").groupBy("rest").agg(F.sum("c").alias("c")).toPandas()  # fewer rows than the window
    histogram = np.zeros(window, np.int64)
    histogram[found["rest"].to_numpy(np.int64)] = found["c"].to_numpy(np.int64)
    plan = spark.sparkContext.broadcast(Plan.make(histogram, window))

    before = F.sum("c").over(Window.partitionBy("rest").orderBy("part")) - F.col("c")
    ranks = per_part.select("part", "rest", before.alias("rank_base"))
    fulls = per_part.groupBy("part").agg(F.sum("f").alias("f")).select("part", (F.sum("f").over(Window.orderBy("part")) - F.col("f")).alias("full_base"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for b in batches:
            out = []
            for r in b.to_pylist():
                for k, crc in enumerate(r["full"]):
                    out.append((r["doc_id"], k * window, window, crc, r["n"], p.sequences + r["full_base"] + r["full_before"] + k, 0))
                if r["rest"]:
                    at = len(r["full"]) * window
                    pieces = p.pieces(r["rest"], r["rank_base"] + r["rank"])
                    crcs = (r["crc"],) if len(pieces) == 1 else (r["head"], r["tail"])
                    out += [(r["doc_id"], at + s, n, crc, r["n"], q, o) for (s, n, q, o), crc in zip(pieces, crcs)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 7)], names=names)

    return rows.join(ranks, ["part", "rest"]).join(fulls, "part").mapInArrow(assign, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0)
