"""Token-ID files coded with a static range asymmetric numeral system (rANS).

One frequency table, counted over the whole corpus, is shared by all blocks. A block holds
whole documents and decodes on its own: its ids are dealt in turn to interleaved lanes,
each a 64-bit state that gives off 32-bit words. Every ``CHECKPOINT`` steps the states and
the position in the words are noted, so that decoding can begin there, and each stretch
between checkpoints has a checksum of its ids. Documents lie in ascending id order: they
are dealt out by ranges of ids, and a range becomes one file of blocks.

Format, as Parquet files below one folder: ``table`` (token, freq), and ``blocks`` (part,
seq, first, doc_ids, doc_tokens, payload). ``first`` counts the ids before the block in its
part. The payload is little-endian: the header (magic, table checksum, number of ids,
lanes, steps between checkpoints, number of words), then per checkpoint its word position
(u64), checksum (u32) and lane states (u64 each), then the words (u32).

Defined cases: null text is empty and has the end id only; null ids come first; repeated
rows are all written; an empty table gives no blocks; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finquarry.llm.common import slices, stored, table, texts
from finquarry.llm.tokens import encoder
from finquarry.session import run_folder

BITS = 20  # the frequencies sum to 2 ** BITS
LOW = np.uint64(1 << 31)  # states lie in [LOW, LOW << 32)
LANES, CHECKPOINT, BLOCK = 512, 256, 1 << 19
MAGIC = b"rANS0001"
HEADER = struct.Struct("<8sIQIIQ")
BLOCKS = "part bigint, seq bigint, first bigint, doc_ids array<bigint>, doc_tokens array<bigint>, payload binary"


class Table:
    """Frequencies that sum to 2 ** BITS, at least 1 for each id that occurs."""

    def __init__(self, tokens: np.ndarray, freqs: np.ndarray):
        self.size = int(tokens.max()) + 1 if len(tokens) else 1
        self.freq = np.zeros(self.size, np.uint64)
        self.freq[tokens] = freqs
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.checksum = zlib.crc32(self.freq.tobytes())
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(self.size, dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Counts (all positive) scaled to the fixed sum; what rounding leaves goes to or comes from the largest."""
        if len(counts) > 1 << (BITS - 1):
            raise ValueError(f"{len(counts)} different ids are too many for {BITS} bits")
        total = int(counts.sum())
        freq = np.maximum(1, counts.astype(np.float64) * (1 << BITS) / max(total, 1)).astype(np.int64)
        order, left = np.argsort(-freq, kind="stable"), (1 << BITS) - int(freq.sum())
        for k in order if len(freq) else ():
            step = max(left, 1 - int(freq[k]))
            freq[k] += step
            left -= step
            if not left:
                break
        return freq


def encode_block(ids: np.ndarray, t: Table) -> bytes:
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    steps = -(-n // lanes)
    freq, start = t.freq[ids], t.start[ids]
    limit = freq << np.uint64(63 - BITS)
    x = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = [None] * steps
    states = []
    b32, bits = np.uint64(32), np.uint64(BITS)
    for i in range(steps - 1, -1, -1):
        a, b = i * lanes, min(n, (i + 1) * lanes)
        y, f = x[: b - a], freq[a:b]
        full = y >= limit[a:b]
        words[i] = y[full].astype(np.uint32)
        y = np.where(full, y >> b32, y)
        q = y // f
        x[: b - a] = (q << bits) + (y - q * f) + start[a:b]
        if i % CHECKPOINT == 0:
            states.append(x.copy())
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    out = [HEADER.pack(MAGIC, t.checksum, n, lanes, CHECKPOINT, int(at[-1]))]
    for k, s in enumerate(reversed(states)):
        piece = ids[k * CHECKPOINT * lanes : (k + 1) * CHECKPOINT * lanes]
        out.append(struct.pack("<QI", int(at[k * CHECKPOINT]), zlib.crc32(piece.astype("<u4").tobytes())) + s.astype("<u8").tobytes())
    return b"".join(out + [w.astype("<u4").tobytes() for w in words])


def decode_block(payload: bytes, t: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids from checkpoint ``first`` up to checkpoint ``last`` (default: all). Raises if a checksum fails."""
    magic, checksum, n, lanes, every, n_words = HEADER.unpack_from(payload)
    if magic != MAGIC or checksum != t.checksum:
        raise ValueError("not a block of this table")
    steps = -(-n // lanes)
    marks = -(-steps // every)
    size = 12 + 8 * lanes
    words = np.frombuffer(payload, "<u4", n_words, HEADER.size + marks * size)
    symbol, mask, bits, b32 = t.symbol, np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
    out = []
    for k in range(first, marks if last is None else min(last, marks)):
        at, check = struct.unpack_from("<QI", payload, HEADER.size + k * size)
        x = np.frombuffer(payload, "<u8", lanes, HEADER.size + k * size + 12).astype(np.uint64)
        piece = []
        for i in range(k * every, min(steps, (k + 1) * every)):
            m = min(lanes, n - i * lanes)
            y = x[:m]
            slot = y & mask
            s = symbol[slot]
            y = t.freq[s] * (y >> bits) + slot - t.start[s]
            low = np.flatnonzero(y < LOW)
            y[low] = (y[low] << b32) | words[at : at + len(low)]
            at += len(low)
            x[:m] = y
            piece.append(s)
        piece = np.concatenate(piece)
        # the states left over must be those of the next checkpoint, or those that encoding began with
        after = np.frombuffer(payload, "<u8", lanes, HEADER.size + (k + 1) * size + 12) if k + 1 < marks else LOW
        if zlib.crc32(piece.astype("<u4").tobytes()) != check or (x != after).any():
            raise ValueError(f"checksum of stretch {k} fails")
        out.append(piece)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _narrow(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def write_tokens(docs: DataFrame, path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenise all documents once and keep their ids, count them, then encode them in id order."""
    spark = docs.sparkSession
    kind = _narrow(max(encoder(path).library.get_vocab_size(), end_id + 1))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, tail = encoder(path), struct.pack("<I", end_id)
        for b in slices(batches):
            ids = [np.frombuffer(e.encode(t) + tail, "<u4").astype(kind).tobytes() for t in texts(b.column("text"))]
            yield pa.record_batch([b.column("doc_id"), b.column("tie"), pa.array(ids, pa.binary())], names=["doc_id", "tie", "ids"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"), F.col(text_col).alias("text"))
    tokenised = stored(slim.mapInArrow(tokenise, "doc_id bigint, tie bigint, ids binary"), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            found = np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), kind))
            total, found = (total, found) if len(total) >= len(found) else (found, total)
            total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["token", "n"])

    counts = tokenised.select("ids").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    counts = counts.sort_values("token")
    tokens, freqs = counts["token"].to_numpy(np.int64), Table.scaled(counts["n"].to_numpy(np.int64))
    spark.createDataFrame([(int(a), int(b)) for a, b in zip(tokens, freqs)], "token bigint, freq bigint").coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast((tokens, freqs))  # at most one entry for each id of the vocabulary

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t, part, seq, first = Table(*shared.value), TaskContext.get().partitionId(), 0, 0
        doc_ids, ids, held = [], [], 0
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

        def block():
            flat = np.frombuffer(b"".join(ids), kind)
            row = [[part], [seq], [first], [doc_ids], [[len(x) // flat.itemsize for x in ids]], [encode_block(flat, t)]]
            return pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds)], names=["part", "seq", "first", "doc_ids", "doc_tokens", "payload"])

        for b in batches:
            for doc_id, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                doc_ids.append(doc_id)
                ids.append(x)
                held += len(x) // np.dtype(kind).itemsize
                if held >= BLOCK:
                    yield block()
                    seq, first, doc_ids, ids, held = seq + 1, first + held, [], [], 0
        if ids:
            yield block()

    tokenised.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "tie").mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Decode all blocks: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and the ids as bytes if asked."""
    found = spark.read.schema("token bigint, freq bigint").parquet(f"{folder}/table").toPandas()
    shared = spark.sparkContext.broadcast((found["token"].to_numpy(np.int64), found["freq"].to_numpy(np.int64)))
    stored = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Table(*shared.value)
        for b in batches:
            for part, first, doc_ids, sizes, payload in zip(*(b.column(c).to_pylist() for c in ("part", "first", "doc_ids", "doc_tokens", "payload"))):
                raw = decode_block(payload, t).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                starts = ends - np.array(sizes)
                pieces = [raw[4 * a : 4 * e] for a, e in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array([part] * len(sizes), pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(starts + first, pa.int64()), pa.array(sizes, pa.int64()), pa.array(map(zlib.crc32, pieces), pa.int64())]
                yield pa.record_batch([*columns, *([pa.array(pieces, pa.binary())] if with_ids else [])], names=["part", "doc_id", "first", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    rows = stored.mapInArrow(documents, "part bigint, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)
    # one row for each part: the ids of all parts before it
    totals = stored.select("part", F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    out = rows.join(bases, "part")
    return out.select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = run_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, folder)
    return read_tokens(spark, folder, with_ids=False)
