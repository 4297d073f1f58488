"""Language-model scores by a weighted backoff automaton.

The automaton's states are the contexts of a smoothed bigram model: the root, and one state
per training word. From the state of v an arc reads w if the pair occurred in training,
with weight log10 P(w | v); otherwise the failure arc of v leads to the root with weight
log10 B(v), and the root's arc reads w with log10 P(w). With counts c and prior weight K

    P(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | v) = (c(v, w) + K P(w)) / (c(v) + K)      B(v) = K / (c(v) + K)

so that each state's probabilities sum to one. Words never seen in training are read by the
root's arc for unknown words and lead back to the root. A text is read from the state of
the end token, and the end token closes it.

The model is never gathered in one place. Documents are taken in blocks, runs of the input
of at most ``BLOCK_BYTES`` of text (or one document), and there is a bucket for each
``BUCKET_BYTES`` of text at least, so that neither grows with the corpus.
A block states the hashes of the words and pairs it holds, with its training counts, dealt
out by hash into buckets. A bucket sums the counts of all blocks and answers each block with
the totals of just what it asked for. With the answers a block builds its part of the
automaton and reads its documents in one pass from left to right, carrying the state.
Counts cover all training documents; what is moved grows with the corpus, in packed arrays.

Defined cases: null text is empty, its only token is the end; a null id belongs to the
training part; repeated rows count each; without training documents all words are unknown;
other columns are not read.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import stored, table, utf8
from finquarry.llm.tokens import Held

PRIOR, ADDED = 50.0, 0.1
END = b"\n"  # no word holds white space
PAIR = np.uint64(0x9E3779B97F4A7C15)
BLOCK_DOCS, BLOCK_BYTES = 1 << 12, 16 << 20  # a block is a run of one input split, of so many documents and bytes at most
BUCKET_BYTES = 32 << 20  # of text for each bucket, whose hashes and counts are a few times that
REQUEST = "block bigint, bucket bigint, words binary, word_counts binary, pairs binary, pair_counts binary, train_tokens bigint"
ANSWER = "block bigint, bucket bigint, word_totals binary, pair_totals binary, train_tokens bigint, train_words bigint"
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


class _Hashes(Held):
    def __init__(self):
        super().__init__(xxhash.xxh3_64_digest, 32 << 20)


_hashes = _Hashes()


def token_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text (A-Z lower-cased) and of the end token."""
    raw = b"".join(map(_hashes.__getitem__, [*text.lower().split(), END]))
    return np.frombuffer(raw, ">u8").astype(np.uint64)


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it; the first follows the end token."""
    before = np.concatenate([[_end()], h[:-1]]).astype(np.uint64)
    x = (before * PAIR) ^ (h + (before >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _end() -> np.uint64:
    return np.uint64(int.from_bytes(_hashes[END], "big"))


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def _merge(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with the sums of their counts."""
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c


def _packed(counts: np.ndarray) -> bytes:
    """Compressed counts, in four bytes each if they fit."""
    wide = int(counts.max(initial=0)) >= 1 << 32
    return zlib.compress(counts.astype("<u8" if wide else "<u4").tobytes() + bytes([wide]), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    raw = zlib.decompress(raw)
    return np.frombuffer(raw[:-1], "<u8" if raw[-1] else "<u4").astype(np.int64)


def _blocked(most: int, most_bytes: int):
    """Documents with their block and their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, docs, held = TaskContext.get().partitionId() << 33, 0, 0
        for b in batches:
            sizes, blocks = [n or 0 for n in pc.binary_length(b.column("text")).to_pylist()], []
            for n in sizes:
                if docs == most or docs and held + n > most_bytes:
                    block, docs, held = block + 1, 0, 0
                docs, held = docs + 1, held + n
                blocks.append(block)
            yield pa.record_batch([pa.array(blocks, pa.int64()), b.column("doc_id"), b.column("text"), pa.array(sizes, pa.int64())], names=["block", "doc_id", "text", "bytes"])

    return run


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the hashes by bucket, in their order, and where each bucket begins and ends in these."""
    at = hashes % np.uint64(buckets)
    order = np.argsort(at, kind="stable")
    return order, np.searchsorted(at[order], np.arange(buckets + 1, dtype=np.uint64))


class _Block:
    """Distinct hashes of the words and pairs of a block, and how often each occurs in its training documents."""

    def __init__(self):
        self.tables, self.tokens, self.waiting = [([], []), ([], [])], 0, 0

    def add(self, docs: list[tuple[int | None, bytes]]) -> None:
        for doc_id, text in docs:
            h = token_hashes(text)
            weight = np.full(len(h), not held_out(doc_id), np.int64)
            self.tokens += int(weight.sum())
            self.waiting += len(h)
            for (hashes, counts), found in zip(self.tables, (h, pair_hashes(h))):
                hashes.append(found)
                counts.append(weight)
        if self.waiting > 1 << 22:
            self.tables = [tuple([x] for x in _merge(*t)) for t in self.tables]
            self.waiting = 0

    def requests(self, block: int, buckets: int) -> Iterator[pa.RecordBatch]:
        (words, word_counts), (pairs, pair_counts) = (_merge(*t) for t in self.tables)
        (word_at, word_ends), (pair_at, pair_ends) = _dealt(words, buckets), _dealt(pairs, buckets)
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.int64()]
        for bucket in range(buckets):
            w, p = (at[ends[bucket] : ends[bucket + 1]] for at, ends in ((word_at, word_ends), (pair_at, pair_ends)))
            if bucket and not len(w) and not len(p):
                continue  # bucket 0 always has a row, it carries the number of tokens
            row = [block, bucket, words[w].tobytes(), _packed(word_counts[w]), pairs[p].tobytes(), _packed(pair_counts[p]), self.tokens if bucket == 0 else 0]
            yield pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in REQUEST.split(", ")])


def _asked(buckets: int):
    """Requests of each block. The rows of a block come one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for b in batches:
            ids, docs = b.column("block").to_numpy(), list(zip(b.column("doc_id").to_pylist(), utf8(b.column("text"))))
            for at in range(0, len(docs), 1 << 10):
                for block in np.unique(ids[at : at + (1 << 10)]).tolist():
                    if block != current:
                        if held:
                            yield from held.requests(current, buckets)
                        current, held = block, _Block()
                    held.add([docs[i] for i in range(at, min(len(docs), at + (1 << 10))) if ids[i] == block])
        if held:
            yield from held.requests(current, buckets)

    return run


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """A bucket: totals over all blocks, returned to each block in the order of its hashes."""
    words = [np.frombuffer(x, np.uint64) for x in group["words"]]
    pairs = [np.frombuffer(x, np.uint64) for x in group["pairs"]]
    out = []
    total_words, n_words = _merge(words, [_unpacked(x) for x in group["word_counts"]])
    total_pairs, n_pairs = _merge(pairs, [_unpacked(x) for x in group["pair_counts"]])
    distinct = int((n_words > 0).sum())
    for i, (block, bucket, tokens, w, p) in enumerate(zip(group["block"], group["bucket"], group["train_tokens"], words, pairs)):
        out.append((block, bucket, _packed(n_words[np.searchsorted(total_words, w)]), _packed(n_pairs[np.searchsorted(total_pairs, p)]), tokens, distinct if i == 0 else 0))
    return pd.DataFrame(out, columns=["block", "bucket", "word_totals", "pair_totals", "train_tokens", "train_words"])


class Automaton:
    """The part of the backoff automaton that some documents need.

    ``keys`` holds the arcs as sorted state << 32 | word, ``arcs`` their weights, ``failure`` the weight of each
    state's failure arc, ``root`` the weight of each word's arc at the root. A word that is not in the model
    leads to the root; its row stands for the root, with a failure arc that costs nothing.
    """

    def __init__(self, word_counts: np.ndarray, tokens: int, distinct: int, before: np.ndarray, word: np.ndarray, counts: np.ndarray, prior: float = PRIOR):
        c = word_counts.astype(np.float64)
        prob = (c + ADDED) / (tokens + ADDED * (distinct + 1))
        self.root = np.log10(prob)
        self.failure = np.where(c > 0, np.log10(prior / (c + prior)), 0.0)
        seen = counts > 0
        before, word = before[seen].astype(np.int64), word[seen].astype(np.int64)
        keys = before << 32 | word
        order = np.argsort(keys)
        self.keys = keys[order]
        self.arcs = np.log10((counts[seen] + prior * prob[word]) / (c[before] + prior))[order]

    def read(self, start: int, words: np.ndarray) -> float:
        """One pass from left to right: from each state the word's arc, or the failure arc and the root's arc."""
        state = np.concatenate([[start], words[:-1]]).astype(np.int64)
        key = state << 32 | words
        at = np.searchsorted(self.keys, key)
        has = self.keys[np.minimum(at, len(self.keys) - 1)] == key if len(self.keys) else np.zeros(len(key), bool)
        weight = self.failure[state] + self.root[words]
        weight[has] = self.arcs[at[has]]
        return math.fsum(weight.tolist())


def _scored(buckets: int, tokens: int, distinct: int):
    names = [c.split()[0] for c in SCORES.split(", ")]

    def run(key, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """One block: rebuild its hashes, take up the answers, and read its documents."""
        hashes = [token_hashes(b"" if t is None else t.encode()) for t in docs["text"]]
        ends = np.cumsum([len(h) for h in hashes])
        words, word_of = np.unique(np.concatenate(hashes), return_inverse=True)
        pairs, first = np.unique(np.concatenate([pair_hashes(h) for h in hashes]), return_index=True)
        word_totals, pair_totals = np.zeros(len(words), np.int64), np.zeros(len(pairs), np.int64)
        (word_at, word_ends), (pair_at, pair_ends) = _dealt(words, buckets), _dealt(pairs, buckets)
        for bucket, w, p in zip(answers["bucket"], answers["word_totals"], answers["pair_totals"]):
            word_totals[word_at[word_ends[bucket] : word_ends[bucket + 1]]] = _unpacked(w)
            pair_totals[pair_at[pair_ends[bucket] : pair_ends[bucket + 1]]] = _unpacked(p)
        start = int(np.searchsorted(words, _end()))
        before = np.concatenate([[start], word_of[:-1]])  # a document follows the end of the one before it
        a = Automaton(word_totals, tokens, distinct, before[first], word_of[first], pair_totals)
        known, out = word_totals > 0, []
        for doc_id, ids in zip(docs["doc_id"], np.split(word_of, ends[:-1])):
            doc_id = None if pd.isna(doc_id) else int(doc_id)
            out.append((doc_id, held_out(doc_id), len(ids), int(known[ids].sum()), tokens, math.fsum(a.root[ids].tolist()), a.read(start, ids)))
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score all documents with the model of those that are not held out."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    slim = slim.mapInArrow(_blocked(BLOCK_DOCS, BLOCK_BYTES), "block bigint, doc_id bigint, text string, bytes bigint")
    # written bucketed by block, so that blocks stay the same and their texts needn't be shuffled to meet the answers
    name = f"lm_blocks_{uuid.uuid4().hex}"
    slim.write.bucketBy(parts, "block").option("compression", "zstd").format("parquet").saveAsTable(name)
    blocks = spark.table(name).drop("bytes")
    buckets = max(parts, -(-(spark.table(name).agg(F.sum("bytes")).first()[0] or 0) // BUCKET_BYTES))
    asked = slim_requests(blocks, buckets)
    answers = stored(asked.groupBy("bucket").applyInPandas(_answer, ANSWER), "lm-answers")
    total = answers.agg(F.coalesce(F.sum("train_tokens"), F.lit(0)), F.coalesce(F.sum("train_words"), F.lit(0))).first()
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_scored(buckets, total[0], total[1]), SCORES)


def slim_requests(blocks: DataFrame, buckets: int) -> DataFrame:
    """What all blocks ask, one row per block and bucket. A file holds whole blocks, its rows sorted by block."""
    return blocks.sortWithinPartitions("block").mapInArrow(_asked(buckets), REQUEST)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
