"""BPE encoding and decoding by a tokenisation automaton.

The automaton reads tokens and accepts exactly the token sequences that BPE produces for
some word. It is built from the merge list by merge gadgets: at first one state loops on
every base symbol. The gadget of a merge (u, v) -> w takes each pair of arcs p -u-> q -v-> r,
sends u to a copy of q without the v arc, and adds the arc p -w-> r. After all merges the
target of an arc depends on its label alone, so a state stands for "the last token was x".
Whether a state has an arc t is decided by the gadgets in merge order: t = (a, b) gets an
arc where a had one at that time, and the gadget (x, t) cuts it later. The rows of all states are
computed for all labels at once, equal rows become one state, and the result is a bit
table states x labels, bounded by the vocabulary.

A pre-split word is encoded by walking the table from left to right: at a position one
scan down a trie of the labels gives all that match there; from a state they are tried
longest first, positions that lead nowhere are remembered, and the one accepting path is
the encoding. Decoding emits the labels of the ids.

Defined cases: null and empty texts give no ids; special tokens in a text are matched
before anything else, as the library does; texts are encoded whole; null ids are kept and
repeated rows give a row each; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import slices, table, texts
from finquarry.llm.tokens import PLAIN, WORD_SPLIT, Held, byte_letters, packed, working_for

NEVER = np.iinfo(np.int32).max


class Automaton:
    """Labels, their bits per state, and the state that each label leads to."""

    def __init__(self, labels: list[str], special: list[tuple[str, int]], suffix: str, state: np.ndarray, rows: np.ndarray):
        self.labels, self.special, self.suffix, self.state, self.rows = labels, special, suffix, state, rows

    @classmethod
    def compile(cls, path: str) -> "Automaton":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix, vocab = model["end_of_word_suffix"] or "", model["vocab"]
        special = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        labels = [""] * (1 + max([*vocab.values(), *(i for _, i in special)]))
        for text, i in [*vocab.items(), *special]:
            labels[i] = text
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        n = len(labels)
        left, right, born = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        cuts: dict[int, list[tuple[int, int]]] = {}  # u: (v, time)
        for time, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            cuts.setdefault(u, []).append((v, time))
            if left[w] < 0:
                left[w], right[w], born[w] = u, v, time
        depth = np.zeros(n, np.int32)  # of the chain of left parts; parts are older than wholes
        for w in np.argsort(born, kind="stable"):
            if left[w] >= 0:
                depth[w] = depth[left[w]] + 1
        levels = [np.flatnonzero((depth == d) & (born >= 0)) for d in range(1, depth.max() + 1)]
        final = np.array([bool(suffix) and t.endswith(suffix) for t in labels])
        usable = np.zeros(n, bool)
        usable[list(vocab.values())] = True
        usable[[i for _, i in special]] = False
        usable &= (born >= 0) | np.array([len(t.removesuffix(suffix) if suffix else t) == 1 for t in labels])

        def row(x: int) -> np.ndarray:
            """Arcs of the state after label x (-1: the start), by the gadgets in order."""
            cut = np.full(n, NEVER, np.int32)
            spine, until = [], NEVER
            while x >= 0:
                spine.append((x, until))
                until, x = (born[x], right[x]) if left[x] >= 0 else (-1, -1)
            for y, before in reversed(spine):
                for v, time in cuts.get(y, ()):
                    if time < before and cut[v] == NEVER:
                        cut[v] = time
            for at in levels:
                cut[at] = np.where(cut[left[at]] > born[at], cut[at], -1)
            return np.packbits((cut == NEVER) & usable)

        state, found, rows = np.zeros(n, np.int32), {}, []
        for x in [-1, *np.flatnonzero(usable & ~final)]:
            bits = row(x)
            k = found.setdefault(bits.tobytes(), len(rows))
            if k == len(rows):
                rows.append(bits)
            if x >= 0:
                state[x] = k
        state[final] = -1  # a word ends here
        return cls(labels, special, suffix, state, np.array(rows))


class Trie:
    """The labels by their letters: ``step`` leads from node * 2^21 + letter to a node; each node's label, if any.

    A label with the suffix that ends words is kept apart, at the node of its letters before the suffix.
    """

    def __init__(self, ids: dict[str, int], suffix: str):
        self.step: dict[int, int] = {}
        self.label, self.last = [-1], [-1]
        for text, i in ids.items():
            ends = bool(suffix) and text.endswith(suffix)
            node = 0
            for c in text.removesuffix(suffix) if ends else text:
                key = node << 21 | ord(c)
                if key not in self.step:
                    self.step[key] = len(self.label)
                    self.label.append(-1)
                    self.last.append(-1)
                node = self.step[key]
            (self.last if ends else self.label)[node] = i


class Coder:
    """Encodes and decodes with a compiled automaton; remembers words."""

    def __init__(self, automaton: Automaton, path: str):
        from tokenizers import Tokenizer

        self.a = automaton
        whole = Tokenizer.from_file(path)
        self.normalise, self.split = whole.normalizer, whole.pre_tokenizer  # only to normalise and split unusual text
        self.letters = byte_letters()
        special = {i for _, i in automaton.special}
        self.trie = Trie({t: i for i, t in enumerate(automaton.labels) if i not in special}, automaton.suffix)
        self.shown = [t.encode() for t in automaton.labels]
        self.bits, self.width, self.state = memoryview(automaton.rows.reshape(-1)), automaton.rows.shape[1], automaton.state.tolist()
        self.special = re.compile("|".join(re.escape(t) for t, _ in sorted(automaton.special, key=lambda s: -len(s[0])))) if automaton.special else None
        self.special_ids = dict(automaton.special)
        self.words = Held(self._walk, 48 << 20)
        self.chunks = Held(self._chunk, 48 << 20)

    def _matches(self, word: str, at: int) -> list[tuple[int, int]]:
        """(end, label) of all labels that match at a position, shortest first; the end of a word lies one beyond its letters if it has a suffix."""
        step, label, last, n, node, out = self.trie.step, self.trie.label, self.trie.last, len(word), 0, []
        ends = 1 if self.a.suffix else 0
        for p in range(at, n):
            node = step.get(node << 21 | ord(word[p]))
            if node is None:
                return out
            if label[node] >= 0:
                out.append((p + 1, label[node]))
        if ends and last[node] >= 0:
            out.append((n + 1, last[node]))
        return out

    def _walk(self, word: str) -> bytes:
        """The labels on the accepting path for one pre-split word (byte letters), as little-endian unsigned 32-bit bytes."""
        size, bits, width, state = len(word) + (1 if self.a.suffix else 0), self.bits, self.width, self.state
        dead: set[tuple[int, int]] = set()
        path: list[tuple[int, int, list, int]] = []  # position, state, labels left to try, label taken
        at, s, left = 0, 0, self._matches(word, 0)
        while at < size:
            while left:
                end, t = left.pop()
                if bits[s * width + (t >> 3)] >> (7 - (t & 7)) & 1:
                    to = state[t]
                    if (to >= 0) == (end < size) and (end, to) not in dead or end == size and not self.a.suffix:
                        path.append((at, s, left, t))
                        at, s, left = end, to, self._matches(word, end) if end < size else []
                        break
            else:
                dead.add((at, s))
                if not path:
                    raise ValueError(f"no path for {word!r}")
                at, s, left, _ = path.pop()
        return packed([t for *_, t in path])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk without special tokens."""
        if chunk.isascii() and chunk.isalpha():
            return self.words[chunk.lower()]
        if PLAIN.fullmatch(chunk):
            pieces = [p if p.isascii() else "".join(map(self.letters.__getitem__, p.encode())) for p in WORD_SPLIT.findall(chunk.lower())]
        else:
            pieces = [p for p, _ in self.split.pre_tokenize_str(self.normalise.normalize_str(chunk))]
        return b"".join(map(self.words.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes."""
        parts, at = [], 0
        if self.special and "<" in text:
            for m in self.special.finditer(text):
                parts += [text[at : m.start()], m.group()]
                at = m.end()
        parts.append(text[at:])
        ids = []
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(packed([self.special_ids[part]]))
            elif part:
                ids += map(self.chunks.__getitem__, part.replace("\n", " ").split(" "))
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8: their labels, a blank between."""
        return b" ".join(map(self.shown.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_compiled: dict[str, Automaton] = {}
_coders: dict[str, Coder] = {}


def automaton(path: str) -> Automaton:
    """Compiled once per process."""
    if path not in _compiled:
        _compiled[path] = Automaton.compile(path)
    return _compiled[path]


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (UTF-8), one row per document.

    The compiled table is broadcast: its size depends on the vocabulary alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("bpe")
        if path not in _coders:
            _coders[path] = Coder(shared.value, path)
        coder = _coders[path]
        for b in slices(batches):
            ids = [coder.encode(t) for t in texts(b.column("text"))]
            counts, decoded = [len(i) // 4 for i in ids], [coder.decode(i) for i in ids]
            yield pa.record_batch([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The given rows (doc_id, ids) with their decoded text."""
    shared = rows.sparkSession.sparkContext.broadcast(automaton(path))

    def run(batches):
        for b in batches:
            labels = shared.value.labels
            out = [None if x is None else " ".join(labels[i] for i in np.frombuffer(x, "<u4")) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("bigint"), F.col(ids_col)).mapInArrow(run, "doc_id bigint, text string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
