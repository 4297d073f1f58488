"""Near-duplicate documents by MinHash and a multi-index Hamming join.

Each document's set of word shingles gets a signature of ``SYMBOLS`` min-hashes of 16 bits.
Signatures are split into ``CHUNKS`` chunks. Two signatures that differ in at most
``THRESHOLD`` symbols have, by pigeonhole, a chunk with at most ``ERRORS`` differing symbols,
so they share a key when each chunk is indexed with every choice of that many symbols left
out: all pairs under the threshold meet, and of those beyond it nearly all that are similar: a
pair at the smallest linked similarity shares no key with a probability of 5 in 10^10. Pairs
that meet are dropped if they differ in more than ``CLOSE`` symbols, which such a pair does with
one of 3 in 10^11 (binomial tails), and confirmed on the full sets. Before any text is fetched,
a pair must pass an exact test: each set has ``PARITY`` bits, each telling whether an odd number
of its shingles falls to it. Sets differ in at least as many shingles as their bits do, and a
linked pair differs in few for its size.

Large groups are never expanded into pairs:

* documents with the same word sequence are one node;
* first, in ``ROUNDS`` rounds, each key names one of its nodes as leader, and a node is compared
  with the ``LEADERS`` leaders that it shares most keys with. What links is contracted towards components;
* then a key is only looked at again where it still joins different components, and only
  pairs across components are compared, with sets of fitting sizes and bits, and with sketches
  (four bits of each symbol) that differ in no more than ``CLOSE`` symbols;
* keys with more than ``CROWD`` nodes left in different components (a passage that many
  otherwise different documents share) use an exact prefix filter instead: their documents'
  shingles are ordered from rare to common, and two sets with the similarity must share one
  of the first n - ceil(similarity * n) + 1; the shared passage is never among these. Counts of
  the most common shingles, ``LISTED`` at most, are broadcast, those of rarer ones joined. A pair
  is only made at a key that can be the first it shares: enough shingles are left for the
  overlap, and none of the ``BEFORE`` keys before it is shared.

Defined cases: null text, or one without words, has an empty set and is linked with nothing;
fewer words than a shingle: the whole sequence is the one shingle; null ids take part and
never name a component that has another id; of repeated rows exactly one is kept; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finquarry.llm.common import dropped, slices, stored, table, utf8
from finquarry.llm.components import components, contracted
from finquarry.llm.tokens import Held, working_for

WORDS, PERCENT = 5, 80  # the library's default shingle; op2's contract sets four
SYMBOLS, CHUNKS, ERRORS = 80, 16, 1
THRESHOLD = CHUNKS * (ERRORS + 1) - 1  # all pairs that differ in no more symbols meet
CLOSE = 42  # pairs that met are looked at in full up to this distance
ROUNDS, LEADERS = 3, 3
CROWD = 64  # nodes of one key that are compared pair by pair; larger keys use the prefix filter
PARITY = 512  # bits of a set that tell pairs apart
LISTED = 1 << 16  # shingles of crowded keys that are broadcast with their counts, at most
BEFORE = 8  # keys before one in a prefix that are looked at to tell whether a pair has met already

_rng = np.random.default_rng(20260101)
FACTORS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
SHIFTS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(Held):
    """The 8-byte hash of each word."""

    def __init__(self):
        super().__init__(xxhash.xxh3_64_digest, 32 << 20)


_words = Words()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes, n: int) -> tuple[np.ndarray, bytes]:
    """Sorted distinct 64-bit hashes of the word n-grams of a text, and a hash of its word sequence (empty without words)."""
    words = text.lower().split()  # on bytes: A-Z only, and exactly the white space asked for
    if not words:
        return np.zeros(0, np.uint64), b""
    raw = b"".join(map(_words.__getitem__, words))
    h = np.frombuffer(raw, ">u8").astype(np.uint64)
    width = min(n, len(h))
    acc = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        acc = (acc + h[k : len(h) - width + 1 + k]) * MIX
        acc ^= acc >> np.uint64(31)
    return np.unique(mixed(acc + np.uint64(width))), xxhash.xxh3_128_digest(raw)


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of each hash function."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), 2048):
        values = found[a : a + 2048, None] * FACTORS + SHIFTS
        low = np.minimum(low, (values ^ (values >> np.uint64(32))).min(0))
    return (mixed(low) >> np.uint64(48)).astype(np.uint16)


def sketch(sig: np.ndarray) -> list[int]:
    """Four bits of each symbol, sixteen symbols to a long."""
    nibbles = (sig & 15).astype(np.uint64).reshape(-1, 16)
    return (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64).view(np.int64).tolist()


SKETCH = [f"s{i}" for i in range(SYMBOLS // 16)]


def parity(found: np.ndarray) -> list[int]:
    """``PARITY`` bits, 64 to a long: has an odd number of shingles these leading bits?"""
    at = (found >> np.uint64(64 - (PARITY - 1).bit_length())).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=PARITY) & 1).astype(np.uint8)).view(np.int64).tolist()


BITS = [f"p{i}" for i in range(PARITY // 64)]


def _may_link(percent: int) -> Column:
    """Sizes and bits of the sides a and b allow the similarity; always true for a linked pair.

    Linked sets differ in at most (100 - percent) / (100 + percent) of their sizes' sum, and in no fewer shingles than bits.
    """
    sizes = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in BITS])
    return sizes & (apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))


def _sketch_distance(a: list[Column], b: list[Column]) -> Column:
    """Symbols whose four bits differ: never more than the symbols that differ."""
    total = None
    for x, y in zip(a, b):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = F.bit_count(d) if total is None else total + F.bit_count(d)
    return total


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature (row) the keys of all chunks with every choice of ERRORS symbols left out."""
    out = []
    per = SYMBOLS // CHUNKS
    for c in range(CHUNKS):
        part = signatures[:, c * per : (c + 1) * per].astype(np.uint64)
        for v, kept in enumerate(combinations(range(per), per - ERRORS)):
            key = np.full(len(part), c * 64 + v + 1, np.uint64) * MIX
            for k in kept:
                key = (key ^ part[:, k]) * MIX
                key ^= key >> np.uint64(29)
            out.append(mixed(key).view(np.int64))
    return np.stack(out, 1) if len(signatures) else np.zeros((0, CHUNKS * per), np.int64)


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        working_for("near")
        first = TaskContext.get().partitionId() << 33
        for b in slices(batches):
            sizes, seqs, sigs, sketches, bits = [], [], [], [], []
            for t in utf8(b.column("text")):
                found, seq = shingles(t, n)
                sizes.append(len(found))
                seqs.append(seq or None)
                sig = signature(found) if len(found) else None
                sigs.append(None if sig is None else sig.tobytes())
                sketches.append(None if sig is None else sketch(sig))
                bits.append(None if sig is None else parity(found))
            row = pa.array(range(first, first + b.num_rows), pa.int64())
            first += b.num_rows
            yield pa.record_batch([row, b.column("doc_id"), b.column("text_key"), pa.array(sizes, pa.int64()), pa.array(seqs, pa.binary()), pa.array(sigs, pa.binary()), pa.array(sketches, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["row", "doc_id", "text_key", "n", "seq", "sig", "sketch", "bits"])

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        keys = chunk_keys(np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(b.num_rows, SYMBOLS))
        node = np.repeat(b.column("node").to_numpy(), keys.shape[1])
        yield pa.record_batch([pa.array(keys.ravel()), pa.array(node), pa.array(np.repeat(b.column("n").to_numpy(), keys.shape[1]))], names=["key", "node", "n"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures differ in at most CLOSE symbols."""
    for b in slices(batches):
        one, two = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, SYMBOLS) for c in ("sig_a", "sig_b"))
        ok = pa.array((one != two).sum(1) <= CLOSE)
        yield pa.record_batch([b.column("a").filter(ok), b.column("b").filter(ok)], names=["a", "b"])


def _confirmed(n: int, percent: int):
    """Pairs whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for("near")
        for b in slices(batches):
            ok, known = [], {}
            for ta, tb, a in zip(utf8(b.column("text_a")), utf8(b.column("text_b")), b.column("a").to_pylist()):
                if a not in known:
                    known = {a: shingles(ta, n)[0]}
                x, y = known[a], shingles(tb, n)[0]
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.record_batch([b.column("a").filter(ok), b.column("b").filter(ok)], names=["u", "v"])

    return run


class _Linker:
    """Nodes (one per word sequence) with their signatures and texts; checks pairs of them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, n: int, percent: int):
        self.docs, self.nodes, self.n, self.percent = docs, nodes, n, percent

    def texts_of(self, ids: DataFrame) -> DataFrame:
        """One text for each node in ``ids`` (node)."""
        wanted = self.nodes.join(ids.distinct(), "node").select("node", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
        return self.docs.join(wanted, same).groupBy("node").agg(F.first("text").alias("text"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, as (u, v): first by sizes, bits and signature, then on the full sets."""
        side = lambda x: self.nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"sig_{x}"), *[F.col("bits")[i].alias(f"{p}_{x}") for i, p in enumerate(BITS)])
        near = pairs.join(side("a"), "a").join(side("b"), "b").filter(_may_link(self.percent)).select("a", "b", "sig_a", "sig_b")
        return self.confirm(stored(near.mapInArrow(_near, "a bigint, b bigint"), "near-pairs"))

    def confirm(self, near: DataFrame) -> DataFrame:
        """The pairs of a stored table that are links; the table is not kept."""
        ids = near.select(F.col("a").alias("node")).union(near.select("b"))
        text = stored(self.texts_of(ids), "near-texts")
        with_text = near.join(text.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(text.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        found = stored(with_text.mapInArrow(_confirmed(self.n, self.percent), "u bigint, v bigint"), "links")
        dropped(text)
        dropped(near)
        return found


def _shingle_sets(n: int):
    def run(batches):
        working_for("near")
        for b in slices(batches):
            found = [shingles(t, n)[0].view(np.int64) for t in utf8(b.column("text"))]
            yield pa.record_batch([b.column("node"), pa.array([len(f) for f in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "n", "shingles"])

    return run


def _listed(known):
    """Of each set the shingles that ``known`` lists, with their counts, and the others."""

    def run(batches):
        listed, counts = known.value
        for b in slices(batches):
            sets = b.column("shingles")
            flat, of = sets.flatten().to_numpy(), np.repeat(np.arange(b.num_rows), sets.value_lengths().to_numpy())
            at = np.searchsorted(listed, flat)
            there = np.append(listed, 0)[at] == flat
            there &= at < len(listed)
            ends = lambda mask: pa.array(np.append(0, np.cumsum(np.bincount(of[mask], minlength=b.num_rows))), pa.int32())
            s = pa.StructArray.from_arrays([pa.array(counts[at[there]]), pa.array(flat[there])], names=["df", "shingle"])
            yield pa.record_batch([b.column("node"), b.column("n"), pa.ListArray.from_arrays(ends(there), s), pa.ListArray.from_arrays(ends(~there), pa.array(flat[~there]))], names=["node", "n", "s", "others"])

    return run


def _ranked(sets: DataFrame) -> DataFrame:
    """node, n and the shingles (df, shingle) of each set that others have too, from rare to common.

    The most common, all from a power of two on, ``LISTED`` at most, stay in the node's row; rarer ones are joined.
    """
    common = stored(sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "crowd-counts")
    least, room = 2, LISTED
    for r in sorted(common.groupBy(F.length(F.bin("df")).alias("bits")).agg(F.count("*").alias("m")).collect(), key=lambda r: -r.bits):
        room -= r.m
        if room < 0:
            least = 1 << r.bits
            break
    most = common.filter(F.col("df") >= least).collect()  # never more than LISTED
    listed, counts = (np.array([r[c] for r in most], np.int64) for c in ("shingle", "df"))
    order = np.argsort(listed)
    known = sets.sparkSession.sparkContext.broadcast((listed[order], counts[order]))
    kind = "array<struct<df:bigint,shingle:bigint>>"
    parts = sets.mapInArrow(_listed(known), f"node bigint, n bigint, s {kind}, others array<bigint>")
    if least > 2:
        parts = stored(parts, "crowd-places")
        more = parts.select("node", F.explode("others").alias("shingle")).join(common.filter(F.col("df") < least), "shingle").groupBy("node").agg(F.collect_list(F.struct("df", "shingle")).alias("more"))
        parts = parts.join(more, "node", "left").withColumn("s", F.concat("s", F.coalesce("more", F.array().cast(kind))))
    return parts.select("node", "n", F.array_sort("s").alias("s"))


def _prefix_keys(linker: _Linker, crowd: DataFrame, percent: int) -> DataFrame:
    """The nodes of crowded keys with their rare shingles as keys (exact prefix filter)."""
    sets = stored(linker.texts_of(crowd.select("node")).mapInArrow(_shingle_sets(linker.n), "node bigint, n bigint, shingles array<bigint>"), "crowd-shingles")
    ranked = _ranked(sets)
    # shingles of df 1 come first in the order and meet nobody: they use up places of the prefix
    width = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1 - (F.col("n") - F.size("s"))

    def place(x: Column, i: Column) -> Column:
        before = F.slice("s", F.greatest(i + 1 - BEFORE, F.lit(1)), F.least(i, F.lit(BEFORE)))["shingle"]
        return F.struct(x["shingle"].alias("key"), (F.size("s") - i).cast("bigint").alias("rest"), before.alias("before"))

    places = F.transform(F.slice("s", F.lit(1), width.cast("int")), place)
    prefix = ranked.filter(width > 0).select("node", "n", F.explode(places).alias("x")).select("node", "n", "x.*")
    return prefix.join(crowd.select("node", "component").distinct(), "node")


def _first_shared(percent: int) -> Column:
    """May this key be the first that the two sets share, in the order of the prefixes? Always true for a linked pair's first one.

    Then the shingles from here on can hold the overlap that a link needs, and none of the keys just before is in both.
    """
    needed = (F.col("na") + F.col("nb")) * percent
    holds = (F.least("rest_a", "rest_b") * (100 + percent)) >= needed
    return holds & ~F.arrays_overlap("before_a", "before_b")


def _cross(linker: _Linker, keyed: DataFrame, percent: int, ordered: bool = False) -> DataFrame:
    """Pairs (a, b) of one key in different components, with sets of fitting sizes and bits, and near sketches.

    ``ordered`` keys are prefixes with ``rest`` and ``before``: a pair is only made where its first shared key can be,
    whatever its sketches.
    """
    seen = [*[F.col("bits")[i].alias(c) for i, c in enumerate(BITS)], *([] if ordered else [F.col("sketch")[i].alias(c) for i, c in enumerate(SKETCH)])]
    rows = keyed.join(linker.nodes.select("node", *seen), "node")
    more = [*BITS, *(["rest", "before"] if ordered else SKETCH)]
    side = lambda df, x: df.select("key", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("component").alias(f"c{x}"), *[F.col(c).alias(f"{c}_{x}") for c in more])
    if ordered:
        fits = _may_link(percent) & _first_shared(percent)
    else:
        fits = _may_link(percent) & (_sketch_distance([F.col(f"{c}_a") for c in SKETCH], [F.col(f"{c}_b") for c in SKETCH]) <= CLOSE)
    return side(rows, "a").join(side(rows, "b"), "key").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & fits).select("a", "b").distinct()


def _led(placed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a node and the leaders, of other components, that it shares most keys with."""
    first = F.min(F.struct(F.xxhash64(F.lit(turn), "node"), "node", "component")).alias("f")
    leaders = placed.groupBy("key").agg(first).select("key", F.col("f.node").alias("a"), F.col("f.component").alias("ca"))
    shared = placed.join(leaders, "key").filter("component <> ca").groupBy(F.col("node").alias("b"), "a").agg(F.count("*").alias("m"))
    best = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("m"), "a"))
    return shared.withColumn("r", best).filter(F.col("r") <= LEADERS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _open(placed: DataFrame) -> DataFrame:
    """The rows of keys that still join different components, with the number of their nodes."""
    keys = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("m")).filter("c0 <> c1").select("key", "m")
    return placed.drop("m").join(keys, "key")


def _merged(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("u").alias("_node")).agg(F.min("v").alias("_to"))


def _joined(placed: DataFrame, merged: DataFrame) -> DataFrame:
    """The rows with the component that their node is known to be in."""
    return placed.join(merged, F.col("node") == F.col("_node"), "left").withColumn("component", F.coalesce("_to", "node")).drop("_node", "_to")


def text_key(text: Column) -> Column:
    """Tells apart rows of the same id with different texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept; one row per document.

    Kept is the row with the component's smallest id, of repeated rows the first.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    sketches = stored(slim.mapInArrow(_sketch(words), "row bigint, doc_id bigint, text_key bigint, n bigint, seq binary, sig binary, sketch array<bigint>, bits array<bigint>"), "sketches")
    # one node for each word sequence, named by its first row
    first = F.min(F.struct("row", "doc_id", "text_key", "n", "sig", "sketch", "bits")).alias("f")
    nodes = stored(sketches.filter("seq is not null").groupBy("seq").agg(first).select("seq", F.col("f.row").alias("node"), "f.doc_id", "f.text_key", "f.n", "f.sig", "f.sketch", "f.bits"), "nodes")
    linker = _Linker(slim, nodes, words, percent)

    keyed = stored(nodes.select("node", "n", "sig").mapInArrow(_keys, "key bigint, node bigint, n bigint"), "keys")
    placed = stored(_open(keyed.withColumn("component", F.col("node"))), "shared-keys")
    links = None
    for turn in range(ROUNDS):
        found = linker.links(_led(placed, turn))
        if found.isEmpty():
            break
        # what is not yet merged here only costs comparisons below; the components are made at the end
        links = contracted(found if links is None else links.union(found))
        last, placed = placed, stored(_open(_joined(placed, _merged(links))), "open-keys")
        dropped(last)
        if placed.isEmpty():
            break
    crossed = linker.confirm(stored(_cross(linker, placed.filter(F.col("m") <= CROWD), percent), "cross-pairs"))  # sketches said what signatures would
    links = crossed if links is None else links.union(crossed)
    crowd = placed.filter(F.col("m") > CROWD)
    if not crowd.isEmpty():
        prefix = stored(_prefix_keys(linker, crowd, percent), "prefix-keys")
        # what is linked so far is known in full first, so that a crowd of near copies isn't paired out
        known = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_to"))
        pairs = stored(_cross(linker, _open(_joined(prefix, known)), percent, ordered=True), "prefix-pairs")
        links = links.union(linker.confirm(pairs))
    final = components(links).withColumnRenamed("node", "_node")

    group = nodes.select("seq", "node").join(final, F.col("node") == F.col("_node"), "left").select(F.col("seq").alias("_seq"), F.coalesce("component", "node").alias("group"))
    linked = sketches.filter("seq is not null").drop("sig", "sketch", "bits").join(group, F.col("seq") == F.col("_seq"))
    linked = stored(linked, "grouped")
    best = linked.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("b")).select(F.col("group").alias("_group"), F.col("b.doc_id").alias("component_id"), F.col("b.row").alias("best"))
    best = stored(best, "best")  # else both sides of the join meet by the same exchange, which can't be split
    columns = ["doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id"]
    grouped = linked.join(best, F.col("group") == F.col("_group")).select(*columns, (F.col("row") == F.col("best")).alias("kept"))
    alone = sketches.filter("seq is null").withColumn("component_id", F.col("doc_id")).select(*columns, F.lit(True).alias("kept"))
    return grouped.unionByName(alone)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
