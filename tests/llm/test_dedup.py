"""Exact and near deduplication against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from finquarry.llm import near_dedup
from finquarry.llm.components import components
from finquarry.llm.exact_dedup import DigestIndex, classify, digests, exact_dedup
from finquarry.llm.near_dedup import near_duplicates
from tests.llm.helpers import awkward, nothing, roots, shingle_set


def test_exact_keeps_the_longest(spark):
    got = exact_dedup(awkward(spark)).collect()
    rows = awkward(spark).collect()
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert len(got) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(strip(r.text), []).append(r)
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        found = [g for g in got if g.digest == __import__("hashlib").sha256(norm.encode()).digest()]
        assert len(found) == len(members) and {g.keep_id for g in found} == {best.doc_id} and {g.group_size for g in found} == {len(members)}
        assert [g.doc_id for g in found if g.kept] == [best.doc_id]  # one, even of repeated rows


def test_index_grows_and_remembers(spark):
    index = DigestIndex(spark, buckets=4)
    one = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string")
    two = spark.createDataFrame([(3, "a  b"), (4, "d"), (5, "d ")], "doc_id bigint, text string")
    assert {(r.doc_id, r.kept) for r in classify(digests(one), index).collect()} == {(1, True), (2, True)}
    assert {(r.doc_id, r.keep_id, r.kept) for r in classify(digests(two), DigestIndex(spark, index.path, 4)).collect()} == {(3, 1, False), (4, 5, False), (5, 5, True)}
    index = DigestIndex(spark, index.path, 4)  # opened again
    assert index.known().count() == 3
    plan = index.known().select("digest").join(index.known().select("digest").hint("merge"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # bucketed


def test_empty_tables(spark):
    assert exact_dedup(nothing(spark)).count() == 0
    assert near_duplicates(nothing(spark)).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(9, 3), (3, 9), (7, 7), (8, 2), (2, 5)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    linked = {i for a, b in edges if a != b for i in (a, b)}
    assert got == roots(linked, [e for e in edges if e[0] != e[1]])


def _variants(seed, families=12, size=14, words=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(families):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        if rnd.random() < 0.5:
            base[10:10] = passage
        for _ in range(size):
            doc = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 5])):
                doc[rnd.randrange(len(doc))] = rnd.choice(vocabulary)
            rows.append(" ".join(doc))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def _brute(rows, n):
    sets = {i: shingle_set(t, n) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, roots(sets, links)


@pytest.mark.parametrize(("seed", "crowd"), [(1, 64), (2, 3), (3, 1)])  # small crowds force the prefix filter
def test_near_equals_brute_force(spark, monkeypatch, seed, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    rows = _variants(seed)
    sets, want = _brute(rows, 4)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i, _ in rows}


def test_near_equals_brute_force_with_few_listed(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LISTED", 10, raising=False)
    test_near_equals_brute_force(spark, monkeypatch, 4, 2)


def test_near_awkward_rows(spark):
    got = near_duplicates(awkward(spark), words=4).collect()
    assert len(got) == awkward(spark).count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].component_id == by_id[2].component_id == 1 and by_id[3].component_id == 1
    assert by_id[4].n_shingles == by_id[5].n_shingles == by_id[6].n_shingles == 0
    assert all(by_id[i].component_id == i and by_id[i].kept for i in (4, 5, 6, 7, 8))
    assert by_id[11].component_id == by_id[12].component_id == 11 and by_id[11].n_shingles == 1
    assert sum(r.kept for r in got if r.component_id == 11) == 1


def test_pigeonhole_keys_meet():
    """Any two signatures that differ in THRESHOLD symbols share a key."""
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(50):
        a = rng.integers(0, 1 << 16, near_dedup.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(near_dedup.SYMBOLS, near_dedup.THRESHOLD, replace=False)] ^= 1
        keys = near_dedup.chunk_keys(np.stack([a, b]))
        assert set(keys[0]) & set(keys[1])


def test_near_groups_are_not_expanded(spark):
    """300 near copies: the pairs checked stay far below all pairs."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i % 150], f"x{i}", *base[i % 150 + 1 :]])) for i in range(300)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.agg(F.max("component_id"), F.sum(F.col("kept").cast("int"))).first()[:] == (0, 1)


def test_bits_drop_no_linked_pair():
    """Sets at the smallest linked similarity differ in no more bits than in shingles, whatever their size; those well below are told apart."""
    rng = np.random.default_rng(5)
    for size in (1, 9, 90, 900, 9000):
        both, one, two = (rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) for k in (size - size // 9, size // 9, size // 9))
        a, b = (np.array(near_dedup.parity(np.concatenate([both, x]))).view(np.uint64) for x in (one, two))
        assert np.bitwise_count(a ^ b).sum() <= len(one) + len(two)
    sets = [rng.integers(0, 1 << 63, 150, dtype=np.uint64) * np.uint64(2) for _ in range(20)]
    bits = [np.array(near_dedup.parity(s)).view(np.uint64) for s in sets]
    assert all(np.bitwise_count(x ^ y).sum() * 180 > 300 * 20 for x, y in itertools.combinations(bits, 2))


def test_documents_around_one_passage_are_not_compared_in_full(spark, monkeypatch):
    """A passage of 60 words with 30 others in each of 90 documents (similarity 0.48): no texts are fetched for them, only for copies."""
    rnd = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*passage, *(f"w{rnd.randrange(10**6)}" for _ in range(30))])) for i in range(90)]
    rows += [(100 + i, f"{rows[i][1]} end") for i in range(5)]
    compared, kept = [], near_dedup._Linker.confirm

    def confirm(self, near):
        compared.extend((r.a, r.b) for r in near.collect())
        return kept(self, near)

    monkeypatch.setattr(near_dedup._Linker, "confirm", confirm)
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: i % 100 for i, _ in rows}
    assert len(set(compared)) == 5


@pytest.mark.parametrize("listed", [1, 40, 1 << 16])
def test_common_shingles_are_not_joined(spark, monkeypatch, listed):
    """Every set's shared shingles from rare to common; the join makes rows for those beyond the list only, not for a passage that all sets hold."""
    passage = list(range(100, 140))
    sets = {0: [], 1: [1], 2: [1, 2, -3], **{i: sorted([*passage, i % 4, -i]) for i in range(10, 90)}}
    joined, plain = [], type(spark.range(1)).join

    def join(self, other, on=None, how=None):
        out = plain(self, other, on, how)
        if on == "shingle":
            joined.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "LISTED", listed, raising=False)
    monkeypatch.setattr(type(spark.range(1)), "join", join)

    class Linker:
        n = 1

        def texts_of(self, ids):
            return spark.createDataFrame([(i, " ".join(f"w{x}" for x in s)) for i, s in sets.items()], "node bigint, text string").join(ids.distinct(), "node")

    crowd = spark.createDataFrame([(i, i) for i in sets], "node bigint, component bigint")
    got = near_dedup._prefix_keys(Linker(), crowd, 80).collect()
    df = Counter(x for s in sets.values() for x in s)
    name = lambda x: int(near_dedup.shingles(f"w{x}".encode(), 1)[0].view(np.int64)[0])
    want = {}
    for i, s in sets.items():
        order = sorted((df[x], name(x)) for x in s if df[x] > 1)
        width = len(s) - -(-len(s) * 80 // 100) + 1 - (len(s) - len(order))
        want |= {(i, k): (len(s), len(order) - at, i) for at, (_, k) in enumerate(order[: max(width, 0)])}
    assert {(r.node, r.key): (r.n, r.rest, r.component) for r in got} == want and len(got) == len(want)
    shared = [d for d in df.values() if d > 1]
    assert sum(joined) == {1: sum(shared), 40: sum(shared) - 40 * 80, 1 << 16: 0}[listed]  # 40 words of the passage, in 80 sets


def test_stated_loss_is_the_binomial_tail():
    import math

    import finquarry.llm.near_dedup as m

    tail = lambda n, least: sum(math.comb(n, k) * 0.2**k * 0.8 ** (n - k) for k in range(least, n + 1))
    no_key, too_far = tail(m.SYMBOLS // m.CHUNKS, m.ERRORS + 1) ** m.CHUNKS, tail(m.SYMBOLS, m.CLOSE + 1)
    assert "probability of 5 in 10^10" in " ".join(m.__doc__.split()) and "one of 3 in 10^11" in m.__doc__
    assert no_key < 5.5e-10 and too_far < 3e-11


def test_no_pair_of_the_smallest_similarity_is_lost():
    """3,000 pairs of sets with a similarity of exactly 0.8: each shares a key, and none is too far."""
    import finquarry.llm.near_dedup as m

    rng = np.random.default_rng(6)
    one, two = [], []
    for _ in range(3000):
        both = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
        one.append(m.signature(np.unique(both[:90])))
        two.append(m.signature(np.unique(np.concatenate([both[:80], both[90:]]))))
    one, two = np.array(one), np.array(two)
    shared = (m.chunk_keys(one) == m.chunk_keys(two)).any(1)
    far = (one != two).sum(1)
    assert shared.all() and far.max() <= m.CLOSE and (far > m.THRESHOLD).sum() < 3
