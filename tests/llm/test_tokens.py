"""Token files, packing and the BPE automaton against the tokenizers library."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from finquarry.llm.bpe_automaton import Coder, automaton, bpe_round_trip, decode_ids
from finquarry.llm.packing import Plan, nnls, pack
from finquarry.llm.token_files import CHECKPOINT, LANES, Table, decode_block, encode_block, read_tokens, write_tokens
from finquarry.llm import tokens
from finquarry.llm.tokens import Encoder, Held
from finquarry.session import run_folder
from tests.llm.helpers import awkward, nothing

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def strange(seed, n=300):
    rnd = random.Random(seed)
    plain = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDE'.,  \n09éß") for _ in range(rnd.randrange(80))) for _ in range(n)]
    any_ = ["".join(chr(rnd.choice([rnd.randrange(1, 127), rnd.randrange(128, 0x500), rnd.randrange(0x3000, 0xD000), rnd.randrange(0x1F000, 0x1FA00)])) for _ in range(rnd.randrange(50))) for _ in range(n)]
    runs = ["".join(rnd.choice("ab") for _ in range(40)) for _ in range(50)]
    return [*plain, *any_, *runs, "", "a   b \n c", "x\n\n y", "<|endoftext|> a<|endoftext|>", "<|startoftext|>", "  lead", "trail  ", "a \n", "'ll 'Tis", "é ́x"]


def test_what_is_remembered_is_bounded_by_bytes():
    held = Held(lambda k: k * 2, 10_000)
    for i in range(500):
        assert held[str(i)] == str(i) * 2 and held.bytes <= 10_000
    assert held["x" * 5000] == "x" * 10_000 and "x" * 5000 not in held
    tokens.working_for("one stage")
    held["kept"]
    tokens.working_for("one stage")
    assert "kept" in held
    tokens.working_for("another")
    assert not held and held.bytes == 0


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_remembered_ids_equal_the_library(path):
    texts, mine = strange(1), Encoder(path)
    for text, e in zip(texts, Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == e.ids, repr(text)


def test_automaton_equals_the_library():
    coder, library = Coder(automaton(WORD), WORD), Tokenizer.from_file(WORD)
    texts = [*strange(2), " ".join(t.removesuffix("</w>") for t in automaton(WORD).labels[:49406])]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, repr(text)
        assert coder.decode(ids).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_automaton_query_rows(spark):
    library = Tokenizer.from_file(WORD)
    got = bpe_round_trip(awkward(spark), WORD).collect()
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in awkward(spark).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=key) == sorted(want, key=key)
    rows = spark.createDataFrame([(r.doc_id, bytes(r.ids)) for r in got], "doc_id bigint, ids binary")
    assert sorted(r.text for r in decode_ids(rows, WORD).collect()) == sorted(bytes(r.decoded).decode() for r in got)
    assert bpe_round_trip(nothing(spark), WORD).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 100, 5000, 2 * CHECKPOINT * LANES + 77])
def test_blocks_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 49408).astype(np.uint32)
    tokens, counts = np.unique(ids, return_counts=True)
    t = Table(tokens, Table.scaled(counts))
    raw = encode_block(ids, t)
    assert (decode_block(raw, t) == ids).all()
    if n > 2 * CHECKPOINT * LANES:
        assert (decode_block(raw, t, 1, 2) == ids[CHECKPOINT * LANES : 2 * CHECKPOINT * LANES]).all()
        broken = bytearray(raw)
        broken[-9] ^= 4
        with pytest.raises(ValueError):
            decode_block(bytes(broken), t)


def test_scaled_frequencies_are_whole():
    for counts in (np.array([1]), np.ones(50000, np.int64), np.array([10**15, 1, 1]), np.arange(1, 40000)):
        f = Table.scaled(counts)
        assert f.sum() == 1 << 20 and f.min() >= 1


def test_token_files(spark):
    folder = run_folder(spark, "test-tokens")
    write_tokens(awkward(spark), WORD, 2, folder)
    library = Tokenizer.from_file(WORD)
    ties = {r.text: r.tie for r in awkward(spark).selectExpr("text", "xxhash64(coalesce(text, '')) AS tie").collect()}
    rows = sorted(awkward(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, ties[r.text]))
    start, want = 0, []
    for r in rows:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        raw = struct.pack(f"<{len(ids)}I", *ids)
        want.append((r.doc_id, start, len(ids), zlib.crc32(raw), raw))
        start += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in read_tokens(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    empty = run_folder(spark, "test-tokens")
    write_tokens(nothing(spark), WORD, 2, empty)
    assert read_tokens(spark, empty).count() == 0


def _check_plan(lengths, window=1024):
    histogram = np.bincount(lengths, minlength=window)[:window]
    histogram[0] = 0
    plan, rank, sequences = Plan.make(histogram, window), {}, {}
    for n in lengths:
        k = rank[n] = rank.get(n, -1) + 1
        pieces = plan.pieces(int(n), k)
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]] and sum(p[1] for p in pieces) == n
        for _, length, sequence, offset in pieces:
            sequences.setdefault(sequence, []).append((offset, length))
    assert sorted(sequences) == list(range(plan.sequences))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += (window - at) * bool(at & (at - 1))
    assert padding == plan.padding
    return padding


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_rest_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 1024, 3000) if seed < 2 else np.clip(rng.lognormal(5.5 + seed / 3, 0.7, 3000).astype(int), 1, 1023)
    assert _check_plan(lengths) < 0.02 * lengths.sum()


def test_plan_of_one_length():
    for n in (1, 511, 512, 513, 1023):
        _check_plan(np.full(37, n))


def test_nnls_meets_a_reachable_histogram():
    combos = np.array([[4, 6, 0], [2, 2, 6], [1, 9, 0], [1, 1, 8]])
    x = np.array([7.0, 0, 3, 5])
    h = sum(np.bincount(combos[:, k], weights=x, minlength=10) for k in range(3))
    h[0] = 0
    assert np.allclose(nnls(combos, h, 2000), x, atol=1e-3)


def test_packing(spark):
    library = Tokenizer.from_file(BYTE)
    rows = awkward(spark).collect()
    pieces = pack(awkward(spark), BYTE, 0).collect()
    ids = {}
    for r in rows:
        x = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        ids.setdefault((r.doc_id, len(x)), []).append(x)
    where = {}
    for p in pieces:
        x = ids[p.doc_id, p.doc_tokens][0]
        part = x[p.start : p.start + p.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == p.ids_crc32 or len(ids[p.doc_id, p.doc_tokens]) > 1
        where.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(p.length for p in pieces) == sum(len(x) for v in ids.values() for x in v)
    for found in where.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    assert pack(nothing(spark), BYTE, 0).count() == 0
