"""Periodic runs, spelling variants and language identification against plain versions."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from finquarry.llm import language_id
from finquarry.llm.common import table
from finquarry.llm.language_id import OP13_SQL, UNKNOWN, code_of, language_profiles, languages, ngrams, op13_language_id, shown, words_of
from finquarry.llm.periodic_runs import op11_periodic_runs, periodic_runs, planted, word_runs
from finquarry.llm.spelling import OP12_SQL, damaged, last_forms, op12_spelling_variants, spelling_variants, symbols_for, vocabulary, with_roots
from finquarry.session import run_folder
from tests.llm.helpers import LONG, WORDS, awkward, nothing, sha

SF = "/root/testdata/sf0.001"


def brute_runs(words, least=24, exponent=3):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, exponent * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rnd = random.Random(5)
    for _ in range(1500):
        n, k = rnd.randrange(150), rnd.choice([1, 2, 2, 3, 6])
        words = [rnd.randrange(1, k + 1) for _ in range(n)]
        for _ in range(rnd.randrange(3) if n > 4 else 0):
            a = rnd.randrange(n)
            p = 1 + rnd.randrange(max(1, (n - a) // 3))
            for i in range(a, min(n, a + p * rnd.randrange(2, 9))):
                words[i] = words[a + (i - a) % p]
        least, exponent = rnd.choice([(24, 3), (6, 3), (2, 2), (24, 2), (10, 4), (1, 3)])
        assert word_runs(np.array(words, np.int64), least, exponent) == brute_runs(words, least, exponent), words


@pytest.mark.parametrize("period", [1, 7, 5000])
def test_runs_of_long_sequences(period):
    ids = np.arange(20_000) % period + 1
    assert word_runs(ids) == [(0, 20_000, period)]


def test_a_phrase_between_ever_new_words_is_no_run():
    ids = np.array([i if i % 20 == 0 else 1_000_000 + i % 20 for i in range(20_000)])
    assert word_runs(ids) == []


def _documents(spark, rows):
    folder = run_folder(spark, "test-documents")
    rows.write.parquet(f"{folder}/documents.parquet")
    return folder


def expected_runs(doc_id, text):
    words = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


@pytest.mark.parametrize("given", [False, True])
def test_run_query(spark, given):
    """The awkward rows with more ids (one in ten is rearranged), and the smallest given table."""
    rows = table(spark, SF, "documents") if given else awkward(spark).unionByName(awkward(spark).selectExpr("doc_id + 100 AS doc_id", "text", "lang", "source", "n_chars", "spans"))
    got = [tuple(r) for r in op11_periodic_runs(spark, _documents(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(str(expected_runs(r.doc_id, r.text)) for r in rows.collect())
    assert any(r[1] for r in got) and len({r[6] for r in got}) > 1


def test_runs_of_awkward_rows(spark):
    rows = {(r.doc_id, r.n_words): r for r in periodic_runs(awkward(spark)).collect()}
    long = next(r for r in rows.values() if r.doc_id == 7)
    assert [tuple(x) for x in long.runs] == [(0, 12_000, 4)] and long.collapsed == "alpha beta gamma delta"
    assert rows[5, 0].runs == [] and rows[5, 0].collapsed == "" and (None, 0) in rows
    assert periodic_runs(awkward(spark)).count() == awkward(spark).count() and periodic_runs(nothing(spark)).count() == 0
    assert op11_periodic_runs(spark, _documents(spark, nothing(spark))).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(awkward(spark), min_exponent=1)
    assert planted(1, 5) is None or len(planted(1, 5)) == 5


# --- spelling -------------------------------------------------------------------------------------------------
def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(counts):
    out, forms = {}, {}
    for w, n in counts.items():
        around = [x for x in counts if x != w and near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (n, len(around), counts[forms[w]] if forms[w] else None)

    def root(w):
        return root(forms[w]) if forms[w] else w

    return sorted((w, forms[w], root(w), *out[w]) for w in counts)


def test_variants_equal_brute_force(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randrange(5, 8))) for _ in range(400)} | {"straße", "strasse", "strase", "naïve", "naive", "ÿÿÿÿÿ", "ÿÿÿÿÀ", "ÿÿÿÿ×÷"}
    counts = {w: rnd.choice([3, 4, 6, 8, 16, 40, 2000]) for w in words}
    got = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == expected_variants(counts)


def test_chains_of_forms_end(spark):
    steps = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(60)]
    rows = {r.word: r.root for r in last_forms(spark.createDataFrame(steps, "word string, form string")).collect()}
    assert rows == {a: "w60" for a, _ in steps}
    assert last_forms(spark.createDataFrame([], "word string, form string")).count() == 0


def test_symbols_grow_with_the_vocabulary():
    assert [symbols_for(n) for n in (0, 204_800, 204_801, 10**6, 10**8)] == [4, 4, 5, 6, 12]


def expected_vocabulary(rows):
    import re

    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("given", [False, True])
def test_vocabulary(spark, given):
    rows = table(spark, SF, "documents") if given else awkward(spark)
    got = vocabulary(rows, changed=damaged).collect()
    assert {r.word: r.n for r in got} == expected_vocabulary([(r.doc_id, r.text) for r in rows.collect()]) and len(got) > 3
    assert vocabulary(nothing(spark), changed=damaged).count() == 0


def _by_sql(folder, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet{'/*.parquet' if 'test-' in folder else ''}'")
    return sorted(map(str, con.sql(sql).fetchall()))


def _rows(df, names):
    return sorted(str(tuple(r)) for r in df.select(*names).collect())


def test_variant_query(spark):
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    assert _rows(op12_spelling_variants(spark, SF), names) == _by_sql(SF, OP12_SQL)
    folder = _documents(spark, awkward(spark))
    assert _rows(op12_spelling_variants(spark, folder), names) == _by_sql(folder, OP12_SQL)
    assert op12_spelling_variants(spark, _documents(spark, nothing(spark))).count() == 0


def test_rows_get_their_root_beside_clashing_columns(spark):
    variants = spark.createDataFrame([("colour", None, "colour"), ("color", "colour", "colour")], "word string, form string, root string")
    rows = spark.createDataFrame([("color", 1, "x"), ("other", 2, "y"), (None, 3, "z")], "word string, root int, _word string")
    assert sorted(with_roots(rows, variants).collect(), key=lambda r: r.root) == [("color", 1, "x", "colour"), ("other", 2, "y", "other"), (None, 3, "z", None)]


# --- languages --------------------------------------------------------------------------------------------------
def plain_ngrams(words):
    return Counter(g for w in words.split() for p in [f" {w} "] for n in (1, 2, 3) for i in range(len(p) - n + 1) for g in [p[i : i + n]] if g != " ")


@pytest.mark.parametrize("piece", [1 << 20, 7, 1])
def test_ngrams_in_pieces_equal_plain_ones(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    rnd = random.Random(2)
    for text in ["aba", "x", "", "a b", "日本 \U0001f600é x", *["".join(rnd.choice("abé 𝒳") for _ in range(60)) for _ in range(50)]]:
        words = words_of(text)
        codes, counts = ngrams(words)
        assert dict(zip(map(shown, codes.tolist()), counts.tolist())) == plain_ngrams(words)
        assert [shown(c) for c in codes.tolist()] == sorted(plain_ngrams(words)) and [code_of(shown(c)) for c in codes.tolist()] == codes.tolist()


def test_words_are_letters_with_their_marks():
    assert words_of("Ab1c_d ½ x²") == " ab c d x " and words_of("12 !") == "" and words_of("e\u0301te\u0301 \u0301a") == " e\u0301te\u0301 a "
    assert words_of("ÀÉ×ß ſt") == " àé ß ſt " and words_of("हिन्दी में") == " हिन्दी में "


def test_language_query(spark):
    names = ["doc_id", "held_out", "lang_pred", "score"]
    assert _rows(op13_language_id(spark, SF), names) == _by_sql(SF, OP13_SQL)
    folder = _documents(spark, awkward(spark))
    got = _rows(op13_language_id(spark, folder), names)
    assert got == _by_sql(folder, OP13_SQL)
    assert str((5, zlib.crc32(b"5") % 5 == 0, UNKNOWN, 0.0)) in got
    assert op13_language_id(spark, _documents(spark, nothing(spark))).count() == 0


def test_held_out_languages_are_found(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = op13_language_id(spark, "/root/testdata/sf0.01").filter("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_before_and_without_any_language(spark):
    none = languages(awkward(spark), language_profiles(nothing(spark)))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {(UNKNOWN, 0.0)}
    rows = spark.createDataFrame([("a", "der die und"), ("b", "der die und"), ("c", LONG), (None, "x y z"), ("d", None), ("e", "12 !")], "lang string, text string")
    profiles = language_profiles(rows)
    assert {r.lang for r in profiles.collect()} == {"a", "b", "c"} and profiles.groupBy("lang").count().filter("count > 300").isEmpty()
    asked = spark.createDataFrame([(1, "und die"), (2, "½ ²  ٣"), (3, "alpha"), (None, "日本")], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in languages(asked, profiles).collect()}
    assert got == {1: ("a", True), 2: (UNKNOWN, False), 3: ("c", True), None: ("a", False)}
    assert {r.lang for r in language_profiles(rows, max_languages=1).collect()} == {"c"}
