"""Language of a text by rank-order profiles.

The profile of a language, and of a document, is its list of most frequent n-grams in order:
the ``PROFILE`` most frequent n-grams of one to ``LONGEST`` characters of its words, each word
lower-cased with a blank before and after it; of equal counts the smaller n-gram first. The
out-of-place distance of a document from a language sums, over the n-grams of the document's
profile, how far the n-gram's place there is from its place in the language's profile, or
``PROFILE`` where the language's profile lacks it. The nearest language is predicted (ties:
the smaller name); the score is 1 less the distance's share of the largest possible one.

Words are runs of letters with the marks that follow them. An n-gram is a number, its code
points in 21 bits each, so that numbers sort as n-grams do and are counted by sorting; long
texts are counted piece by piece. Profiles of languages come from all training texts: each
task adds up the counts of its languages, Spark sums them, and only the first ``PROFILE`` of
a language leave it. The languages are at most ``MAX_LANGUAGES``, those with the most n-grams
in training, so that what is sent to the tasks has a bound; there are some hundreds of
written languages.

Defined cases: a null text, and one without letters, is ``und`` with score 0, and so is
every text if nothing was learned; rows with a null label or null id train nothing (a null
id is not held out either); repeated rows each count and are each answered; texts are read
whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finquarry.llm.common import slices, stored, table, texts

PROFILE, LONGEST, MAX_LANGUAGES, UNKNOWN = 300, 3, 1000, "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
PLAIN = re.compile("[\x00-\u02af]*")  # no marks there
PLAIN_WORD = re.compile("[%s]+" % "".join(c for c in map(chr, range(0x2B0)) if unicodedata.category(c)[0] == "L"))
BLANK, BITS = ord(" ") + 1, 21
PIECE = 1 << 20  # characters counted at once
FLUSH = 1 << 21  # distinct n-grams that a task holds before it hands them on


def words_of(text: str) -> str:
    """The words of a text, lower-cased, with a blank before, between and after them; empty without any."""
    text = text.lower()
    words = (PLAIN_WORD if PLAIN.fullmatch(text) else WORD).findall(text)
    return f" {' '.join(words)} " if words else ""


def merged(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with their counts summed (each 1 where none are given)."""
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, len(codes))) if counts is None else np.add.reduceat(counts, first)


def ngrams(words: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of words between single blanks, in order, with their counts. None is a blank alone or goes across one."""
    found = []
    for at in range(0, len(words), PIECE):  # n-grams that begin in the piece
        c = np.frombuffer(words[at : at + PIECE + LONGEST - 1].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        n = min(PIECE, len(words) - at)
        letter = c != BLANK
        one, two, three = c[:n], c[1 : n + 1], c[2 : n + 2]
        pairs = one[: len(two)] << 2 * BITS | two << BITS
        found.append(merged(np.concatenate([(one << 2 * BITS)[letter[:n]], pairs, (pairs[: len(three)] | three)[letter[1 : len(three) + 1]]])))
    if len(found) == 1:
        return found[0]
    return merged(*map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def shown(code: int) -> str:
    """The n-gram of a code."""
    points = [code >> k * BITS & (1 << BITS) - 1 for k in (2, 1, 0)]
    return "".join(chr(p - 1) for p in points if p)


def code_of(gram: str) -> int:
    return sum(ord(c) + 1 << (2 - k) * BITS for k, c in enumerate(gram))


def held_out(doc_id: Column) -> Column:
    """One id in five by its hash; a null id is not."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def _language_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of the texts by language, with counts; summed over all texts of a task."""
    waiting: defaultdict[str, list[str]] = defaultdict(list)
    length: defaultdict[str, int] = defaultdict(int)
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def count(lang: str) -> None:
        found = ngrams("".join(waiting.pop(lang, [])).replace("  ", " "))  # one blank between texts as between words
        length.pop(lang, None)
        held[lang] = merged(*map(np.concatenate, zip(held[lang], found))) if lang in held else found

    def rows() -> Iterator[pa.RecordBatch]:
        for lang in [*waiting]:
            count(lang)
        for lang, (codes, counts) in held.items():
            yield pa.record_batch([pa.array([lang] * len(codes), pa.string()), pa.array([shown(c) for c in codes.tolist()], pa.string()), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])
        held.clear()

    for b in slices(batches):
        for lang, text in zip(b.column("lang").to_pylist(), texts(b.column("text"))):
            words = words_of(text)
            waiting[lang].append(words)
            length[lang] += len(words)
            if length[lang] > PIECE or sum(length.values()) > 4 * PIECE:
                count(max(length, key=length.get))
                if sum(len(codes) for codes, _ in held.values()) > FLUSH:
                    yield from rows()
    yield from rows()


def language_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """lang, gram, place (from 0) of the ``size`` first n-grams of each language."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = stored(known.mapInArrow(_language_ngrams, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-ngrams")
    kept = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).select("lang")
    ranked = counts.join(F.broadcast(kept), "lang", "left_semi")  # at most max_languages names
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return ranked.withColumn("place", place).filter(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """The languages' profiles: by n-gram its place in each, ``size`` places from any where it lacks."""

    def __init__(self, rows: list[tuple[str, str, int]], size: int = PROFILE):
        self.size, self.languages = size, sorted({lang for lang, _, _ in rows})
        number = {lang: i for i, lang in enumerate(self.languages)}
        self.codes = np.array(sorted({code_of(gram) for _, gram, _ in rows}), np.int64)
        self.places = np.full((len(self.codes), len(self.languages)), -1, np.int64)
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.codes, code_of(gram)), number[lang]] = place

    def profile(self, words: str) -> np.ndarray:
        """The first n-grams of a document: most frequent first, then by code."""
        codes, counts = ngrams(words)
        if len(codes) > self.size:
            often = counts >= np.partition(counts, -self.size)[-self.size]
            codes, counts = codes[often], counts[often]
        return codes[np.argsort(-counts, kind="stable")[: self.size]]

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language of a text, and 1 less the share of its distance from the largest possible one."""
        words = words_of(text)
        if not words or not self.languages:
            return UNKNOWN, 0.0
        mine = self.profile(words)
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        known = np.flatnonzero(self.codes[at] == mine)
        there = self.places[at[known]]
        near = np.where(there < 0, 0, self.size - np.abs(there - known[:, None]))
        most = self.size * len(mine)
        far = (most - near.sum(axis=0)).tolist()
        best = far.index(min(far))  # the first of equal ones has the smallest name
        return self.languages[best], 1 - far[best] / most


def languages(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    rows = [(r.lang, r.gram, r.place) for r in profiles.collect()]  # at most size rows for each of MAX_LANGUAGES languages
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(rows, size))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [shared.value.predict(t) for t in texts(b.column("text"))]
            yield pa.record_batch([b.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(predicted, "doc_id bigint, lang_pred string, score double")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_profiles(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return languages(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


OP13_SQL = """
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
), docs AS (
  SELECT row_number() OVER () AS d, doc_id, lang, text,
         doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0 AS held_out
  FROM documents, crc
), words AS (
  SELECT d, word, count(*) AS n FROM (SELECT d, unnest(regexp_extract_all(lower(text), '\\p{L}[\\p{L}\\p{M}]*')) AS word FROM docs) GROUP BY 1, 2
), pieces AS (
  SELECT word, (' ' || word || ' ')[i : i + g - 1] AS gram FROM (SELECT DISTINCT word FROM words), range(1, 4) s(g), unnest(range(1, length(word) + 4 - g)) u(i) WHERE g > 1 OR i BETWEEN 2 AND length(word) + 1
), grams AS (
  SELECT d, gram, sum(n) AS n FROM words JOIN pieces USING (word) GROUP BY 1, 2
), profiles AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place
  FROM (SELECT lang, gram, sum(n) AS n FROM grams JOIN docs USING (d) WHERE NOT held_out AND lang IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1, 2) QUALIFY place <= 300
), own AS (
  SELECT d, gram, row_number() OVER (PARTITION BY d ORDER BY n DESC, gram) AS place FROM grams QUALIFY place <= 300
), most AS (
  SELECT d, count(*) * 300 AS most FROM own GROUP BY d
), nearer AS (
  SELECT d, lang, sum(300 - abs(own.place - profiles.place)) AS less FROM own JOIN profiles USING (gram) GROUP BY 1, 2
), far AS (
  SELECT d, lang, most, most - coalesce(less, 0) AS far FROM most CROSS JOIN (SELECT DISTINCT lang FROM profiles) LEFT JOIN nearer USING (d, lang)
), best AS (
  SELECT d, most, arg_min(lang, (far, lang)) AS lang, min(far) AS far FROM far GROUP BY 1, 2
)
SELECT doc_id, held_out, coalesce(best.lang, 'und') AS lang_pred, coalesce(1 - far::DOUBLE / most, 0.0) AS score FROM docs LEFT JOIN best USING (d)
"""
