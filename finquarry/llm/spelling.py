"""Groups of spelling variants: words of a corpus one edit apart, found in a reduced alphabet.

Each letter is mapped to one of a few symbols, so a word becomes a reduced word. Words one
edit apart (a code point inserted, deleted or replaced) have reduced words at most one edit
apart. So the neighbourhood of a word's reduced word is generated (itself, every deletion,
every replacement) and joined to the reduced vocabulary, and what meets is verified on the
words themselves. Insertions are deletions seen from the other word, and a replacement is
generated from the side of its smaller symbol only, so that a pair meets once. The number
of symbols grows with the sixth root of the vocabulary, and letters are dealt out so that
symbols are about equally frequent; both only bound how many words meet by chance.

A word's form is its near word of largest count, if that is at least ``ratio`` times its own.
Counts at least double on the way, so a word's last form is reached by six rounds of pointer
doubling at the very most; they end when no pointer moves.

Everything is Spark's own: words are counted per task before they are shuffled, the joins
are on reduced words and words, no group is gathered, and what is used again is written.

Defined cases: null and empty texts have no words; a null id counts as an empty one; texts
are read whole; repeated rows count each; ties between forms go to the smaller word in
code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import stored, table, unused

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
CROWD = 50  # words of the vocabulary for each reduced word of six letters
ROUNDS = 6  # counts double on each step, so 2^6 steps pass any count


def lowered(c: Column) -> Column:
    """Only A-Z become small."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def damaged(doc_id: Column, word: Column) -> Column:
    """The word without one of its code points, for one in 97 of (document, word) by their hash."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word), "UTF-8"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, changed=None) -> DataFrame:
    """word, n: the words of at least so many letters that occur often enough. ``changed(id, word)`` may rewrite each occurrence."""
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"([{LETTERS}]+)"))).alias("run"))
    word = lowered(F.col("run"))
    words = runs.select(F.col("doc_id"), word.alias("word"))
    if changed:
        words = words.select(changed(F.col("doc_id"), F.col("word")).alias("word"))
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def symbols_for(words: int) -> int:
    """The least number of symbols, from 4 on, whose six-letter words hold so many words ``CROWD`` at a time."""
    symbols = 4
    while symbols**6 * CROWD < words:
        symbols += 1
    return symbols


def symbol_map(words: DataFrame, symbols: int) -> dict[str, str]:
    """The symbol of each letter: frequent letters first, each to the symbol that has least so far."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    load, out = [0] * symbols, {}
    for r in sorted(letters.collect(), key=lambda r: (-r["count"], r.letter)):  # as many rows as there are letters
        least = load.index(min(load))
        load[least] += r["count"]
        out[r.letter] = chr(48 + least)
    return out


def reduced(word: Column, symbol: dict[str, str]) -> Column:
    return F.translate(word, "".join(symbol), "".join(symbol.values()))


def neighbourhood(r: Column, symbols: int) -> Column:
    """Deletions of a reduced word, and replacements by a larger symbol; together with those of all other words, every edit."""
    size = F.length(r)
    places = F.sequence(F.lit(1), size)

    def without(i: Column) -> Column:
        return F.concat(F.substring(r, F.lit(1), i - 1), F.substring(r, i + 1, size))

    def replaced(i: Column) -> Column:
        above = F.filter(F.array(*[F.lit(chr(48 + s)) for s in range(symbols)]), lambda s: s > F.substring(r, i, F.lit(1)))
        return F.transform(above, lambda s: F.concat(F.substring(r, F.lit(1), i - 1), s, F.substring(r, i + 1, size)))

    return F.concat(F.array_distinct(F.transform(places, without)), F.flatten(F.transform(places, replaced)))


def near_words(words: DataFrame) -> DataFrame:
    """Every unordered pair of words one edit apart, once: a, n_a, b, n_b."""
    symbols = symbols_for(words.count())
    short = words.select("word", "n", reduced(F.col("word"), symbol_map(words, symbols)).alias("r"))
    meant = lambda keys, itself: F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(itself).alias("itself")))
    spread = short.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")  # few rows become many
    around = spread.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.inline(F.concat(meant(F.array("r"), True), meant(neighbourhood(F.col("r"), symbols), False))))
    met = around.join(short.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("r").alias("key")), "key")
    once = ~F.col("itself") | (F.col("a") < F.col("b"))  # words with the same reduced word meet from both sides
    return met.filter(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root of each word that has a form (word, form), by pointer doubling."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(ROUNDS):
        on = at.select(F.col("word").alias("_via"), F.col("root").alias("_next"))
        moved = stored(at.join(on, F.col("root") == F.col("_via"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    return at


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n) of distinct words."""
    words = stored(words.select("word", "n"), "spelling-words")
    pairs = near_words(words)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")))).alias("p"))
    best = both.groupBy("p.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("p.n")).alias("less"), F.col("p.near").alias("near"))).alias("best"))
    joined = words.join(best.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = stored(
        joined.select("word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n")),
        "spelling-forms",
    )
    roots = last_forms(found.filter("form is not null")).withColumnRenamed("word", "_word")
    return found.join(roots, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_roots(docs: DataFrame, variants: DataFrame, word_col: str = "word") -> DataFrame:
    """Rows with a ``root`` column: the last form of their word, or the word itself where it has none."""
    key, name = unused(docs, "_word"), unused(docs, "root")
    known = variants.filter("form is not null").select(F.col("word").alias(key), F.col("root").alias(name))
    return docs.join(known, F.col(word_col) == F.col(key), "left").select(*docs.columns, F.coalesce(name, word_col).alias(name))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(table(spark, sf_dir, "documents"), changed=damaged))


#: Words, hashes by the table of the CRC's reversed polynomial 0xEDB88320, deletions that meet, forms, and their ends by recursion.
OP12_SQL = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c) - 64] END)) AS b FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3
), cuts AS (
  SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM words, unnest(range(length(word))) u(i)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(near, (-n, near)) AS near FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN near END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS here, 0 AS steps FROM forms
  UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN forms f ON f.word = walk.here WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY word) USING (word)
"""
