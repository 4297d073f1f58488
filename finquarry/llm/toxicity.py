"""Toxicity by classifier chains.

Categories are predicted one after another: low quality, toxic, and severe (toxic with at
least as much of the learned toxic vocabulary as half of the toxic training documents).
Each is a linear model on word features and on the probabilities of the categories before
it. In training these come from out-of-fold predictions, so that a later model sees earlier
ones as uncertain as they will be on new documents. A document is rejected when its
probability of being toxic reaches ``REJECT``.

Features are words of letters, lower-cased, and the beginnings of longer ones; the ``FEATURES`` words whose document
frequencies differ most between the classes of a category are used, as log(1 + count).
The model is fitted, and its words are chosen, on at most ``MAX_TRAIN`` labelled documents, those with
the smallest hash of the id (a documented bound: more do not change a linear model of this
size); frequencies are counted in Spark, and only the selected features of these documents
come to the driver. All of them take part, but near copies, whose least and greatest
shingle hashes are the same, share the weight of one document, or the rare words of a text with
many copies would look like signs of its class. Scoring reads all documents whole.

Defined cases: null text is empty and clean; documents without a label are scored like all
others; repeated labels of an id all count, null labels do not; without labels, or with one
class only, a category has its base rate (0 without any) as probability; ids may be null;
repeated rows are each scored; texts of any length are read whole; of words that tell
classes apart equally well the smaller one is used; an empty table gives no rows; other
columns are carried or not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finquarry.llm.common import slices, stored, table, texts
from finquarry.llm.near_dedup import shingles
from finquarry.llm.tokens import working_for

CATEGORIES = ["low_quality", "toxic", "severe"]
MAX_TRAIN, FEATURES, MIN_DOCS, FOLDS, RIDGE, REJECT = 10_000, 200, 5, 3, 5.0, 0.6
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The words, and the first letters of longer ones, so that other forms of a word count too."""
    words = WORD.findall(text.lower())
    return words + [w[:n] + "*" for n in STEMS for w in words if len(w) > n]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Logistic regression with a ridge, fitted by Newton steps; both classes weigh the same."""

    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> "Linear":
        """``share`` is the weight of each row; both classes weigh the same in all."""
        n, k = x.shape
        rate = float((y * share).sum() / share.sum()) if n else 0.0
        if n == 0 or y.min() == y.max():
            return cls(np.zeros(k), float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
        weight = share * np.where(y > 0, 0.5 / rate, 0.5 / (1 - rate))
        x1 = np.column_stack([x, np.ones(n)])
        w, penalty = np.zeros(k + 1), np.append(np.full(k, ridge), 1e-6)
        for _ in range(rounds):
            p = _sigmoid(x1 @ w)
            curve = weight * np.maximum(p * (1 - p), 1e-4)
            step = np.linalg.solve((x1 * curve[:, None]).T @ x1 + np.diag(penalty), x1.T @ (weight * (y - p)) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(w[:-1], float(w[-1]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(x @ self.weights + self.bias)


def matrix(found: list[dict[int, int]], width: int) -> np.ndarray:
    """log(1 + count), one row per document."""
    x = np.zeros((len(found), width))
    for row, f in zip(x, found):
        for c, n in f.items():
            row[c] = np.log1p(n)
    return x


@dataclass
class Chain:
    """The vocabulary and one linear model per category, in order."""

    vocabulary: dict[str, int]
    models: list[Linear]

    def features(self, text: str) -> dict[int, int]:
        v = self.vocabulary
        return Counter(v[w] for w in words_of(text) if w in v)

    @classmethod
    def fit(cls, vocabulary: list[str], found: list[dict[int, int]], low_quality: np.ndarray, toxic: np.ndarray, fold: np.ndarray, share: np.ndarray) -> "Chain":
        x, width, models = matrix(found, len(vocabulary)), len(vocabulary), []
        for category in CATEGORIES:
            y = {"low_quality": low_quality, "toxic": toxic}.get(category)
            if category == "severe":  # by the learned toxic words of a document
                load = x[:, :width] @ np.maximum(models[-1].weights[:width], 0)
                at = np.median(load[toxic > 0]) if (toxic > 0).any() else np.inf
                y = ((toxic > 0) & (load >= at)).astype(float)
            models.append(Linear.fit(x, y, share))
            out = np.zeros(len(found))
            for k in range(FOLDS):  # out-of-fold: what later models are trained on
                here = fold == k
                if here.any():
                    out[here] = Linear.fit(x[~here], y[~here], share[~here]).predict(x[here])
            x = np.column_stack([x, out])
        return cls({w: i for i, w in enumerate(vocabulary)}, models)

    def predict(self, batch: list[str]) -> np.ndarray:
        """Probabilities of all categories, one row per text."""
        x = matrix([self.features(t) for t in batch], len(self.vocabulary))
        for m in self.models:
            x = np.column_stack([x, m.predict(x)])
        return x[:, len(self.vocabulary) :]


ONE = 1 << 20  # the weight of a document, whole numbers so that sums don't depend on their order


@F.pandas_udf(T.StringType())
def _copy_key(text):
    """The least and the greatest hash of a text's five-word shingles: nearly always the same for near copies; null without words."""
    import pandas as pd

    working_for("toxicity")
    found = (shingles((t or "").encode(), 5)[0] for t in text)
    return pd.Series([f"{f[0]}-{f[-1]}" if len(f) else None for f in found], dtype=object)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of the documents with each word, by class; summed per task."""
    held: Counter = Counter()
    names, kinds = ["word", "low_quality", "toxic", "n"], [pa.string(), pa.int32(), pa.int32(), pa.int64()]

    def rows():
        columns = [*zip(*held)] if held else [[], [], []]
        out = pa.record_batch([pa.array(c, k) for c, k in zip([*columns, list(held.values())], kinds)], names=names)
        held.clear()
        return out

    working_for("toxicity")
    for b in slices(batches):
        for t, q, x, share in zip(texts(b.column("text")), *(b.column(c).to_pylist() for c in ("low_quality", "toxic", "share"))):
            for w in {"", *words_of(t)}:  # "" counts the documents
                held[w, q, x] += share
            if len(held) > 500_000:
                yield rows()
    yield rows()


def _selected(counts: DataFrame) -> list[str]:
    """The words whose shares of documents differ most between classes, by standard errors."""
    n = F.col("n") / ONE
    by_word = counts.groupBy("word").agg(
        F.sum("n").alias("docs"), F.sum(F.when(F.col("toxic") == 1, n).otherwise(0)).alias("t"), F.sum(F.when(F.col("low_quality") == 1, n).otherwise(0)).alias("q")
    )
    total = by_word.filter("word = ''").first()
    if total is None:
        return []

    def score(hits: str, of: int) -> Column:
        """Deviation of the class's share among documents with the word from its share among all, in standard errors."""
        rate = of / max(total["docs"], 1)
        return F.abs(F.col(hits) - F.col("docs") * rate) / F.sqrt(F.col("docs") * rate * (1 - rate) + 0.25)

    ranked = by_word.filter((F.col("word") != "") & (F.col("docs") >= MIN_DOCS)).select("word", F.greatest(score("t", total["t"]), score("q", total["q"]) / 4).alias("score"))
    return [r["word"] for r in ranked.orderBy(F.desc("score"), "word").limit(FEATURES).collect()]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> Chain:
    spark = docs.sparkSession
    known = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("bigint").alias("_id"), F.coalesce(1 - F.col("quality"), F.lit(0)).cast("int").alias("low_quality"), F.col("toxic").cast("int").alias("toxic"))
    h = F.xxhash64(F.lit(17), "_id")
    sample = known.withColumn("h", h).orderBy("h", "_id", "toxic", "low_quality").limit(max_train)
    labelled = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # at most max_train rows
    labelled = stored(labelled.select("h", "doc_id", "low_quality", "toxic", "text", _copy_key("text").alias("copy")), "labelled")
    copies = labelled.filter("copy is not null").groupBy(F.col("copy").alias("_copy")).agg(F.round(F.lit(ONE) / F.count("*")).cast("bigint").alias("share"))
    labelled = stored(labelled.join(F.broadcast(copies), F.col("copy") == F.col("_copy"), "left").withColumn("share", F.coalesce("share", F.lit(ONE).cast("bigint"))).drop("_copy"), "labelled")  # at most max_train rows
    counts = labelled.select("text", "low_quality", "toxic", "share").mapInArrow(_words, "word string, low_quality int, toxic int, n bigint")
    vocabulary = _selected(counts)
    at = {w: i for i, w in enumerate(vocabulary)}
    shared = spark.sparkContext.broadcast(at)  # at most FEATURES words

    def features(batches):
        for b in batches:
            found = [Counter(shared.value[w] for w in words_of(t) if w in shared.value) for t in texts(b.column("text"))]
            columns = [b.column("h"), b.column("doc_id"), b.column("low_quality"), b.column("toxic"), b.column("share"), pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))]
            yield pa.record_batch(columns, names=["h", "doc_id", "low_quality", "toxic", "share", "cols", "counts"])

    rows = labelled.mapInArrow(features, "h bigint, doc_id bigint, low_quality int, toxic int, share bigint, cols array<int>, counts array<int>").toPandas()
    rows = rows.sort_values(["h", "doc_id", "toxic", "low_quality"], kind="stable")
    found = [dict(zip(c, n)) for c, n in zip(rows["cols"], rows["counts"])]
    fold = np.abs(rows["h"].to_numpy(np.int64)) % FOLDS
    return Chain.fit(vocabulary, found, rows["low_quality"].to_numpy(float), rows["toxic"].to_numpy(float), fold, rows["share"].to_numpy(float) / ONE)


def probabilities(docs: DataFrame, chain: Chain, text_col: str = "text") -> Column:
    """A struct with the probability of each category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES words and weights
    kind = T.StructType([T.StructField(c, T.DoubleType()) for c in CATEGORIES])

    @F.pandas_udf(kind)
    def score(text):
        import pandas as pd

        working_for("toxicity")
        return pd.DataFrame(shared.value.predict([t or "" for t in text]), columns=CATEGORIES)

    return score(F.col(text_col))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    p = probabilities(docs, train(docs, labels, id_col, text_col), text_col)
    return docs.filter(p["toxic"] < reject)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the probability of each category, and whether the document is rejected."""
    docs = table(spark, sf_dir, "documents")
    p = probabilities(docs, train(docs, table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", p.alias("p"))
    return scored.select("doc_id", *[F.round(f"p.{c}", 9).alias(f"p_{c}") for c in CATEGORIES], (F.col("p.toxic") >= REJECT).alias("rejected"))
