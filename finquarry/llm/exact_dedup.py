"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch of new documents is reduced to
one winner per digest, the winners that the index already holds are removed by a
sort-merge anti-join on the bucketed digests, and the rest is appended. Only 32-byte
digests are shuffled, never texts, and a digest with very many copies is reduced before
the shuffle.

Defined cases: a null text counts as empty, all empty texts are equal; of equal rows with
equal length the smallest id stays (null ids last), of repeated rows with the same id
exactly one; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import stored, table
from finquarry.session import run_folder

SPACE = " \t\n\x0b\x0c\r"
INDEX_SCHEMA = "digest binary, keep_id bigint, keep_row bigint, group_size bigint, batch string"


def without_space(text: Column) -> Column:
    """The text without ``[\\x20\\x09-\\x0D]``; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(without_space(text), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One slim row per document, written so that ``row`` stays the same: row, doc_id, digest, n_points."""
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        digest_of(F.col(text_col)).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n_points"),
    )
    return stored(slim, "digests")


class DigestIndex:
    """The digests of all documents admitted so far, in a table bucketed and sorted by digest.

    Its files lie in ``path``; a later session opens the same index by giving the same path and
    number of buckets. Without a path a fresh one is made below the shared folder.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or run_folder(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").saveAsTable(self.name)

    def known(self) -> DataFrame:
        return self.spark.table(self.name)

    def admit(self, batch: DataFrame) -> str:
        """Append the winners of ``batch`` (from ``digests``) that are new; returns the batch's name.

        The winner of a digest has the most code points, then the smallest id, then the first row.
        """
        name = uuid.uuid4().hex
        order = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), "doc_id", "row")
        # written first: else the optimizer moves the anti-join below the aggregate, to the rows of very large groups
        winners = stored(batch.groupBy("digest").agg(F.min(order).alias("w"), F.count("*").alias("group_size")), "winners")
        fresh = winners.join(self.known().select("digest").hint("merge"), "digest", "left_anti")
        self._append(fresh.select("digest", F.col("w.doc_id").alias("keep_id"), F.col("w.row").alias("keep_row"), "group_size", F.lit(name).alias("batch")))
        return name

    def answers(self) -> DataFrame:
        """The index as plain files: a join with many copies of one digest can then be split by AQE."""
        return self.spark.read.schema(INDEX_SCHEMA).parquet(self.path)


def classify(batch: DataFrame, index: DigestIndex) -> DataFrame:
    """Admit a batch and say for each of its rows which document stands for it.

    ``group_size`` counts the rows of the batch that first brought the digest.
    """
    name = index.admit(batch)
    return batch.join(index.answers(), "digest").select(
        "row", "doc_id", "digest", "keep_id", "group_size",
        ((F.col("batch") == name) & (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """Classify documents against an index, or a fresh one."""
    return classify(digests(docs, id_col, text_col), index or DigestIndex(docs.sparkSession))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
