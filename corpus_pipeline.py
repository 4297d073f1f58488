"""The corpus pipeline: documents through five of the operators, each stage on what the one before it kept.

Defined cases, for every stage: an empty table gives no rows, with the same columns where the stage keeps
them; null texts count as empty, are clean, equal to one another and near to nothing; a null id is kept, and
stands after all others where the smallest counts; of repeated rows one stays from exact dedup on; texts are
read whole whatever their length; columns of any name pass unchanged, but for the text and its length where
a secret was replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import stored, table, unused
from finquarry.llm.exact_dedup import digest_of, exact_dedup
from finquarry.llm.near_dedup import near_duplicates, text_key
from finquarry.llm.packing import pack
from finquarry.llm.secret_ledger import redacted
from finquarry.llm.toxicity import kept_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled ones, rejects go. Repeated rows are each judged; without labels all stay."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def _keep(docs: DataFrame, wanted: DataFrame, mark) -> DataFrame:
    """The rows of ``docs`` with the id and mark of a row of ``wanted`` (doc_id, mark); one row for each."""
    name = unused(docs, "mark")
    wanted = wanted.select(F.col("doc_id").alias("_wanted_id"), F.col("mark").alias("_wanted_mark"))
    rows = docs.withColumn(name, mark)
    same = rows["doc_id"].cast("bigint").eqNullSafe(wanted["_wanted_id"]) & (rows[name] == wanted["_wanted_mark"])
    return rows.join(wanted, same, "left_semi").dropDuplicates(["doc_id", name]).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space the longest stays, of equally long ones the smallest id."""
    kept = exact_dedup(docs).filter("kept").select("doc_id", F.col("digest").alias("mark"))
    return _keep(docs, kept, digest_of(F.col("text")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8 or more) the smallest id stays; documents without words all do."""
    kept = near_duplicates(docs).filter("kept").select("doc_id", F.col("text_key").alias("mark"))
    return _keep(docs, kept, text_key(F.col("text")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are replaced by a mark, overlapping ones by one."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens; a document without text is its end token."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 0)


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("MinHash near-dedup", near), ("secret scans", secrets), ("packing", packing)]

#: Training, tokenisation and packing can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
