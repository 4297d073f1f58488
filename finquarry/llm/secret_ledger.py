"""Secret scanning with an incremental ledger of content-addressed blobs.

Every historical version of every path is addressed by the SHA-256 of its content. The
ledger holds one row per (blob, rule version) that has been scanned, with its findings,
possibly none. A scan reads only contents whose pair is not in the ledger yet, one copy of
each, appends what it finds, and joins the findings back to all paths that ever held the
blob. New rules get a new rule version, so that old blobs are scanned again once.

Defined cases: null content is empty; repeated rows each get their findings; ids and
versions may be null; other columns are carried through by ``redacted`` and not read here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.llm.common import joined_spans, slices, table, texts, unused
from finquarry.llm.tokens import working_for
from finquarry.session import run_folder

BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "private_key", "web_token", "host_token", "chat_token", "url_login"]
RULE_VERSION = "2.1"

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs: a run can only start where the one before it ended
KEY_LINE = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_BREAK = r"(?:\s|\\[nr])++"  # also as written in a quoted string
KEY_BODY = re.compile(rf"(?:{_BREAK}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+)*+(?:{_BREAK}[A-Za-z0-9+/=]{{16,}}+)*+(?:(?:\r?\n|\\n)[A-Za-z0-9+/=]++(?=[\x20\t]*+(?:[\r\n\\]|\Z)))*+")
WEB_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
HOST_TOKEN = re.compile(r"gh[opsur]_[A-Za-z0-9]{36,}")
CHAT_TOKEN = re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")
URL_LOGIN = re.compile(r"://([^\s:/@]++:[^\s:/@]++)@")

SPAN = "struct<kind:string,start:bigint,end:bigint>"
LEDGER = f"blob binary, rule_version string, spans array<{SPAN}>"


def _private_keys(text: str) -> Iterator[tuple[int, int]]:
    """From a BEGIN line to the END line that follows it, or without one to the end of the key's lines."""
    lines = list(KEY_LINE.finditer(text))
    for m, after in zip(lines, [*lines[1:], None]):
        if m[1] == "BEGIN":
            yield m.start(), after.end() if after and after[1] == "END" else KEY_BODY.match(text, m.end()).end()


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive. A cheap test of what a rule needs comes before it."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [("private_key", a, b) for a, b in _private_keys(text)]
    if "eyJ" in text:
        out += [("web_token", m.start(), m.end()) for m in WEB_TOKEN.finditer(text)]
    if "gh" in text and "_" in text:
        out += [("host_token", m.start(), m.end()) for m in HOST_TOKEN.finditer(text)]
    if "xox" in text:
        out += [("chat_token", m.start(), m.end()) for m in CHAT_TOKEN.finditer(text)]
    if "://" in text:
        out += [("url_login", m.start(1), m.end(1)) for m in URL_LOGIN.finditer(text)]
    return out


def _scan(rule_version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("blob", pa.binary()), ("rule_version", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])
        working_for("secrets")
        for b in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in find_secrets(t)] for t in texts(b.column("content"))]
            yield pa.record_batch([b.column("blob").cast(pa.binary()), pa.array([rule_version] * b.num_rows, pa.string()), pa.array(found, schema.field("spans").type)], schema=schema)

    return run


def blob_of(content: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256))


class BlobLedger:
    """Scanned (blob, rule version) pairs with their findings, as Parquet files that are only appended to.

    One scan at a time: a pair is in it once.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or run_folder(spark, "ledger")

    def scanned(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.folder)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], LEDGER)

    def scan(self, versions: DataFrame, content: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
        """Scan the contents that are new to the ledger; returns the ledger for this rule version."""
        seen = self.scanned().filter(F.col("rule_version") == rule_version).select("blob")
        contents = versions.select(blob_of(F.col(content)).alias("blob"), F.col(content).alias("content"))
        once = contents.groupBy("blob").agg(F.first("content").alias("content"))
        # as an outer join: an anti-join would be moved below the aggregate, to the rows of very large groups
        unseen = once.join(seen.select(F.col("blob").alias("_seen")), F.col("blob") == F.col("_seen"), "left").filter("_seen is null").drop("_seen")
        unseen.mapInArrow(_scan(rule_version), LEDGER).write.mode("append").parquet(self.folder)
        return self.scanned().filter(F.col("rule_version") == rule_version)


def findings(versions: DataFrame, keys: list[str], content: str = "text", ledger: BlobLedger | None = None) -> DataFrame:
    """All paths and versions (``keys``) with their ``blob`` and the ``spans`` found in it; where a key has such a name, with an underscore before it."""
    ledger = ledger or BlobLedger(versions.sparkSession)
    paths = versions.select(*keys)
    blob, spans, scanned = unused(paths, "blob"), unused(paths, "spans"), unused(paths, "scanned_blob")
    found = ledger.scan(versions, content).select(F.col("blob").alias(scanned), F.col("spans").alias(spans))
    return versions.select(*keys, blob_of(F.col(content)).alias(blob)).join(found, F.col(blob) == F.col(scanned)).drop(scanned)


def _without(text: Column, spans: Column) -> Column:
    """The text with each span replaced, overlapping spans by one mark."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["a"] - acc["at"], F.lit(0)).cast("int"))
        more = F.when(s["a"] >= acc["at"], F.concat(acc["out"], gap, F.lit("[SECRET]"))).otherwise(acc["out"])
        return F.struct(more.alias("out"), F.greatest(acc["at"], s["b"]).alias("at"))

    return F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def redacted(docs: DataFrame, content: str = "text", length: str = "n_chars", ledger: BlobLedger | None = None) -> DataFrame:
    """The same rows and columns with ``[SECRET]`` for every finding; ``length``, if there, follows the new text.

    Texts without a finding pass unchanged, null included.
    """
    ledger = ledger or BlobLedger(docs.sparkSession)
    blob, spans, scanned = unused(docs, "blob"), unused(docs, "spans"), unused(docs, "scanned_blob")
    found = ledger.scan(docs, content).filter(F.size("spans") > 0).select(F.col("blob").alias(scanned), F.col("spans").alias(spans))
    rows = docs.withColumn(blob, blob_of(F.col(content))).join(found, F.col(blob) == F.col(scanned), "left")
    rows = rows.withColumn(content, F.when(F.col(spans).isNotNull(), _without(F.col(content), F.col(spans))).otherwise(F.col(content)))
    if length in docs.columns:
        rows = rows.withColumn(length, F.when(F.col(spans).isNotNull(), F.length(content).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return rows.select(*docs.columns)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = findings(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined_spans(base, BASE_KINDS), 256).alias("base_sha256"), joined_spans(F.col("spans"), KINDS).alias("spans"))
