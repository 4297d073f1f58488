"""Tables by key on plain files: versions, merges that rewrite only the files they change.

A version is a manifest: the data files it consists of, each with the range of keys that it
owns. Files are sorted by key and their ranges don't overlap, so the file of a key is found
by halving the list of lowest keys. A merge reads just key and content hash of the files
that own a source key, and writes anew just those in which a row changes; all others are
taken over into the next manifest. A version becomes visible with its ledger row, so readers
never see half of it and a job killed midway leaves nothing but files that no manifest names.

Manifests are metadata: one row per data file, read by the driver as any file listing is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finquarry.functions import exprs as X
from finquarry.operators.skew import position
from finquarry.session import exists, remove

FILE_ROWS = 1_000_000


class DuplicateKeys(ValueError):
    """A merge was given two rows of one key, or a row without a key."""


class KeyedTable:
    """Versions of a table with a unique key of one or more columns.

    ``file_rows`` bounds the rows of a data file. The column ``stamp`` holds when a row was last
    changed and doesn't count as content. NULL in a key is an error unless ``null_keys``, when
    it is a value like any other. One writer at a time: the manifest of a version that
    exists already is never overwritten, so of two writers one fails.
    """

    LEDGER = "version bigint, committed_at timestamp, mark bigint"

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], schema: T.StructType, file_rows: int = FILE_ROWS, stamp: str | None = None, null_keys: bool = False):
        self.spark, self.path, self.file_rows, self.stamp = spark, path.rstrip("/"), file_rows, stamp
        self.null_keys = null_keys
        self.keys = [key] if isinstance(key, str) else list(key)
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.values = [c for c in self.schema.names if c not in self.keys]
        self._stored = T.StructType([*self.schema.fields, T.StructField("_hash", T.StringType())])
        kind = ", ".join(f"`{k}`: {self.schema[k].dataType.simpleString()}" for k in self.keys)
        self._manifest = f"file string, rows bigint, low struct<{kind}>, high struct<{kind}>"

    # --- versions -----------------------------------------------------------------------------------
    def ledger(self) -> DataFrame:
        return self.spark.read.schema(self.LEDGER).parquet(f"{self.path}/_ledger")

    def latest(self) -> tuple[int, int | None]:
        """Number of the latest version and the greatest mark of any; (0, None) before the first."""
        if not exists(self.spark, f"{self.path}/_ledger"):
            return 0, None
        return tuple(self.ledger().agg(F.max("version"), F.max("mark")).first())

    def manifest(self, version: int) -> DataFrame:
        """One row per data file: name, rows, lowest and highest key."""
        return self.spark.read.schema(self._manifest).parquet(f"{self.path}/_manifest/{version}")

    def files(self, version: int) -> list[str]:
        return sorted(r.file for r in self.manifest(version).select("file").collect())

    def _read(self, files: Sequence[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in files]
        return self.spark.read.schema(self._stored).parquet(*paths) if paths else self.spark.createDataFrame([], self._stored)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.latest()[0] if version is None else version
        return self._read(self.files(version) if version else []).select(*self.schema.names)

    def version_as_of(self, at: str) -> int:
        row = self.ledger().filter(F.col("committed_at") <= F.lit(at).cast("timestamp")).agg(F.max_by("version", F.struct("committed_at", "version")).alias("v")).first()
        if row.v is None:
            raise ValueError(f"no version at {at}")
        return row.v

    def read_as_of(self, at: str) -> DataFrame:
        return self.read(self.version_as_of(at))

    def deleted_between(self, old: int, new: int) -> DataFrame:
        """Rows of the old version whose key is gone: what a recovery would bring back."""
        return self.read(old).join(self.read(new).select(*self.keys), self.keys, "left_anti")

    def clone(self, version: int, target: str, at: str) -> "KeyedTable":
        other = KeyedTable(self.spark, target, self.keys, self.schema, self.file_rows, self.stamp, self.null_keys)
        other._commit(self._read(self.files(version)), at, None)
        return other

    # --- writing ---------------------------------------------------------------------------------------
    def _key(self) -> Column:
        return F.struct(*self.keys)

    def _staged(self, df: DataFrame, at: str, *extra: str) -> tuple[DataFrame, str]:
        """Source rows with their content hash, written once, and the folder they are in; keys are checked."""
        columns = [F.lit(at).cast(f.dataType).alias(f.name) if f.name == self.stamp else F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        rows = df.select(*columns, *extra).withColumn("_hash", X.row_hash(*[c for c in self.values if c != self.stamp]))
        folder = f"{self.path}/_staged/{uuid.uuid4().hex[:12]}"
        rows.write.parquet(folder)
        rows = self.spark.read.schema(rows.schema).parquet(folder)
        missing = F.lit(False) if self.null_keys else F.array_contains(F.array(*[F.col(k).isNull() for k in self.keys]), True)
        bad = rows.groupBy(*self.keys).agg(F.count("*").alias("_n")).filter((F.col("_n") > 1) | missing).first()
        if bad:
            remove(self.spark, folder)
            raise DuplicateKeys(f"{bad['_n']} rows of key {[bad[k] for k in self.keys]}")
        return rows, folder

    def _write(self, df: DataFrame) -> DataFrame:
        """Write rows with ``_owner`` as sorted files, none with rows of two owners; their part of the manifest.

        Rows are dealt by owner and key ranges, so an owner that has grown is split.
        """
        folder = f"data/{uuid.uuid4().hex[:12]}"
        rows = df.select(*self._stored.names, "_owner").repartitionByRange("_owner", *self.keys).sortWithinPartitions("_owner", *self.keys)
        rows.write.partitionBy("_owner").option("maxRecordsPerFile", self.file_rows).parquet(f"{self.path}/{folder}")
        stored = self.spark.read.schema(self._stored).option("recursiveFileLookup", "true").parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.element_at(F.split("_metadata.file_path", f"/{folder}/"), -1))
        return stored.groupBy(name.alias("file")).agg(F.count("*").alias("rows"), F.min(self._key()).alias("low"), F.max(self._key()).alias("high"))

    def _publish(self, manifest: DataFrame, at: str, mark: int | None) -> int:
        version = self.latest()[0] + 1
        manifest.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/_manifest/{version}")
        row = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(at).cast("timestamp").alias("committed_at"), F.lit(mark).cast("bigint").alias("mark"))
        row.write.mode("append").parquet(f"{self.path}/_ledger")
        return version

    def _commit(self, hashed: DataFrame, at: str, mark: int | None) -> int:
        return self._publish(self._write(hashed.withColumn("_owner", F.lit(0))), at, mark)

    def commit(self, df: DataFrame, at: str, mark: int | None = None) -> int:
        """A new version with just these rows."""
        rows, folder = self._staged(df, at)
        version = self._commit(rows, at, mark)
        remove(self.spark, folder)
        return version

    def merge(self, source: DataFrame, at: str, newer: str | None = None, deleted: str | None = None, mark: int | None = None) -> int:
        """A new version in which source rows replace those of their key whose content differs, and new keys are added.

        With ``newer`` a known row gives way only to one that has more in that column. Where the
        boolean source column ``deleted`` is true the row goes. Two source rows of one key are an error.
        """
        version = self.latest()[0]
        rows, folder = self._staged(source, at, *([deleted] if deleted else []))
        files = [r.file for r in self.manifest(version).select("file", "low").orderBy("low").collect()] if version else []
        gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
        if not files:
            version = self._commit(rows.filter(~gone), at, mark)
            remove(self.spark, folder)
            return version
        lows = self.manifest(version).agg(F.sort_array(F.collect_list("low")).alias("lows")).scalar()
        owned = lambda df: df.withColumn("_lows", lows).withColumn("_owner", F.greatest(position(F.col("_lows"), self._key()) - 1, F.lit(0))).drop("_lows")
        rows = owned(rows)

        def beside(owners: list[int], columns: Sequence[str]) -> DataFrame:
            """Rows of the files of these owners next to the source rows that fall there, and whether the latter win."""
            known = owned(self._read([files[i] for i in owners]).select(*self.keys, *columns)).select(self._key().alias("_tk"), F.col("_owner").alias("_from"), F.struct(*columns).alias("_t"))
            fresh = rows.filter(F.col("_owner").isin(owners)).select(self._key().alias("_sk"), F.col("_owner").alias("_to"), F.struct(*columns, gone.alias("_gone")).alias("_s"))
            same = [F.col(f"_tk.{k}").eqNullSafe(F.col(f"_sk.{k}")) if self.null_keys else F.col(f"_tk.{k}") == F.col(f"_sk.{k}") for k in self.keys]
            differs = (F.col("_t._hash") != F.col("_s._hash")) | F.col("_s._gone")
            if newer:
                differs = differs & F.coalesce(F.col(f"_s.{newer}") > F.col(f"_t.{newer}"), F.col(f"_t.{newer}").isNull())
            wins = F.col("_s").isNotNull() & F.when(F.col("_t").isNull(), ~F.col("_s._gone")).otherwise(differs)
            both = known.join(fresh, same, "full").withColumns({"_owner": F.coalesce("_from", "_to"), "_wins": wins, "_key": F.coalesce("_tk", "_sk")})
            return both.select("_key.*", "_owner", "_wins", "_t", "_s")

        met = sorted(r[0] for r in rows.select("_owner").distinct().collect())
        touched = sorted(r[0] for r in beside(met, ["_hash", *([newer] if newer and newer not in self.keys else [])]).filter("_wins").select("_owner").distinct().collect()) if met else []
        kept = self.manifest(version).filter(~F.col("file").isin([files[i] for i in touched])) if touched else self.manifest(version)
        if touched:
            merged = beside(touched, [*self.values, "_hash"]).filter(F.when(F.col("_wins"), ~F.col("_s._gone")).otherwise(F.col("_t").isNotNull()))
            pick = [F.when(F.col("_wins"), F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) for c in [*self.values, "_hash"]]
            kept = kept.unionByName(self._write(merged.select(*self.keys, *pick, "_owner")))
        version = self._publish(kept, at, mark)
        remove(self.spark, folder)
        return version

    def vacuum(self, keep: int) -> list[str]:
        """Delete the data files that none of the last ``keep`` versions names; returns their names. Older versions can't be read any more."""
        latest = self.latest()[0]
        needed = {f for v in range(max(1, latest - keep + 1), latest + 1) for f in self.files(v)}
        known = {f for v in range(1, latest + 1) if exists(self.spark, f"{self.path}/_manifest/{v}") for f in self.files(v)}
        for v in range(1, latest - keep + 1):
            remove(self.spark, f"{self.path}/_manifest/{v}")
        for f in known - needed:
            remove(self.spark, f"{self.path}/{f}")
        return sorted(known - needed)
