"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finquarry.session import remove, run_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh path of the shared folder and read back: cuts the lineage, survives lost executors."""
    path = run_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    remove(df.sparkSession, df.stored_path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that a task holds the Python objects of few texts at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as bytes; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts of an Arrow string column; null is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, so that extra columns cannot clash."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def joined_spans(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of an array of structs, by start, then by the order of ``kinds``, comma-joined."""
    rank = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(rank, s["kind"]).alias("b"), s["end"].alias("c"), s["kind"].alias("d")))
    return F.concat_ws(",", F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))))
