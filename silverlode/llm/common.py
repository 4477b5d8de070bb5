"""Small helpers of the text operators: scratch tables, sizes, and word rules."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.storage import scratch_path, write_and_read

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# White space between words; every other character belongs to a word.
SPACES = "[\\x20\\x09-\\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared scratch folder, so that later steps do not depend on lost executors."""
    spark = df.sparkSession
    # Only where no cluster folder is named (tests, single machine).
    beside = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    return write_and_read(df, scratch_path(spark, beside))


# Rows that Spark hands to a Python worker at a time: with some kilobytes of text each, a few megabytes.
ROWS_PER_BATCH = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application; Spark's own file server carries the archive.

    Batches of the session get a size that suits texts; smaller ones that are set stay.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= ROWS_PER_BATCH:
        spark.conf.set(_BATCH, ROWS_PER_BATCH)
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(), "silverlode.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(os.path.join(root, "silverlode")):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def packed_texts(docs: DataFrame) -> DataFrame:
    """The same rows with compressed texts (null stays null), for moves of whole documents between tasks."""
    at = docs.columns.index("text")
    fields = [T.StructField(f.name, T.BinaryType() if i == at else f.dataType) for i, f in enumerate(docs.schema)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = [None if t is None else compress(t.encode()) for t in batch.column(at).to_pylist()]
            yield _with_column(batch, at, pa.array(texts, pa.binary()))

    return docs.mapInArrow(pack, T.StructType(fields))


def unpacked_texts(packed: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of ``packed_texts`` as they were."""
    at = schema.names.index("text")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else zstandard.decompress(t).decode() for t in batch.column(at).to_pylist()]
            yield _with_column(batch, at, pa.array(texts, pa.string()))

    return packed.mapInArrow(unpack, schema)


def _with_column(batch: pa.RecordBatch, at: int, column: pa.Array) -> pa.RecordBatch:
    columns = list(batch.columns)
    columns[at] = column
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words of a text in lower case; no words for null or blank text."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SPACES)
    return F.filter(parts, lambda w: w != "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
