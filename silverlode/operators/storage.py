"""Tables on a shared file system."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Stored tables hold many digests as hexadecimal text, which this codec halves and Spark's default does not.
COMPRESSION = "zstd"


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; meant for folders of few entries."""
    fs, jpath = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(jpath)]


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, jpath = _file_system(spark, path)
    return fs.getContentSummary(jpath).getLength()


def scratch_path(spark: SparkSession, beside: str) -> str:
    """A new path for an intermediate table that every executor can reach.

    It lies in the checkpoint folder of the cluster; where none is named, next
    to the table it serves.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or f"{beside}.scratch"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: what follows reads files, also after an executor is lost."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_note(spark: SparkSession, folder: str, note: dict, keep: int = 2) -> None:
    """A few values that take the place of the folder's last ones in a single step.

    They are written whole and then renamed to a new number; readers take the highest number, and older ones are
    deleted afterwards, so there is no moment without a note.
    """
    numbers = _notes(spark, folder)
    number = max(numbers, default=0) + 1
    fs, draft = _file_system(spark, f"{folder}/draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(json.dumps(note).encode())
    out.close()
    target = f"{folder}/note-{number:012d}"
    if not fs.rename(draft, _file_system(spark, target)[1]):
        raise OSError(f"{target} could not be written")
    for old in sorted(numbers)[: len(numbers) - keep + 1]:
        delete_path(spark, f"{folder}/note-{old:012d}")


def read_note(spark: SparkSession, folder: str) -> dict | None:
    """The newest values of ``write_note``; None where there are none."""
    numbers = _notes(spark, folder)
    if not numbers:
        return None
    fs, path = _file_system(spark, f"{folder}/note-{max(numbers):012d}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _notes(spark: SparkSession, folder: str) -> list[int]:
    if not path_exists(spark, folder):
        return []
    return [int(n.removeprefix("note-")) for n in child_names(spark, folder) if n.startswith("note-")]
