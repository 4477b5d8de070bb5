"""Tables that are replaced as a whole without disturbing those who read them.

Each version lies in a folder of its own, and a note beside the versions names the one that counts. A
reader keeps the version it began with; one that dies while it is written was never named.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from silverlode.operators.storage import child_names, delete_path, read_note, write_note

# Versions that stay, with the current one, for readers that have begun.
KEPT = 2
_VERSION = "version-"


def replace_table(df: DataFrame, path: str, keep: int = KEPT) -> DataFrame:
    """Write the rows as the new version of the table and read them back; versions beyond ``keep`` are deleted."""
    spark = df.sparkSession
    before = read_note(spark, path) or {"versions": []}
    name = f"{_VERSION}{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    versions = [*before["versions"], name][-keep:]
    write_note(spark, path, {"versions": versions, "columns": df.schema.jsonValue()})
    for old in child_names(spark, path):
        # Also what writers left that died.
        if old.startswith(_VERSION) and old not in versions:
            delete_path(spark, f"{path}/{old}")
    return read_current(spark, path)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The version that counts now."""
    note = read_note(spark, path)
    if note is None:
        raise FileNotFoundError(f"no table has been written to {path}")
    return spark.read.schema(T.StructType.fromJson(note["columns"])).parquet(f"{path}/{note['versions'][-1]}")
