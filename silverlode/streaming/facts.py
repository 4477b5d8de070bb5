"""Facts fed from raw files as they arrive.

The query keeps track of the files it has read. All that have arrived since are
one batch, whatever their number, as rows of one run are compared with one mark:
in several batches the first would raise the mark above rows of the next. The
batch is cleaned, reduced to what is newer than the fact, and merged by key. One
that is delivered again after a failure is merged again to the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from silverlode.operators.merge import MergeTable
from silverlode.plans.refresh import FACT_SOURCES, load_changes
from silverlode.sources.raw import raw_schema


def stream_fact(
    spark: SparkSession,
    name: str,
    path: str,
    table: MergeTable,
    checkpoint: str,
    stored: Callable[[], Mapping[str, DataFrame]] = dict,
    as_of: dt.date | None = None,
) -> StreamingQuery:
    """Read all raw files that have not been read yet, then stop.

    ``stored`` is asked for the joined tables when the batch is merged, so they
    are as fresh as the batch.
    """
    source = FACT_SOURCES[name]

    def merge(batch: DataFrame, _: int) -> None:
        def raw(wanted: str) -> DataFrame:
            if wanted != source:
                raise KeyError(f"{name} needs {wanted}, which is neither stored nor streamed")
            return batch

        load_changes(batch.sparkSession, name, table, raw, as_of, stored())

    files = spark.readStream.schema(raw_schema(source)).parquet(path)
    return (
        files.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
