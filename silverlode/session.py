"""Session settings the tables are designed for."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and timestamps mean the same on every machine.
    "spark.sql.session.timeZone": "UTC",
    # Split a hot key of a join at run time. No join with a hot key shares its
    # exchange with a later step, so nothing has to be forced.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split and fill up the files of a month by size.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def warn_unless_configured(spark: SparkSession) -> None:
    """Say which settings are missing; without them a hot key of a join stays in one task."""
    off = [name for name, value in SETTINGS.items() if spark.conf.get(name) != value]
    if off:
        warnings.warn(f"settings the tables are designed for are off: {', '.join(off)}", stacklevel=3)
