"""Generated daily calendar, both ends inclusive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, column ``full_date``.

    Row count = (end - start).days + 1, known before running; the range is
    split into several partitions so that larger calendars spread out.
    """
    n_days = (end - start).days + 1
    if n_days <= 0:
        return spark.range(0).select(F.lit(None).cast("date").alias("full_date")).limit(0)
    parts = max(1, min(64, n_days // 4096))
    return (spark.range(0, n_days, 1, parts)
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")))
