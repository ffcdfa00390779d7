"""Incremental loads with Structured Streaming.

The warehouse has no event-time streams; its incremental need is "append the
business keys not loaded yet" (D9).  ``incremental_append`` runs that as a
file-source stream: each new file in a landing folder is read once (the
stream's checkpoint records which files were processed, so a restarted or
failed job neither skips nor repeats a file), and every micro-batch is
de-duplicated on the business key and anti-joined with the table before
being appended.  ``trigger(availableNow=True)`` processes what has landed
and stops, which suits scheduled batch loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starforge.operators.keys import keep_first
from starforge.sinks import table_exists
from starforge.sinks.merge import append_unseen_months


def append_unseen(batch: DataFrame, table_path: str, business_key: str, fmt: str = "parquet",
                  quarantine_path: str | None = None):
    """One micro-batch: keep the first row per key, drop keys already in the
    table, append the rest.  Rows with a NULL key or beyond the first of their
    key go to ``quarantine_path`` (by default ``<table_path>_quarantine``) with
    a reject_reason.  They are written before the table, so a batch that is
    repeated after a failure may list a reject twice but loses none."""
    spark = batch.sparkSession
    first, rejects = keep_first(batch, business_key, batch.columns, f"duplicate_{business_key}")
    rejects.write.mode("append").format(fmt).save(quarantine_path or f"{table_path.rstrip('/')}_quarantine")
    if table_exists(spark, table_path):
        existing = spark.read.format(fmt).load(table_path).select(business_key)
        first = first.join(existing, business_key, "left_anti")
    first.write.mode("append").format(fmt).save(table_path)


def incremental_append(spark: SparkSession, landing_dir: str, schema: StructType,
                       table_path: str, business_key: str, checkpoint_dir: str,
                       source_format: str = "parquet", options: dict | None = None,
                       max_files_per_trigger: int | None = None, at: str | None = None):
    """Start the stream and return the StreamingQuery (call
    ``awaitTermination()``; with availableNow it stops when caught up).

    ``at`` (a time column that belongs to the key) keeps the table partitioned by its month,
    and every batch compares its keys with those of its own months only
    (``sinks.merge.append_unseen_months``); without it, with all keys of the table.

    ``checkpoint_dir`` must be on shared storage (e.g. under
    spark.checkpoint.dir) so that the progress survives a lost driver.
    """
    reader = spark.readStream.format(source_format).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_dir)

    def load(batch: DataFrame, _epoch: int) -> None:
        if at is None:
            append_unseen(batch, table_path, business_key)
        else:
            append_unseen_months(batch, table_path, business_key, at, f"{table_path.rstrip('/')}_quarantine")
    return (stream.writeStream
            .foreachBatch(load)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start())
