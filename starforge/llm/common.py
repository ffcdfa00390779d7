"""Helpers shared by the corpus operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.session import scratch_path, shuffles_dropped
from starforge.sinks.files import remove_folder

# A table is sent to every executor only when it was counted and has at most
# this many narrow rows (two long columns, about 6 MB as the hash table that the
# driver builds and keeps until it collects garbage); larger tables are joined by a
# shuffle, with the same rows.
BROADCAST_ROWS = 100_000
FEW_ROWS = 1_000_000        # so many narrow rows at most are dealt to few tasks


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage with a table that survives the loss of executors; the shuffle files that
    it was made from are dropped when it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=codec)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Send at most ``rows`` rows at once to Python, for jobs on whole texts that end inside; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*staged: DataFrame | None) -> None:
    """Remove the folders of staged tables that nothing will read any more.

    Only for tables whose every reader has been written to a staged table itself.
    """
    for df in staged:
        if df is not None:
            remove_folder(df.sparkSession, df.staged_path)


def checked_small(staged: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a narrow staged table only after counting it."""
    return F.broadcast(staged) if staged.count() <= max_rows else staged


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """Deal a result of at most ``rows`` (counted) narrow rows to one task per 50,000 rows, 8 at least.

    More than ``FEW_ROWS`` stay as they are dealt.
    """
    return df.coalesce(max(8, -(-rows // 50_000))) if rows <= FEW_ROWS else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_remainder(col, divisor: int):
    """crc32 of the decimal text of an id, modulo ``divisor`` (held-out folds)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(divisor)
