"""Sinks (K1-K9, D8, D9): Parquet / CSV tables, BOM CSV export, quarantine,
SCD type 1 upsert and incremental append.

Every writer is a distributed write: one file per task, no funnel through one
task or the driver.  Overwrites of a table that is also read by the same job
go through a staged copy in the shared checkpoint folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.operators.keys import extra_rows, first_rows, keep_first
from starforge.session import scratch_path, shuffles_dropped
from starforge.sinks.files import has_data

BOM = "﻿"


def csv_writer(w):
    """CSV options shared by every CSV sink: header, doubled-quote escaping, spaces
    kept, microsecond time stamps (the default keeps only milliseconds)."""
    return (w.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple = ()) -> str:
    """K1 / K2 / K7: write a table (parquet by default, csv with header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        csv_writer(w).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_csv_bom(df: DataFrame, path: str) -> str:
    """K3: CSV with header whose files start with the UTF-8 byte order mark.

    The mark is put in front of the first column name, so every part file's
    header line (and thus every file) begins with EF BB BF.
    """
    first = df.columns[0]
    out = df.withColumnRenamed(first, BOM + first)
    csv_writer(out.write.mode("overwrite")).csv(path)
    return path


def write_with_quarantine(valid: DataFrame, rejects: DataFrame, path: str,
                          quarantine_path: str, mode: str = "append") -> tuple[str, str]:
    """K4 / K6: valid rows to the table, rejected rows (with reject_reason)
    to a quarantine table next to it."""
    write_table(valid, path, mode=mode)
    write_table(rejects, quarantine_path, mode="append")
    return path, quarantine_path


class ConstraintError(ValueError):
    pass


def assert_unique(df: DataFrame, cols, table: str = "") -> DataFrame:
    """K5 / Q11: fail the load if a declared unique key repeats (a typed
    table's UNIQUE constraint would reject the whole batch).  Reads one
    aggregate row."""
    from starforge.operators.quality import repeated_keys
    r = repeated_keys(df, cols).first()
    if r.duplicate_keys:
        raise ConstraintError(f"{table}: {r.duplicate_keys} repeated keys on {cols}")
    return df


def load_dimension(df: DataFrame, path: str, key_cols) -> str:
    """K2: append a dimension keeping its staged surrogate keys, after the
    key check in the batch and against the rows already loaded."""
    assert_unique(df, key_cols, path)
    _assert_new(df, path, key_cols)
    return write_table(df, path, mode="append")


def _assert_new(df: DataFrame, path: str, key_cols) -> None:
    """A UNIQUE key that is already in the table fails the load, like one repeated in the batch."""
    if has_data(df.sparkSession, path):
        cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
        loaded = df.sparkSession.read.parquet(path).select(*cols)
        clash = df.select(*cols).join(loaded, cols, "left_semi").limit(1).count()
        if clash:
            raise ConstraintError(f"{path}: rows of the batch repeat loaded keys on {cols}")


def load_fact_orders(fact: DataFrame, path: str, quarantine_path: str) -> tuple[str, str]:
    """K4 / K6: append the valid rows (first row per order_id, non-NULL id, not
    loaded before), quarantine the rest with a reason (null_key,
    duplicate_order_id, loaded_order_id); every input row is in one of both.
    A plain append: ``loads.load_facts`` is the load that can be repeated."""
    spark = fact.sparkSession
    kept, rejects = keep_first(fact, "order_id", [c for c in fact.columns if c != "order_id"],
                               "duplicate_order_id")
    if has_data(spark, path):
        loaded = spark.read.parquet(path).select("order_id")
        # what is loaded now must not be read again after the append
        again = stage(kept.join(loaded, "order_id", "left_semi").select(*fact.columns)
                      .withColumn("reject_reason", F.lit("loaded_order_id")), "loaded")
        kept = stage(kept.join(loaded, "order_id", "left_anti").select(*fact.columns), "load")
        rejects = rejects.unionByName(again)
    return write_with_quarantine(kept, rejects, path, quarantine_path, mode="append")


def load_cohort(retention: DataFrame, path: str) -> str:
    """K5: append the cohort fact; a (cohort_month, offset) repeated in the batch
    or loaded before aborts."""
    key = ["cohort_month", "months_since_first_purchase"]
    assert_unique(retention, key, path)
    _assert_new(retention, path, key)
    return write_table(retention, path, mode="append")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, column_count), one aggregate per
    table stacked with unionByName."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(len(df.columns)).cast("long").alias("column_count"))
        out = one if out is None else out.unionByName(one)
    return out


def table_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """``row_counts`` with the grand totals of the dimensions, the facts and all tables."""
    one = row_counts(tables)
    kind = (F.when(F.col("table_name").startswith("dim_"), "all dimensions")
            .when(F.col("table_name").startswith("fact_"), "all facts"))
    both = one.withColumn("k", F.explode(F.array_compact(F.array(F.lit("all tables"), kind))))
    return one.unionByName(both.groupBy(F.col("k").alias("table_name")).agg(
        F.sum("row_count").alias("row_count"), F.sum("column_count").alias("column_count")))


def upsert_scd1(current: DataFrame, incoming: DataFrame, business_key: str, surrogate_key: str,
                updated_col: str = "updated_at", created_col: str = "created_at",
                load_ts=None) -> DataFrame:
    """SCD type 1 merge, the merged table alone (``merge.merge_scd1`` also returns
    the class of every key and the rejects).

    Rows whose business key exists keep their surrogate key and created_at and
    take every other attribute from ``incoming``; ``updated_at`` is refreshed.
    New business keys get keys max(existing) + 1.. in business-key order.
    Untouched rows pass through.
    """
    from starforge.sinks.merge import merge_scd1
    return merge_scd1(current, incoming, business_key, surrogate_key, updated_col, created_col,
                      load_ts).table


def incremental_new_rows(existing: DataFrame, incoming: DataFrame, business_key: str) -> DataFrame:
    """Rows of ``incoming`` whose business key is not yet in ``existing``
    (left anti join), de-duplicated on the key.  The rows left out for a NULL
    or repeated key are ``incremental_rejects``; ``merge.append_unseen_months`` does both
    for a large table."""
    first = first_rows(incoming, business_key, incoming.columns)
    return first.join(existing.select(business_key), business_key, "left_anti")


def incremental_rejects(incoming: DataFrame, business_key: str) -> DataFrame:
    """Rows of a batch that an upsert or append can't take, with their
    reject_reason (NULL key, or beyond the first row of its key)."""
    return extra_rows(incoming, business_key, incoming.columns, f"duplicate_{business_key}")


def table_exists(spark, path: str) -> bool:
    """Whether a table was written at ``path``; an empty folder is none."""
    return has_data(spark, path)


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts the
    lineage; survives executor loss, unlike a local checkpoint)."""
    path = scratch_path(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
