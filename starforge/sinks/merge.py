"""Merges into tables that exist: SCD type 1 (D8) and appends of unseen keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators.keys import extra_rows, first_rows, number_ids
from starforge.sinks.files import has_data, read_table

CLASS = "change_class"              # new | changed | same | missing
REJECT_REASON = "reject_reason"


@dataclass
class Merge:
    table: DataFrame        # the merged table, in the columns of the current one
    classes: DataFrame      # business key, surrogate key, change_class: every key of either side
    rejects: DataFrame      # rows of the batch that were not taken, with their reject_reason


def merge_scd1(current: DataFrame, incoming: DataFrame, business_key: str, surrogate_key: str,
               updated_col: str = "updated_at", created_col: str = "created_at",
               load_ts=None) -> Merge:
    """One full outer join, written once, classes every business key.

    * ``new`` (only in the batch): its surrogate key is numbered on from the largest one,
      in business-key order;
    * ``changed`` / ``same``: keeps surrogate key and created_at, takes the batch's other
      attributes, updated_at is refreshed;
    * ``missing`` (only in the table): stays as it is.

    A key that the batch repeats gives its smallest row; the others, and rows without a
    key, are rejected.  The join is null-safe, so a NULL key of the table is a key of its
    own.  Either side is read once; the batch is read again only if something was rejected.
    """
    from starforge.sinks import stage
    ts = load_ts if load_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    attrs = [c for c in incoming.columns if c not in (surrogate_key, created_col, updated_col)]
    others = [c for c in attrs if c != business_key]
    batch = incoming.select(*attrs)
    # the smallest row of every key, and how many rows it has; the NULL key is only counted
    inc = (batch.groupBy(business_key).agg(F.min(F.struct(*attrs)).alias("_sf_row"), F.count(F.lit(1)).alias("_sf_rows"))
           .select(F.col(business_key).alias("_sf_key"), F.col("_sf_row").alias("_sf_in"), "_sf_rows"))
    cur = current.select(F.struct(*current.columns).alias("_sf_cur"))
    both = cur.join(inc, (F.col(f"_sf_cur.{business_key}").eqNullSafe(F.col("_sf_key")))
                    & F.col("_sf_key").isNotNull(), "full_outer")
    same = F.lit(True)
    for c in others:
        if c in current.columns:
            same = same & F.col(f"_sf_cur.{c}").eqNullSafe(F.col(f"_sf_in.{c}"))
    both = both.withColumn(CLASS, F.when(F.col("_sf_in").isNull(), "missing")
                           .when(F.col("_sf_cur").isNull(), "new").when(same, "same").otherwise("changed"))
    both = stage(both, "merge")
    null_key = F.col("_sf_in").isNotNull() & F.col("_sf_key").isNull()
    state = both.agg(F.max(f"_sf_cur.{surrogate_key}").alias("last"),
                     F.coalesce(F.max("_sf_rows"), F.lit(0)).alias("most"),
                     F.count_if(null_key).alias("nulls")).first()
    keyed = both.where(~null_key)

    new = keyed.where(F.col(CLASS) == "new")
    numbered = number_ids(new.select(F.col("_sf_key")), "_sf_key", "_sf_new", state["last"] or 0)
    rows = (keyed.where(F.col(CLASS) != "new").withColumn("_sf_new", F.lit(None).cast("long"))
            .unionByName(new.join(numbered, "_sf_key").select(*keyed.columns, "_sf_new")))
    fresh = F.col(CLASS) != "missing"
    out = []
    for c in current.columns:
        old = F.col(f"_sf_cur.{c}")
        if c == surrogate_key:
            value = F.coalesce(old, F.col("_sf_new").cast(current.schema[c].dataType))
        elif c == created_col:
            value = F.when(F.col(CLASS) == "new", ts).otherwise(old)
        elif c == updated_col:
            value = F.when(fresh, ts).otherwise(old)
        elif c in attrs:
            value = F.when(fresh, F.col(f"_sf_in.{c}")).otherwise(old)
        else:
            value = old
        out.append(value.alias(c))
    table = rows.select(*out)
    classes = rows.select(F.coalesce("_sf_key", F.col(f"_sf_cur.{business_key}")).alias(business_key),
                          F.coalesce(F.col(f"_sf_cur.{surrogate_key}"), F.col("_sf_new")).alias(surrogate_key), CLASS)
    if state["most"] > 1 or state["nulls"]:
        repeated = keyed.where("_sf_rows > 1").select(F.col("_sf_key").alias(business_key))
        rejects = extra_rows(batch, business_key, attrs, f"duplicate_{business_key}", repeated)
    else:
        rejects = batch.limit(0).withColumn(REJECT_REASON, F.lit(None).cast("string"))
    return Merge(table, classes, rejects)


MONTH = "load_month"


def loaded_keys(spark: SparkSession, path: str, schema: T.StructType, key: str, batch: DataFrame) -> DataFrame:
    """(key, load_month) of the table at ``path``, only of the months that ``batch`` has.

    The months are a broadcast side of a semi join on the partition column: Spark prunes the
    folders of all other months before it reads them.  Between the first and the last month
    of the batch there are only so many; the count is checked.
    """
    loaded = read_table(spark, path, T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())]))
    span = batch.agg(F.min(MONTH).alias("low"), F.max(MONTH).alias("high"),
                     F.months_between(F.max(MONTH), F.min(MONTH)).alias("months")).first()
    if span["low"] is None:
        return loaded.select(key, MONTH).limit(0)
    touched = batch.where(F.col(MONTH).between(F.lit(span["low"]), F.lit(span["high"]))).select(MONTH).distinct()
    if span["months"] <= 12 * 1000:
        touched = F.broadcast(touched)
    return loaded.select(key, MONTH).join(touched, MONTH, "left_semi")


def append_unseen_months(batch: DataFrame, path: str, key: str, at: str, quarantine_path: str) -> DataFrame:
    """D9 for a large table: append the rows whose ``key`` is not in the table yet; returns them.

    The table is partitioned by the month of ``at`` (``load_month``), a time that belongs to
    the key: a key that comes again has the same month.  So only the batch's months are
    looked at, not all keys ever loaded.  Rows with a NULL key or time, and those beyond the
    first of their key, go to ``quarantine_path`` with their reason.
    """
    from starforge.sinks import stage
    spark = batch.sparkSession
    dated = stage(batch.withColumn(MONTH, F.trunc(F.to_date(F.col(at)), "MM")), "batch")
    nameless = F.col(key).isNull()
    timeless = dated.where(~nameless & F.col(MONTH).isNull()).drop(MONTH).withColumn(REJECT_REASON, F.lit(f"null_{at}"))
    usable = dated.where(nameless | F.col(MONTH).isNotNull())
    cols = batch.columns
    rejects = extra_rows(usable.select(*cols), key, cols, f"duplicate_{key}").unionByName(timeless)
    rejects.write.mode("append").parquet(quarantine_path)
    first = first_rows(usable, key, cols)
    if has_data(spark, path):
        known = loaded_keys(spark, path, batch.schema, key, usable)
        first = first.join(known, [MONTH, key], "left_anti").select(*first.columns)
    fresh = stage(first, "fresh")
    fresh.write.mode("append").partitionBy(MONTH).parquet(path)
    return fresh.select(*cols)
