"""Loads that can be repeated (K2, K4, K5, K6).

A load has an id, and both its rows in the table and its rejected rows are kept in the
folder of that id (a partition column, ``load_id``).  Writing replaces the folder
(dynamic partition overwrite), so a load that broke half-way, or ran twice, is simply run
again: it sees only what *earlier* loads left, computes the same rows and replaces its own.
Only the newest load can be repeated: a later one was numbered and checked after it.

Surrogate keys are numbered on from the largest key of the earlier loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators.keys import beyond_first, dense_key, first_rows
from starforge.schemas import TARGETS, UNFIT, UNIQUE_KEYS, flag_unfit, is_unfit
from starforge.sinks.files import has_data, read_table, remove_folder

LOAD_ID = "load_id"
REJECT_REASON = "reject_reason"


class LoadOrderError(ValueError):
    """An older load was run again after a newer one."""


def _with_load(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LOAD_ID, T.LongType())])


def loaded(spark: SparkSession, path: str, table: str) -> DataFrame:
    """What is in the table at ``path``, with the id of the load that wrote each row."""
    return read_table(spark, path, _with_load(TARGETS[table]))


def replace_load(df: DataFrame, path: str, load_id: int) -> int:
    """Make ``df`` the rows of one load of the table at ``path``; returns how many they are.

    The rows are counted while they are written.  A load that has none any more loses its
    folder, which an overwrite by partitions would leave alone.
    """
    seen = Observation()
    (df.withColumn(LOAD_ID, F.lit(load_id).cast("long")).observe(seen, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID).parquet(path))
    rows = seen.get["rows"]
    if not rows and has_data(df.sparkSession, path):
        remove_folder(df.sparkSession, f"{path.rstrip('/')}/{LOAD_ID}={load_id}")
    return rows


def _earlier(spark: SparkSession, path: str, table: str, load_id: int) -> DataFrame:
    rows = loaded(spark, path, table)
    newest = rows.agg(F.max(LOAD_ID)).first()[0]            # partition values only
    if newest is not None and newest > load_id:
        raise LoadOrderError(f"{path}: load {newest} came after load {load_id}; repeat that one only")
    return rows.where(F.col(LOAD_ID) < load_id)


def _known_columns(df: DataFrame, schema: T.StructType, without=()) -> DataFrame:
    """The columns of the target that ``df`` has, in the target's order; others are dropped."""
    return df.select(*[f.name for f in schema.fields if f.name in df.columns and f.name not in without])


def _complete(df: DataFrame, schema: T.StructType, extra=()) -> DataFrame:
    """The target's columns: those that ``df`` lacks are NULL, ``created_at`` is the time of the load."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name))
        elif f.name == "created_at":
            cols.append(F.current_timestamp().cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *extra)


def load_facts(fact: DataFrame, path: str, quarantine_path: str, load_id: int,
               table: str = "fact_orders", id_col: str = "order_id",
               key: str = "order_key") -> tuple[int, int]:
    """K4 / K6: one repeatable load of ``fact``; returns (rows loaded, rows rejected).

    ``key`` is dropped and numbered on from the earlier loads, in id order (W2).  Columns of
    the target that ``fact`` lacks stay NULL, columns that the target lacks are dropped (P1).
    Rejected, with their reason: rows without an id (``null_key``); rows with a value that the
    declared types can't hold (``out_of_range``, or ``missing`` for a NULL in another NOT NULL
    column; ``unfit`` lists column and value); beyond the first row of an id
    (``duplicate_<id>``); ids of an earlier load (``loaded_<id>``).  Every input row is in one
    of both tables.

    The ids are counted, looked up in the earlier loads and numbered alone (one narrow column);
    the wide rows are then joined with them once, and staged.  Only rows of ids that repeat in
    the batch are grouped.
    """
    from starforge.sinks import stage
    spark, schema = fact.sparkSession, TARGETS[table]
    earlier = _earlier(spark, path, table, load_id).select(id_col, key)
    batch = _known_columns(fact, schema, without=(key,))
    checked = T.StructType([f for f in schema.fields if f.name != id_col])
    batch = stage(flag_unfit(batch, checked), "load")
    cols = [c for c in batch.columns if c != UNFIT]
    fits = F.col(id_col).isNull() | ~is_unfit()
    good = batch.where(fits).select(*cols)
    others = [c for c in cols if c != id_col]
    known = earlier.select(id_col).distinct().withColumn("_sf_known", F.lit(True))
    ids = stage(good.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_sf_rows"))
                .join(known, id_col, "left"), "ids")
    after = earlier.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = dense_key(ids.where("_sf_known is null").select(id_col, "_sf_rows"), [id_col], key, first=False, after=after)
    before = ids.where("_sf_known").select(id_col, "_sf_rows", F.lit(None).cast("long").alias(key))
    tagged = stage(good.join(fresh.unionByName(before), id_col, "left").select(*cols, key, "_sf_rows"), "tagged")
    several = tagged.where("_sf_rows > 1")
    first = (tagged.where("_sf_rows = 1").select(*cols, key)
             .unionByName(first_rows(several.select(*cols, key), id_col, others)))

    no_values = F.lit(None).cast(batch.schema[UNFIT].dataType).alias("unfit")
    bad = (beyond_first(several.select(*cols), id_col, others, f"duplicate_{id_col}")
           .unionByName(tagged.where(F.col(id_col).isNull()).select(*cols)
                        .withColumn(REJECT_REASON, F.lit("null_key")))
           .unionByName(first.where(F.col(key).isNull()).select(*cols)
                        .withColumn(REJECT_REASON, F.lit(f"loaded_{id_col}")))
           .select("*", no_values)
           .unionByName(batch.where(~fits).select(*cols, F.col(UNFIT)[0]["reject_reason"].alias(REJECT_REASON),
                                                  F.col(UNFIT).alias("unfit"))))
    rows = _complete(first.where(F.col(key).isNotNull()), schema)
    kept = T.StructType([f for f in schema.fields if f.name != key])
    return (replace_load(rows, path, load_id),
            replace_load(_complete(bad, kept, extra=(REJECT_REASON, "unfit")), quarantine_path, load_id))


def load_keyed(df: DataFrame, path: str, load_id: int, table: str) -> int:
    """K2 / K5: one repeatable load of a table that keeps its keys; returns the rows loaded.

    A declared unique key (``UNIQUE_KEYS``) that repeats in the batch, or is in an earlier
    load, fails the load before anything is written.
    """
    from starforge.sinks import ConstraintError, assert_unique, stage
    earlier = _earlier(df.sparkSession, path, table, load_id)
    batch = stage(_complete(_known_columns(df, TARGETS[table]), TARGETS[table]), "load")
    for cols in UNIQUE_KEYS[table]:
        assert_unique(batch, list(cols), path)
        if batch.select(*cols).join(earlier.select(*cols), list(cols), "left_semi").limit(1).count():
            raise ConstraintError(f"{path}: rows of the batch repeat loaded keys on {list(cols)}")
    return replace_load(batch, path, load_id)


def load_numbered(df: DataFrame, path: str, load_id: int, table: str, key: str) -> int:
    """K5: like ``load_keyed``, but ``key`` is dropped and numbered on from the earlier loads,
    in the order of the table's other unique key."""
    from starforge.operators.keys import dense_key
    earlier = _earlier(df.sparkSession, path, table, load_id)
    after = earlier.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    order = next(cols for cols in UNIQUE_KEYS[table] if cols != (key,))
    return load_keyed(dense_key(df.drop(key), list(order), key, after=after), path, load_id, table)
