"""Full refresh with a cut-over (K1, K7).

Every refresh writes all its tables into a folder of its own, ``<root>/v<n>``.  Only when all
of them are written does the pointer name it: one row appended to ``<root>/_current``.
Readers follow the pointer, so a refresh that breaks leaves the tables before it in place;
its folder is used again, or removed, by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.operators.validate import REPORT, Observed, enforce_rows
from starforge.schemas import TARGETS
from starforge.sinks.files import read_table, remove_folder, subfolders

POINTER = "_current"
_POINTER_SCHEMA = "version long, published_at timestamp_ntz, tables array<string>"


def published(spark: SparkSession, root: str) -> DataFrame:
    """(version, published_at, tables) of every refresh that was completed, also of removed ones."""
    schema = spark.createDataFrame([], _POINTER_SCHEMA).schema
    return read_table(spark, f"{root.rstrip('/')}/{POINTER}", schema)


def current_version(spark: SparkSession, root: str) -> int | None:
    return published(spark, root).agg(F.max("version")).first()[0]


def _folders(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[1:]) for n in subfolders(spark, root) if n[:1] == "v" and n[1:].isdigit())


REPORT_TABLE = "load_report"


def publish(tables: dict[str, DataFrame], root: str, keep: int = 2, before_cutover=None,
            rules=None) -> int:
    """Write ``tables`` as the next version and make it the current one; returns its number.

    ``rules`` (a callable from table name to its list of Rules) are counted by the writes
    themselves (Q1, Q6-Q8); the counts are published as ``load_report``, and a failed
    ``raise`` rule stops the refresh before the cut-over.  ``before_cutover`` (a callable
    that gets the version's folder) may raise to stop it too.  The ``keep`` newest published
    versions stay; older ones, and folders of refreshes that never were published, are
    removed after the cut-over.
    """
    root = root.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    last = current_version(spark, root) or 0
    version = last + 1
    folder = f"{root}/v{version}"
    remove_folder(spark, folder)                        # what a broken refresh left
    report = []
    for name, df in tables.items():
        seen = Observed(df, name, rules(name)) if rules is not None else None
        (df if seen is None else seen.df).write.mode("errorifexists").parquet(f"{folder}/{name}")
        if seen is not None:
            report += seen.rows()
    names = sorted(tables)
    if rules is not None:
        spark.createDataFrame(report, REPORT).coalesce(1).write.parquet(f"{folder}/{REPORT_TABLE}")
        names.append(REPORT_TABLE)
        enforce_rows(report)
    if before_cutover is not None:
        before_cutover(folder)
    row = [(version, dt.datetime.now().replace(microsecond=0), names)]
    spark.createDataFrame(row, _POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{POINTER}")
    good = {r["version"] for r in published(spark, root).select("version").collect()}      # one row a refresh
    for old in _folders(spark, root):
        if old not in good or old <= version - keep:
            remove_folder(spark, f"{root}/v{old}")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a published version (the current one by default) in their declared schemas."""
    chosen = published(spark, root).where(
        F.col("version") == (version if version is not None else (current_version(spark, root) or 0))).first()
    if chosen is None:
        raise ValueError(f"{root}: version {version} was not published")
    folder = f"{root.rstrip('/')}/v{chosen['version']}"
    out = {}
    for name in chosen["tables"]:
        reader = spark.read.schema(TARGETS[name]) if name in TARGETS else spark.read
        out[name] = reader.parquet(f"{folder}/{name}")
    return out


def table_list(spark: SparkSession, root: str) -> DataFrame:
    """K9: (table_name, version, row_count) of the tables of the current version, read back."""
    version = current_version(spark, root)
    out = None
    for name, df in sorted(read_version(spark, root).items()):
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(version).alias("version"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
