"""Lookups against small tables.

A lookup is a left join that must not multiply rows, so the lookup side is
de-duplicated on its key first.  Broadcast is used only for literal tables
built from rules (size = len of the rule list).  Anything else goes through a
normal shuffle join, which AQE may still turn into a broadcast at run time
from real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, pairs, key: str, value: str) -> DataFrame:
    """A two-column table from (key, value) pairs of a rule list."""
    schema = T.StructType([T.StructField(key, T.StringType(), False),
                           T.StructField(value, T.StringType(), True)])
    return spark.createDataFrame(list(pairs), schema)


def literal_lookup(df: DataFrame, column: str, pairs, out: str, default=None) -> DataFrame:
    """``out`` = value of ``column`` in the rule list ``pairs``.

    ``default`` (a Column) fills misses; the literal side is broadcast, its
    size being the length of the rule list.
    """
    spark = df.sparkSession
    seen: dict = {}
    for k, v in pairs:
        seen[k] = v   # a dict keeps the last duplicate key
    table = literal_table(spark, seen.items(), "_sf_lk", "_sf_lv")
    joined = df.join(F.broadcast(table), df[column] == F.col("_sf_lk"), "left")
    value = F.col("_sf_lv") if default is None else F.coalesce(F.col("_sf_lv"), default)
    return joined.withColumn(out, value).drop("_sf_lk", "_sf_lv")


def key_lookup(df: DataFrame, left_on, dim: DataFrame, dim_on: str, dim_value: str,
               out: str) -> DataFrame:
    """Surrogate-key lookup: ``out`` = dim_value of the dim row whose
    ``dim_on`` equals ``left_on``; NULL when unmatched.  A business key that
    ``dim`` holds several times gives its last (largest) surrogate key, so the
    lookup never multiplies rows.  Catalyst / AQE choose the join.
    """
    side = (dim.groupBy(F.col(dim_on).alias("_sf_dk"))
            .agg(F.max(dim_value).alias(out)))
    lk = F.col(left_on) if isinstance(left_on, str) else left_on
    return df.join(side, lk == F.col("_sf_dk"), "left").drop("_sf_dk")
