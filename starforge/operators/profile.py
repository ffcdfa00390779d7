"""Column profiles (A6-A11, A16, W1, O3) used by the validation logs and as
standalone reports.  All are aggregates; top-k uses a total order so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions.scalars import share_pct


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-NULL values, keyed 1..n by sorted value.  The
    distinct set is small by nature here (payment types, statuses)."""
    from starforge.operators.keys import dense_key
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return dense_key(d, [col], "value_key")


def distinct_count(df: DataFrame, cols) -> DataFrame:
    """Exact distinct count per column (NULLs ignored).

    Every column is an aggregation of its own, which reads that column alone: several
    distinct counts in one aggregation would copy each row once per column (Expand).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = None
    for c in cols:
        one = df.agg(F.count_distinct(c).alias(f"distinct_{c}"))
        out = one if out is None else _one_row_pair(out, one)
    return out


def distinct_keys(df: DataFrame, cols) -> DataFrame:
    """A7 over surrogate keys (dense positive integers): exact distinct counts of all columns in
    one pass, by bitmaps.

    A bucket is a bitmap of 32,768 consecutive keys (4 KB).  What is shuffled is one bitmap
    per task, column and bucket, however often a key occurs; bitmaps of a bucket are or-ed.
    NULLs are ignored.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    entries = [F.when(F.col(c).isNotNull(), F.struct(
        F.lit(i).alias("i"), F.bitmap_bucket_number(F.col(c).cast("long")).alias("bucket"),
        F.bitmap_bit_position(F.col(c).cast("long")).alias("bit"))) for i, c in enumerate(cols)]
    maps = (df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
            .groupBy("e.i", "e.bucket").agg(F.bitmap_count(F.bitmap_construct_agg("e.bit")).alias("n")))
    return maps.agg(*[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).cast("long")
                      .alias(f"distinct_{c}") for i, c in enumerate(cols)])


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """Count per value with its share of all rows, count
    descending then value ascending; ``k`` keeps the top k."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    # the total is the sum of the counts: the same aggregation, whose exchange Spark reuses
    total = counts.agg(F.sum("count").alias("_sf_total"))
    out = (counts.withColumn("_sf_one", F.lit(1))
           .join(F.broadcast(total.withColumn("_sf_one", F.lit(1))), "_sf_one")
           .select(col, "count", share_pct(F.col("count"), F.col("_sf_total")).alias("percentage"))
           .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first()))
    return out.limit(k) if k else out


def multi_row_groups(df: DataFrame, key: str) -> DataFrame:
    """Groups with more than one row, how many, and their share."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_sf_n"))
    return g.agg(F.count_if(F.col("_sf_n") > 1).alias("multi_row_groups"),
                 F.count(F.lit(1)).alias("groups"),
                 share_pct(F.count_if(F.col("_sf_n") > 1), F.count(F.lit(1))).alias("multi_pct"))


def _one_row_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.withColumn("_sf_one", F.lit(1)).join(
        F.broadcast(b.withColumn("_sf_one", F.lit(1))), "_sf_one").drop("_sf_one")


def numeric_summary(df: DataFrame, col: str, where=None) -> DataFrame:
    """A10: sum, mean, min, max, median of a numeric column (optional filter).
    The median comes from narrowing histograms, not a one-task buffer."""
    from starforge.operators.quantile import exact_percentiles
    d = df if where is None else df.where(where)
    a = d.agg(F.sum(col).alias("sum"),
              F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double")).alias("mean"),
              F.min(col).alias("min"), F.max(col).alias("max"))
    med = exact_percentiles(d, col, {"median": 0.5})
    return _one_row_pair(a, med)


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, std, min, exact quartiles (linear interpolation), max.

    A DECIMAL column is summed exactly, its squares too, so mean and std have one rounding
    each and don't depend on the order of the rows.
    """
    from starforge.operators.quantile import exact_percentiles
    v = F.col(col).cast("double")
    if isinstance(df.schema[col].dataType, T.DecimalType):
        unit = 10 ** df.schema[col].dataType.scale
        whole = (F.col(col) * unit).cast("decimal(18,0)")
        a = df.agg(F.count(col).alias("count"), F.sum(whole).cast("decimal(38,0)").alias("s"),
                   F.sum(whole * whole).cast("decimal(38,0)").alias("q"), F.stddev_samp(v).alias("near"),
                   F.min(v).alias("min"), F.max(v).alias("max"))
        n = F.col("count").cast("double")
        # n * squares - sum ** 2, exact up to 38 digits; NULL beyond
        spread = F.expr("try_subtract(try_multiply(q, cast(count as decimal(19,0))), try_multiply(s, s))")
        std = F.sqrt(F.try_divide(spread.cast("double"), n * (n - 1))) / unit
        a = a.select("count", F.try_divide(F.col("s").cast("double") / unit, n).alias("mean"),
                     F.when(F.col("count") > 1, F.coalesce(std, "near")).alias("std"), "min", "max")
    else:
        a = df.agg(F.count(v).alias("count"),
                   F.try_divide(F.sum(v), F.count(v).cast("double")).alias("mean"),
                   F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    q = exact_percentiles(df, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return _one_row_pair(a, q).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")
