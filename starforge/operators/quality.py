"""Warehouse quality checks (Q1-Q13).

Each check is one aggregate pass returning a small DataFrame; a report is the
checks stacked with unionByName.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions.scalars import percent


def orphan_check(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                 name: str | None = None) -> DataFrame:
    """Q2-Q5: total rows, distinct fact keys, distinct matched keys, orphans.

    NULL fact keys are neither counted as keys nor as orphans.  Both sides are
    reduced to one row per key before the left join: a key that holds a third
    of the fact is one row there.
    """
    d = dim.select(F.col(dim_key).alias("_sf_dk")).distinct()
    keys = fact.groupBy(F.col(fact_key).alias("_sf_fk")).agg(F.count(F.lit(1)).alias("_sf_n"))
    j = keys.join(d, F.col("_sf_fk") == F.col("_sf_dk"), "left")
    a = j.agg(F.coalesce(F.sum("_sf_n"), F.lit(0)).alias("total_rows"),
              F.count("_sf_fk").alias("unique_keys"),
              F.count("_sf_dk").alias("matched_keys"))
    return a.select(F.lit(name or fact_key).alias("check_name"), "total_rows", "unique_keys",
                    "matched_keys",
                    (F.col("unique_keys") - F.col("matched_keys")).alias("orphaned_keys"))


def orphan_rows(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Cross-check for Q2-Q5: fact rows whose non-NULL key has no dim row."""
    return (fact.where(F.col(fact_key).isNotNull())
            .join(dim.select(F.col(dim_key).alias(fact_key)), fact_key, "left_anti"))


def null_counts(df: DataFrame, cols) -> DataFrame:
    """NULL count and share per column, one row per column."""
    a = df.agg(F.count(F.lit(1)).alias("_sf_total"),
               *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = a.selectExpr("_sf_total", f"stack({len(cols)}, {stack}) as (column_name, null_count)")
    return long.select("column_name", "null_count", F.col("_sf_total").alias("total_rows"),
                       percent("null_count", "_sf_total").alias("null_pct"))


def value_consistency(fact: DataFrame) -> DataFrame:
    """Q8: negative / zero order values and negative delivery days."""
    return fact.agg(
        F.count_if(F.col("order_total_value") < 0).alias("negative_values"),
        F.count_if(F.col("order_total_value") == 0).alias("zero_values"),
        F.count_if(F.col("delivery_days") < 0).alias("negative_delivery_days"))


def repeated_keys(df: DataFrame, cols) -> DataFrame:
    """Q9 / Q11 / Q12: how many key values occur more than once, and the
    number of rows involved.  NULL key values are ignored (as UNIQUE does)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    present = df
    for c in cols:
        present = present.where(F.col(c).isNotNull())
    g = present.groupBy(*cols).agg(F.count(F.lit(1)).alias("_sf_n")).where(F.col("_sf_n") > 1)
    return g.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                 F.coalesce(F.sum("_sf_n"), F.lit(0)).cast("long").alias("duplicate_rows"))


def unique_check(df: DataFrame, cols, table: str = "") -> DataFrame:
    """Q11 / Q12: one result row per declared key."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    r = repeated_keys(df, cols)
    return r.select(F.lit(table).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"),
                    "duplicate_keys", "duplicate_rows",
                    (F.col("duplicate_keys") == 0).alias("passed"))


def not_null_check(df: DataFrame, cols, table: str = "") -> DataFrame:
    """Q13: NULLs in NOT NULL columns."""
    n = null_counts(df, cols)
    return n.select(F.lit(table).alias("table_name"), "column_name", "null_count",
                    (F.col("null_count") == 0).alias("passed"))


def max_length_check(df: DataFrame, limits: dict, table: str = "") -> DataFrame:
    """Q13: values longer than the declared VARCHAR length."""
    cols = list(limits)
    a = df.agg(*[F.count_if(F.length(F.col(c)) > limits[c]).alias(c) for c in cols],
               *[F.max(F.length(F.col(c))).alias(f"_sf_max_{c}") for c in cols])
    stack = ", ".join(f"'{c}', {limits[c]}, `{c}`, `_sf_max_{c}`" for c in cols)
    long = a.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, max_length,"
                        " too_long, longest)")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.col("max_length").cast("int").alias("max_length"),
                       "too_long", F.col("longest").cast("int").alias("longest"),
                       (F.col("too_long") == 0).alias("passed"))


def business_order_metrics(fact: DataFrame) -> DataFrame:
    """Q10: completion and late rates over all orders, mean delivery days over
    all rows (zeros of undelivered orders included), mean order value."""
    a = fact.agg(F.count(F.lit(1)).alias("total_orders"),
                 F.count_if("is_completed_order").alias("completed_orders"),
                 F.count_if("is_late_delivery").alias("late_deliveries"),
                 F.try_divide(F.sum("delivery_days").cast("double"),
                              F.count("delivery_days").cast("double")).alias("avg_delivery_days"),
                 F.try_divide(F.sum("order_total_value").cast("double"),
                              F.count("order_total_value").cast("double")).alias("avg_order_value"))
    return a.select("*", percent("completed_orders", "total_orders").alias("completion_rate"),
                    percent("late_deliveries", "total_orders").alias("late_rate"))


def segment_summary(dim_customers: DataFrame) -> DataFrame:
    """Q10: customers and mean CLV per segment, largest first."""
    return (dim_customers.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.try_divide(F.sum("lifetime_value").cast("double"),
                              F.count("lifetime_value").cast("double")).alias("avg_clv"))
            .orderBy(F.col("customer_count").desc(), "customer_segment"))
