"""fact_cohort_retention and the cohort reports (A5, A13, A14, J10, J11,
F20, F21, W4, B11, D11).

The order table is first reduced to distinct (customer, order month) pairs:
a customer holding a third of all orders contributes at most one row per
month after the map-side partial aggregation, so no join or group below it
sees the hot key at full size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.functions.dates import month_start, months_between_starts
from starforge.functions.scalars import round_ratio
from starforge.operators.keys import dense_key
from starforge.schemas import TARGETS, conform

OFFSET = "months_since_first_purchase"


def _mean(c) -> F.Column:
    """Mean as exact SUM / COUNT (rates are DECIMAL), one final rounding."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def cohort_cells(orders: DataFrame, dim_customers: DataFrame, grain: str = "customer_id") -> DataFrame:
    """(cohort_month, offset) -> retained_customers, cohort_size, retention_rate.

    grain='customer_unique_id' counts persons (D7): the orders of all ids of a person are
    the person's, whose cohort is the month of the first of them.
    """
    if grain not in orders.columns:
        person = dim_customers.groupBy("customer_id").agg(F.min(grain).alias(grain))
        orders = (orders.groupBy("customer_id", month_start("order_purchase_timestamp").alias("order_purchase_timestamp"))
                  .agg(F.lit(1).alias("_sf_one")).join(person, "customer_id"))
    active = (orders.select(F.col(grain), month_start("order_purchase_timestamp").alias("order_month"))
              .where(F.col("order_month").isNotNull() & F.col(grain).isNotNull())
              .distinct())
    cohorts = (dim_customers.select(F.col(grain), month_start("first_order_date").alias("cohort_month"))
               .where(F.col("cohort_month").isNotNull())
               .groupBy(grain).agg(F.min("cohort_month").alias("cohort_month")))
    a = (active.join(cohorts, grain, "inner")
         .withColumn(OFFSET, months_between_starts("order_month", "cohort_month")))
    cells = a.groupBy("cohort_month", OFFSET).agg(F.count(F.lit(1)).cast("int")
                                                   .alias("retained_customers"))
    # size = retained at offset 0 of the same cohort (one small group per cohort)
    size = F.max(F.when(F.col(OFFSET) == 0, F.col("retained_customers"))) \
        .over(Window.partitionBy("cohort_month"))
    cells = cells.withColumn("cohort_size", size.cast("int"))
    return cells.withColumn(
        "retention_rate",
        round_ratio(F.col("retained_customers") * 100, "cohort_size", 2).cast("decimal(5,2)"))


def fact_cohort_retention(orders: DataFrame, dim_customers: DataFrame, created_at=None,
                          grain: str = "customer_id") -> DataFrame:
    from starforge.plans.dims import run_timestamp
    cells = cohort_cells(orders, dim_customers, grain)
    keyed = dense_key(cells, ["cohort_month", OFFSET], "cohort_retention_key")
    keyed = keyed.withColumn("created_at", created_at if created_at is not None else run_timestamp())
    return conform(keyed, TARGETS["fact_cohort_retention"])


def retention_by_offset(retention: DataFrame, first_n: int = 12) -> DataFrame:
    """Mean retention rate per month offset, the first ``first_n`` offsets."""
    return (retention.groupBy(OFFSET)
            .agg(_mean(F.col("retention_rate")).alias("avg_retention_rate"))
            .orderBy(OFFSET).limit(first_n))


def cohort_insights(retention: DataFrame) -> DataFrame:
    """Cohorts, mean size, mean month-1 and month-3 retention."""
    r = retention
    at = lambda k, c: F.when(F.col(OFFSET) == k, F.col(c))
    return r.agg(
        F.count_distinct("cohort_month").alias("total_cohorts"),
        _mean(at(0, "cohort_size")).alias("avg_cohort_size"),
        _mean(at(1, "retention_rate")).alias("avg_month_1_retention"),
        _mean(at(3, "retention_rate")).alias("avg_month_3_retention"))


def retention_heatmap(retention: DataFrame) -> DataFrame:
    """One row per cell, that is per cohort and month offset from 0 on, with no last offset."""
    return (retention.select("cohort_month", "cohort_size", F.col(OFFSET).alias("month_offset"),
                             F.col("retention_rate").cast("double").alias("retention_rate"))
            .orderBy("cohort_month", "month_offset"))
