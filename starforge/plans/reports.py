"""Business reports over the built tables.

Every report is an aggregate over fact_orders joined to at most one
dimension.  Money is summed as DECIMAL; averages are sum / count in DOUBLE.
Joins to dim_date, dim_payment_type and dim_products would be broadcast by
AQE from their real size; dim_customers is joined on its key with a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.operators.profile import _one_row_pair
from starforge.functions.scalars import percent, share_pct


def mean(col) -> F.Column:
    """Average as SUM / COUNT in DOUBLE (exact sum, one rounding)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def completed(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("is_completed_order"))


def _by_key(fact: DataFrame, key: str, **extra) -> DataFrame:
    """Completed orders pre-aggregated on a surrogate key: a hot key (one
    customer with a third of the orders) is reduced map-side before any
    shuffle, and the join to the dimension then sees one row per key."""
    aggs = [F.count(F.lit(1)).alias("_sf_orders"),
            F.sum("order_total_value").alias("_sf_revenue"),
            F.count("order_total_value").alias("_sf_valued")]
    aggs += [v.alias(k) for k, v in extra.items()]
    return completed(fact).groupBy(key).agg(*aggs)


def top_customers_by_revenue(fact: DataFrame, dim_customers: DataFrame, k: int = 10) -> DataFrame:
    """B1: top-k customers by revenue of completed orders.  order_id is unique
    in the fact, so distinct orders per customer = rows per customer."""
    per_key = _by_key(fact, "customer_key")
    j = per_key.join(dim_customers.select("customer_key", "customer_id", "customer_state"),
                     "customer_key", "inner")
    return (j.groupBy("customer_id", "customer_state")
            .agg(F.sum("_sf_orders").alias("total_orders"),
                 F.sum("_sf_revenue").alias("lifetime_value"))
            .orderBy(F.col("lifetime_value").desc(), F.col("customer_id"))
            .limit(k))


def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """B2: completed-order revenue by calendar month."""
    j = completed(fact).join(dim_date, fact["order_date_key"] == dim_date["date_key"], "inner")
    return (j.groupBy("year", "month", "month_name")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("order_total_value").alias("monthly_revenue"),
                 mean("order_total_value").alias("avg_order_value"))
            .orderBy("year", "month"))


def retention_since(retention: DataFrame, since: str) -> DataFrame:
    """Retention rows from cohort month ``since`` on."""
    return (retention.where(F.col("cohort_month") >= F.lit(since).cast("date"))
            .select("cohort_month", "months_since_first_purchase", "cohort_size",
                    "retained_customers", "retention_rate")
            .orderBy("cohort_month", "months_since_first_purchase"))


def category_segment_performance(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Completed orders by product category segment (pre-aggregated on
    product_key, then joined to the product dimension)."""
    per_key = _by_key(fact, "product_key",
                      _sf_score_sum=F.sum("review_score"), _sf_scored=F.count("review_score"))
    j = per_key.join(dim_products.select("product_key", "product_category_segment"),
                     "product_key", "inner")
    return (j.groupBy("product_category_segment")
            .agg(F.sum("_sf_orders").alias("order_count"),
                 F.sum("_sf_revenue").alias("total_revenue"),
                 F.try_divide(F.sum("_sf_revenue").cast("double"),
                              F.sum("_sf_valued").cast("double")).alias("avg_order_value"),
                 F.try_divide(F.sum("_sf_score_sum").cast("double"),
                              F.sum("_sf_scored").cast("double")).alias("avg_review_score"))
            .orderBy(F.col("total_revenue").desc(), "product_category_segment"))


def revenue_metrics(fact: DataFrame) -> DataFrame:
    """Revenue, average order value and count of completed orders."""
    return completed(fact).agg(F.sum("order_total_value").alias("total_revenue"),
                               mean("order_total_value").alias("avg_order_value"),
                               F.count(F.lit(1)).alias("total_orders"))


def delivery_performance(fact: DataFrame) -> DataFrame:
    """Late / on-time counts, mean delivery days, late share (completed)."""
    a = completed(fact).agg(
        F.count_if(F.col("is_late_delivery")).alias("late_deliveries"),
        F.count_if(~F.col("is_late_delivery")).alias("on_time_deliveries"),
        mean("delivery_days").alias("avg_delivery_days"))
    total = F.col("late_deliveries") + F.col("on_time_deliveries")
    return a.select("*", percent("late_deliveries", total).alias("late_pct"),
                    (F.lit(100.0) - percent("late_deliveries", total)).alias("on_time_pct"))


def status_counts(fact: DataFrame, k: int = 5) -> DataFrame:
    """Orders per status, the k largest."""
    return (fact.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.col("order_count").desc(), "order_status").limit(k))


def build_metrics(order_grain: DataFrame) -> DataFrame:
    """The builder's metrics over the review fan-out.

    An order with n > 1 reviews stands for n rows in the fanned-out table, so
    each order is weighted by greatest(review_rows, 1) instead of
    materialising the copies.  Input: ``facts.order_measures`` output.
    """
    w = F.greatest(F.col("review_rows"), F.lit(1))
    rows = F.sum(w)
    return order_grain.agg(
        rows.alias("total_rows"),
        F.sum(F.col("order_total_value") * w).alias("total_revenue"),
        (F.sum(F.col("order_total_value") * w).cast("double") / rows).alias("avg_order_value"),
        percent(F.sum(F.when(F.col("is_completed_order"), w).otherwise(0)), rows)
        .alias("completed_pct"),
        percent(F.sum(F.when(F.col("is_late_delivery"), w).otherwise(0)), rows).alias("late_pct"),
        F.try_divide(F.sum(F.when(F.col("delivery_days") > 0, F.col("delivery_days") * w))
                     .cast("double"),
                     F.sum(F.when(F.col("delivery_days") > 0, w)).cast("double"))
        .alias("avg_delivery_days_positive"))


def fanout_weights(fact: DataFrame, reviews: DataFrame) -> DataFrame:
    """The fact with ``review_rows``: how many rows the review fan-out
    would give each order (review rows per order, aggregated map-side)."""
    n = reviews.groupBy("order_id").agg(F.count(F.lit(1)).alias("review_rows"))
    return (fact.join(n, "order_id", "left")
            .withColumn("review_rows", F.coalesce("review_rows", F.lit(0))))


def review_fanout_metrics(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """B8 review part: share of fanned-out rows with a review and their mean
    score, from review rows joined to existing orders (no fan-out built)."""
    o = orders.select("order_id").where(F.col("order_id").isNotNull()).distinct()
    per_order = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("review_score").alias("n_scored"),
        F.sum("review_score").alias("score_sum"))
    j = o.join(per_order, "order_id", "left")
    rows = F.sum(F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)))
    return j.agg(
        rows.alias("total_rows"),
        percent(F.coalesce(F.sum("n_scored"), F.lit(0)), rows).alias("reviewed_pct"),
        mean_of_sums("score_sum", "n_scored").alias("avg_review_score"))


def mean_of_sums(total, count) -> F.Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(count).cast("double"))


def clv_stats(dim_customers: DataFrame) -> DataFrame:
    """Mean / median / max lifetime value (exact median by narrowing histograms)."""
    from starforge.operators.quantile import exact_percentiles
    a = dim_customers.agg(mean(F.col("lifetime_value")).alias("avg_clv"),
                          F.max("lifetime_value").alias("max_clv"))
    med = exact_percentiles(dim_customers, "lifetime_value", {"median_clv": 0.5})
    return _one_row_pair(a, med).select("avg_clv", "median_clv", "max_clv")


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts with share, count descending (value breaks ties)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    # the total is the one-row sum of the counts (whose exchange Spark reuses) in a
    # broadcast join, so a high-cardinality column never meets an unpartitioned window
    total = counts.agg(F.sum("count").alias("_sf_total"))
    return (_one_row_pair(counts, total)
            .withColumn("percentage", share_pct(F.col("count"), F.col("_sf_total")))
            .drop("_sf_total")
            .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first()))


def calendar_summary(dim_date: DataFrame) -> DataFrame:
    """Calendar range, weekend days, holidays, total days."""
    return dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"),
                        F.count_if("is_weekend").alias("weekend_days"),
                        F.count_if("is_holiday").alias("holidays"),
                        F.count(F.lit(1)).alias("total_days"))


def days_per_year(dim_date: DataFrame) -> DataFrame:
    """Days per calendar year."""
    return dim_date.groupBy("year").agg(F.count(F.lit(1)).alias("days")).orderBy("year")


def fk_null_coverage(fact: DataFrame) -> DataFrame:
    """NULL count per surrogate key of the fact."""
    keys = ["customer_key", "product_key", "order_date_key", "delivery_date_key",
            "payment_type_key"]
    return fact.agg(*[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
                    F.count(F.lit(1)).alias("total_rows"))


# ------------------------------------------------------------- dashboards
def kpi_sales(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """D10 page 1: revenue, completed orders, customers, average order value."""
    f = completed(fact).agg(F.sum("order_total_value").alias("total_revenue"),
                            F.count(F.lit(1)).alias("completed_orders"),
                            mean("order_total_value").alias("avg_order_value"))
    c = dim_customers.agg(F.count_distinct("customer_id").alias("total_customers"))
    return _one_row_pair(f, c)


def kpi_delivery(fact: DataFrame) -> DataFrame:
    """D10 page 2: completion, late and on-time rates, mean delivery days."""
    done = F.col("is_completed_order")
    days = F.when(done, F.col("delivery_days"))
    j = fact.agg(F.count(F.lit(1)).alias("total_orders"),
                 F.count_if(done).alias("completed_orders"),
                 F.count_if(done & F.col("is_late_delivery")).alias("late"),
                 F.count_if(done).alias("delivered"),
                 F.try_divide(F.sum(days).cast("double"), F.count(days).cast("double")).alias("avg_delivery_days"))
    return j.select(percent("completed_orders", "total_orders").alias("completion_rate"),
                    percent("late", "delivered").alias("late_rate"),
                    (F.lit(100.0) - percent("late", "delivered")).alias("on_time_rate"),
                    "avg_delivery_days")


def kpi_customers_products(fact: DataFrame, dim_customers: DataFrame,
                           order_items: DataFrame) -> DataFrame:
    """D10 page 3: mean CLV, new customers, unique products, items sold,
    items per order."""
    c = dim_customers.agg(mean("lifetime_value").alias("avg_clv"),
                          F.count_if(F.col("customer_segment") == "New").alias("new_customers"))
    # items per order first: orders and items are counted from one row per order
    per_order = order_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_sf_n"))
    i = per_order.agg(F.coalesce(F.sum("_sf_n"), F.lit(0)).alias("items_sold"),
                      F.count("order_id").alias("orders_with_items"))
    p = order_items.agg(F.count_distinct("product_id").alias("unique_products"))
    j = _one_row_pair(_one_row_pair(c, i), p)
    return j.select("avg_clv", "new_customers", "unique_products", "items_sold",
                    F.try_divide(F.col("items_sold").cast("double"),
                                 F.col("orders_with_items").cast("double")).alias("items_per_order"))


def revenue_by_geography(fact: DataFrame, dim_customers: DataFrame,
                         level: str = "customer_state") -> DataFrame:
    """Revenue, orders and customers by state or region (pre-aggregated
    on customer_key, so each customer counts once)."""
    per_key = _by_key(fact, "customer_key")
    j = per_key.join(dim_customers.select("customer_key", level), "customer_key", "inner")
    return (j.groupBy(level)
            .agg(F.sum("_sf_revenue").alias("revenue"),
                 F.sum("_sf_orders").alias("orders"),
                 F.count(F.lit(1)).alias("customers"))
            .orderBy(F.col("revenue").desc(), F.col(level).asc_nulls_first()))


# ---------------------------------------------------- documented options
def delivery_class(orders: DataFrame, very_late_days: int = 7) -> DataFrame:
    """Not Delivered / Very Late / Late / On-Time, most severe first.
    Late compares exact timestamps (delivered after estimated).  Input: the
    order grain of ``facts.order_measures`` (it keeps the estimated date)."""
    status = F.col("order_status")
    delivered = F.col("order_delivered_customer_date")
    cls = (F.when(F.coalesce(status != "delivered", F.lit(True)) | delivered.isNull(),
                  "Not Delivered")
           .when(F.col("delivery_delay_days") > very_late_days, "Very Late")
           .when(delivered > F.col("order_estimated_delivery_date"), "Late")
           .otherwise("On-Time"))
    return orders.withColumn("delivery_class", cls)


def price_outliers(order_items: DataFrame, q: float = 0.99) -> DataFrame:
    """Flag items priced above the q-quantile; rows are kept.  The
    quantile comes from narrowing histograms (one row), attached by a
    broadcast join on a constant key."""
    from starforge.operators.quantile import exact_percentiles
    cut = exact_percentiles(order_items, "price", {"_sf_cut": q})
    j = _one_row_pair(order_items, cut)
    return j.withColumn("is_outlier", F.coalesce(F.col("price").cast("double") > F.col("_sf_cut"),
                                                 F.lit(False))).drop("_sf_cut")


def delivery_outliers(orders: DataFrame, max_days: int = 90) -> DataFrame:
    """D3: drop rows with negative delivery days, flag more than max_days."""
    return (orders.where(~(F.coalesce(F.col("delivery_days"), F.lit(0)) < 0))
            .withColumn("is_delivery_outlier",
                        F.coalesce(F.col("delivery_days") > max_days, F.lit(False))))


def undelivered_handling(orders: DataFrame) -> DataFrame:
    """Drop canceled / unavailable orders, flag shipped ones in transit."""
    st = F.col("order_status")
    return (orders.where(~F.coalesce(st.isin("canceled", "unavailable"), F.lit(False)))
            .withColumn("in_transit", F.coalesce(st == "shipped", F.lit(False))))
