"""Dimension builders: date, products, payment type, customers.

Each takes DataFrames and Rules and returns a DataFrame in the target schema.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.functions.dates import date_key, iso_weekday, whole_days_between
from starforge.functions.scalars import (cents, customer_segment, item_total, lifetime_value,
                                         positive_flag, product_volume, round_ratio)
from starforge.operators.keys import dense_key, key_and_conform
from starforge.operators.lookup import literal_lookup
from starforge.rules import (DELIVERED, OTHER, UNCATEGORIZED, UNKNOWN_REGION, Rules,
                             first_group_of)
from starforge.schemas import TARGETS, conform
from starforge.sources.calendar import calendar_days


def run_timestamp() -> F.Column:
    """one load time stamp per run, as TIMESTAMP_NTZ."""
    return F.lit(dt.datetime.now().replace(microsecond=0)).cast("timestamp_ntz")


# ---------------------------------------------------------------- dim_date
def date_attributes(days: DataFrame, holidays=()) -> DataFrame:
    """F4-F7, P9 on a ``full_date`` column."""
    d = F.col("full_date")
    hol = [dt.date.fromisoformat(h) for h in holidays]
    flags = days.sparkSession.createDataFrame([(h,) for h in sorted(set(hol))], "h date")
    out = (days.join(F.broadcast(flags), d == F.col("h"), "left")     # the rule list
           .withColumn("is_holiday", F.col("h").isNotNull()).drop("h"))
    return out.select(
        date_key(d).alias("date_key"), d.alias("full_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"), iso_weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), (F.weekday(d) >= 5).alias("is_weekend"),
        F.col("is_holiday"),
        F.year(d).alias("fiscal_year"), F.quarter(d).alias("fiscal_quarter"))


def dim_date(spark: SparkSession, rules: Rules, created_at=None) -> DataFrame:
    days = calendar_days(spark, rules.calendar_start, rules.calendar_end)
    out = date_attributes(days, rules.holidays)
    return conform(out.withColumn("created_at", created_at if created_at is not None
                                  else run_timestamp()), TARGETS["dim_date"])


# ------------------------------------------------------------ dim_products
def enrich_products(products: DataFrame, rules: Rules) -> DataFrame:
    """P5, F2, F3, F17, F18 on the products source (no key yet)."""
    p = products.where(F.col("product_id").isNotNull())
    p = literal_lookup(p, "product_category_name", rules.translations, "product_category_english",
                       default=F.coalesce(F.col("product_category_name"), F.lit(UNCATEGORIZED)))
    p = literal_lookup(p, "product_category_english", first_group_of(rules.category_segments),
                       "product_category_segment", default=F.lit(OTHER))
    return (p.withColumn("product_volume_cm3", product_volume())
             .withColumn("has_photos", positive_flag("product_photos_qty")))


def split_products(products: DataFrame, rules: Rules, created_at=None) -> tuple[DataFrame, DataFrame]:
    """(dim_products, rejected values)."""
    ts = created_at if created_at is not None else run_timestamp()
    return key_and_conform(enrich_products(products, rules), "dim_products",
                           ["product_id", "product_category_name", "product_photos_qty"], "product_key",
                           "product_id", {"created_at": ts})


def dim_products(products: DataFrame, rules: Rules, created_at=None) -> DataFrame:
    return split_products(products, rules, created_at)[0]


# -------------------------------------------------------- dim_payment_type
def dim_payment_type(payments: DataFrame, rules: Rules, created_at=None) -> DataFrame:
    """A6 distinct non-NULL payment types, F19 category, W2 key by type."""
    types = payments.select("payment_type").where(F.col("payment_type").isNotNull()).distinct()
    types = literal_lookup(types, "payment_type", rules.payment_categories, "payment_category",
                           default=F.lit(OTHER))
    keyed = dense_key(types, ["payment_type"], "payment_type_key")
    keyed = keyed.withColumn("created_at", created_at if created_at is not None else run_timestamp())
    return conform(keyed, TARGETS["dim_payment_type"])


# ----------------------------------------------------------- dim_customers
def order_revenue(order_items: DataFrame) -> DataFrame:
    """A3: order_id -> order_total = sum(price + freight)."""
    return (order_items.groupBy("order_id")
            .agg(F.sum(item_total()).alias("order_total")))


def customer_metrics(orders: DataFrame, order_items: DataFrame, rules: Rules,
                     grain: str = "customer_id", customers: DataFrame | None = None,
                     order_totals: DataFrame | None = None) -> DataFrame:
    """J1 + A4 + F8, F12-F14: one row per customer with order metrics.

    grain='customer_id' (default) or 'customer_unique_id' (D7: the person;
    then ``customers`` maps customer_id to the person).  ``order_totals``
    (order_id, order_total) may be passed when the order-level item
    aggregate is already materialised, so lineitems are aggregated once.
    """
    o = orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    if grain != "customer_id":
        # one person per customer_id (the smallest, if the source repeats an id)
        person = customers.groupBy("customer_id").agg(F.min(grain).alias(grain))
        o = o.join(person, "customer_id", "inner").drop("customer_id")
    totals = order_totals if order_totals is not None else order_revenue(order_items)
    o = (o.join(totals, "order_id", "left")
          .withColumn("order_total", F.coalesce("order_total", F.lit(0).cast("decimal(12,2)"))))
    m = o.groupBy(grain).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("order_total").alias("total_spent"),
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        F.count_if(F.col("order_status") == DELIVERED).alias("delivered_orders"))
    raw_days = whole_days_between("last_order_date", "first_order_date")
    m = m.withColumn("days_as_customer", F.when(raw_days.isNotNull(), F.greatest(raw_days, F.lit(1))))
    return m.select(
        grain, "total_orders", "delivered_orders", "total_spent",
        round_ratio(cents("total_spent"), F.col("total_orders") * 100, 2).alias("avg_order_value"),
        lifetime_value("total_spent", "days_as_customer", rules).alias("lifetime_value"),
        "first_order_date", "last_order_date", "days_as_customer",
        round_ratio(F.col("total_orders") * 365, "days_as_customer", 2)
        .alias("purchase_frequency_annual"))


def region_of(df: DataFrame, rules: Rules, state: str = "customer_state",
              out: str = "customer_region") -> DataFrame:
    """NULL -> Unknown, listed -> region (first listed wins), else Other."""
    df = literal_lookup(df, state, first_group_of(rules.regions), out, default=F.lit(OTHER))
    return df.withColumn(out, F.when(F.col(state).isNull(), F.lit(UNKNOWN_REGION))
                         .otherwise(F.col(out)))


def enrich_customers(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                     rules: Rules, order_totals: DataFrame | None = None) -> DataFrame:
    """J2 + P7 + F15 + F16 (no key yet)."""
    m = customer_metrics(orders, order_items, rules, order_totals=order_totals)
    c = customers.join(m, "customer_id", "left")
    none = F.col("total_orders").isNull()
    c = c.select("*", *[F.when(none, F.lit(0)).otherwise(F.col(k)).alias(f"_sf_{k}")
                        for k in ("total_orders", "total_spent", "lifetime_value")])
    for k in ("total_orders", "total_spent", "lifetime_value"):
        c = c.drop(k).withColumnRenamed(f"_sf_{k}", k)
    c = region_of(c, rules)
    return c.withColumn("customer_segment",
                        customer_segment("total_orders", "lifetime_value", rules))


def split_customers(customers: DataFrame, orders: DataFrame, order_items: DataFrame, rules: Rules,
                    created_at=None, order_totals: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(dim_customers, rejected values): a customer whose amounts the table can't hold is rejected,
    and the orders of that customer have no customer_key."""
    ts = created_at if created_at is not None else run_timestamp()
    return key_and_conform(enrich_customers(customers, orders, order_items, rules, order_totals),
                           "dim_customers",
                           ["customer_id", "customer_unique_id", "customer_city", "customer_state"],
                           "customer_key", "customer_id", {"created_at": ts, "updated_at": ts})


def dim_customers(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                  rules: Rules, created_at=None, order_totals: DataFrame | None = None) -> DataFrame:
    return split_customers(customers, orders, order_items, rules, created_at, order_totals)[0]
