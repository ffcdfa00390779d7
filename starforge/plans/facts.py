"""fact_orders: one row per order with item, payment, review, delivery
measures and surrogate keys to the four dimensions.

Plan shape (all keyed joins are 1:1 because every side is aggregated to the
order grain first, so no join multiplies rows):

    orders (+customer_key) --dedupe by order_id-->
        (+) items agg (+product_key) (+) payments agg (+) first review
        (+) order_key, numbered on the ids alone
        -> payment-type key (tiny side), date keys (computed, no join)

The customer and product lookups are plain joins on the narrow inputs; AQE
broadcasts a side at run time when its real size is small.

The aggregations on order_id leave the data hash-partitioned by order_id, so
the three order_id joins reuse one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.functions.dates import date_key, whole_days_between
from starforge.functions.scalars import MONEY, is_completed, item_total, positive_flag
from starforge.operators.keys import extra_rows, number_ids
from starforge.operators.lookup import key_lookup
from starforge.rules import NO_PAYMENT_TYPE, Rules
from starforge.schemas import TARGETS, conform, flag_unfit, unfit_rows

ITEM_ORDER = ("order_item_id", "product_id", "seller_id", "price", "freight_value")
PAYMENT_ORDER = ("payment_sequential", "payment_type", "payment_value", "payment_installments")
REVIEW_ORDER = ("review_creation_date", "review_id", "review_score")
ORDER_COLUMNS = ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                 "order_delivered_customer_date", "order_estimated_delivery_date")


def _zero(x) -> F.Column:
    return F.coalesce(x, F.lit(0).cast(MONEY))


def order_items_agg(order_items: DataFrame, primary: str = "first") -> DataFrame:
    """A1: items -> order.  primary='first' (W3, lowest item tuple) or
    'most_expensive' (D6, highest price, ties by item tuple).

    The tuple is carried only as far as the two ids that are picked: rows that are equal up to
    there give the same ids."""
    rank = [F.col(x) for x in ITEM_ORDER[:3]]
    if primary == "most_expensive":
        rank = [(-F.coalesce(F.col("price"), F.lit(0))).alias("_sf_price"), *rank]
    agg = order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("order_item_count"),
        _zero(F.sum("price")).alias("order_subtotal"),
        _zero(F.sum("freight_value")).alias("order_freight_total"),
        _zero(F.sum(item_total())).alias("order_total_value"),
        F.min(F.struct(*rank)).alias("_sf_first"))
    return agg.select("order_id", "order_item_count", "order_subtotal", "order_freight_total",
                      "order_total_value", F.col("_sf_first.product_id").alias("primary_product_id"),
                      F.col("_sf_first.seller_id").alias("seller_id"))


def payments_agg(payments: DataFrame, primary: str = "first") -> DataFrame:
    """A2: payments -> order.  primary='first' (lowest sequence tuple) or
    'largest' (D5, highest value, ties by sequence tuple)."""
    rank = [F.col(c) for c in PAYMENT_ORDER[:2]]     # as far as the type that is picked
    if primary == "largest":
        rank = [(-F.coalesce(F.col("payment_value"), F.lit(0))).alias("_sf_value"), *rank]
    ptype = F.min(F.struct(*rank))["payment_type"]
    return payments.groupBy("order_id").agg(
        _zero(F.sum("payment_value")).alias("payment_value"),
        ptype.alias("payment_type"),
        F.max("payment_installments").alias("payment_installments"))


def reviews_agg(reviews: DataFrame) -> DataFrame:
    """J5 reduced to the order grain: the first review's score (the row K6
    keeps) and the number of review rows the plain left join would fan out."""
    return reviews.groupBy("order_id").agg(
        F.min(F.struct(*REVIEW_ORDER))["review_score"].alias("review_score"),
        F.count(F.lit(1)).alias("review_rows"))


KEY_COLUMNS = ("customer_key", "product_key")


def unique_orders(orders: DataFrame) -> DataFrame:
    """Orders with a non-NULL, unique order_id (K6 on the order source).
    A customer_key already looked up on the order rows is carried along."""
    cols = [c for c in ORDER_COLUMNS + ("customer_key",) if c in orders.columns]
    best = (orders.where(F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(F.min(F.struct(*[F.col(c) for c in cols if c != "order_id"])).alias("_sf_o")))
    # keep the grouping column itself (not the struct's copy), so the output
    # stays known as hash-partitioned by order_id and the joins that follow
    # do not shuffle the orders again
    return best.select("order_id", *[F.col(f"_sf_o.{c}").alias(c) for c in cols if c != "order_id"])


def order_measures(orders: DataFrame, order_items: DataFrame, payments: DataFrame,
                   reviews: DataFrame, primary_product: str = "first",
                   primary_payment: str = "first", items_agg: DataFrame | None = None,
                   payments_by_order: DataFrame | None = None) -> DataFrame:
    """J3, J4, J5 + P6 + F8-F11: order grain, no surrogate keys yet.
    ``items_agg`` / ``payments_by_order``: already materialised ``order_items_agg`` and
    ``payments_agg`` results."""
    items = items_agg if items_agg is not None else order_items_agg(order_items, primary_product)
    paid = payments_by_order if payments_by_order is not None else payments_agg(payments, primary_payment)
    f = (unique_orders(orders)
         .join(items, "order_id", "left")
         .join(paid, "order_id", "left")
         .join(reviews_agg(reviews), "order_id", "left"))
    delivered, purchased = "order_delivered_customer_date", "order_purchase_timestamp"
    delay = whole_days_between(delivered, "order_estimated_delivery_date")
    return f.select(
        *ORDER_COLUMNS,
        F.coalesce("order_item_count", F.lit(0)).alias("order_item_count"),
        _zero(F.col("order_subtotal")).alias("order_subtotal"),
        _zero(F.col("order_freight_total")).alias("order_freight_total"),
        _zero(F.col("order_total_value")).alias("order_total_value"),
        "primary_product_id", "seller_id",
        _zero(F.col("payment_value")).alias("payment_value"),
        F.coalesce("payment_installments", F.lit(1)).alias("payment_installments"),
        F.coalesce("payment_type", F.lit(NO_PAYMENT_TYPE)).alias("payment_type"),
        "review_score",
        F.col("review_score").isNotNull().alias("has_review"),
        F.coalesce("review_rows", F.lit(0)).alias("review_rows"),
        F.coalesce(whole_days_between(delivered, purchased), F.lit(0)).alias("delivery_days"),
        whole_days_between("order_estimated_delivery_date", purchased)
        .alias("estimated_delivery_days"),
        F.coalesce(delay, F.lit(0)).alias("delivery_delay_days"),
        positive_flag(delay).alias("is_late_delivery"),
        is_completed().alias("is_completed_order"),
        *[c for c in KEY_COLUMNS if c in f.columns])


def calendar_key(ts, rules: Rules) -> F.Column:
    """J9 without a join: the date dimension holds every day of the rules'
    calendar, so the lookup of to_date(ts) is its YYYYMMDD key when the day is
    inside the calendar and NULL outside it."""
    d = F.to_date(F.col(ts))
    inside = (d >= F.lit(rules.calendar_start)) & (d <= F.lit(rules.calendar_end))
    return F.when(inside, date_key(d))


def attach_keys(f: DataFrame, dim_customers: DataFrame, dim_products: DataFrame,
                dim_payment_type: DataFrame, rules: Rules) -> DataFrame:
    """J6-J9 on an order-grain table: surrogate keys not yet present are
    looked up; unmatched business keys give NULL keys (V7)."""
    if "customer_key" not in f.columns:
        f = key_lookup(f, "customer_id", dim_customers, "customer_id", "customer_key",
                       "customer_key")
    if "product_key" not in f.columns:
        f = key_lookup(f, "primary_product_id", dim_products, "product_id", "product_key",
                       "product_key")
    f = key_lookup(f, "payment_type", dim_payment_type, "payment_type", "payment_type_key",
                   "payment_type_key")
    return (f.withColumn("order_date_key", calendar_key("order_purchase_timestamp", rules))
             .withColumn("delivery_date_key", calendar_key("order_delivered_customer_date", rules)))


def unfit_orders(*aggregates: DataFrame) -> DataFrame:
    """Rejected values of the order-level aggregates: sums that ``fact_orders`` can't hold.
    The aggregates are read once more, so they should be staged."""
    out = None
    for agg in aggregates:
        one = unfit_rows(flag_unfit(agg, TARGETS["fact_orders"]), "fact_orders", "order_id")
        out = one if out is None else out.unionByName(one)
    return out


def fact_orders(orders: DataFrame, order_items: DataFrame, payments: DataFrame,
                reviews: DataFrame, dim_customers: DataFrame, dim_products: DataFrame,
                dim_payment_type: DataFrame, rules: Rules, created_at=None,
                primary_product: str = "first", primary_payment: str = "first",
                items_agg: DataFrame | None = None, payments_by_order: DataFrame | None = None,
                rejected: DataFrame | None = None, after: int = 0) -> DataFrame:
    """The key lookups that need a shuffle run on the narrow inputs, not on
    the 25-column fact: customer_key on the order rows (before they are
    de-duplicated on order_id), product_key on the order-level item
    aggregate.  order_key is numbered on the ids alone (``number_ids``) and joined
    back, so the fact itself is only shuffled by order_id, with joins that are all
    co-partitioned, and is never sorted or staged.

    ``rejected``: orders of ``unfit_orders`` are left out and take no key.
    """
    from starforge.plans.dims import run_timestamp
    o = key_lookup(orders.select(*[c for c in ORDER_COLUMNS if c in orders.columns]),
                   "customer_id", dim_customers, "customer_id", "customer_key", "customer_key")
    items = items_agg if items_agg is not None else order_items_agg(order_items, primary_product)
    items = key_lookup(items, "primary_product_id", dim_products, "product_id", "product_key",
                       "product_key")
    ids = orders.select("order_id")
    if rejected is not None:
        ids = ids.join(rejected.where("table_name = 'fact_orders'")
                       .select(F.col("business_key").alias("order_id")), "order_id", "left_anti")
    numbered = number_ids(ids, "order_id", "order_key", after)
    f = order_measures(o, order_items, payments, reviews, primary_product, primary_payment, items,
                       payments_by_order)
    f = attach_keys(f.join(numbered, "order_id"), dim_customers, dim_products, dim_payment_type, rules)
    f = f.withColumn("created_at", created_at if created_at is not None else run_timestamp())
    return conform(f, TARGETS["fact_orders"])


def fact_quarantine(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """K4/K6 rejects: the rows a plain load would refuse.

    * order rows with a NULL or repeated order_id (reason null_key /
      duplicate_order_id);
    * the extra rows a review fan-out (J5) creates for an order with more
      than one review (reason duplicate_order_id_review): one per review
      beyond the kept first one.
    """
    cols = [c for c in ORDER_COLUMNS if c in orders.columns]
    bad_orders = extra_rows(orders.select(*cols), "order_id", cols, "duplicate_order_id")
    r = reviews.select("order_id", "review_id", "review_score", "review_creation_date")
    r = r.join(orders.select("order_id").where(F.col("order_id").isNotNull()).distinct(),
               "order_id", "left_semi")
    extra = extra_rows(r, "order_id", REVIEW_ORDER, "duplicate_order_id_review")
    bad = bad_orders.select("order_id", F.lit(None).cast("string").alias("review_id"),
                            F.lit(None).cast("int").alias("review_score"), "reject_reason")
    return bad.unionByName(extra.select("order_id", "review_id", "review_score", "reject_reason"))
