"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the warehouse, each reading the driver tables of ``sf_dir``
through the fixture views (FIXTURES.md) with the fixture rules.

``COVERS`` maps every query to the operator IDs it exercises.  Outputs are
made oracle-friendly by ``for_oracle``: DECIMAL money becomes DOUBLE (exact
for 2-place values) and the run time stamps are dropped.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators import profile, quality
from starforge.operators.keys import keep_first
from starforge.operators.validate import unmapped_keys, validate
from starforge.plans import catalog_loads, cohort, dims, facts, reports
from starforge.plans.dims import customer_metrics, dim_customers
from starforge.plans.pipeline import build, fetch, write
from starforge.rules import FIXTURE_RULES
from starforge.schemas import MAX_LENGTHS, TARGETS, UNIQUE_KEYS
from starforge.session import ensure_checkpoint_dir, scratch_path
from starforge.sinks import csv_writer
from starforge.sources.csv import read_csv_table
from starforge.sources.fixtures import Sources, driver_table, fixture_view, load_fixture_sources

RULES = FIXTURE_RULES
RETENTION_SINCE = "1999-01-01"   # B3 cut-off inside the fixture calendar (1995-2001)

_lock = threading.Lock()
_built: dict = {}


def for_oracle(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in ("created_at", "updated_at"):
            continue
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return load_fixture_sources(spark, sf_dir)


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The built tables for ``sf_dir``, built and written once per session; the
    DataFrames read what was written."""
    ensure_checkpoint_dir(spark)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _built:
            out = scratch_path(spark, "warehouse")
            tables = build(spark, sources(spark, sf_dir), RULES)
            write(tables, out)
            _built[key] = {name: spark.read.schema(df.schema).parquet(f"{out}/{name}")
                           for name, df in tables.items()}
        return _built[key]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_products as ``warehouse`` builds it, read from what was written, without the tables that it does not need."""
    ensure_checkpoint_dir(spark)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key in _built:
            return _built[key]["dim_products"]
        if (key, "dim_products") not in _built:
            source = fixture_view(spark, sf_dir, "src_products")
            table = dims.dim_products(source, RULES)
            out = write({"dim_products": table}, scratch_path(spark, "products"))["dim_products"]
            _built[key, "dim_products"] = spark.read.schema(table.schema).parquet(out)
        return _built[key, "dim_products"]


def _t(name):
    return lambda spark, sf: for_oracle(warehouse(spark, sf)[name])


# ----------------------------------------------------------------- tables
def q_quarantine(spark, sf):
    s = sources(spark, sf)
    return facts.fact_quarantine(s.orders, s.reviews)


def q_items_agg(spark, sf):
    return for_oracle(facts.order_items_agg(sources(spark, sf).order_items))


def q_payments_agg(spark, sf):
    return for_oracle(facts.payments_agg(sources(spark, sf).payments))


def _csv_roundtrip(view_attr: str, table: str, multiline: bool = False):
    def run(spark, sf):
        df = getattr(sources(spark, sf), view_attr)
        path = scratch_path(spark, f"csv-{table}")
        csv_writer(df.write.mode("overwrite")).csv(path)
        return for_oracle(read_csv_table(spark, path, table, multiline=multiline))
    return run


def q_warehouse_readback(spark, sf):
    """K1 + K7 + S8/S9 + K9: write the six tables, read them back, count."""
    from starforge.sinks import row_counts
    out = scratch_path(spark, "warehouse")
    paths = write(warehouse(spark, sf), out)
    back = {n: spark.read.parquet(p) for n, p in paths.items()}
    return row_counts(back)


def q_load(spark, sf):
    """K2 + K4 + K5 + K6 + K9: load the built tables into an empty warehouse
    (dimensions after their key checks, the fact through the valid /
    quarantine split, the cohort after its unique check), then count."""
    from starforge.schemas import UNIQUE_KEYS as UK
    from starforge.sinks import load_cohort, load_dimension, load_fact_orders, row_counts
    w = warehouse(spark, sf)
    out = scratch_path(spark, "load")
    for dim in ("dim_date", "dim_products", "dim_payment_type", "dim_customers"):
        load_dimension(w[dim], f"{out}/{dim}", list(UK[dim][0]))
    load_fact_orders(w["fact_orders"], f"{out}/fact_orders", f"{out}/fact_orders_quarantine")
    load_cohort(w["fact_cohort_retention"], f"{out}/fact_cohort_retention")
    names = ["dim_date", "dim_products", "dim_payment_type", "dim_customers", "fact_orders",
             "fact_cohort_retention", "fact_orders_quarantine"]
    return row_counts({n: spark.read.parquet(f"{out}/{n}") for n in names})


def q_bom_export(spark, sf):
    """K3: export the six tables as CSV files that start with a UTF-8 byte
    order mark, read them back (the reader drops the mark) and count."""
    from starforge.sinks import row_counts, write_csv_bom
    w = warehouse(spark, sf)
    out = scratch_path(spark, "export")
    back = {}
    for name in ("dim_date", "dim_products", "dim_payment_type", "dim_customers",
                 "fact_orders", "fact_cohort_retention"):
        path = write_csv_bom(w[name], f"{out}/{name}")
        back[name] = spark.read.option("header", True).option("escape", '"').csv(path)
    return row_counts(back)


def q_adhoc_sql(spark, sf):
    """Ad-hoc SQL with named parameters over the warehouse tables."""
    return fetch(warehouse(spark, sf),
                 "SELECT order_status, COUNT(*) AS orders, CAST(SUM(order_total_value) AS DOUBLE) AS revenue"
                 " FROM {fact_orders} WHERE order_total_value >= :min_value GROUP BY order_status",
                 {"min_value": 100000})


# ---------------------------------------------------------------- reports
def _w(spark, sf, *names):
    w = warehouse(spark, sf)
    return [w[n] for n in names]


def q_b1(spark, sf):
    f, c = _w(spark, sf, "fact_orders", "dim_customers")
    return for_oracle(reports.top_customers_by_revenue(f, c))


def q_b2(spark, sf):
    f, d = _w(spark, sf, "fact_orders", "dim_date")
    return for_oracle(reports.monthly_revenue(f, d))


def q_b3(spark, sf):
    (r,) = _w(spark, sf, "fact_cohort_retention")
    return for_oracle(reports.retention_since(r, RETENTION_SINCE))


def q_b4(spark, sf):
    f, p = _w(spark, sf, "fact_orders", "dim_products")
    return for_oracle(reports.category_segment_performance(f, p))


def q_b5(spark, sf):
    return for_oracle(reports.revenue_metrics(*_w(spark, sf, "fact_orders")))


def q_b6(spark, sf):
    return reports.delivery_performance(*_w(spark, sf, "fact_orders"))


def q_b7(spark, sf):
    return reports.status_counts(*_w(spark, sf, "fact_orders"))


def _order_grain(spark, sf):
    s = sources(spark, sf)
    return facts.order_measures(s.orders, s.order_items, s.payments, s.reviews)


def q_b8(spark, sf):
    (f,) = _w(spark, sf, "fact_orders")
    return for_oracle(reports.build_metrics(
        reports.fanout_weights(f, sources(spark, sf).reviews)))


def q_b8_reviews(spark, sf):
    s = sources(spark, sf)
    return reports.review_fanout_metrics(s.orders, s.reviews)


def q_b9_clv(spark, sf):
    return for_oracle(reports.clv_stats(*_w(spark, sf, "dim_customers")))


def q_b9_regions(spark, sf):
    return reports.distribution(*_w(spark, sf, "dim_customers"), "customer_region")


def q_b9_segments(spark, sf):
    return reports.distribution(*_w(spark, sf, "dim_customers"), "customer_segment")


def q_b10(spark, sf):
    return reports.calendar_summary(*_w(spark, sf, "dim_date"))


def q_b10_years(spark, sf):
    return reports.days_per_year(*_w(spark, sf, "dim_date"))


def q_b11(spark, sf):
    return cohort.cohort_insights(*_w(spark, sf, "fact_cohort_retention"))


def q_b11_offsets(spark, sf):
    return cohort.retention_by_offset(*_w(spark, sf, "fact_cohort_retention"))


def q_b12(spark, sf):
    return reports.fk_null_coverage(*_w(spark, sf, "fact_orders"))


def q_d10_sales(spark, sf):
    return for_oracle(reports.kpi_sales(*_w(spark, sf, "fact_orders", "dim_customers")))


def q_d10_delivery(spark, sf):
    return reports.kpi_delivery(*_w(spark, sf, "fact_orders"))


def q_d10_customers(spark, sf):
    f, c = _w(spark, sf, "fact_orders", "dim_customers")
    return reports.kpi_customers_products(f, c, sources(spark, sf).order_items)


def q_d11(spark, sf):
    return cohort.retention_heatmap(*_w(spark, sf, "fact_cohort_retention"))


def q_d12_state(spark, sf):
    f, c = _w(spark, sf, "fact_orders", "dim_customers")
    return for_oracle(reports.revenue_by_geography(f, c, "customer_state"))


def q_d12_region(spark, sf):
    f, c = _w(spark, sf, "fact_orders", "dim_customers")
    return for_oracle(reports.revenue_by_geography(f, c, "customer_region"))


def q_d1(spark, sf):
    d = reports.delivery_class(_order_grain(spark, sf), RULES.very_late_threshold_days)
    return d.groupBy("delivery_class").agg(F.count(F.lit(1)).alias("orders"))


def q_d2(spark, sf):
    flagged = reports.price_outliers(sources(spark, sf).order_items, RULES.price_outlier_quantile)
    return flagged.agg(F.count(F.lit(1)).alias("items"),
                       F.count_if("is_outlier").alias("outliers"))


def q_d3(spark, sf):
    d = reports.delivery_outliers(_order_grain(spark, sf), RULES.delivery_outlier_days)
    return d.agg(F.count(F.lit(1)).alias("orders"),
                 F.count_if("is_delivery_outlier").alias("delivery_outliers"))


def q_d4(spark, sf):
    d = reports.undelivered_handling(_order_grain(spark, sf))
    return d.groupBy("order_status", "in_transit").agg(F.count(F.lit(1)).alias("orders"))


def q_d5(spark, sf):
    return facts.payments_agg(sources(spark, sf).payments, "largest").select(
        "order_id", "payment_type")


def q_d6(spark, sf):
    return facts.order_items_agg(sources(spark, sf).order_items, "most_expensive").select(
        "order_id", "primary_product_id", "seller_id")


def q_d7(spark, sf):
    s = sources(spark, sf)
    return for_oracle(customer_metrics(s.orders, s.order_items, RULES, grain="customer_unique_id",
                                       customers=s.customers))


def q_d9(spark, sf):
    """Orders placed from 1999 on, appended to a fact built from the
    earlier orders: the incremental batch is exactly the unseen order ids."""
    from starforge.sinks import incremental_new_rows
    s = sources(spark, sf)
    before = s.orders.where(F.col("order_purchase_timestamp") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return incremental_new_rows(before, s.orders, "order_id").select(
        "order_id", "customer_id", "order_status")


def q_d9_stream(spark, sf):
    """D9 as a stream: orders land in two files (before 1999, then all
    orders again); an availableNow file-source stream appends each batch's
    unseen order ids to the table.  The result is the loaded table."""
    from starforge.streaming import incremental_append
    s = sources(spark, sf)
    orders = s.orders.select("order_id", "customer_id", "order_status")
    landing = scratch_path(spark, "landing")
    table = scratch_path(spark, "orders_table")
    ckpt = scratch_path(spark, "orders_stream")
    early = s.orders.where(F.col("order_purchase_timestamp") < F.lit("1999-01-01")
                           .cast("timestamp_ntz")).select(*orders.columns)
    early.write.mode("append").parquet(landing)
    incremental_append(spark, landing, orders.schema, table, "order_id", ckpt).awaitTermination()
    orders.write.mode("append").parquet(landing)
    incremental_append(spark, landing, orders.schema, table, "order_id", ckpt).awaitTermination()
    return spark.read.parquet(table)


def q_d8(spark, sf):
    """SCD1 upsert of dim_customers built from orders before 1999 with
    the dimension built from all orders; keys of known customers survive."""
    from starforge.sinks import upsert_scd1
    s = sources(spark, sf)
    early = s.orders.where(F.col("order_purchase_timestamp") < F.lit("1999-01-01").cast("timestamp_ntz"))
    current = dim_customers(s.customers.join(early.select("customer_id").distinct(),
                                             "customer_id", "left_semi"),
                            early, s.order_items, RULES)
    incoming = dim_customers(s.customers, s.orders, s.order_items, RULES)
    merged = upsert_scd1(current, incoming, "customer_id", "customer_key")
    return for_oracle(merged.select("customer_key", "customer_id", "total_orders", "total_spent",
                                    "customer_segment"))


# ---------------------------------------------------------------- quality
def q_q1(spark, sf):
    from starforge.plans.pipeline import TABLE_ORDER
    from starforge.sinks import row_counts
    w = warehouse(spark, sf)
    return row_counts({name: w[name] for name in TABLE_ORDER})


def q_q2_q5(spark, sf):
    w = warehouse(spark, sf)
    f = w["fact_orders"]
    parts = [quality.orphan_check(f, "customer_key", w["dim_customers"], "customer_key"),
             quality.orphan_check(f, "product_key", w["dim_products"], "product_key"),
             quality.orphan_check(f, "order_date_key", w["dim_date"], "date_key"),
             quality.orphan_check(f, "payment_type_key", w["dim_payment_type"], "payment_type_key")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_q6(spark, sf):
    return quality.null_counts(*_w(spark, sf, "fact_orders"),
                               ["customer_key", "product_key", "order_date_key",
                                "payment_type_key", "order_id", "order_total_value"])


def q_q7(spark, sf):
    return quality.null_counts(*_w(spark, sf, "dim_customers"), ["customer_id", "customer_segment"])


def q_q8(spark, sf):
    return quality.value_consistency(*_w(spark, sf, "fact_orders"))


def q_q9(spark, sf):
    return quality.repeated_keys(*_w(spark, sf, "fact_orders"), "order_id")


def q_q10_status(spark, sf):
    return profile.value_counts(*_w(spark, sf, "fact_orders"), "order_status")


def q_q10_orders(spark, sf):
    return quality.business_order_metrics(*_w(spark, sf, "fact_orders"))


def q_q10_segments(spark, sf):
    return quality.segment_summary(*_w(spark, sf, "dim_customers"))


def q_q11_q12(spark, sf):
    w = warehouse(spark, sf)
    out = None
    for table, keys in UNIQUE_KEYS.items():
        for cols in keys:
            one = quality.unique_check(w[table], cols, table)
            out = one if out is None else out.unionByName(one)
    return out


def q_q13_not_null(spark, sf):
    w = warehouse(spark, sf)
    out = None
    for table, schema in TARGETS.items():
        cols = [f.name for f in schema.fields if not f.nullable]
        one = quality.not_null_check(w[table], cols, table)
        out = one if out is None else out.unionByName(one)
    return out


def q_q13_lengths(spark, sf):
    w = warehouse(spark, sf)
    out = None
    for table, limits in MAX_LENGTHS.items():
        one = quality.max_length_check(w[table], limits, table)
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------- validation
def _v(attr, table):
    return lambda spark, sf: validate(getattr(sources(spark, sf), attr), table)


def q_v7(spark, sf):
    return unmapped_keys(*_w(spark, sf, "fact_orders"))


def q_v3_top_states(spark, sf):
    return profile.value_counts(sources(spark, sf).customers, "customer_state", 5)


def q_v4_weight(spark, sf):
    p = sources(spark, sf).products
    return profile.numeric_summary(p, "product_weight_g")


def q_v4_volume(spark, sf):
    from starforge.plans.dims import enrich_products
    p = enrich_products(sources(spark, sf).products, RULES)
    return for_oracle(profile.numeric_summary(p, "product_volume_cm3",
                                              F.col("product_volume_cm3") > 0))


def q_v4_top_categories(spark, sf):
    return profile.value_counts(sources(spark, sf).products, "product_category_name", 5)


def q_v5_types(spark, sf):
    return profile.value_counts(sources(spark, sf).payments, "payment_type")


def q_v5_installments(spark, sf):
    return profile.numeric_summary(sources(spark, sf).payments, "payment_installments")


def q_v5_multi(spark, sf):
    return profile.multi_row_groups(sources(spark, sf).payments, "order_id")


def q_v6_scores(spark, sf):
    r = sources(spark, sf).reviews
    return profile.value_counts(r, "review_score")


def q_v6_sentiment(spark, sf):
    from starforge.functions.scalars import review_sentiment
    r = sources(spark, sf).reviews.withColumn("sentiment", review_sentiment())
    return profile.value_counts(r, "sentiment")


# --------------------------------------------------- driver-table profiles
def q_a6(spark, sf):
    return profile.distinct_values(driver_table(spark, sf, "orders"), "o_orderstatus")


def q_a7(spark, sf):
    return profile.distinct_count(driver_table(spark, sf, "orders"),
                                  ["o_custkey", "o_orderstatus", "o_orderpriority"])


def q_a8(spark, sf):
    return profile.value_counts(driver_table(spark, sf, "part"), "p_type")


def q_a9(spark, sf):
    return profile.multi_row_groups(driver_table(spark, sf, "lineitem"), "l_orderkey")


def q_a10(spark, sf):
    o = driver_table(spark, sf, "orders").select(
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    return for_oracle(profile.numeric_summary(o, "o_totalprice"))


def q_a11(spark, sf):
    li = driver_table(spark, sf, "lineitem")
    return profile.describe(li.select(F.col("l_quantity").cast("decimal(12,2)").alias("l_quantity")), "l_quantity")


def q_a16(spark, sf):
    e = driver_table(spark, sf, "events")
    return quality.null_counts(e, e.columns)


def q_o2(spark, sf):
    (c,) = _w(spark, sf, "dim_customers")
    return for_oracle(c.select("customer_key", "customer_id", "lifetime_value")
                      .orderBy(F.col("lifetime_value").desc(), "customer_key").limit(10))


def q_o5(spark, sf):
    (p,) = _w(spark, sf, "dim_products")
    w = Window.partitionBy("product_category_segment").orderBy("product_key")
    return (p.withColumn("rank_in_segment", F.row_number().over(w))
            .where(F.col("rank_in_segment") <= 3)
            .select("product_category_segment", "rank_in_segment", "product_key", "product_id"))


def q_o5_calendar_ends(spark, sf):
    """First and last 10 days of the calendar."""
    (d,) = _w(spark, sf, "dim_date")
    first = d.orderBy("full_date").limit(10).select("date_key", "full_date", F.lit("head").alias("part"))
    last = d.orderBy(F.col("full_date").desc()).limit(10).select("date_key", "full_date",
                                                                  F.lit("tail").alias("part"))
    return first.unionByName(last)


def q_o5_first_cohort(spark, sf):
    """All rows of the first cohort (filter on the smallest month,
    found by an aggregate, attached by a one-row broadcast join)."""
    (r,) = _w(spark, sf, "fact_cohort_retention")
    first = r.agg(F.min("cohort_month").alias("_sf_first"))
    j = reports._one_row_pair(r, first).where(F.col("cohort_month") == F.col("_sf_first"))
    return for_oracle(j.drop("_sf_first"))


def q_w5(spark, sf):
    """W5 / K6 on a raw table: first row per (l_orderkey, l_linenumber) kept,
    the other rows quarantined; returns the rejects per reason."""
    li = driver_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                    "l_suppkey", "l_quantity")
    kept, rejects = keep_first(li, ["l_orderkey", "l_linenumber"],
                               ["l_partkey", "l_suppkey", "l_quantity"])
    k = kept.agg(F.count(F.lit(1)).alias("kept_rows"))
    r = rejects.agg(F.count(F.lit(1)).alias("rejected_rows"))
    return reports._one_row_pair(k, r)


QUERIES = {
    "dim_date": _t("dim_date"),
    "dim_products": _t("dim_products"),
    "dim_payment_type": _t("dim_payment_type"),
    "dim_customers": _t("dim_customers"),
    "fact_orders": _t("fact_orders"),
    "fact_cohort_retention": _t("fact_cohort_retention"),
    "a1_order_items_agg": q_items_agg,
    "a2_payments_agg": q_payments_agg,
    "k6_quarantine": q_quarantine,
    "s1_orders_csv": _csv_roundtrip("orders", "orders"),
    "s2_order_items_csv": _csv_roundtrip("order_items", "order_items"),
    "s3_customers_csv": _csv_roundtrip("customers", "customers"),
    "s4_products_csv": _csv_roundtrip("products", "products"),
    "s5_payments_csv": _csv_roundtrip("payments", "payments"),
    "s6_reviews_csv": _csv_roundtrip("reviews", "reviews", multiline=True),
    "s8_s9_warehouse_readback": q_warehouse_readback,
    "s11_adhoc_sql": q_adhoc_sql,
    "k2_k4_k5_load": q_load,
    "k3_bom_csv_export": q_bom_export,
    "b1_top_customers": q_b1,
    "b2_monthly_revenue": q_b2,
    "b3_retention_since": q_b3,
    "b4_category_segments": q_b4,
    "b5_revenue_metrics": q_b5,
    "b6_delivery_performance": q_b6,
    "b7_status_top5": q_b7,
    "b8_build_metrics": q_b8,
    "b8_review_metrics": q_b8_reviews,
    "b9_clv_stats": q_b9_clv,
    "b9_region_distribution": q_b9_regions,
    "b9_segment_distribution": q_b9_segments,
    "b10_calendar_summary": q_b10,
    "b10_days_per_year": q_b10_years,
    "b11_cohort_insights": q_b11,
    "b11_retention_by_offset": q_b11_offsets,
    "b12_fk_null_coverage": q_b12,
    "d1_delivery_class": q_d1,
    "d2_price_outliers": q_d2,
    "d3_delivery_outliers": q_d3,
    "d4_undelivered": q_d4,
    "d5_largest_payment_type": q_d5,
    "d6_most_expensive_product": q_d6,
    "d7_person_grain": q_d7,
    "d8_scd1_upsert": q_d8,
    "d9_incremental_orders": q_d9,
    "d9_incremental_stream": q_d9_stream,
    "d10_kpi_sales": q_d10_sales,
    "d10_kpi_delivery": q_d10_delivery,
    "d10_kpi_customers_products": q_d10_customers,
    "d11_retention_heatmap": q_d11,
    "d12_revenue_by_state": q_d12_state,
    "d12_revenue_by_region": q_d12_region,
    "q1_row_counts": q_q1,
    "q2_q5_orphans": q_q2_q5,
    "q6_fact_nulls": q_q6,
    "q7_customer_nulls": q_q7,
    "q8_consistency": q_q8,
    "q9_duplicate_orders": q_q9,
    "q10_status_share": q_q10_status,
    "q10_order_metrics": q_q10_orders,
    "q10_segments": q_q10_segments,
    "q11_q12_unique_keys": q_q11_q12,
    "q13_not_null": q_q13_not_null,
    "q13_max_lengths": q_q13_lengths,
    "v1_orders": _v("orders", "orders"),
    "v2_order_items": _v("order_items", "order_items"),
    "v3_customers": _v("customers", "customers"),
    "v4_products": _v("products", "products"),
    "v5_payments": _v("payments", "payments"),
    "v6_reviews": _v("reviews", "reviews"),
    "v7_unmapped_keys": q_v7,
    "v3_top_states": q_v3_top_states,
    "v4_weight_stats": q_v4_weight,
    "v4_volume_stats": q_v4_volume,
    "v4_top_categories": q_v4_top_categories,
    "v5_payment_types": q_v5_types,
    "v5_installments": q_v5_installments,
    "v5_multi_payment_orders": q_v5_multi,
    "v6_score_distribution": q_v6_scores,
    "v6_sentiment": q_v6_sentiment,
    "a6_distinct_statuses": q_a6,
    "a7_distinct_counts": q_a7,
    "a8_part_type_counts": q_a8,
    "a9_multi_line_orders": q_a9,
    "a10_totalprice_summary": q_a10,
    "a11_describe_quantity": q_a11,
    "a16_event_nulls": q_a16,
    "o2_top_clv": q_o2,
    "o5_first_products_per_segment": q_o5,
    "w5_k6_lineitem_duplicates": q_w5,
    "o5_calendar_head_tail": q_o5_calendar_ends,
    "o5_first_cohort": q_o5_first_cohort,
}

COVERS = {
    "dim_date": "S10 F4 F5 F6 F7 F25 P2 P9 K8",
    "dim_products": "S4 P1 P5 F2 F3 F17 F18 F25 J12 J13 U4 W2",
    "dim_payment_type": "A6 F19 F25 J12 W2",
    "dim_customers": "A3 A4 J1 J2 P3 P6 P7 F1 F8 F12 F13 F14 F15 F16 F25 U1 U2 U3 W2 W4",
    "fact_orders": "A1 A2 J3 J4 J5 J6 J7 J8 J9 P6 F8 F9 F10 F11 F22 F25 W2 W3 K6 K8",
    "fact_cohort_retention": "A5 J10 J11 F20 F21 W2 W4 O1 U5 P4",
    "a1_order_items_agg": "A1 W3", "a2_payments_agg": "A2 W3",
    "k6_quarantine": "J5 K4 K6 W5",
    "s1_orders_csv": "S1 S7", "s2_order_items_csv": "S2 F1", "s3_customers_csv": "S3",
    "s4_products_csv": "S4", "s5_payments_csv": "S5", "s6_reviews_csv": "S6 S7",
    "s8_s9_warehouse_readback": "K1 K7 S8 S9 K9 A15", "s11_adhoc_sql": "S11",
    "k2_k4_k5_load": "K2 K4 K5 K6 K9 Q11 Q12",
    "k3_bom_csv_export": "K3 K9",
    "b1_top_customers": "B1 J15 O2 O4",
    "b2_monthly_revenue": "B2 J15 O4",
    "b3_retention_since": "B3 P8 O1",
    "b4_category_segments": "B4 J15 O4",
    "b5_revenue_metrics": "B5 A10 A12",
    "b6_delivery_performance": "B6 A12 F27",
    "b7_status_top5": "B7 O4",
    "b8_build_metrics": "B8 J5 A12 F27",
    "b8_review_metrics": "B8 J5 F27",
    "b9_clv_stats": "B9 A10",
    "b9_region_distribution": "B9 A8 W1",
    "b9_segment_distribution": "B9 A8 W1",
    "b10_calendar_summary": "B10 A12",
    "b10_days_per_year": "B10 A8",
    "b11_cohort_insights": "B11 A14",
    "b11_retention_by_offset": "B11 A13",
    "b12_fk_null_coverage": "B12 V7 A12",
    "d1_delivery_class": "D1", "d2_price_outliers": "D2", "d3_delivery_outliers": "D3",
    "d4_undelivered": "D4", "d5_largest_payment_type": "D5", "d6_most_expensive_product": "D6",
    "d7_person_grain": "D7", "d8_scd1_upsert": "D8", "d9_incremental_orders": "D9",
    "d9_incremental_stream": "D9",
    "d10_kpi_sales": "D10", "d10_kpi_delivery": "D10 F27", "d10_kpi_customers_products": "D10",
    "d11_retention_heatmap": "D11", "d12_revenue_by_state": "D12", "d12_revenue_by_region": "D12",
    "q1_row_counts": "Q1 A15 K9", "q2_q5_orphans": "Q2 Q3 Q4 Q5 J14",
    "q6_fact_nulls": "Q6 A12 F27", "q7_customer_nulls": "Q7 A12", "q8_consistency": "Q8 A12",
    "q9_duplicate_orders": "Q9 A9",
    "q10_status_share": "Q10 W1 A8", "q10_order_metrics": "Q10 A12 F27",
    "q10_segments": "Q10 A8",
    "q11_q12_unique_keys": "Q11 Q12",
    "q13_not_null": "Q13", "q13_max_lengths": "Q13 F23",
    "v1_orders": "V1 W5 A7", "v2_order_items": "V2 P10", "v3_customers": "V3 F23 P10 A7",
    "v4_products": "V4 P10", "v5_payments": "V5 P10", "v6_reviews": "V6 P10 W5",
    "v7_unmapped_keys": "V7",
    "v3_top_states": "V3 O3", "v4_top_categories": "V4 O3", "v4_weight_stats": "V4 A10",
    "v4_volume_stats": "V4 A10", "v5_payment_types": "V5 A8", "v5_installments": "V5 A10",
    "v5_multi_payment_orders": "V5 A9",
    "v6_score_distribution": "V6 A8", "v6_sentiment": "V6 F24",
    "a6_distinct_statuses": "A6", "a7_distinct_counts": "A7", "a8_part_type_counts": "A8 W1",
    "a9_multi_line_orders": "A9", "a10_totalprice_summary": "A10", "a11_describe_quantity": "A11",
    "a16_event_nulls": "A16",
    "o2_top_clv": "O2", "o5_first_products_per_segment": "O5",
    "o5_calendar_head_tail": "O5", "o5_first_cohort": "O5 P8",
    "w5_k6_lineitem_duplicates": "W5 K6",
}

# SURVEY IDs exercised by unit tests rather than a registered query.
TESTED_ONLY: dict[str, str] = {}

QUERIES |= catalog_loads.QUERIES
COVERS |= catalog_loads.COVERS
