"""Build the six warehouse tables and write them.

``build`` returns DataFrames; the keyed dimensions are staged once in the shared
checkpoint folder by ``dense_key``, so later readers (the fact's key lookups, the
cohort) read a materialised table.  ``fact_orders`` is evaluated by whoever writes it:
readers should take the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.plans.cohort import fact_cohort_retention
from starforge.plans.dims import (dim_date, dim_payment_type, run_timestamp, split_customers,
                                  split_products)
from starforge.plans.facts import (fact_orders, fact_quarantine, order_items_agg, payments_agg,
                                   unfit_orders)
from starforge.operators.validate import REPORT, enforce_rows, warehouse_rules
from starforge.rules import Rules
from starforge.sinks import stage
from starforge.sinks.versions import publish
from starforge.sources.csv import Extract, read_sources
from starforge.sources.tables import Sources

TABLE_ORDER = ("dim_date", "dim_products", "dim_payment_type", "dim_customers",
               "fact_orders", "fact_cohort_retention")
REJECT_TABLES = ("fact_quarantine", "load_rejects")


def build(spark: SparkSession, src: Sources, rules: Rules,
          primary_product: str = "first", primary_payment: str = "first") -> dict[str, DataFrame]:
    """Dimensions first (date, products, payment type, customers), then the
    two facts, as in the warehouse's load order.  ``fact_quarantine`` holds the
    order and review rows that ``fact_orders`` leaves out, with their reason;
    ``load_rejects`` the values that the declared types can't hold, one row each:
    the product, customer or order they belong to is left out of its table."""
    ts = run_timestamp()
    t: dict[str, DataFrame] = {}
    # The order-level aggregates (A1, which contains A3's order total, and A2) are made
    # once and staged: dim_customers, fact_orders and the range check read them.
    items = stage(order_items_agg(src.order_items, primary_product), "items_agg")
    paid = stage(payments_agg(src.payments, primary_payment), "payments_agg")
    totals = items.select("order_id", F.col("order_total_value").alias("order_total"))
    t["dim_date"] = dim_date(spark, rules, ts)
    t["dim_products"], bad_products = split_products(src.products, rules, ts)
    t["dim_payment_type"] = dim_payment_type(src.payments, rules, ts)
    t["dim_customers"], bad_customers = split_customers(src.customers, src.orders, src.order_items, rules, ts,
                                                        order_totals=totals)
    bad_orders = unfit_orders(items, paid)
    t["fact_orders"] = fact_orders(src.orders, src.order_items, src.payments, src.reviews,
                                   t["dim_customers"], t["dim_products"], t["dim_payment_type"],
                                   rules, ts, primary_product, primary_payment, items_agg=items,
                                   payments_by_order=paid, rejected=bad_orders)
    t["fact_cohort_retention"] = fact_cohort_retention(src.orders, t["dim_customers"], ts)
    t["fact_quarantine"] = fact_quarantine(src.orders, src.reviews)
    t["load_rejects"] = bad_products.unionByName(bad_customers).unionByName(bad_orders)
    return t


def write(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """K1/K7: full refresh, one folder per table; the rejects go beside them (``REJECT_TABLES``)."""
    from starforge.sinks import write_table
    paths = {}
    for name in REJECT_TABLES:
        if name in tables:
            write_table(tables[name], f"{out_dir.rstrip('/')}/{name}", fmt)
    for name in TABLE_ORDER:
        if name in tables:
            paths[name] = write_table(tables[name], f"{out_dir.rstrip('/')}/{name}", fmt)
    return paths


def run_from_csv(spark: SparkSession, paths: dict[str, str], rules: Rules, root: str,
                 keep: int = 2) -> Extract:
    """CSV files to warehouse in one run: read and check (S1-S7, V1-V6; a failed ``raise`` rule
    stops here, with nothing written), build, and publish under ``root`` as the next version
    (K1, K7), whose tables are checked while they are written (Q1, Q6-Q8).

    The lines that could not be read, the ledger of lost values and the source checks are
    published with the six tables and the rejects.
    """
    extract = read_sources(spark, paths)
    enforce_rows(extract.checks)
    tables = build(spark, extract.sources, rules)
    tables |= {"malformed_records": extract.malformed, "extract_ledger": extract.ledger,
               "extract_checks": spark.createDataFrame(extract.checks, REPORT).coalesce(1)}
    publish(tables, root, keep, rules=warehouse_rules)
    return extract


def fetch(tables: dict[str, DataFrame], query: str, params: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the warehouse tables, which the text names in braces (``{fact_orders}``),
    with named parameters (``:name``).  No view is registered, so sessions don't clash."""
    spark = next(iter(tables.values())).sparkSession
    used = {n: df for n, df in tables.items() if "{" + n + "}" in query}
    return spark.sql(query, args=params or {}, **used)
