"""Registered queries of extracts and loads: CSV files to warehouse, loads that are repeated,
values that don't fit, and refreshes with a cut-over.  Each reads back what was written and
returns values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.operators.profile import distinct_keys
from starforge.operators.validate import REPORT, extract_metrics, warehouse_rules
from starforge.plans.dims import dim_customers
from starforge.plans.pipeline import TABLE_ORDER, build, write
from starforge.rules import FIXTURE_RULES as RULES
from starforge.schemas import table_columns
from starforge.session import scratch_path
from starforge.sinks import csv_writer, stage, table_totals, write_csv_bom
from starforge.sinks.loads import load_facts, load_keyed, load_numbered, loaded, replace_load
from starforge.sinks.merge import append_unseen_months, merge_scd1
from starforge.sinks.versions import publish, read_version
from starforge.sources.csv import read_csv_table, read_sources, read_staged_csv
from starforge.sources.fixtures import REVIEW_TEXT_SQL, driver_table, load_fixture_sources
from starforge.sources.tables import Sources

SPLIT = "1999-01-01"        # the first of two loads holds the orders before this day


def _plain(df: DataFrame) -> DataFrame:
    from starforge.plans.catalog import for_oracle
    return for_oracle(df)


def _warehouse(spark, sf):
    from starforge.plans.catalog import warehouse
    return warehouse(spark, sf)


def _products(spark, sf):
    from starforge.plans.catalog import products
    return products(spark, sf)


def before_split(df: DataFrame) -> DataFrame:
    return df.where(F.col("order_purchase_timestamp") < F.lit(SPLIT).cast("timestamp_ntz"))


# ------------------------------------------------- CSV files with bad rows
def _mod(col: str, n: int):
    return F.col(col).cast("long") % n == 0


# (column, rows whose text is replaced, text): values that can't be converted
def _bad_values() -> dict:
    return {
        "orders": [("order_delivered_customer_date", _mod("order_id", 41), "not a date")],
        "order_items": [("price", _mod("order_id", 43) & (F.col("order_item_id") == 1), "n/a")],
        "products": [("product_photos_qty", _mod("product_id", 37), "many")],
        "payments": [("payment_value", _mod("order_id", 47), "free"),
                     ("payment_installments", _mod("order_id", 53), "x")],
        "reviews": [("review_score", _mod("review_id", 59), "good")],
    }


# (column, rows that are written once more with one field too many)
def _bad_lines() -> dict:
    return {
        "orders": ("order_status", _mod("order_id", 97)),
        "order_items": ("seller_id", _mod("order_id", 89) & (F.col("order_item_id") == 1)),
        "payments": ("payment_type", _mod("order_id", 83)),
    }


def damaged_files(src: Sources, root: str) -> dict[str, str]:
    """The sources as CSV folders that hold values of the wrong type and lines of the wrong length."""
    paths, values, lines = {}, _bad_values(), _bad_lines()
    for name, df in src.items():
        paths[name] = f"{root}/{name}"
        out = df
        for c, rows, text in values.get(name, []):
            out = out.withColumn(c, F.when(rows, F.lit(text)).otherwise(F.col(c).cast("string")))
        csv_writer(out.write.mode("append")).csv(paths[name])
        if name in lines:
            c, rows = lines[name]
            longer = df.where(rows).withColumn(c, F.lit("left,right"))
            csv_writer(longer.write.mode("append")).option("quote", "").csv(paths[name])
    return paths


def _extract(spark, sf):
    root = scratch_path(spark, "csv-sources")
    return read_sources(spark, damaged_files(load_fixture_sources(spark, sf), root))


def q_csv_to_warehouse(spark, sf):
    """Damaged CSV files are read from their paths, validated, built and published;
    the fact is read back from the published version."""
    from starforge.plans.pipeline import run_from_csv
    paths = damaged_files(load_fixture_sources(spark, sf), scratch_path(spark, "csv-sources"))
    root = scratch_path(spark, "published")
    run_from_csv(spark, paths, RULES, root)
    return _plain(read_version(spark, root)["fact_orders"])


def q_extract_ledger(spark, sf):
    return _extract(spark, sf).ledger


def q_malformed(spark, sf):
    """Malformed lines per table, with the number of their fields."""
    lines = _extract(spark, sf).malformed
    return (lines.groupBy("table_name", F.size(F.split("record", ",")).alias("fields"))
            .agg(F.count(F.lit(1)).alias("lines")))


def _derived(name: str):
    def run(spark, sf):
        df = getattr(load_fixture_sources(spark, sf), name)
        root = scratch_path(spark, f"csv-{name}")
        csv_writer(df.write.mode("append")).csv(root)
        from starforge.sources.csv import derived_columns
        return _plain(derived_columns(read_csv_table(spark, root, name), name))
    return run


def review_texts(spark, sf) -> DataFrame:
    """Reviews with title and message, written as quoted CSV over several lines and scanned again."""
    texts = spark.sql(REVIEW_TEXT_SQL, documents=driver_table(spark, sf, "documents"))
    # an answer time that both engines make alike: hours after a fixed day
    start = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    texts = texts.withColumn("review_answer_timestamp", F.when(
        F.col("answer_mark").isNotNull(),
        F.dateadd(start.cast("date"), (F.col("answer_mark").cast("long") % 365).cast("int")).cast("timestamp_ntz")))
    path = scratch_path(spark, "csv-review-texts")
    csv_writer(texts.drop("answer_mark").write.mode("append").option("maxRecordsPerFile", 5000)).csv(path)
    return read_csv_table(spark, path, "reviews")


def q_review_text(spark, sf):
    from starforge.functions.scalars import text_prefix
    return review_texts(spark, sf).select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_answer_timestamp", text_prefix("review_comment_message").alias("message_start"))


def q_extract_metrics(spark, sf):
    src = load_fixture_sources(spark, sf)
    return (extract_metrics(src.products, "products").unionByName(extract_metrics(src.payments, "payments"))
            .unionByName(extract_metrics(review_texts(spark, sf), "reviews")))


# ------------------------------------------------------------ staged files
def q_staged_csv(table: str):
    def run(spark, sf):
        """K1 as CSV, S8: the staged file of a table, read back and repaired to its types."""
        path = scratch_path(spark, f"staged-{table}")
        write({table: _warehouse(spark, sf)[table]}, path, fmt="csv")
        return _plain(read_staged_csv(spark, f"{path}/{table}", table))
    return run


def q_bom_values(spark, sf):
    """K3: the export with a byte order mark, read back with its values."""
    path = write_csv_bom(_warehouse(spark, sf)["dim_customers"], scratch_path(spark, "export-customers"))
    return _plain(read_staged_csv(spark, path, "dim_customers"))


# --------------------------------------------------------- repeated loads
def _repeated_loads(spark, sf) -> tuple[str, str]:
    """Load 1: the orders before SPLIT.  Load 2: all orders, some twice, some without an id; its
    first run breaks between table and quarantine, then it is run again, twice."""
    fact = _warehouse(spark, sf)["fact_orders"]
    table, bad = scratch_path(spark, "fact_orders"), scratch_path(spark, "fact_orders_quarantine")
    load_facts(before_split(fact), table, bad, 1)
    again = fact.where(_mod("order_id", 31))
    batch = stage(fact.unionByName(again).unionByName(again.withColumn("order_status", F.lit("zzz")))
                  .unionByName(fact.where(_mod("order_id", 67)).withColumn("order_id", F.lit(None).cast("string"))),
                  "batch")
    replace_load(batch.where(_mod("order_id", 2)), table, 2)        # what a broken load 2 left
    load_facts(batch, table, bad, 2)
    load_facts(batch, table, bad, 2)
    return table, bad


def q_repeated_loads(spark, sf):
    """The loaded fact; keys are numbered on from load to load."""
    table, _ = _repeated_loads(spark, sf)
    rows = loaded(spark, table, "fact_orders")
    return _plain(rows.select("load_id", *table_columns("fact_orders")))


def q_load_quarantine(spark, sf):
    """K4 / K6: what two loads rejected, row for row."""
    _, bad = _repeated_loads(spark, sf)
    return _plain(spark.read.parquet(bad).select(
        F.col("load_id").cast("long").alias("load_id"), "order_id", "order_status", "order_total_value",
        "reject_reason"))


def q_reloaded_products(spark, sf):
    """K2: a dimension in two loads that keep its keys, the second one run twice."""
    dim = _products(spark, sf)
    path = scratch_path(spark, "dim_products")
    load_keyed(dim.where("product_key % 2 = 0"), path, 1, "dim_products")
    for _ in range(2):
        load_keyed(dim.where("product_key % 2 = 1"), path, 2, "dim_products")
    return _plain(loaded(spark, path, "dim_products").drop("load_id"))


def q_reloaded_cohorts(spark, sf):
    """K5: the cohort fact in two loads, keys numbered on, the second one run twice."""
    cells = _warehouse(spark, sf)["fact_cohort_retention"]
    path = scratch_path(spark, "fact_cohort_retention")
    early = F.col("cohort_month") < F.lit("1997-01-01").cast("date")
    load_numbered(cells.where(early), path, 1, "fact_cohort_retention", "cohort_retention_key")
    for _ in range(2):
        load_numbered(cells.where(~early), path, 2, "fact_cohort_retention", "cohort_retention_key")
    return _plain(loaded(spark, path, "fact_cohort_retention").drop("load_id"))


# ------------------------------------------------------ values out of range
def large_sources(spark, sf) -> Sources:
    """The sources with item prices so large that sums or lifetime values exceed DECIMAL(12,2)."""
    src = load_fixture_sources(spark, sf)
    price = (F.when(_mod("order_id", 997), F.lit("9999999999.00").cast("decimal(12,2)"))
             .when(_mod("order_id", 101) & (F.col("order_item_id") == 1), F.lit("30000001.00").cast("decimal(12,2)"))
             .otherwise(F.col("price")))
    src.order_items = src.order_items.withColumn("price", price)
    return src


def _large_warehouse(spark, sf) -> dict[str, DataFrame]:
    out = scratch_path(spark, "large")
    tables = build(spark, large_sources(spark, sf), RULES)
    write({n: tables[n] for n in ("load_rejects", "dim_customers", "fact_orders")}, out)
    return {n: spark.read.parquet(f"{out}/{n}") for n in ("load_rejects", "dim_customers", "fact_orders")}


def q_out_of_range(spark, sf):
    """K8: the values that the declared types can't hold, by table, key and column."""
    return _large_warehouse(spark, sf)["load_rejects"]


def q_out_of_range_rest(spark, sf):
    """K8: the fact without the rejected orders; customers that were rejected have no key."""
    return _plain(_large_warehouse(spark, sf)["fact_orders"].select(
        "order_key", "order_id", "customer_key", "product_key", "order_total_value"))


# ---------------------------------------------------------------- cut-over
class Broken(RuntimeError):
    pass


def q_cutover(spark, sf):
    """K1 / K7: version 1 holds the orders before SPLIT, version 2 all of them; the refresh to
    version 3 breaks before its cut-over.  The fact of both readable versions is returned."""
    root = scratch_path(spark, "versions")
    src = load_fixture_sources(spark, sf)
    full = _warehouse(spark, sf)
    src.orders = before_split(src.orders)
    names = ("dim_date", "dim_products", "dim_payment_type", "dim_customers", "fact_orders", "fact_cohort_retention")
    early = build(spark, src, RULES)
    publish({n: early[n] for n in names}, root)
    publish({n: full[n] for n in names}, root)

    def stop(folder):
        raise Broken(folder)
    try:
        publish({n: full[n].limit(0) for n in names}, root, before_cutover=stop)
    except Broken:
        pass
    out = None
    for version in (1, 2):
        one = read_version(spark, root, version)["fact_orders"].select(
            F.lit(version).alias("version"), "order_key", "order_id", "customer_key", "product_key",
            "order_status", "order_total_value", "review_score")
        out = one if out is None else out.unionByName(one)
    return _plain(out)


# ------------------------------------------- checks observed in the writes
def q_observed_checks(spark, sf):
    """Q1, Q6-Q8 counted by the writes of a refresh, read back from the published report."""
    root = scratch_path(spark, "observed")
    w = _warehouse(spark, sf)
    publish({n: w[n] for n in ("dim_products", "dim_customers", "fact_orders")}, root, rules=warehouse_rules)
    return read_version(spark, root)["load_report"]


def q_extract_checks(spark, sf):
    """V1-V6 counted while the CSV sources are staged; malformed lines don't count."""
    return spark.createDataFrame(_extract(spark, sf).checks, REPORT)


# ------------------------------------------------------------------ merges
def _customer(n: int):
    """Every n-th customer by number; the ids are not all numbers."""
    return F.coalesce(F.col("customer_id").try_cast("long") % n == 0, F.lit(False))


def _merged(spark, sf):
    """The customers known before SPLIT, merged with all customers but every 7th; every 11th
    comes twice, every 13th once more without an id."""
    src = load_fixture_sources(spark, sf)
    early = before_split(src.orders)
    some = src.customers.join(early.select("customer_id").distinct(), "customer_id", "left_semi")
    current = stage(dim_customers(some, early, src.order_items, RULES), "current")
    full = _warehouse(spark, sf)["dim_customers"].where(~_customer(7))
    batch = (full.unionByName(full.where(_customer(11)).withColumn("customer_unique_id", F.lit("zz")))
             .unionByName(full.where(_customer(13)).withColumn("customer_id", F.lit(None).cast("string"))))
    return merge_scd1(current, batch, "customer_id", "customer_key")


def q_merge_classes(spark, sf):
    return _merged(spark, sf).classes


def q_merge_table(spark, sf):
    return _plain(_merged(spark, sf).table.drop("first_order_date", "last_order_date"))


def q_merge_rejects(spark, sf):
    return _plain(_merged(spark, sf).rejects.select("customer_id", "customer_unique_id", "customer_city",
                                                    "total_orders", "total_spent", "reject_reason"))


def _months(spark, sf):
    """Orders before SPLIT, then those from two months before SPLIT on, some of them twice,
    without an id or without a time."""
    orders = load_fixture_sources(spark, sf).orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp")
    table, bad = scratch_path(spark, "orders-by-month"), scratch_path(spark, "orders-by-month-quarantine")
    at = "order_purchase_timestamp"
    append_unseen_months(before_split(orders), table, "order_id", at, bad)
    late = orders.where(F.col(at) >= F.lit("1998-11-01").cast("timestamp_ntz"))
    batch = (late.unionByName(late.where(_mod("order_id", 19)).withColumn("order_status", F.lit("zzz")))
             .unionByName(late.where(_mod("order_id", 23)).withColumn("order_id", F.lit(None).cast("string")))
             .unionByName(late.where(_mod("order_id", 29)).withColumn(at, F.lit(None).cast("timestamp_ntz"))))
    append_unseen_months(batch, table, "order_id", at, bad)
    return table, bad


def q_months_table(spark, sf):
    """D9 on a table partitioned by month: all orders, each once, with the month of its folder."""
    return spark.read.parquet(_months(spark, sf)[0])


def q_months_rejects(spark, sf):
    return spark.read.parquet(_months(spark, sf)[1])


def q_distinct_keys(spark, sf):
    """A7 over the surrogate keys of the fact, by bitmaps."""
    return distinct_keys(_warehouse(spark, sf)["fact_orders"],
                         ["order_key", "customer_key", "product_key", "payment_type_key", "order_date_key"])


def q_table_totals(spark, sf):
    """Rows and columns of every published table, and the totals of dimensions, facts and all."""
    w = _warehouse(spark, sf)
    return table_totals({n: w[n] for n in TABLE_ORDER})


QUERIES = {
    "s1_s7_csv_to_warehouse": q_csv_to_warehouse,
    "s7_extract_ledger": q_extract_ledger,
    "s7_malformed_lines": q_malformed,
    "s2_derived_order_items": _derived("order_items"),
    "s4_derived_products": _derived("products"),
    "s6_review_text": q_review_text,
    "v4_v5_v6_extract_metrics": q_extract_metrics,
    "s8_staged_csv_customers": q_staged_csv("dim_customers"),
    "s8_staged_csv_fact": q_staged_csv("fact_orders"),
    "k3_bom_csv_values": q_bom_values,
    "k4_repeated_loads": q_repeated_loads,
    "k4_load_quarantine": q_load_quarantine,
    "k2_reloaded_products": q_reloaded_products,
    "k5_reloaded_cohorts": q_reloaded_cohorts,
    "k8_out_of_range": q_out_of_range,
    "k8_out_of_range_rest": q_out_of_range_rest,
    "k1_k7_cutover": q_cutover,
    "q1_q6_q8_observed": q_observed_checks,
    "v1_v6_observed": q_extract_checks,
    "d8_merge_classes": q_merge_classes,
    "d8_merge_table": q_merge_table,
    "d8_merge_rejects": q_merge_rejects,
    "d9_months_table": q_months_table,
    "d9_months_rejects": q_months_rejects,
    "a7_distinct_keys": q_distinct_keys,
    "a15_table_totals": q_table_totals,
}

COVERS = {
    "s1_s7_csv_to_warehouse": "S1 S2 S3 S4 S5 S6 S7 S9 K1 K7 V1 V2 V3 V4 V5 V6",
    "s7_extract_ledger": "S7", "s7_malformed_lines": "S7",
    "s2_derived_order_items": "S2 F1", "s4_derived_products": "S4 F2 F3",
    "s6_review_text": "S6 F26", "v4_v5_v6_extract_metrics": "V4 V5 V6",
    "s8_staged_csv_customers": "K1 S8", "s8_staged_csv_fact": "K1 S8 S7",
    "k3_bom_csv_values": "K3",
    "k4_repeated_loads": "K4 K6 W2 P1", "k4_load_quarantine": "K4 K6 W5",
    "k2_reloaded_products": "K2 Q11 Q12", "k5_reloaded_cohorts": "K5 W2",
    "k8_out_of_range": "K8 F14", "k8_out_of_range_rest": "K8 W2",
    "k1_k7_cutover": "K1 K7 S9",
    "q1_q6_q8_observed": "Q1 Q6 Q7 Q8", "v1_v6_observed": "V1 V2 V3 V4 V5 V6",
    "d8_merge_classes": "D8 W2", "d8_merge_table": "D8", "d8_merge_rejects": "D8",
    "d9_months_table": "D9", "d9_months_rejects": "D9",
    "a7_distinct_keys": "A7", "a15_table_totals": "A15 K9",
}
