"""Loads that are repeated, refreshes with a cut-over, CSV extracts and values that don't fit."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starforge.operators.validate import ValidationError
from starforge.plans import catalog_loads
from starforge.plans.pipeline import run_from_csv
from starforge.rules import FIXTURE_RULES
from starforge.schemas import TARGETS, conform_split
from starforge.sinks import ConstraintError, load_dimension, load_fact_orders
from starforge.sinks.loads import LoadOrderError, load_facts, load_keyed, loaded
from starforge.sinks.versions import current_version, publish, published, read_version, table_list
from starforge.sources.csv import read_sources, scan_csv
from starforge.sources.fixtures import load_fixture_sources

NOW = dt.datetime(2020, 1, 1)


def rows(spark, data):
    """Few columns of fact_orders, and one that it lacks."""
    return spark.createDataFrame([(99, o, v, "x") for o, v in data],
                                 "order_key long, order_id string, order_total_value long, other string"
                                 ).withColumn("order_total_value", F.col("order_total_value").cast("decimal(20,2)"))


def places(spark, tmp_dir):
    return os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "q")


def test_a_broken_load_is_run_again(spark, tmp_dir):
    table, bad = places(spark, tmp_dir)
    assert load_facts(rows(spark, [("b", 1), ("a", 2), (None, 3)]), table, bad, 1) == (2, 1)
    second = rows(spark, [("c", 4), ("a", 5), ("c", 6), ("d", 10 ** 11)])
    for _ in range(3):
        assert load_facts(second, table, bad, 2) == (1, 3)
    got = sorted((r.load_id, r.order_key, r.order_id, int(r.order_total_value), r.order_status)
                 for r in loaded(spark, table, "fact_orders").collect())
    assert got == [(1, 1, "a", 2, None), (1, 2, "b", 1, None), (2, 3, "c", 4, None)]
    rejects = sorted((r.load_id, r.order_id or "", r.reject_reason, r.unfit and r.unfit[0].value)
                     for r in spark.read.parquet(bad).collect())
    assert rejects == [(1, "", "null_key", None), (2, "a", "loaded_order_id", None),
                       (2, "c", "duplicate_order_id", None), (2, "d", "out_of_range", "100000000000.00")]
    with pytest.raises(LoadOrderError):
        load_facts(second, table, bad, 1)
    # a repeat that has nothing left clears what the load wrote before
    assert load_facts(second.limit(0), table, bad, 2) == (0, 0)
    assert loaded(spark, table, "fact_orders").where("load_id = 2").count() == 0
    assert load_facts(second, table, bad, 2) == (1, 3)


def test_an_empty_folder_is_no_table(spark, tmp_dir):
    table, bad = places(spark, tmp_dir)
    os.mkdir(table)
    load_fact_orders(rows(spark, [("a", 1)]), table, bad)
    assert spark.read.parquet(table).count() == 1
    os.mkdir(os.path.join(tmp_dir, "d"))
    load_dimension(spark.createDataFrame([(1, "x")], "k int, name string"), os.path.join(tmp_dir, "d"), "k")


def test_keyed_load_checks_earlier_loads(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    types = spark.createDataFrame([(1, "a", "c"), (2, "b", "c")],
                                  "payment_type_key long, payment_type string, payment_category string")
    assert [load_keyed(types, path, 1, "dim_payment_type") for _ in range(2)] == [2, 2]
    with pytest.raises(ConstraintError):
        load_keyed(types, path, 2, "dim_payment_type")
    assert loaded(spark, path, "dim_payment_type").count() == 2


def test_conform_split_names_the_column(spark):
    df = spark.createDataFrame([(1, "credit", "cards"), (2, None, "cards"), (None, "x", None)],
                               "payment_type_key long, payment_type string, payment_category string")
    df = df.withColumn("created_at", F.lit(NOW).cast("timestamp_ntz"))
    typed, bad = conform_split(df, TARGETS["dim_payment_type"], "dim_payment_type", "payment_type")
    assert [r.payment_type for r in typed.collect()] == ["credit"]
    assert sorted((r.business_key or "", r.column_name, r.reject_reason) for r in bad.collect()) == [
        ("", "payment_type", "missing"), ("x", "payment_category", "missing"), ("x", "payment_type_key", "missing")]


def test_publish_cuts_over_last_and_cleans_up(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    with pytest.raises(ValueError):
        read_version(spark, root)

    def tables(n):
        return {"a": spark.range(n), "b": spark.range(2 * n)}
    assert [publish(tables(n), root) for n in (1, 2)] == [1, 2]

    def stop(folder):
        raise RuntimeError(folder)
    with pytest.raises(RuntimeError):
        publish(tables(9), root, before_cutover=stop)
    assert current_version(spark, root) == 2
    assert read_version(spark, root)["b"].count() == 4 and read_version(spark, root, 1)["a"].count() == 1
    assert publish(tables(3), root) == 3
    assert sorted(os.listdir(root)) == ["_current", "v2", "v3"]
    assert [(r.table_name, r.version, r.row_count) for r in table_list(spark, root).collect()] == [
        ("a", 3, 3), ("b", 3, 6)]
    assert published(spark, root).count() == 3


def test_scan_keeps_lines_of_the_wrong_length(spark, tmp_dir):
    path = os.path.join(tmp_dir, "o.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("order_id,order_status,order_purchase_timestamp,unknown\n")
        fh.write("o1,ok,2018-01-01 10:00:00,u\no2,ok,never,u\no3,ok\no4,ok,,u,v\n")
    got = {r.order_id: r for r in scan_csv(spark, path, "orders").collect()}
    assert got["o1"].order_purchase_timestamp == dt.datetime(2018, 1, 1, 10) and not got["o1"]._sf_nulled
    assert got["o2"]._sf_nulled == ["order_purchase_timestamp"] and got["o2"]._sf_record is None
    assert got["o3"]._sf_record == "o3,ok" and got["o4"]._sf_record == "o4,ok,,u,v"
    assert "unknown" not in got["o1"].asDict()


def test_failed_validation_writes_nothing(spark, tmp_dir):
    src = load_fixture_sources(spark, SF_SMALL)
    src.orders = src.orders.withColumn("customer_id", F.when(F.col("order_id") != "7", F.col("customer_id")))
    paths = catalog_loads.damaged_files(src, os.path.join(tmp_dir, "csv"))
    root = os.path.join(tmp_dir, "wh")
    with pytest.raises(ValidationError):
        run_from_csv(spark, paths, FIXTURE_RULES, root)
    assert not os.path.exists(root)
    extract = read_sources(spark, paths)
    assert extract.malformed.count() > 0
    assert {"item_total"} <= set(extract.sources.order_items.columns)
    assert {"product_volume_cm3", "has_photos"} <= set(extract.sources.products.columns)


def test_large_orders_are_rejected(spark):
    got = catalog_loads.QUERIES["k8_out_of_range"](spark, SF_SMALL)
    found = {(r.table_name, r.column_name) for r in got.collect()}
    assert ("dim_customers", "total_spent") in found and ("fact_orders", "order_total_value") in found


def test_one_large_order_does_not_end_the_build(spark):
    """30,000,001.00 on one day is a lifetime value of over ten digits."""
    from starforge.plans.dims import split_customers
    customers = spark.createDataFrame([("c1", "p1", "x", "SP"), ("c2", "p2", "x", "SP")],
                                      "customer_id string, customer_unique_id string, customer_city string,"
                                      " customer_state string")
    orders = spark.createDataFrame([("o1", "c1", "delivered", NOW), ("o2", "c2", "delivered", NOW)],
                                   "order_id string, customer_id string, order_status string,"
                                   " order_purchase_timestamp timestamp_ntz")
    items = spark.createDataFrame([("o1", "30000001.00", "0.00"), ("o2", "10.00", "1.00")],
                                  "order_id string, price string, freight_value string").select(
        "order_id", *[F.col(c).cast("decimal(12,2)").alias(c) for c in ("price", "freight_value")])
    dim, bad = split_customers(customers, orders, items, FIXTURE_RULES)
    assert [(r.customer_key, r.customer_id) for r in dim.collect()] == [(1, "c2")]
    assert [(r.business_key, r.column_name, r.reject_reason) for r in bad.collect()] == [
        ("c1", "lifetime_value", "out_of_range")]


def test_reloaded_products_read_no_other_table(spark, tmp_dir):
    from starforge.plans.catalog import QUERIES, products
    part = spark.createDataFrame([(i, "COPPER", i % 50) for i in range(1, 41)], "p_partkey long, p_type string, p_size int")
    part.write.parquet(f"{tmp_dir}/part.parquet")
    got = QUERIES["k2_reloaded_products"](spark, tmp_dir).collect()
    assert sorted(r.product_key for r in got) == list(range(1, 41))
    want = [r.product_id for r in products(spark, tmp_dir).orderBy("product_key").collect()]
    assert [r.product_id for r in sorted(got, key=lambda r: r.product_key)] == want
    assert want == sorted(want)
