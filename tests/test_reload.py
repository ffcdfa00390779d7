"""Second loads, rejected rows and person-grain cohorts: inputs the fixtures don't hold."""

import datetime as dt
import os

import pytest

from starforge.plans.cohort import OFFSET, cohort_cells
from starforge.sinks import ConstraintError, load_cohort, load_dimension, load_fact_orders
from starforge.streaming import append_unseen


def test_second_fact_load_goes_to_quarantine(spark, tmp_dir):
    table, bad = os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "q")
    first = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "order_id string, v int")
    load_fact_orders(first, table, bad)
    load_fact_orders(spark.createDataFrame([("b", 9), ("c", 4)], "order_id string, v int"), table, bad)
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [("a", 1), ("b", 2), ("c", 4)]
    assert sorted((r.v, r.reject_reason) for r in spark.read.parquet(bad).collect()) == [
        (3, "null_key"), (9, "loaded_order_id")]


def test_second_dimension_and_cohort_load_fail(spark, tmp_dir):
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    load_dimension(dim, os.path.join(tmp_dir, "d"), "k")
    with pytest.raises(ConstraintError):
        load_dimension(dim, os.path.join(tmp_dir, "d"), "k")
    load_dimension(spark.createDataFrame([(2, "y")], "k int, name string"), os.path.join(tmp_dir, "d"), "k")
    assert spark.read.parquet(os.path.join(tmp_dir, "d")).count() == 2
    cells = spark.createDataFrame([(dt.date(2000, 1, 1), 0)], "cohort_month date, months_since_first_purchase int")
    load_cohort(cells, os.path.join(tmp_dir, "c"))
    with pytest.raises(ConstraintError):
        load_cohort(cells, os.path.join(tmp_dir, "c"))


def test_append_unseen_keeps_its_rejects(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    schema = "id string, v int"
    append_unseen(spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], schema), table, "id")
    append_unseen(spark.createDataFrame([("a", 5), ("b", 6)], schema), table, "id")
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [("a", 1), ("b", 6)]
    assert sorted((r.v, r.reject_reason) for r in spark.read.parquet(table + "_quarantine").collect()) == [
        (2, "duplicate_id"), (3, "null_key")]


def test_person_grain_cohorts(spark):
    at = dt.datetime
    orders = spark.createDataFrame(
        [("o1", "c1", at(2000, 1, 5)), ("o2", "c2", at(2000, 3, 5)), ("o3", "c3", at(2000, 3, 7))],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz")
    customers = spark.createDataFrame(
        [("c1", "p", at(2000, 1, 5)), ("c2", "p", at(2000, 3, 5)), ("c3", "q", at(2000, 3, 7))],
        "customer_id string, customer_unique_id string, first_order_date timestamp_ntz")
    cells = cohort_cells(orders, customers, "customer_unique_id").collect()
    assert sorted((r.cohort_month.month, r[OFFSET], r.retained_customers, r.cohort_size) for r in cells) == [
        (1, 0, 1, 1), (1, 2, 1, 1), (3, 0, 1, 1)]
