"""Keys, first-row selection, validation, quality checks, sinks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starforge.operators.keys import dense_key, first_by, keep_first
from starforge.operators.quality import (max_length_check, orphan_check, orphan_rows,
                                         repeated_keys, unique_check)
from starforge.operators.validate import ValidationError, enforce, validate


def test_dense_key_is_1_to_n_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    keyed = dense_key(df.repartition(5), ["k"], "key")
    rows = keyed.orderBy("key").collect()
    assert [r.key for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    assert keyed.columns[0] == "key"


def test_dense_key_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = [(r.key, r.k) for r in dense_key(df, ["k"], "key").orderBy("key").collect()]
    assert got == [(1, None), (2, "a"), (3, "b")]


def test_first_by_tuple(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "z"), (1, 1, "y"), (2, 5, "q")],
                               "g int, seq int, v string")
    got = {r.g: r.f for r in df.groupBy("g").agg(first_by("v", ["seq", "v"]).alias("f")).collect()}
    assert got == {1: "y", 2: "q"}


def test_keep_first_splits_every_row(spark):
    rows = [("o1", 1, "a"), ("o1", 1, "a"), ("o1", 2, "b"), ("o2", 1, "c"), (None, 1, "d")]
    df = spark.createDataFrame(rows, "id string, seq int, v string")
    kept, rejects = keep_first(df, "id", ["seq", "v"], "dup")
    assert sorted(tuple(r) for r in kept.collect()) == [("o1", 1, "a"), ("o2", 1, "c")]
    rej = sorted((r.id or "", r.seq, r.v, r.reject_reason) for r in rejects.collect())
    assert rej == [("", 1, "d", "null_key"), ("o1", 1, "a", "dup"), ("o1", 2, "b", "dup")]


def test_two_reviews_one_kept_one_quarantined(spark):
    from starforge.plans.facts import fact_quarantine, reviews_agg
    orders = spark.createDataFrame([("o1",)], "order_id string")
    t = dt.datetime
    reviews = spark.createDataFrame(
        [("r1", "o1", 5, t(2018, 1, 2)), ("r2", "o1", 1, t(2018, 1, 1))],
        "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz")
    agg = reviews_agg(reviews).first()
    assert (agg.review_score, agg.review_rows) == (1, 2)
    q = fact_quarantine(orders, reviews).collect()
    assert [(r.review_id, r.reject_reason) for r in q] == [("r1", "duplicate_order_id_review")]


def test_orphan_check(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    r = orphan_check(fact, "k", dim, "k").first()
    assert (r.total_rows, r.unique_keys, r.matched_keys, r.orphaned_keys) == (3, 2, 1, 1)
    assert orphan_rows(fact, "k", dim, "k").count() == r.orphaned_keys


def test_unique_and_length_checks(spark):
    df = spark.createDataFrame([("a", "SP"), ("a", "S"), ("b", None), (None, "RJX")],
                               "id string, st string")
    r = repeated_keys(df, "id").first()
    assert (r.duplicate_keys, r.duplicate_rows) == (1, 2)
    assert unique_check(df, ["id"], "t").first().passed is False
    m = max_length_check(df, {"st": 2}, "t").first()
    assert (m.too_long, m.longest, m.passed) == (1, 3, False)


def test_validation_state_rule_and_raise(spark):
    rows = [("c1", "u1", "x", None), ("c2", "u2", "y", "S"), ("c3", "u3", "z", "SP")]
    df = spark.createDataFrame(rows, "customer_id string, customer_unique_id string,"
                                     " customer_city string, customer_state string")
    rep = {r.rule: r.bad_rows for r in validate(df, "customers").collect()}
    assert rep["invalid_state_length"] == 2
    assert rep["null_customer_state"] == 1
    enforce(validate(df, "customers"))       # no critical failure
    bad = spark.createDataFrame([(None, "c1")], "order_id string, customer_id string")
    with pytest.raises(ValidationError):
        enforce(validate(bad, "orders"))


def test_csv_source_lenient_and_multiline(spark, tmp_dir):
    from starforge.sources.csv import read_csv_table
    path = os.path.join(tmp_dir, "reviews.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("review_id,order_id,review_score,review_comment_message,review_creation_date\n")
        fh.write('r1,o1,5,"line1\nline2 ""q"" x",2018-01-01 10:00:00\n')
        fh.write("r2,o2,x,plain,garbage\n")
    df = read_csv_table(spark, path, "reviews", multiline=True)
    rows = {r.review_id: r for r in df.collect()}
    assert len(rows) == 2
    assert rows["r1"].review_comment_message == 'line1\nline2 "q" x'
    assert rows["r1"].review_creation_date == dt.datetime(2018, 1, 1, 10)
    assert rows["r2"].review_creation_date is None and rows["r2"].review_score is None


def test_csv_bom_export(spark, tmp_dir):
    from starforge.sinks import write_csv_bom
    df = spark.createDataFrame([(1, "credit_card")], "payment_type_key int, payment_type string")
    out = write_csv_bom(df, os.path.join(tmp_dir, "bom"))
    parts = [f for f in os.listdir(out) if f.startswith("part-") and f.endswith(".csv")]
    with open(os.path.join(out, parts[0]), "rb") as fh:
        head = fh.read(3)
    assert head == b"\xef\xbb\xbf"


def test_upsert_and_incremental(spark):
    from starforge.sinks import incremental_new_rows, upsert_scd1
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    cur = spark.createDataFrame([(1, "a", "x", t0, t0), (2, "b", "y", t0, t0)],
                                "k long, id string, v string, created_at timestamp_ntz,"
                                " updated_at timestamp_ntz")
    inc = spark.createDataFrame([("b", "y2"), ("c", "z")], "id string, v string")
    out = {r.id: r for r in upsert_scd1(cur, inc, "id", "k", load_ts=F.lit(t1)
                                        .cast("timestamp_ntz")).collect()}
    assert (out["a"].k, out["a"].v, out["a"].updated_at) == (1, "x", t0)
    assert (out["b"].k, out["b"].v, out["b"].created_at, out["b"].updated_at) == (2, "y2", t0, t1)
    assert (out["c"].k, out["c"].created_at) == (3, t1)
    new = incremental_new_rows(cur, inc.withColumnRenamed("v", "w"), "id").collect()
    assert [r.id for r in new] == ["c"]


def test_cohort_load_rejects_repeated_key(spark, tmp_dir):
    from starforge.sinks import ConstraintError, load_cohort
    d = dt.date(2018, 1, 1)
    df = spark.createDataFrame([(d, 0), (d, 0)], "cohort_month date, months_since_first_purchase int")
    with pytest.raises(ConstraintError):
        load_cohort(df, os.path.join(tmp_dir, "c"))


def test_fact_load_quarantines_duplicates(spark, tmp_dir):
    from starforge.sinks import load_fact_orders
    df = spark.createDataFrame([("o1", 1), ("o1", 2), (None, 3)], "order_id string, v int")
    ok, bad = load_fact_orders(df, os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "q"))
    assert sorted(tuple(r) for r in spark.read.parquet(ok).collect()) == [("o1", 1)]
    rej = sorted((r.v, r.reject_reason) for r in spark.read.parquet(bad).collect())
    assert rej == [(2, "duplicate_order_id"), (3, "null_key")]


def test_text_prefix(spark):
    from starforge.functions.scalars import text_prefix
    df = spark.createDataFrame([("x" * 250,), ("short",), (None,)], "t string")
    got = [r[0] for r in df.select(text_prefix("t")).collect()]
    assert got == ["x" * 200, "short", None]


def test_exact_percentiles_with_hot_value(spark):
    import numpy as np
    from starforge.operators.quantile import exact_percentiles
    vals = [0.0] * 3000 + [float(i % 997) / 7 for i in range(6001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    ps = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p0": 0.0, "p100": 1.0}
    got = exact_percentiles(df, "x", ps).first().asDict()
    for name, p in ps.items():
        assert got[name] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-9), name
    empty = exact_percentiles(df.where("x < 0"), "x", {"m": 0.5}).first()
    assert empty.m is None


def test_key_lookup_keeps_one_row_per_key(spark):
    """A business key listed twice gives its last surrogate key and no second row."""
    from starforge.operators.lookup import key_lookup
    facts = spark.createDataFrame([("o1", "p1"), ("o2", "p2"), ("o3", None)], "order_id string, product_id string")
    dim = spark.createDataFrame([("p1", 1), ("p1", 4), ("p2", 2)], "product_id string, product_key int")
    got = key_lookup(facts, "product_id", dim, "product_id", "product_key", "product_key").collect()
    assert sorted((r.order_id, r.product_key or 0) for r in got) == [("o1", 4), ("o2", 2), ("o3", 0)]
