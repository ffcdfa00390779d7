"""Merges, appends by month, checks observed in a write, and exact quantiles of several columns."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from starforge.operators.quantile import percentiles_of
from starforge.operators.validate import Observed, Rule, ValidationError, enforce_rows, rules_for, validate
from starforge.sinks.merge import append_unseen_months, loaded_keys, merge_scd1
from starforge.sinks.versions import current_version, publish, read_version

T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)


def test_merge_classes_and_rejects(spark):
    current = spark.createDataFrame(
        [(4, "a", "x", None, T0, T0), (2, "b", None, 1, T0, T0), (9, "c", "z", 1, T0, T0), (1, None, "n", 1, T0, T0)],
        "k long, id string, v string, w int, created_at timestamp_ntz, updated_at timestamp_ntz")
    batch = spark.createDataFrame([("a", "x", None), ("b", "y", 1), ("d", "2", 2), ("d", "1", 3), ("d", "1", 3), (None, "q", 0),
                                   ("aa", "r", 5)], "id string, v string, w int")
    m = merge_scd1(current, batch, "id", "k", load_ts=F.lit(T1).cast("timestamp_ntz"))
    got = {(r.k, r.id): (r.v, r.w, r.created_at, r.updated_at) for r in m.table.collect()}
    assert got == {(4, "a"): ("x", None, T0, T1), (2, "b"): ("y", 1, T0, T1), (9, "c"): ("z", 1, T0, T0),
                   (1, None): ("n", 1, T0, T0), (10, "aa"): ("r", 5, T1, T1), (11, "d"): ("1", 3, T1, T1)}
    assert {(r.id, r.k): r.change_class for r in m.classes.collect()} == {
        ("a", 4): "same", ("b", 2): "changed", ("c", 9): "missing", (None, 1): "missing", ("aa", 10): "new", ("d", 11): "new"}
    assert sorted((r.id or "", r.v, r.reject_reason) for r in m.rejects.collect()) == [
        ("", "q", "null_key"), ("d", "1", "duplicate_id"), ("d", "2", "duplicate_id")]
    clean = merge_scd1(current, batch.where("id = 'b'"), "id", "k")
    assert clean.rejects.count() == 0 and clean.rejects.columns == ["id", "v", "w", "reject_reason"]
    assert merge_scd1(current.limit(0), batch.where("id = 'b'"), "id", "k").classes.first().k == 1


def test_append_reads_only_the_months_of_the_batch(spark, tmp_dir):
    table, bad = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "q")
    at = dt.datetime
    schema = "id string, at timestamp_ntz, v int"
    first = spark.createDataFrame([("a", at(2020, 1, 5), 1), ("b", at(2020, 2, 5), 2), ("c", at(2020, 3, 5), 3)], schema)
    assert append_unseen_months(first, table, "id", "at", bad).count() == 3
    batch = spark.createDataFrame([("c", at(2020, 3, 9), 4), ("d", at(2020, 3, 5), 5), ("d", at(2020, 3, 5), 6),
                                   (None, at(2020, 3, 5), 7), ("e", None, 8)], schema)
    assert [r.id for r in append_unseen_months(batch, table, "id", "at", bad).collect()] == ["d"]
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == ["a", "b", "c", "d"]
    assert sorted((r.v, r.reject_reason) for r in spark.read.parquet(bad).collect()) == [
        (6, "duplicate_id"), (7, "null_key"), (8, "null_at")]
    dated = batch.where("at is not null").withColumn("load_month", F.trunc(F.to_date("at"), "MM"))
    known = loaded_keys(spark, table, batch.schema, "id", dated)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and sorted(r.id for r in known.collect()) == ["c", "d"]
    assert append_unseen_months(batch.limit(0), table, "id", "at", bad).count() == 0


def test_observed_rules_equal_the_scan(spark, tmp_dir):
    df = spark.createDataFrame([("o1", "p", -1.0), ("o2", None, 0.0), (None, "p", 2.0)],
                               "order_id string, product_id string, price double")
    seen = Observed(df, "order_items", rules_for("order_items"))
    seen.df.write.parquet(os.path.join(tmp_dir, "t"))
    scan = [tuple(r) for r in validate(df, "order_items").collect()]
    assert seen.rows()[0] == ("order_items", "row_count", "info", 3, 3, 100.0)
    assert seen.rows()[1:] == scan
    with pytest.raises(ValidationError):
        enforce_rows(seen.rows())


def test_a_failed_rule_stops_the_cutover(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")

    def rules(name):
        return [Rule("negative", "raise", F.col("id") < 0)]
    publish({"a": spark.range(3)}, root, rules=rules)
    with pytest.raises(ValidationError):
        publish({"a": spark.range(-1, 3)}, root, rules=rules)
    assert current_version(spark, root) == 1
    assert sorted(tuple(r)[1:4] for r in read_version(spark, root)["load_report"].collect()) == [
        ("negative", "raise", 0), ("row_count", "info", 3)]


def test_percentiles_of_several_columns(spark):
    rng = np.random.default_rng(5)
    n = 60_000
    cols = {"hot": np.where(rng.random(n) < 0.6, 7.25, rng.normal(0, 1e6, n)), "wide": 10.0 ** rng.uniform(-300, 300, n),
            "two": rng.integers(0, 2, n) * 1.0, "one": np.full(n, -3.5)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())],
                               ", ".join(f"{c} double" for c in cols)).repartition(5)
    ps = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p75": 0.75, "p999": 0.999, "p100": 1.0}
    got = percentiles_of(df, {c: ps for c in cols})
    for c, values in cols.items():
        for name, p in ps.items():
            assert got[c][name] == pytest.approx(float(np.percentile(values, p * 100)), rel=1e-9), (c, name)
    odd = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    found = percentiles_of(odd, {"x": {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}})["x"]
    assert (found["a"], found["b"], found["c"], found["d"]) == (float("-inf"), 1.0, 2.0, float("inf"))
    assert np.isnan(found["e"])
    assert percentiles_of(odd.where("x is null"), {"x": {"m": 0.5}}) == {"x": {"m": None}}


def test_distinct_keys_by_bitmaps(spark):
    from starforge.operators.profile import distinct_count, distinct_keys
    df = spark.range(0, 200_000, 1, 4).select(
        (F.col("id") % 70_001 + 1).alias("a"), F.when(F.col("id") % 3 > 0, F.lit(5)).cast("int").alias("b"),
        F.lit(None).cast("long").alias("c"))
    for f in (distinct_keys, distinct_count):
        got = f(df, ["a", "b", "c"])
        assert tuple(got.first()) == (70_001, 1, 0)
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
