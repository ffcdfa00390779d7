"""What the build and the loads shuffle: each column once, wide rows only where their keys repeat."""

import os

from pyspark.sql import functions as F

from starforge.operators import keys
from starforge.sinks.loads import load_facts, loaded


def test_smallest_row_holds_each_column_once(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 2, "x"), ("a", None, "y"), ("b", 1, "z"), (None, 0, "n")],
                               "k string, v int, w string")
    best = keys._best(df, ["k"], ["v", "w"])
    assert best.schema["_sf_best"].dataType.names == ["v", "w", "_sf_end"]
    # by a column, an expression, and one that is listed twice
    for by, want in ((["v", "v"], {("a", None, "y"), ("b", 1, "z")}),
                     ([(-F.col("v")).alias("x"), "k"], {("a", None, "y"), ("b", 1, "z")}),
                     (["w"], {("a", 2, None), ("b", 1, "z")})):
        kept, bad = keys.keep_first(df, "k", by)
        assert {tuple(r) for r in kept.collect()} == want
        assert sorted(r.reject_reason for r in bad.collect()) == ["duplicate_key", "duplicate_key", "null_key"]
    only = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    kept, bad = keys.keep_first(only, "k", ["k"])
    assert kept.count() == 2 and bad.count() == 1


def test_few_repeated_keys_do_not_shuffle_the_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("starforge.sinks.stage", lambda df, purpose="stage": seen.append((purpose, df)) or df)
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    monkeypatch.setattr(keys, "KEYS_SENT", 5)
    assert keys.extra_rows(df, "k", ["v"]).count() == 1
    assert "broadcast" in dict(seen)["repeated"]._jdf.queryExecution().analyzed().toString().lower()
    seen.clear()
    monkeypatch.setattr(keys, "KEYS_SENT", 0)
    assert keys.extra_rows(df, "k", ["v"]).count() == 1
    assert "broadcast" not in dict(seen)["repeated"]._jdf.queryExecution().analyzed().toString().lower()


def test_a_load_joins_its_wide_rows_once(spark, tmp_dir, monkeypatch):
    table, bad = os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "q")
    schema = "order_id string, order_status string, order_item_count int"
    load_facts(spark.createDataFrame([("b", "x", 1), ("d", "x", 2)], schema), table, bad, 1)
    grouped = []
    first = keys.first_rows
    monkeypatch.setattr("starforge.sinks.loads.first_rows",
                        lambda df, *a: grouped.append(sorted(r.order_id for r in df.collect())) or first(df, *a))
    batch = spark.createDataFrame([("a", "x", 1), ("b", "y", 1), ("b", "z", 1), ("c", "x", 2), ("c", "x", 2),
                                   ("c", "w", 9), ("d", "x", 3), (None, "x", 1)], schema)
    assert load_facts(batch, table, bad, 2) == (2, 6)
    assert grouped == [["b", "b", "c", "c", "c"]]
    got = sorted((r.order_key, r.order_id, r.order_status) for r in loaded(spark, table, "fact_orders").collect())
    assert got == [(1, "b", "x"), (2, "d", "x"), (3, "a", "x"), (4, "c", "w")]
    left = sorted((r.order_id or "", r.order_status, r.reject_reason) for r in
                  spark.read.parquet(bad).where("load_id = 2").collect())
    assert left == [("", "x", "null_key"), ("b", "y", "loaded_order_id"), ("b", "z", "duplicate_order_id"),
                    ("c", "x", "duplicate_order_id"), ("c", "x", "duplicate_order_id"), ("d", "x", "loaded_order_id")]
