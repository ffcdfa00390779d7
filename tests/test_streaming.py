"""D9 as a file-source stream: two landed batches, overlapping keys."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starforge.session import scratch_path
from starforge.sources.fixtures import load_fixture_sources
from starforge.streaming import incremental_append


def test_incremental_append_stream(spark, tmp_dir):
    orders = load_fixture_sources(spark, SF_SMALL).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    landing = os.path.join(tmp_dir, "landing")
    early = orders.where(F.col("order_purchase_timestamp") < cut)
    # second batch repeats the early orders and adds the later ones
    early.write.mode("append").parquet(landing)
    table = os.path.join(tmp_dir, "orders_table")
    ckpt = scratch_path(spark, "stream-ckpt")
    incremental_append(spark, landing, orders.schema, table, "order_id", ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == early.count()
    orders.write.mode("append").parquet(landing)
    incremental_append(spark, landing, orders.schema, table, "order_id", ckpt).awaitTermination()
    loaded = spark.read.parquet(table)
    assert loaded.count() == orders.count()
    assert loaded.select("order_id").distinct().count() == orders.count()


def test_incremental_append_stream_by_month(spark, tmp_dir):
    """The same two batches into a table partitioned by month."""
    orders = load_fixture_sources(spark, SF_SMALL).orders
    landing, table = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "orders_table")
    ckpt = scratch_path(spark, "stream-ckpt")
    for batch in (orders.where(F.col("order_purchase_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")), orders):
        batch.write.mode("append").parquet(landing)
        incremental_append(spark, landing, orders.schema, table, "order_id", ckpt,
                           at="order_purchase_timestamp").awaitTermination()
    loaded = spark.read.parquet(table)
    assert loaded.count() == loaded.select("order_id").distinct().count() == orders.count()
    assert {r.load_month for r in loaded.select("load_month").distinct().collect()} == {
        r[0] for r in orders.select(F.trunc(F.to_date("order_purchase_timestamp"), "MM")).distinct().collect()}
