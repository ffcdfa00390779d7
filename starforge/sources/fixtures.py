"""Fixture views: the driver's TPC-H-like Parquet tables re-shaped into the six
source schemas of the warehouse (orders, order items, customers, products,
payments, reviews).

The SQL text is written once with ``{table}`` placeholders.  Spark fills them
with DataFrames (``spark.sql(text, orders=df)``), so no global view names are
registered; the oracle fills them with plain table names for DuckDB.  The same
text therefore defines the inputs of both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starforge.sources.tables import Sources

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

FIXTURE_SQL = {
    "src_orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
  o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 17 AS INT) AS order_purchase_timestamp,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' HOUR
    * CAST(24 * (1 + o_orderkey % 25) + o_orderkey % 23 AS INT) END AS order_delivered_customer_date,
  o_orderdate + INTERVAL '1' DAY * CAST(10 + o_orderkey % 11 AS INT) AS order_estimated_delivery_date
FROM {orders}""",
    "src_order_items": """
SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS order_item_id,
  CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
FROM {lineitem}""",
    "src_customers": """
SELECT CAST(c_custkey AS STRING) AS customer_id, CAST(c_custkey - c_custkey % 2 AS STRING) AS customer_unique_id,
  c_mktsegment AS customer_city, CASE WHEN c_nationkey = 24 THEN NULL ELSE n_name END AS customer_state
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL SELECT 'no-order-1', 'no-order-1', 'BUILDING', 'NATION_0'""",
    "src_products": """
SELECT CAST(p_partkey AS STRING) AS product_id,
  CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_type END AS product_category_name,
  p_size * 100 AS product_weight_g, p_size AS product_length_cm, p_size % 7 AS product_height_cm,
  p_size % 5 + 1 AS product_width_cm,
  CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST(p_partkey % 4 AS INT) END AS product_photos_qty
FROM {part}""",
    "src_payments": """
SELECT CAST(CAST(FLOOR(event_id * 3 / 5.0) AS BIGINT) AS STRING) AS order_id,
  CAST(1 + event_id % 3 AS INT) AS payment_sequential,
  CASE event_type WHEN 'view' THEN 'credit_card' WHEN 'click' THEN 'boleto' WHEN 'signup' THEN 'debit_card'
    WHEN 'purchase' THEN 'voucher' ELSE 'gift_points' END AS payment_type,
  CAST(1 + event_id % 12 AS INT) AS payment_installments, CAST(value AS DECIMAL(12,2)) AS payment_value
FROM {events}""",
    "src_reviews": """
SELECT CAST(event_id AS STRING) AS review_id,
  CAST(CAST(FLOOR(event_id * 4 / 5.0) AS BIGINT) AS STRING) AS order_id,
  CAST(1 + event_id % 5 AS INT) AS review_score, ts AS review_creation_date
FROM {events}""",
}

# reviews with their free text (line breaks, quotes, commas): the texts of the documents
REVIEW_TEXT_SQL = """
SELECT CAST(doc_id AS STRING) AS review_id, CAST(doc_id AS STRING) AS order_id,
  CAST(1 + doc_id % 5 AS INT) AS review_score,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CONCAT('"', source, '", ', lang) END AS review_comment_title,
  CASE WHEN text = '' THEN NULL ELSE text END AS review_comment_message,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id AS STRING) END AS answer_mark
FROM {documents}"""

# which driver tables each view reads
FIXTURE_INPUTS = {
    "src_orders": ("orders",),
    "src_order_items": ("lineitem",),
    "src_customers": ("customer", "nation"),
    "src_products": ("part",),
    "src_payments": ("events",),
    "src_reviews": ("events",),
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    tables = {t: driver_table(spark, sf_dir, t) for t in FIXTURE_INPUTS[view]}
    return spark.sql(FIXTURE_SQL[view], **tables)


def load_fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    v = {name: fixture_view(spark, sf_dir, name) for name in FIXTURE_SQL}
    return Sources(orders=v["src_orders"], order_items=v["src_order_items"],
                   customers=v["src_customers"], products=v["src_products"],
                   payments=v["src_payments"], reviews=v["src_reviews"])
