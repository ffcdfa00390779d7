"""Order-level aggregates carry no more of a row than what they pick."""

from pyspark.sql import functions as F

from starforge.plans import facts


def test_aggregates_carry_what_they_pick(spark):
    items = spark.createDataFrame([("o", 1, "p2", "s", 5.0, 1.0), ("o", 1, "p1", "t", 1.0, 1.0), ("o", 2, "p0", "s", 9.0, None)],
                                  "order_id string, order_item_id int, product_id string, seller_id string, price double,"
                                  " freight_value double")
    items = items.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("price", "freight_value")})
    first, most = facts.order_items_agg(items), facts.order_items_agg(items, "most_expensive")
    assert [(r.primary_product_id, r.seller_id) for r in (first.first(), most.first())] == [("p1", "t"), ("p0", "s")]
    struct = first._jdf.queryExecution().optimizedPlan().toString().split("min(struct(")[1].split(")")[0]
    assert "price" not in struct and "seller_id" in struct
    paid = spark.createDataFrame([("o", 1, None, 1, 2), ("o", 1, "b", 3, 9), ("q", 2, "c", 1, 1)],
                                 "order_id string, payment_sequential int, payment_type string, payment_installments int,"
                                 " payment_value int")
    assert {r.order_id: r.payment_type for r in facts.payments_agg(paid).collect()} == {"o": None, "q": "c"}
    assert {r.order_id: r.payment_type for r in facts.payments_agg(paid, "largest").collect()} == {"o": "b", "q": "c"}
