"""DuckDB SQL for the queries of ``plans/catalog_loads.py``."""

from __future__ import annotations

from oracle import duckdb_sql as base
from starforge.schemas import TARGETS
from starforge.sources.fixtures import REVIEW_TEXT_SQL

SPLIT = "TIMESTAMP '1999-01-01'"
MOST = "9999999999.99"                  # DECIMAL(12,2)


def changed_sources(changes: dict[str, str]) -> list[str]:
    """The fixture views; ``changes`` maps a view to a SELECT over ``whole_<view>``."""
    out = []
    for cte in base._fixture_ctes():
        name, rest = cte.split(" AS ", 1)
        if name in changes:
            out += [f"whole_{name} AS {rest}", f"{name} AS ({changes[name]})"]
        else:
            out.append(cte)
    return out


def warehouse_over(sources: list[str], replace=()) -> str:
    parts = [*sources, base._calendar(), *base._products(), *base._payment_types(), *base._customers(),
             *base._facts(), *base._cohort()]
    text = "WITH " + ",\n".join(parts) + "\n"
    for old, new in replace:
        assert old in text, old
        text = text.replace(old, new)
    return text


def _mod(col: str, n: int) -> str:
    return f"CAST({col} AS BIGINT) % {n} = 0"


DAMAGED = {
    "src_orders": "SELECT * REPLACE (CASE WHEN " + _mod("order_id", 41) + " THEN NULL ELSE"
                  " order_delivered_customer_date END AS order_delivered_customer_date) FROM whole_src_orders",
    "src_order_items": "SELECT * REPLACE (CASE WHEN " + _mod("order_id", 43) + " AND order_item_id = 1 THEN NULL"
                       " ELSE price END AS price) FROM whole_src_order_items",
    "src_products": "SELECT * REPLACE (CASE WHEN " + _mod("product_id", 37) + " THEN NULL ELSE product_photos_qty"
                    " END AS product_photos_qty) FROM whole_src_products",
    "src_payments": "SELECT * REPLACE (CASE WHEN " + _mod("order_id", 47) + " THEN NULL ELSE payment_value END AS"
                    " payment_value, CASE WHEN " + _mod("order_id", 53) + " THEN NULL ELSE payment_installments END"
                    " AS payment_installments) FROM whole_src_payments",
    "src_reviews": "SELECT * REPLACE (CASE WHEN " + _mod("review_id", 59) + " THEN NULL ELSE review_score END AS"
                   " review_score) FROM whole_src_reviews",
}

# per source: its columns in the declared order, and the rule of a column whose value is lost
LEDGER = {
    "orders": ("order_id customer_id order_status order_purchase_timestamp order_delivered_customer_date"
               " order_estimated_delivery_date",
               {"order_delivered_customer_date": _mod("order_id", 41)}, _mod("order_id", 97)),
    "order_items": ("order_id order_item_id product_id seller_id price freight_value",
                    {"price": _mod("order_id", 43) + " AND order_item_id = 1"},
                    _mod("order_id", 89) + " AND order_item_id = 1"),
    "customers": ("customer_id customer_unique_id customer_city customer_state", {}, "false"),
    "products": ("product_id product_category_name product_weight_g product_length_cm product_height_cm"
                 " product_width_cm product_photos_qty", {"product_photos_qty": _mod("product_id", 37)}, "false"),
    "payments": ("order_id payment_sequential payment_type payment_installments payment_value",
                 {"payment_value": _mod("order_id", 47), "payment_installments": _mod("order_id", 53)},
                 _mod("order_id", 83)),
    "reviews": ("review_id order_id review_score review_creation_date",
                {"review_score": _mod("review_id", 59)}, "false"),
}


def _ledger() -> str:
    parts = []
    for table, (cols, lost, twice) in LEDGER.items():
        for c in cols.split():
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name,"
                f" count(*) + count(*) FILTER (WHERE {twice}) AS rows_read,"
                f" count(*) FILTER (WHERE {twice}) AS malformed_rows,"
                f" count(*) FILTER (WHERE {lost.get(c, 'false')}) AS values_nulled FROM src_{table}")
    return base.fixtures_only(" UNION ALL ".join(parts))


def _malformed() -> str:
    return base.fixtures_only(" UNION ALL ".join(
        f"SELECT * FROM (SELECT '{table}' AS table_name, {len(cols.split()) + 1} AS fields, count(*) AS lines"
        f" FROM src_{table} WHERE {twice}) WHERE lines > 0"
        for table, (cols, _, twice) in LEDGER.items()))


def _texts() -> str:
    return (f"WITH t AS ({REVIEW_TEXT_SQL.format(documents='documents')}), r AS (SELECT *,"
            " CASE WHEN answer_mark IS NOT NULL THEN CAST(DATE '2000-01-01'"
            " + CAST(CAST(answer_mark AS BIGINT) % 365 AS INTEGER) AS TIMESTAMP) END"
            " AS review_answer_timestamp FROM t) ")


def _select(table: str, source: str) -> str:
    cols = [f"CAST({c} AS DOUBLE) AS {c}" if c in base.MONEY.get(table, []) else c
            for c in base.COLUMNS[table].split()]
    return f"SELECT {', '.join(cols)} FROM {source}"


LARGE = {"src_order_items": "SELECT * REPLACE (CASE WHEN " + _mod("order_id", 997) + " THEN"
                            " CAST(9999999999.00 AS DECIMAL(12,2)) WHEN " + _mod("order_id", 101) +
                            " AND order_item_id = 1 THEN CAST(30000001.00 AS DECIMAL(12,2)) ELSE price END AS price)"
                            " FROM whole_src_order_items"}
CUSTOMER_MONEY = ("total_spent", "avg_order_value", "lifetime_value", "purchase_frequency_annual")
ORDER_MONEY = ("order_subtotal", "order_freight_total", "order_total_value", "payment_value")


def _over(cols, table: str = "") -> str:
    return " OR ".join(f"coalesce(abs({table}{c}) > {MOST}, false)" for c in cols)


def _large(select: str) -> str:
    return warehouse_over(changed_sources(LARGE), [
        ("  FROM cust)", f"  FROM cust WHERE NOT ({_over(CUSTOMER_MONEY)}))"),
        ("  FROM om m\n", f"  FROM (SELECT * FROM om WHERE NOT ({_over(ORDER_MONEY)})) m\n"),
    ]) + select


def _rejects() -> str:
    parts = [f"SELECT 'dim_customers' AS table_name, customer_id AS business_key, '{c}' AS column_name,"
             f" CAST({c} AS VARCHAR) AS value, 'out_of_range' AS reject_reason FROM cust"
             f" WHERE abs({c}) > {MOST}" for c in CUSTOMER_MONEY]
    parts += [f"SELECT 'fact_orders', order_id, '{c}', CAST({c} AS VARCHAR), 'out_of_range' FROM {src}"
              f" WHERE abs({c}) > {MOST}"
              for src, cols in (("ia", ORDER_MONEY[:3]), ("pa", ORDER_MONEY[3:])) for c in cols]
    return _large(" UNION ALL ".join(parts))


LOADS = """, first_load AS (
  SELECT CAST(1 AS BIGINT) AS load_id, row_number() OVER (ORDER BY order_id) AS new_key, f.*
  FROM fact_orders f WHERE order_purchase_timestamp < {split}),
loads AS (
  SELECT * FROM first_load UNION ALL
  SELECT CAST(2 AS BIGINT), (SELECT count(*) FROM first_load) + row_number() OVER (ORDER BY order_id), f.*
  FROM fact_orders f WHERE order_id NOT IN (SELECT order_id FROM first_load))
"""


def _loads(select: str) -> str:
    return base.warehouse_ctes() + LOADS.format(split=SPLIT) + select


def _observed() -> str:
    def rule(table, name, severity, cond):
        return (f"SELECT '{table}' AS table_name, '{name}' AS rule, '{severity}' AS severity,"
                f" count(*) FILTER (WHERE {cond}) AS bad_rows, count(*) AS total_rows,"
                f" {base.pct(f'count(*) FILTER (WHERE {cond})', 'count(*)')} AS bad_pct FROM {table}")
    fact = [("null_" + c, "info", f"{c} IS NULL") for c in ("customer_key", "product_key", "order_date_key",
                                                            "payment_type_key", "order_total_value")]
    fact += [("null_order_id", "raise", "order_id IS NULL"), ("negative_values", "error", "order_total_value < 0"),
             ("zero_values", "warn", "order_total_value = 0"), ("negative_delivery_days", "warn", "delivery_days < 0")]
    customers = [("null_customer_id", "raise", "customer_id IS NULL"),
                 ("null_customer_segment", "warn", "customer_segment IS NULL")]
    return base.with_wh(" UNION ALL ".join(
        [rule(t, "row_count", "info", "true") for t in ("dim_products", "dim_customers", "fact_orders")]
        + [rule("fact_orders", *r) for r in fact] + [rule("dim_customers", *r) for r in customers]))


def _observed_sources() -> str:
    parts = []
    for table, src, rules in base.VALIDATION.values():
        for name, severity, expr in [("row_count", "info", "count(*)"), *rules]:
            if "DISTINCT" not in expr:
                parts.append(f"SELECT '{table}' AS table_name, '{name}' AS rule, '{severity}' AS severity,"
                             f" CAST({expr} AS BIGINT) AS bad_rows, count(*) AS total_rows,"
                             f" {base.pct(expr, 'count(*)')} AS bad_pct FROM {src}")
    return "WITH " + ",\n".join(changed_sources(DAMAGED)) + "\n" + " UNION ALL ".join(parts)


def _customer(n: int, col: str = "customer_id") -> str:
    return f"coalesce(TRY_CAST({col} AS BIGINT) % {n} = 0, false)"


ATTRS = ("customer_unique_id customer_city customer_state customer_region customer_segment first_order_date"
         " last_order_date total_orders delivered_orders total_spent avg_order_value lifetime_value days_as_customer"
         " purchase_frequency_annual").split()


def _merge(select: str) -> str:
    """Current: the customers with an order before SPLIT; batch: all customers but every 7th."""
    early = ["e_orders AS (SELECT * FROM src_orders WHERE order_purchase_timestamp < " + SPLIT + ")",
             "e_customers AS (SELECT * FROM src_customers WHERE customer_id IN (SELECT customer_id FROM e_orders))",
             *base._customers("e_", "e_orders", "e_customers", with_rev=False)]
    same = " AND ".join(f"c.{a} IS NOT DISTINCT FROM n.{a}" for a in ATTRS)
    attrs = ", ".join(f"CASE WHEN n.customer_id IS NULL THEN c.{a} ELSE n.{a} END AS {a}" for a in ATTRS)
    own = [f"n AS (SELECT * FROM dim_customers WHERE NOT {_customer(7)})",
           f"""j AS (SELECT coalesce(c.customer_id, n.customer_id) AS customer_id, c.customer_key AS old_key, {attrs},
  CASE WHEN n.customer_id IS NULL THEN 'missing' WHEN c.customer_id IS NULL THEN 'new' WHEN {same} THEN 'same'
       ELSE 'changed' END AS change_class
  FROM e_dim_customers c FULL JOIN n ON c.customer_id = n.customer_id)""",
           """m AS (SELECT *, CASE WHEN change_class = 'new' THEN (SELECT max(customer_key) FROM e_dim_customers)
    + row_number() OVER (PARTITION BY change_class ORDER BY customer_id) ELSE old_key END AS customer_key FROM j)"""]
    return base.warehouse_ctes().rstrip() + ",\n" + ",\n".join([*early, *own]) + "\n" + select


def _months(table: bool) -> str:
    cols = "order_id, customer_id, order_status, order_purchase_timestamp"
    if table:
        return base.fixtures_only(
            f"SELECT {cols}, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS load_month FROM src_orders")
    late = "FROM src_orders WHERE order_purchase_timestamp >= TIMESTAMP '1998-11-01' AND "
    return base.fixtures_only(
        f"SELECT order_id, customer_id, 'zzz' AS order_status, order_purchase_timestamp,"
        f" 'duplicate_order_id' AS reject_reason {late} {_mod('order_id', 19)}"
        f" UNION ALL SELECT NULL, customer_id, order_status, order_purchase_timestamp, 'null_key' {late}"
        f" {_mod('order_id', 23)} UNION ALL SELECT order_id, customer_id, order_status, NULL,"
        f" 'null_order_purchase_timestamp' {late} {_mod('order_id', 29)}")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["s1_s7_csv_to_warehouse"] = warehouse_over(
        changed_sources(DAMAGED), [("arg_min(review_score", "arg_min_null(review_score")]) \
        + _select("fact_orders", "fact_orders")
    q["s7_extract_ledger"] = _ledger()
    q["s7_malformed_lines"] = _malformed()
    q["s2_derived_order_items"] = base.fixtures_only(
        "SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,"
        " CAST(freight_value AS DOUBLE) AS freight_value, CAST(price + freight_value AS DOUBLE) AS item_total"
        " FROM src_order_items")
    q["s4_derived_products"] = base.fixtures_only(
        "SELECT *, CAST(product_length_cm * product_height_cm * product_width_cm AS DOUBLE) AS product_volume_cm3,"
        " coalesce(product_photos_qty > 0, false) AS has_photos FROM src_products")
    q["s6_review_text"] = _texts() + (
        "SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,"
        " review_answer_timestamp, substring(review_comment_message, 1, 200) AS message_start FROM r")
    texts = _texts()[len("WITH "):]
    q["v4_v5_v6_extract_metrics"] = (
        "WITH " + ",\n".join(base._fixture_ctes()) + ", " + texts +
        "SELECT 'products' AS table_name, 'products_with_photos' AS metric,"
        " count(*) FILTER (WHERE product_photos_qty > 0) AS value, count(*) AS total_rows FROM src_products"
        " UNION ALL SELECT 'payments', 'max_payment_sequential', CAST(max(payment_sequential) AS BIGINT), count(*)"
        " FROM src_payments"
        " UNION ALL SELECT 'reviews', 'reviews_with_title', count(review_comment_title), count(*) FROM r"
        " UNION ALL SELECT 'reviews', 'reviews_with_message', count(review_comment_message), count(*) FROM r"
        " UNION ALL SELECT 'reviews', 'reviews_with_answer', count(review_answer_timestamp), count(*) FROM r")
    q["s8_staged_csv_customers"] = q["k3_bom_csv_values"] = base.table_select("dim_customers")
    q["s8_staged_csv_fact"] = base.table_select("fact_orders")
    q["k2_reloaded_products"] = base.table_select("dim_products")
    q["k5_reloaded_cohorts"] = base.table_select("fact_cohort_retention")
    money = base.MONEY["fact_orders"]
    cols = [c for c in base.COLUMNS["fact_orders"].split() if c != "order_key"]
    q["k4_repeated_loads"] = _loads(
        "SELECT load_id, new_key AS order_key, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols) + " FROM loads")
    row = "order_id, order_status, CAST(order_total_value AS DOUBLE) AS order_total_value"
    q["k4_load_quarantine"] = _loads(
        f"SELECT CAST(2 AS BIGINT) AS load_id, {row}, 'loaded_order_id' AS reject_reason FROM first_load"
        f" UNION ALL SELECT 2, {row}, 'duplicate_order_id' FROM fact_orders WHERE {_mod('order_id', 31)}"
        f" UNION ALL SELECT 2, {row.replace('order_status', chr(39) + 'zzz' + chr(39) + ' AS order_status')},"
        f" 'duplicate_order_id' FROM fact_orders WHERE {_mod('order_id', 31)}"
        f" UNION ALL SELECT 2, {row.replace('order_id,', 'NULL AS order_id,', 1)}, 'null_key' FROM fact_orders"
        f" WHERE {_mod('order_id', 67)}")
    q["k8_out_of_range"] = _rejects()
    q["k8_out_of_range_rest"] = _large(
        "SELECT order_key, order_id, customer_key, product_key, CAST(order_total_value AS DOUBLE)"
        " AS order_total_value FROM fact_orders")
    some = ("order_key, order_id, customer_key, product_key, order_status,"
            " CAST(order_total_value AS DOUBLE) AS order_total_value, review_score")
    early = changed_sources({"src_orders": "SELECT * FROM whole_src_orders"
                                           f" WHERE order_purchase_timestamp < {SPLIT}"})
    q["k1_k7_cutover"] = (
        f"SELECT 1 AS version, * FROM ({warehouse_over(early)} SELECT {some} FROM fact_orders)"
        f" UNION ALL SELECT 2 AS version, * FROM ({base.warehouse_ctes()} SELECT {some} FROM fact_orders)")
    q["q1_q6_q8_observed"] = _observed()
    q["v1_v6_observed"] = _observed_sources()
    q["d8_merge_classes"] = _merge("SELECT customer_id, customer_key, change_class FROM m")
    kept = [a for a in ATTRS if a not in ("first_order_date", "last_order_date")]
    q["d8_merge_table"] = _merge("SELECT customer_key, customer_id, " + ", ".join(
        f"CAST({a} AS DOUBLE) AS {a}" if a in base.MONEY["dim_customers"] else a for a in kept) + " FROM m")
    row = "customer_city, total_orders, CAST(total_spent AS DOUBLE) AS total_spent"
    q["d8_merge_rejects"] = _merge(
        f"SELECT customer_id, 'zz' AS customer_unique_id, {row}, 'duplicate_customer_id' AS reject_reason FROM n"
        f" WHERE {_customer(11)} UNION ALL SELECT NULL, customer_unique_id, {row}, 'null_key' FROM n"
        f" WHERE {_customer(13)}")
    keys = ("order_key", "customer_key", "product_key", "payment_type_key", "order_date_key")
    q["a7_distinct_keys"] = base.with_wh(
        "SELECT " + ", ".join(f"count(DISTINCT {k}) AS distinct_{k}" for k in keys) + " FROM fact_orders")
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(s.fields)} AS BIGINT)"
                                f" AS column_count FROM {t}" for t, s in TARGETS.items())
    total = "CAST(sum(row_count) AS BIGINT), CAST(sum(column_count) AS BIGINT) FROM c"
    q["a15_table_totals"] = (
        base.warehouse_ctes().rstrip() + f", c AS ({counts}) SELECT * FROM c UNION ALL SELECT 'all tables', {total}"
        f" UNION ALL SELECT 'all dimensions', {total} WHERE table_name LIKE 'dim%'"
        f" UNION ALL SELECT 'all facts', {total} WHERE table_name LIKE 'fact%'")
    q["d9_months_table"], q["d9_months_rejects"] = _months(True), _months(False)
    return q
