"""DuckDB SQL for each registered query.

The warehouse tables are restated as CTEs over the driver's tables: the
fixture views (same text as the Spark side), then the dimensions and facts
written the plain SQL way (joins to the dimensions, ROW_NUMBER keys,
arg_min for "first").  Money stays DECIMAL inside and is cast to DOUBLE in
the outer SELECT, like the Spark side's ``for_oracle``.
"""

from __future__ import annotations

from starforge.rules import FIXTURE_RULES, first_group_of
from starforge.sources.fixtures import FIXTURE_SQL

R = FIXTURE_RULES
MICROS_PER_DAY = "86400000000.0"
RETENTION_SINCE = "1999-01-01"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(pairs) -> str:
    return ", ".join(f"({_q(k)}, {_q(v)})" for k, v in pairs)


def days(later: str, earlier: str) -> str:
    """Whole days, floored."""
    return f"CAST(floor(date_diff('microsecond', {earlier}, {later}) / {MICROS_PER_DAY}) AS INTEGER)"


def rr_dec(num: str, den: str, scale: int = 2) -> str:
    """num / den rounded half away from zero to ``scale`` places, as DECIMAL."""
    n, d, p = f"CAST(({num}) AS BIGINT)", f"CAST(({den}) AS BIGINT)", 10 ** scale
    units = (f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
             f"((2 * abs({n}) * {p} + abs({d})) // (2 * abs({d})))")
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST({units} AS DECIMAL(18,0))"
            f" * CAST({1 / p} AS DECIMAL({scale + 1},{scale})) END)")


def rr(num: str, den: str, scale: int = 2) -> str:
    """Same as ``rr_dec``, as DOUBLE."""
    return f"CAST({rr_dec(num, den, scale)} AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"coalesce(CAST(({part}) AS DOUBLE) / NULLIF(CAST(({whole}) AS DOUBLE), 0) * 100.0, 0.0)"


def mean(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / NULLIF(CAST(count({x}) AS DOUBLE), 0)"


def _fixture_ctes() -> list[str]:
    names = {t: t for t in ("orders", "lineitem", "customer", "nation", "part", "events")}
    return [f"{view} AS ({text.format(**names)})" for view, text in FIXTURE_SQL.items()]


def _calendar() -> str:
    hol = ", ".join(f"DATE '{h}'" for h in R.holidays)
    return f"""dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
    CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month,
    CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
    isodow(d) >= 6 AS is_weekend, d IN ({hol}) AS is_holiday,
    CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
  FROM (SELECT CAST(range AS DATE) AS d
        FROM range(TIMESTAMP '{R.calendar_start}', TIMESTAMP '{R.calendar_end}' + INTERVAL 1 DAY,
                   INTERVAL 1 DAY)))"""


def _products() -> list[str]:
    return [
        f"tr(k, v) AS (VALUES {_values(R.translations)})",
        f"sg(k, v) AS (VALUES {_values(first_group_of(R.category_segments))})",
        """prod AS (
  SELECT p.*, coalesce(tr.v, p.product_category_name, 'uncategorized') AS eng
  FROM src_products p LEFT JOIN tr ON p.product_category_name = tr.k
  WHERE p.product_id IS NOT NULL)""",
        """dim_products AS (
  SELECT row_number() OVER (ORDER BY p.product_id NULLS FIRST,
           p.product_category_name NULLS FIRST, p.product_photos_qty NULLS FIRST) AS product_key,
    p.product_id, p.product_category_name, p.eng AS product_category_english,
    coalesce(sg.v, 'Other') AS product_category_segment,
    p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
    CAST(round(CAST(p.product_length_cm AS DECIMAL(20,2)) * p.product_height_cm
               * p.product_width_cm, 2) AS DECIMAL(12,2)) AS product_volume_cm3,
    p.product_photos_qty, coalesce(p.product_photos_qty > 0, false) AS has_photos
  FROM prod p LEFT JOIN sg ON p.eng = sg.k)""",
    ]


def _payment_types() -> list[str]:
    return [
        f"pc(k, v) AS (VALUES {_values(R.payment_categories)})",
        """dim_payment_type AS (
  SELECT row_number() OVER (ORDER BY t.payment_type) AS payment_type_key, t.payment_type,
    coalesce(pc.v, 'Other') AS payment_category
  FROM (SELECT DISTINCT payment_type FROM src_payments WHERE payment_type IS NOT NULL) t
  LEFT JOIN pc ON t.payment_type = pc.k)""",
    ]


def _segment(orders: str, ltv: str) -> str:
    return (f"CASE WHEN {orders} = 0 THEN 'Inactive' "
            f"WHEN {orders} >= {R.vip_min_orders} OR coalesce(CAST({ltv} AS DOUBLE), 0.0) >= "
            f"{float(R.vip_min_value)} THEN 'VIP' "
            f"WHEN {orders} <= {R.new_max_orders} THEN 'New' "
            f"WHEN {orders} <= {R.returning_max_orders} THEN 'Returning' ELSE 'Loyal' END")


def _metrics_cte(name: str, grain: str, orders_src: str) -> list[str]:
    return [f"""{name}0 AS (
  SELECT o.{grain}, count(o.order_id) AS total_orders,
    sum(coalesce(r.order_total, CAST(0 AS DECIMAL(12,2)))) AS total_spent,
    min(o.order_purchase_timestamp) AS first_order_date,
    max(o.order_purchase_timestamp) AS last_order_date,
    count(*) FILTER (WHERE o.order_status = 'delivered') AS delivered_orders
  FROM {orders_src} o LEFT JOIN rev r ON o.order_id = r.order_id GROUP BY o.{grain})""",
            f"""{name} AS (
  SELECT *, CASE WHEN dd IS NOT NULL THEN greatest(dd, 1) END AS days_as_customer,
    CAST(total_spent * 100 AS BIGINT) AS cents
  FROM (SELECT *, {days('last_order_date', 'first_order_date')} AS dd FROM {name}0))"""]


def _customers(prefix: str = "", orders_src: str = "src_orders",
               customers_src: str = "src_customers", with_rev: bool = True) -> list[str]:
    L = R.lifespan_days
    rev = ["rev AS (SELECT order_id, sum(price + freight_value) AS order_total FROM src_order_items"
           " GROUP BY order_id)"] if with_rev else []
    return [
        *rev,
        *_metrics_cte(f"{prefix}cm", "customer_id", orders_src),
        *([f"rg(k, v) AS (VALUES {_values(first_group_of(R.regions))})"] if with_rev else []),
        f"""{prefix}cust AS (
  SELECT c.*, m.first_order_date, m.last_order_date, m.delivered_orders, m.days_as_customer,
    coalesce(m.total_orders, 0) AS total_orders,
    CASE WHEN m.total_orders IS NULL THEN CAST(0 AS DECIMAL(12,2)) ELSE m.total_spent END AS total_spent,
    {rr_dec('m.cents', 'm.total_orders * 100')} AS avg_order_value,
    CASE WHEN m.total_orders IS NULL THEN CAST(0 AS DECIMAL(12,2))
         ELSE {rr_dec(f'm.cents * {L}', 'm.days_as_customer * 100')} END AS lifetime_value,
    {rr_dec('m.total_orders * 365', 'm.days_as_customer')} AS purchase_frequency_annual,
    CASE WHEN c.customer_state IS NULL THEN 'Unknown' ELSE coalesce(rg.v, 'Other') END
      AS customer_region
  FROM {customers_src} c LEFT JOIN {prefix}cm m ON c.customer_id = m.customer_id
  LEFT JOIN rg ON c.customer_state = rg.k)""",
        f"""{prefix}dim_customers AS (
  SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST, customer_unique_id NULLS FIRST,
           customer_city NULLS FIRST, customer_state NULLS FIRST) AS customer_key,
    customer_id, customer_unique_id, customer_city, customer_state, customer_region,
    {_segment('total_orders', 'lifetime_value')} AS customer_segment,
    first_order_date, last_order_date, CAST(total_orders AS INTEGER) AS total_orders,
    CAST(delivered_orders AS INTEGER) AS delivered_orders, total_spent, avg_order_value,
    lifetime_value, days_as_customer, purchase_frequency_annual
  FROM {prefix}cust)""",
    ]


ITEM_TIE = "(order_item_id, product_id, seller_id, price, freight_value)"
PAY_TIE = "(payment_sequential, payment_type, payment_value, payment_installments)"
REVIEW_TIE = "(review_creation_date, review_id, review_score)"


def _items_agg(primary: str = "first") -> str:
    tie = ITEM_TIE if primary == "first" else \
        "(-coalesce(price, 0), order_item_id, product_id, seller_id, price, freight_value)"
    return f"""SELECT order_id, count(order_item_id) AS order_item_count,
    coalesce(sum(price), 0) AS order_subtotal, coalesce(sum(freight_value), 0) AS order_freight_total,
    coalesce(sum(price + freight_value), 0) AS order_total_value,
    arg_min(product_id, {tie}) AS primary_product_id, arg_min(seller_id, {tie}) AS seller_id
  FROM src_order_items GROUP BY order_id"""


def _payments_agg(primary: str = "first") -> str:
    tie = PAY_TIE if primary == "first" else \
        "(-coalesce(payment_value, 0), payment_sequential, payment_type, payment_value, payment_installments)"
    return f"""SELECT order_id, coalesce(sum(payment_value), 0) AS payment_value,
    arg_min(payment_type, {tie}) AS payment_type, max(payment_installments) AS payment_installments
  FROM src_payments GROUP BY order_id"""


def _facts() -> list[str]:
    return [
        f"ia AS ({_items_agg()})",
        f"pa AS ({_payments_agg()})",
        f"""ra AS (SELECT order_id, arg_min(review_score, {REVIEW_TIE}) AS review_score,
    count(*) AS review_rows FROM src_reviews GROUP BY order_id)""",
        """uo AS (SELECT * FROM src_orders WHERE order_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST,
    order_status NULLS FIRST, order_purchase_timestamp NULLS FIRST,
    order_delivered_customer_date NULLS FIRST, order_estimated_delivery_date NULLS FIRST) = 1)""",
        f"""om AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
    o.order_delivered_customer_date, o.order_estimated_delivery_date,
    coalesce(ia.order_item_count, 0) AS order_item_count,
    coalesce(ia.order_subtotal, 0) AS order_subtotal,
    coalesce(ia.order_freight_total, 0) AS order_freight_total,
    coalesce(ia.order_total_value, 0) AS order_total_value,
    ia.primary_product_id, ia.seller_id,
    coalesce(pa.payment_value, 0) AS payment_value,
    coalesce(pa.payment_installments, 1) AS payment_installments,
    coalesce(pa.payment_type, 'not_defined') AS payment_type,
    ra.review_score, ra.review_score IS NOT NULL AS has_review,
    coalesce(ra.review_rows, 0) AS review_rows,
    coalesce({days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')}, 0) AS delivery_days,
    {days('o.order_estimated_delivery_date', 'o.order_purchase_timestamp')} AS estimated_delivery_days,
    coalesce({days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')}, 0)
      AS delivery_delay_days,
    coalesce({days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} > 0, false)
      AS is_late_delivery,
    coalesce(o.order_status = 'delivered', false) AS is_completed_order
  FROM uo o LEFT JOIN ia ON o.order_id = ia.order_id LEFT JOIN pa ON o.order_id = pa.order_id
  LEFT JOIN ra ON o.order_id = ra.order_id)""",
        """fact_orders AS (
  SELECT row_number() OVER (ORDER BY m.order_id) AS order_key, c.customer_key, p.product_key,
    d1.date_key AS order_date_key, d2.date_key AS delivery_date_key, pt.payment_type_key,
    m.order_id, m.order_status, m.seller_id, CAST(m.order_item_count AS INTEGER) AS order_item_count,
    m.order_subtotal, m.order_freight_total, m.order_total_value, m.payment_value,
    CAST(m.payment_installments AS INTEGER) AS payment_installments, m.delivery_days,
    m.estimated_delivery_days, m.delivery_delay_days, m.is_late_delivery, m.is_completed_order,
    m.review_score, m.has_review, m.order_purchase_timestamp, m.order_delivered_customer_date
  FROM om m
  LEFT JOIN dim_customers c ON m.customer_id = c.customer_id
  LEFT JOIN dim_products p ON m.primary_product_id = p.product_id
  LEFT JOIN dim_payment_type pt ON m.payment_type = pt.payment_type
  LEFT JOIN dim_date d1 ON CAST(m.order_purchase_timestamp AS DATE) = d1.full_date
  LEFT JOIN dim_date d2 ON CAST(m.order_delivered_customer_date AS DATE) = d2.full_date)""",
    ]


def _cohort() -> list[str]:
    return [
        """act AS (SELECT DISTINCT customer_id,
    CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month
  FROM src_orders WHERE order_purchase_timestamp IS NOT NULL AND customer_id IS NOT NULL)""",
        """coh AS (SELECT DISTINCT customer_id,
    CAST(date_trunc('month', first_order_date) AS DATE) AS cohort_month
  FROM dim_customers WHERE first_order_date IS NOT NULL)""",
        """cells AS (SELECT cohort_month,
    CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month)
         AS INTEGER) AS m,
    CAST(count(DISTINCT customer_id) AS INTEGER) AS retained_customers
  FROM act JOIN coh USING (customer_id) GROUP BY 1, 2)""",
        f"""fact_cohort_retention AS (
  SELECT row_number() OVER (ORDER BY c.cohort_month, c.m) AS cohort_retention_key,
    c.cohort_month, c.m AS months_since_first_purchase, s.retained_customers AS cohort_size,
    c.retained_customers, {rr_dec('c.retained_customers * 100', 's.retained_customers')} AS retention_rate
  FROM cells c LEFT JOIN cells s ON s.cohort_month = c.cohort_month AND s.m = 0)""",
    ]


def warehouse_ctes() -> str:
    parts = [*_fixture_ctes(), _calendar(), *_products(), *_payment_types(), *_customers(),
             *_facts(), *_cohort()]
    return "WITH " + ",\n".join(parts) + "\n"


def with_wh(select: str) -> str:
    return warehouse_ctes() + select


def fixtures_only(select: str) -> str:
    return "WITH " + ",\n".join(_fixture_ctes()) + "\n" + select


MONEY = {
    "dim_products": ["product_volume_cm3"],
    "dim_customers": ["total_spent", "avg_order_value", "lifetime_value",
                      "purchase_frequency_annual"],
    "fact_orders": ["order_subtotal", "order_freight_total", "order_total_value", "payment_value"],
    "fact_cohort_retention": ["retention_rate"],
}

COLUMNS = {
    "dim_date": "date_key full_date year quarter month month_name week day_of_month day_of_week"
                " day_name is_weekend is_holiday fiscal_year fiscal_quarter",
    "dim_products": "product_key product_id product_category_name product_category_english"
                    " product_category_segment product_weight_g product_length_cm product_height_cm"
                    " product_width_cm product_volume_cm3 product_photos_qty has_photos",
    "dim_payment_type": "payment_type_key payment_type payment_category",
    "dim_customers": "customer_key customer_id customer_unique_id customer_city customer_state"
                     " customer_region customer_segment first_order_date last_order_date total_orders"
                     " delivered_orders total_spent avg_order_value lifetime_value days_as_customer"
                     " purchase_frequency_annual",
    "fact_orders": "order_key customer_key product_key order_date_key delivery_date_key"
                   " payment_type_key order_id order_status seller_id order_item_count order_subtotal"
                   " order_freight_total order_total_value payment_value payment_installments"
                   " delivery_days estimated_delivery_days delivery_delay_days is_late_delivery"
                   " is_completed_order review_score has_review order_purchase_timestamp"
                   " order_delivered_customer_date",
    "fact_cohort_retention": "cohort_retention_key cohort_month months_since_first_purchase"
                             " cohort_size retained_customers retention_rate",
}


def table_select(name: str) -> str:
    cols = [f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY.get(name, []) else c
            for c in COLUMNS[name].split()]
    return with_wh(f"SELECT {', '.join(cols)} FROM {name}")


def _share(col: str, src: str) -> str:
    """value counts with share of all rows."""
    return (f"SELECT {col}, count(*) AS count, "
            f"{rr('count(*) * 100', f'(SELECT count(*) FROM {src})')} AS percentage "
            f"FROM {src} GROUP BY {col}")


def _top_share(col: str, src: str, k: int) -> str:
    return (f"SELECT * FROM ({_share(col, src)}) ORDER BY count DESC, {col} ASC NULLS FIRST "
            f"LIMIT {k}")


def _null_counts(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
             f" count(*) AS total_rows,"
             f" {pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS null_pct FROM {src}"
             for c in cols]
    return " UNION ALL ".join(parts)


def _validate(table: str, src: str, rules: list[tuple[str, str, str]]) -> str:
    parts = [f"SELECT '{table}' AS table_name, '{name}' AS rule, '{sev}' AS severity,"
             f" CAST({expr} AS BIGINT) AS bad_rows, count(*) AS total_rows,"
             f" {pct(expr, 'count(*)')} AS bad_pct FROM {src}"
             for name, sev, expr in rules]
    return fixtures_only(" UNION ALL ".join(parts))


def _dup(c: str) -> str:
    return (f"(count(*) - count(DISTINCT {c}) - "
            f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 1 ELSE 0 END)")


def _nul(c: str) -> str:
    return f"count(*) FILTER (WHERE {c} IS NULL)"


def _bad_or_null(c: str, pred: str) -> str:
    return f"count(*) FILTER (WHERE coalesce({pred}, true))"


VALIDATION = {
    "v1_orders": ("orders", "src_orders", [
        ("duplicate_order_id", "warn", _dup("order_id")),
        ("null_order_id", "raise", _nul("order_id")),
        ("null_customer_id", "raise", _nul("customer_id"))]),
    "v2_order_items": ("order_items", "src_order_items", [
        ("negative_price", "warn", "count(*) FILTER (WHERE price < 0)"),
        ("zero_price", "warn", "count(*) FILTER (WHERE price = 0)"),
        ("null_order_id", "raise", _nul("order_id")),
        ("null_product_id", "raise", _nul("product_id"))]),
    "v3_customers": ("customers", "src_customers", [
        ("duplicate_customer_id", "warn", _dup("customer_id")),
        ("repeat_customer_records", "info", "(count(*) - count(DISTINCT customer_unique_id))"),
        ("null_customer_id", "raise", _nul("customer_id")),
        ("null_customer_unique_id", "raise", _nul("customer_unique_id")),
        ("null_customer_state", "warn", _nul("customer_state")),
        ("null_customer_city", "warn", _nul("customer_city")),
        ("invalid_state_length", "warn",
         _bad_or_null("customer_state", "length(customer_state) <> 2"))]),
    "v4_products": ("products", "src_products", [
        ("duplicate_product_id", "error", _dup("product_id")),
        ("null_product_id", "raise", _nul("product_id")),
        ("null_category", "warn", _nul("product_category_name")),
        *[(f"invalid_{c}", "warn", _bad_or_null(c, f"{c} <= 0"))
          for c in ("product_weight_g", "product_length_cm", "product_height_cm",
                    "product_width_cm")]]),
    "v5_payments": ("payments", "src_payments", [
        ("null_order_id", "raise", _nul("order_id")),
        ("null_payment_type", "warn", _nul("payment_type")),
        ("negative_payment_value", "error", "count(*) FILTER (WHERE payment_value < 0)"),
        ("zero_payment_value", "warn", "count(*) FILTER (WHERE payment_value = 0)"),
        ("null_payment_value", "warn", _nul("payment_value")),
        ("installments_below_one", "warn", "count(*) FILTER (WHERE payment_installments < 1)")]),
    "v6_reviews": ("reviews", "src_reviews", [
        ("duplicate_review_id", "warn", _dup("review_id")),
        ("null_review_id", "raise", _nul("review_id")),
        ("null_order_id", "raise", _nul("order_id")),
        ("null_review_score", "warn", _nul("review_score")),
        ("score_out_of_range", "error",
         "count(*) FILTER (WHERE review_score < 1 OR review_score > 5)")]),
}


def _numeric_summary(col: str, src: str, where: str = "", money: bool = False) -> str:
    w = f" WHERE {where}" if where else ""
    s = f"CAST(sum({col}) AS DOUBLE)" if money else f"sum({col})"
    mx = (f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max" if money
          else f"min({col}) AS min, max({col}) AS max")
    return (f"SELECT {s} AS sum, {mean(col)} AS mean, {mx}, "
            f"median(CAST({col} AS DOUBLE)) AS median FROM {src}{w}")


def _multi_rows(key: str, src: str) -> str:
    return (f"SELECT count(*) FILTER (WHERE n > 1) AS multi_row_groups, count(*) AS groups, "
            f"{rr('count(*) FILTER (WHERE n > 1) * 100', 'count(*)')} AS multi_pct "
            f"FROM (SELECT {key}, count(*) AS n FROM {src} GROUP BY {key})")


def _orphans(fk: str, dim: str, dk: str) -> str:
    return (f"SELECT '{fk}' AS check_name, count(*) AS total_rows, count(DISTINCT f.{fk}) AS unique_keys,"
            f" count(DISTINCT d.{dk}) AS matched_keys,"
            f" count(DISTINCT f.{fk}) - count(DISTINCT d.{dk}) AS orphaned_keys"
            f" FROM fact_orders f LEFT JOIN (SELECT DISTINCT {dk} FROM {dim}) d ON f.{fk} = d.{dk}")


def _unique(table: str, cols: tuple) -> str:
    k = ", ".join(cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (f"SELECT '{table}' AS table_name, '{','.join(cols)}' AS key_columns,"
            f" count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows,"
            f" count(*) = 0 AS passed"
            f" FROM (SELECT {k}, count(*) AS n FROM {table} WHERE {nn} GROUP BY {k} HAVING count(*) > 1)")


def _geo(level: str) -> str:
    return with_wh(
        f"SELECT c.{level}, CAST(sum(f.order_total_value) AS DOUBLE) AS revenue, count(*) AS orders,"
        f" count(DISTINCT f.customer_key) AS customers FROM fact_orders f"
        f" JOIN dim_customers c ON f.customer_key = c.customer_key WHERE f.is_completed_order"
        f" GROUP BY c.{level}")


def _delivery_class_sql() -> str:
    return (f"CASE WHEN coalesce(order_status <> 'delivered', true)"
            f" OR order_delivered_customer_date IS NULL THEN 'Not Delivered'"
            f" WHEN delivery_delay_days > {R.very_late_threshold_days} THEN 'Very Late'"
            f" WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'Late'"
            f" ELSE 'On-Time' END")


def oracle_sql() -> dict[str, str]:
    from starforge.schemas import MAX_LENGTHS, TARGETS, UNIQUE_KEYS
    q: dict[str, str] = {}
    for t in COLUMNS:
        q[t] = table_select(t)
    q["a1_order_items_agg"] = fixtures_only(
        "SELECT order_id, order_item_count, CAST(order_subtotal AS DOUBLE) AS order_subtotal,"
        " CAST(order_freight_total AS DOUBLE) AS order_freight_total,"
        " CAST(order_total_value AS DOUBLE) AS order_total_value, primary_product_id, seller_id"
        f" FROM ({_items_agg()})")
    q["a2_payments_agg"] = fixtures_only(
        "SELECT order_id, CAST(payment_value AS DOUBLE) AS payment_value, payment_type,"
        f" payment_installments FROM ({_payments_agg()})")
    q["k6_quarantine"] = fixtures_only(
        "SELECT order_id, review_id, review_score, 'duplicate_order_id_review' AS reject_reason"
        " FROM (SELECT r.order_id, r.review_id, r.review_score, row_number() OVER"
        " (PARTITION BY r.order_id ORDER BY r.review_creation_date, r.review_id, r.review_score) AS rn"
        " FROM src_reviews r WHERE r.order_id IN (SELECT order_id FROM src_orders)) WHERE rn > 1"
        " UNION ALL SELECT order_id, NULL, NULL, CASE WHEN order_id IS NULL THEN 'null_key'"
        " ELSE 'duplicate_order_id' END FROM (SELECT order_id, row_number() OVER (PARTITION BY"
        " order_id) AS rn FROM src_orders) WHERE rn > 1 OR order_id IS NULL")
    src_cols = {
        "s1_orders_csv": ("src_orders", "order_id customer_id order_status order_purchase_timestamp"
                          " order_delivered_customer_date order_estimated_delivery_date", []),
        "s2_order_items_csv": ("src_order_items",
                               "order_id order_item_id product_id seller_id price freight_value",
                               ["price", "freight_value"]),
        "s3_customers_csv": ("src_customers",
                             "customer_id customer_unique_id customer_city customer_state", []),
        "s4_products_csv": ("src_products", "product_id product_category_name product_weight_g"
                            " product_length_cm product_height_cm product_width_cm product_photos_qty",
                            []),
        "s5_payments_csv": ("src_payments", "order_id payment_sequential payment_type"
                            " payment_installments payment_value", ["payment_value"]),
        "s6_reviews_csv": ("src_reviews", "review_id order_id review_score review_creation_date", []),
    }
    for name, (src, cols, money) in src_cols.items():
        sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols.split())
        q[name] = fixtures_only(f"SELECT {sel} FROM {src}")
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(TARGETS[t].fields)} AS BIGINT)"
        f" AS column_count FROM {t}" for t in TARGETS)
    q["s8_s9_warehouse_readback"] = with_wh(counts)
    q["k2_k4_k5_load"] = with_wh(
        counts + " UNION ALL SELECT 'fact_orders_quarantine', CAST(0 AS BIGINT),"
        f" CAST({len(TARGETS['fact_orders'].fields) + 1} AS BIGINT)")
    q["q1_row_counts"] = with_wh(counts)
    q["k3_bom_csv_export"] = with_wh(counts)
    q["s11_adhoc_sql"] = with_wh(
        "SELECT order_status, count(*) AS orders, CAST(sum(order_total_value) AS DOUBLE) AS revenue"
        " FROM fact_orders WHERE order_total_value >= 100000 GROUP BY order_status")
    q["b1_top_customers"] = with_wh(
        "SELECT c.customer_id, c.customer_state, count(DISTINCT f.order_id) AS total_orders,"
        " CAST(sum(f.order_total_value) AS DOUBLE) AS lifetime_value FROM fact_orders f"
        " JOIN dim_customers c ON f.customer_key = c.customer_key WHERE f.is_completed_order = TRUE"
        " GROUP BY c.customer_id, c.customer_state ORDER BY sum(f.order_total_value) DESC,"
        " c.customer_id LIMIT 10")
    q["b2_monthly_revenue"] = with_wh(
        "SELECT d.year, d.month, d.month_name, count(*) AS order_count,"
        " CAST(sum(f.order_total_value) AS DOUBLE) AS monthly_revenue,"
        f" {mean('f.order_total_value')} AS avg_order_value"
        " FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key"
        " WHERE f.is_completed_order = TRUE GROUP BY d.year, d.month, d.month_name"
        " ORDER BY d.year, d.month")
    q["b3_retention_since"] = with_wh(
        "SELECT cohort_month, months_since_first_purchase, cohort_size, retained_customers,"
        " CAST(retention_rate AS DOUBLE) AS retention_rate FROM fact_cohort_retention"
        f" WHERE cohort_month >= DATE '{RETENTION_SINCE}'"
        " ORDER BY cohort_month, months_since_first_purchase")
    q["b4_category_segments"] = with_wh(
        "SELECT p.product_category_segment, count(DISTINCT f.order_id) AS order_count,"
        " CAST(sum(f.order_total_value) AS DOUBLE) AS total_revenue,"
        f" {mean('f.order_total_value')} AS avg_order_value, {mean('f.review_score')} AS avg_review_score"
        " FROM fact_orders f JOIN dim_products p ON f.product_key = p.product_key"
        " WHERE f.is_completed_order = TRUE GROUP BY p.product_category_segment")
    q["b5_revenue_metrics"] = with_wh(
        "SELECT CAST(sum(order_total_value) AS DOUBLE) AS total_revenue,"
        f" {mean('order_total_value')} AS avg_order_value, count(*) AS total_orders"
        " FROM fact_orders WHERE is_completed_order = TRUE")
    late, ontime = ("count(*) FILTER (WHERE is_late_delivery)",
                    "count(*) FILTER (WHERE NOT is_late_delivery)")
    q["b6_delivery_performance"] = with_wh(
        f"SELECT {late} AS late_deliveries, {ontime} AS on_time_deliveries,"
        f" {mean('delivery_days')} AS avg_delivery_days,"
        f" {pct(late, f'{late} + {ontime}')} AS late_pct,"
        f" 100.0 - {pct(late, f'{late} + {ontime}')} AS on_time_pct"
        " FROM fact_orders WHERE is_completed_order = TRUE")
    q["b7_status_top5"] = with_wh(
        "SELECT order_status, count(*) AS order_count FROM fact_orders GROUP BY order_status"
        " ORDER BY count(*) DESC, order_status LIMIT 5")
    w = "greatest(review_rows, 1)"
    pos = "delivery_days > 0"
    q["b8_build_metrics"] = with_wh(
        f"SELECT CAST(sum({w}) AS BIGINT) AS total_rows,"
        f" CAST(sum(order_total_value * {w}) AS DOUBLE) AS total_revenue,"
        f" CAST(sum(order_total_value * {w}) AS DOUBLE) / sum({w}) AS avg_order_value,"
        f" {pct(f'sum(CASE WHEN is_completed_order THEN {w} ELSE 0 END)', f'sum({w})')} AS completed_pct,"
        f" {pct(f'sum(CASE WHEN is_late_delivery THEN {w} ELSE 0 END)', f'sum({w})')} AS late_pct,"
        f" CAST(sum(CASE WHEN {pos} THEN delivery_days * {w} END) AS DOUBLE)"
        f" / CAST(sum(CASE WHEN {pos} THEN {w} END) AS DOUBLE) AS avg_delivery_days_positive"
        " FROM om")
    rows = "sum(greatest(coalesce(n, 0), 1))"
    q["b8_review_metrics"] = fixtures_only(
        f"SELECT CAST({rows} AS BIGINT) AS total_rows,"
        f" {pct('coalesce(sum(n_scored), 0)', rows)} AS reviewed_pct,"
        " CAST(sum(score_sum) AS DOUBLE) / CAST(sum(n_scored) AS DOUBLE) AS avg_review_score"
        " FROM (SELECT DISTINCT order_id FROM src_orders WHERE order_id IS NOT NULL) o"
        " LEFT JOIN (SELECT order_id, count(*) AS n, count(review_score) AS n_scored,"
        " sum(review_score) AS score_sum FROM src_reviews GROUP BY order_id) r USING (order_id)")
    q["b9_clv_stats"] = with_wh(
        f"SELECT {mean('lifetime_value')} AS avg_clv,"
        " median(CAST(lifetime_value AS DOUBLE)) AS median_clv,"
        " CAST(max(lifetime_value) AS DOUBLE) AS max_clv FROM dim_customers")
    q["b9_region_distribution"] = with_wh(_share("customer_region", "dim_customers"))
    q["b9_segment_distribution"] = with_wh(_share("customer_segment", "dim_customers"))
    q["b10_calendar_summary"] = with_wh(
        "SELECT min(full_date) AS min_date, max(full_date) AS max_date,"
        " count(*) FILTER (WHERE is_weekend) AS weekend_days,"
        " count(*) FILTER (WHERE is_holiday) AS holidays, count(*) AS total_days FROM dim_date")
    q["b10_days_per_year"] = with_wh(
        "SELECT year, count(*) AS days FROM dim_date GROUP BY year ORDER BY year")
    rate = "CAST(retention_rate AS DOUBLE)"
    q["b11_cohort_insights"] = with_wh(
        "SELECT count(DISTINCT cohort_month) AS total_cohorts,"
        f" {mean('CASE WHEN months_since_first_purchase = 0 THEN cohort_size END')} AS avg_cohort_size,"
        f" {mean('CASE WHEN months_since_first_purchase = 1 THEN retention_rate END')}"
        " AS avg_month_1_retention,"
        f" {mean('CASE WHEN months_since_first_purchase = 3 THEN retention_rate END')}"
        " AS avg_month_3_retention"
        " FROM fact_cohort_retention")
    q["b11_retention_by_offset"] = with_wh(
        f"SELECT months_since_first_purchase, {mean('retention_rate')} AS avg_retention_rate"
        " FROM fact_cohort_retention GROUP BY 1 ORDER BY 1 LIMIT 12")
    keys = ["customer_key", "product_key", "order_date_key", "delivery_date_key",
            "payment_type_key"]
    q["b12_fk_null_coverage"] = with_wh(
        "SELECT " + ", ".join(f"count(*) FILTER (WHERE {k} IS NULL) AS null_{k}" for k in keys)
        + ", count(*) AS total_rows FROM fact_orders")
    q["d1_delivery_class"] = with_wh(
        f"SELECT {_delivery_class_sql()} AS delivery_class, count(*) AS orders FROM om GROUP BY 1")
    q["d2_price_outliers"] = fixtures_only(
        "SELECT count(*) AS items, count(*) FILTER (WHERE CAST(price AS DOUBLE) >"
        f" (SELECT quantile_cont(CAST(price AS DOUBLE), {R.price_outlier_quantile})"
        " FROM src_order_items)) AS outliers FROM src_order_items")
    q["d3_delivery_outliers"] = with_wh(
        "SELECT count(*) AS orders,"
        f" count(*) FILTER (WHERE delivery_days > {R.delivery_outlier_days}) AS delivery_outliers"
        " FROM om WHERE NOT (coalesce(delivery_days, 0) < 0)")
    q["d4_undelivered"] = with_wh(
        "SELECT order_status, coalesce(order_status = 'shipped', false) AS in_transit,"
        " count(*) AS orders FROM om"
        " WHERE NOT coalesce(order_status IN ('canceled', 'unavailable'), false) GROUP BY 1, 2")
    q["d5_largest_payment_type"] = fixtures_only(
        f"SELECT order_id, payment_type FROM ({_payments_agg('largest')})")
    q["d6_most_expensive_product"] = fixtures_only(
        f"SELECT order_id, primary_product_id, seller_id FROM ({_items_agg('most_expensive')})")
    L = R.lifespan_days
    pm_ctes = ["rev AS (SELECT order_id, sum(price + freight_value) AS order_total"
               " FROM src_order_items GROUP BY order_id)",
               "po AS (SELECT o.*, c.customer_unique_id FROM src_orders o JOIN"
               " (SELECT customer_id, min(customer_unique_id) AS customer_unique_id"
               " FROM src_customers GROUP BY customer_id) c ON o.customer_id = c.customer_id)",
               *_metrics_cte("pm", "customer_unique_id", "po")]
    q["d7_person_grain"] = (
        "WITH " + ",\n".join(_fixture_ctes() + pm_ctes) + "\n"
        "SELECT customer_unique_id, total_orders, delivered_orders,"
        " CAST(total_spent AS DOUBLE) AS total_spent,"
        f" {rr('cents', 'total_orders * 100')} AS avg_order_value,"
        f" {rr(f'cents * {L}', 'days_as_customer * 100')} AS lifetime_value,"
        " first_order_date, last_order_date, days_as_customer,"
        f" {rr('total_orders * 365', 'days_as_customer')} AS purchase_frequency_annual FROM pm")
    d8 = [
        "early AS (SELECT * FROM src_orders"
        " WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01')",
        "ecust AS (SELECT * FROM src_customers WHERE customer_id IN"
        " (SELECT customer_id FROM early))",
        *_customers("e_", "early", "ecust", with_rev=False)]
    def attrs(a: str) -> str:
        return (f"{a}.customer_id, {a}.total_orders, CAST({a}.total_spent AS DOUBLE) AS total_spent,"
                f" {a}.customer_segment")
    q["d8_scd1_upsert"] = (
        warehouse_ctes().rstrip("\n") + ",\n" + ",\n".join(d8) + "\n"
        f"SELECT c.customer_key, {attrs('i')}"
        " FROM dim_customers i JOIN e_dim_customers c ON i.customer_id = c.customer_id"
        f" UNION ALL SELECT c.customer_key, {attrs('c')}"
        " FROM e_dim_customers c WHERE c.customer_id NOT IN (SELECT customer_id FROM dim_customers)"
        " UNION ALL SELECT (SELECT coalesce(max(customer_key), 0) FROM e_dim_customers)"
        f" + row_number() OVER (ORDER BY i.customer_id) AS customer_key, {attrs('i')}"
        " FROM dim_customers i WHERE i.customer_id NOT IN (SELECT customer_id FROM e_dim_customers)")
    q["d9_incremental_orders"] = fixtures_only(
        "SELECT order_id, customer_id, order_status FROM src_orders WHERE order_id NOT IN"
        " (SELECT order_id FROM src_orders WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01')")
    q["d9_incremental_stream"] = fixtures_only(
        "SELECT order_id, customer_id, order_status FROM src_orders")
    q["d10_kpi_sales"] = with_wh(
        "SELECT CAST(sum(order_total_value) AS DOUBLE) AS total_revenue, count(*) AS completed_orders,"
        f" {mean('order_total_value')} AS avg_order_value,"
        " (SELECT count(DISTINCT customer_id) FROM dim_customers) AS total_customers"
        " FROM fact_orders WHERE is_completed_order")
    dl = "(SELECT count(*) FILTER (WHERE is_late_delivery) FROM fact_orders WHERE is_completed_order)"
    dn = "(SELECT count(*) FROM fact_orders WHERE is_completed_order)"
    q["d10_kpi_delivery"] = with_wh(
        f"SELECT {pct('count(*) FILTER (WHERE is_completed_order)', 'count(*)')} AS completion_rate,"
        f" {pct(dl, dn)} AS late_rate, 100.0 - {pct(dl, dn)} AS on_time_rate,"
        " (SELECT CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) FROM fact_orders"
        " WHERE is_completed_order) AS avg_delivery_days FROM fact_orders")
    q["d10_kpi_customers_products"] = with_wh(
        f"SELECT {mean('lifetime_value')} AS avg_clv,"
        " count(*) FILTER (WHERE customer_segment = 'New') AS new_customers,"
        " (SELECT count(DISTINCT product_id) FROM src_order_items) AS unique_products,"
        " (SELECT count(*) FROM src_order_items) AS items_sold,"
        " (SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) FROM src_order_items)"
        " AS items_per_order FROM dim_customers")
    q["d11_retention_heatmap"] = with_wh(
        "SELECT cohort_month, cohort_size, months_since_first_purchase AS month_offset,"
        " CAST(retention_rate AS DOUBLE) AS retention_rate FROM fact_cohort_retention"
        " ORDER BY cohort_month, month_offset")
    q["d12_revenue_by_state"] = _geo("customer_state")
    q["d12_revenue_by_region"] = _geo("customer_region")
    q["q2_q5_orphans"] = with_wh(" UNION ALL ".join([
        _orphans("customer_key", "dim_customers", "customer_key"),
        _orphans("product_key", "dim_products", "product_key"),
        _orphans("order_date_key", "dim_date", "date_key"),
        _orphans("payment_type_key", "dim_payment_type", "payment_type_key")]))
    q["q6_fact_nulls"] = with_wh(_null_counts("fact_orders", [
        "customer_key", "product_key", "order_date_key", "payment_type_key", "order_id",
        "order_total_value"]))
    q["q7_customer_nulls"] = with_wh(_null_counts("dim_customers",
                                                  ["customer_id", "customer_segment"]))
    q["q8_consistency"] = with_wh(
        "SELECT count(*) FILTER (WHERE order_total_value < 0) AS negative_values,"
        " count(*) FILTER (WHERE order_total_value = 0) AS zero_values,"
        " count(*) FILTER (WHERE delivery_days < 0) AS negative_delivery_days FROM fact_orders")
    q["q9_duplicate_orders"] = with_wh(
        "SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows"
        " FROM (SELECT order_id, count(*) AS n FROM fact_orders WHERE order_id IS NOT NULL"
        " GROUP BY order_id HAVING count(*) > 1)")
    q["q10_status_share"] = with_wh(_share("order_status", "fact_orders"))
    q["q10_order_metrics"] = with_wh(
        "SELECT count(*) AS total_orders,"
        " count(*) FILTER (WHERE is_completed_order) AS completed_orders,"
        " count(*) FILTER (WHERE is_late_delivery) AS late_deliveries,"
        f" {mean('delivery_days')} AS avg_delivery_days, {mean('order_total_value')} AS avg_order_value,"
        f" {pct('count(*) FILTER (WHERE is_completed_order)', 'count(*)')} AS completion_rate,"
        f" {pct('count(*) FILTER (WHERE is_late_delivery)', 'count(*)')} AS late_rate"
        " FROM fact_orders")
    q["q10_segments"] = with_wh(
        f"SELECT customer_segment, count(*) AS customer_count, {mean('lifetime_value')} AS avg_clv"
        " FROM dim_customers GROUP BY customer_segment")
    q["q11_q12_unique_keys"] = with_wh(" UNION ALL ".join(
        _unique(t, cols) for t, keys in UNIQUE_KEYS.items() for cols in keys))
    q["q13_not_null"] = with_wh(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name,"
        f" count(*) FILTER (WHERE {f.name} IS NULL) AS null_count,"
        f" count(*) FILTER (WHERE {f.name} IS NULL) = 0 AS passed FROM {t}"
        if f.name not in ("created_at", "updated_at") else
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, CAST(0 AS BIGINT) AS null_count,"
        f" true AS passed"
        for t, s in TARGETS.items() for f in s.fields if not f.nullable))
    q["q13_max_lengths"] = with_wh(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length,"
        f" count(*) FILTER (WHERE length({c}) > {n}) AS too_long,"
        f" CAST(max(length({c})) AS INTEGER) AS longest,"
        f" count(*) FILTER (WHERE length({c}) > {n}) = 0 AS passed FROM {t}"
        for t, lim in MAX_LENGTHS.items() for c, n in lim.items()))
    for name, (table, src, rules) in VALIDATION.items():
        q[name] = _validate(table, src, rules)
    q["v7_unmapped_keys"] = with_wh(
        "SELECT count(*) FILTER (WHERE customer_key IS NULL) AS unmapped_customers,"
        " count(*) FILTER (WHERE product_key IS NULL) AS unmapped_products,"
        " count(*) FILTER (WHERE payment_type_key IS NULL) AS unmapped_payment_types"
        " FROM fact_orders")
    q["v3_top_states"] = fixtures_only(_top_share("customer_state", "src_customers", 5))
    q["v4_weight_stats"] = fixtures_only(_numeric_summary("product_weight_g", "src_products"))
    q["v4_volume_stats"] = with_wh(_numeric_summary("product_volume_cm3", "dim_products",
                                                    "product_volume_cm3 > 0", money=True))
    q["v4_top_categories"] = fixtures_only(_top_share("product_category_name", "src_products", 5))
    q["v5_payment_types"] = fixtures_only(_share("payment_type", "src_payments"))
    q["v5_installments"] = fixtures_only(_numeric_summary("payment_installments", "src_payments"))
    q["v5_multi_payment_orders"] = fixtures_only(_multi_rows("order_id", "src_payments"))
    q["v6_score_distribution"] = fixtures_only(_share("review_score", "src_reviews"))
    q["v6_sentiment"] = fixtures_only(
        "SELECT sentiment, count(*) AS count,"
        f" {rr('count(*) * 100', '(SELECT count(*) FROM src_reviews)')} AS percentage FROM"
        " (SELECT CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3 THEN 'neutral'"
        " WHEN review_score <= 2 THEN 'negative' END AS sentiment FROM src_reviews) GROUP BY 1")
    q["a6_distinct_statuses"] = (
        "SELECT row_number() OVER (ORDER BY o_orderstatus) AS value_key, o_orderstatus"
        " FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL)")
    q["a7_distinct_counts"] = (
        "SELECT count(DISTINCT o_custkey) AS distinct_o_custkey,"
        " count(DISTINCT o_orderstatus) AS distinct_o_orderstatus,"
        " count(DISTINCT o_orderpriority) AS distinct_o_orderpriority FROM orders")
    q["a8_part_type_counts"] = _share("p_type", "part")
    q["a9_multi_line_orders"] = _multi_rows("l_orderkey", "lineitem")
    q["a10_totalprice_summary"] = _numeric_summary(
        "p", "(SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)", money=True)
    q["a11_describe_quantity"] = (
        "SELECT n AS count, CAST(s AS DOUBLE) / 100 / CAST(n AS DOUBLE) AS mean,"
        " sqrt(CAST(n * q - s * s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n - 1 AS DOUBLE))) / 100 AS std,"
        " min, p25, p50, p75, max FROM (SELECT count(l_quantity) AS n, sum(c) AS s, sum(c * c) AS q,"
        " min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50,"
        " quantile_cont(l_quantity, 0.75) AS p75, max(l_quantity) AS max FROM (SELECT l_quantity,"
        " CAST(CAST(l_quantity AS DECIMAL(12,2)) * 100 AS HUGEINT) AS c FROM lineitem))")
    q["a16_event_nulls"] = _null_counts(
        "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    q["o2_top_clv"] = with_wh(
        "SELECT customer_key, customer_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value"
        " FROM dim_customers ORDER BY lifetime_value DESC, customer_key LIMIT 10")
    q["o5_first_products_per_segment"] = with_wh(
        "SELECT product_category_segment, rank_in_segment, product_key, product_id FROM"
        " (SELECT *, row_number() OVER (PARTITION BY product_category_segment ORDER BY product_key)"
        " AS rank_in_segment FROM dim_products) WHERE rank_in_segment <= 3")
    q["w5_k6_lineitem_duplicates"] = (
        "SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS kept_rows,"
        " count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rejected_rows FROM lineitem"
        " WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    q["o5_calendar_head_tail"] = with_wh(
        "SELECT * FROM (SELECT date_key, full_date, 'head' AS part FROM dim_date"
        " ORDER BY full_date LIMIT 10) UNION ALL SELECT * FROM (SELECT date_key, full_date,"
        " 'tail' AS part FROM dim_date ORDER BY full_date DESC LIMIT 10)")
    q["o5_first_cohort"] = with_wh(
        "SELECT cohort_retention_key, cohort_month, months_since_first_purchase, cohort_size,"
        " retained_customers, CAST(retention_rate AS DOUBLE) AS retention_rate"
        " FROM fact_cohort_retention"
        " WHERE cohort_month = (SELECT min(cohort_month) FROM fact_cohort_retention)")
    from oracle import duckdb_loads
    return q | duckdb_loads.oracle_sql()
