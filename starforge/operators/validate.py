"""Row validation at extract (V1-V7).

``validate(df, table, rules)`` evaluates every rule of a table in one
aggregate pass and returns one row per rule:
(table_name, rule, severity, bad_rows, total_rows, bad_pct).
``enforce`` raises when a rule of severity ``raise`` has bad rows; it reads
only that small report (one row per rule).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starforge.functions.scalars import percent
from starforge.operators.keys import duplicate_count


@dataclass(frozen=True)
class Rule:
    """``rows`` marks the bad rows one by one, or ``total`` counts them over the whole table
    (distinct counts: those can't be observed while a table is written)."""
    name: str
    severity: str           # raise | error | warn | info
    rows: Column | None = None
    total: Column | None = None

    def bad_rows(self, where: Column | None = None) -> Column:
        if self.rows is None:
            return self.total
        bad = F.coalesce(self.rows, F.lit(False))
        return F.count_if(bad if where is None else bad & where)


def _null(c: str) -> Column:
    return F.col(c).isNull()


def _bad_or_null(c: str, pred) -> Column:
    # NULL counts as bad: pandas' (s <= 0) | s.isnull()
    return F.coalesce(pred(F.col(c)), F.lit(True))


def rules_for(table: str) -> list[Rule]:
    """The rule list of a source table (built on call: Columns need a session)."""
    return _RULES()[table]


def _RULES() -> dict:
    return {
        "orders": [
            Rule("duplicate_order_id", "warn", total=duplicate_count("order_id")),
            Rule("null_order_id", "raise", _null("order_id")),
            Rule("null_customer_id", "raise", _null("customer_id")),
        ],
        "order_items": [
            Rule("negative_price", "warn", F.col("price") < 0),
            Rule("zero_price", "warn", F.col("price") == 0),
            Rule("null_order_id", "raise", _null("order_id")),
            Rule("null_product_id", "raise", _null("product_id")),
        ],
        "customers": [
            Rule("duplicate_customer_id", "warn", total=duplicate_count("customer_id")),
            Rule("repeat_customer_records", "info",
                 total=(F.count(F.lit(1)) - F.count_distinct("customer_unique_id")).cast("long")),
            Rule("null_customer_id", "raise", _null("customer_id")),
            Rule("null_customer_unique_id", "raise", _null("customer_unique_id")),
            Rule("null_customer_state", "warn", _null("customer_state")),
            Rule("null_customer_city", "warn", _null("customer_city")),
            Rule("invalid_state_length", "warn",
                 _bad_or_null("customer_state", lambda s: F.length(s) != 2)),
        ],
        "products": [
            Rule("duplicate_product_id", "error", total=duplicate_count("product_id")),
            Rule("null_product_id", "raise", _null("product_id")),
            Rule("null_category", "warn", _null("product_category_name")),
            *[Rule(f"invalid_{c}", "warn", _bad_or_null(c, lambda s: s <= 0))
              for c in ("product_weight_g", "product_length_cm", "product_height_cm",
                        "product_width_cm")],
        ],
        "payments": [
            Rule("null_order_id", "raise", _null("order_id")),
            Rule("null_payment_type", "warn", _null("payment_type")),
            Rule("negative_payment_value", "error", F.col("payment_value") < 0),
            Rule("zero_payment_value", "warn", F.col("payment_value") == 0),
            Rule("null_payment_value", "warn", _null("payment_value")),
            Rule("installments_below_one", "warn", F.col("payment_installments") < 1),
        ],
        "reviews": [
            Rule("duplicate_review_id", "warn", total=duplicate_count("review_id")),
            Rule("null_review_id", "raise", _null("review_id")),
            Rule("null_order_id", "raise", _null("order_id")),
            Rule("null_review_score", "warn", _null("review_score")),
            Rule("score_out_of_range", "error",
                 (F.col("review_score") < 1) | (F.col("review_score") > 5)),
        ],
    }


# Q1, Q6-Q8: what is checked while the warehouse tables are written
def _WAREHOUSE() -> dict:
    return {
        "fact_orders": [
            *[Rule(f"null_{c}", "info", _null(c)) for c in ("customer_key", "product_key", "order_date_key",
                                                            "payment_type_key", "order_total_value")],
            Rule("null_order_id", "raise", _null("order_id")),
            Rule("negative_values", "error", F.col("order_total_value") < 0),
            Rule("zero_values", "warn", F.col("order_total_value") == 0),
            Rule("negative_delivery_days", "warn", F.col("delivery_days") < 0),
        ],
        "dim_customers": [Rule("null_customer_id", "raise", _null("customer_id")),
                          Rule("null_customer_segment", "warn", _null("customer_segment"))],
    }


def warehouse_rules(table: str) -> list[Rule]:
    return _WAREHOUSE().get(table, [])


REPORT = ("table_name string, rule string, severity string, bad_rows long, total_rows long, bad_pct double")


class Observed:
    """Rules counted while ``df`` is written, without a scan of their own.

    Write ``.df`` (instead of the DataFrame that was given), then read ``.rows()``.  Only
    rules that mark single rows can be observed; ``where`` limits which rows count.
    """

    def __init__(self, df: DataFrame, table: str, rules: list[Rule], where: Column | None = None):
        self.table, self.rules = table, [r for r in rules if r.rows is not None]
        self._seen = Observation()
        total = F.count(F.lit(1)) if where is None else F.count_if(where)
        self.df = df.observe(self._seen, total.alias("total"),
                             *[r.bad_rows(where).alias(f"r{i}") for i, r in enumerate(self.rules)])

    def rows(self) -> list[tuple]:
        """One row per rule, in the columns of ``REPORT``, and first the row count; waits for the write."""
        seen = self._seen.get
        total = seen["total"]
        out = [(self.table, "row_count", "info", total, total, 100.0 if total else 0.0)]
        for i, r in enumerate(self.rules):
            bad = seen[f"r{i}"]
            out.append((self.table, r.name, r.severity, bad, total, bad / total * 100.0 if total else 0.0))
        return out


def validate(df: DataFrame, table: str, rules=None) -> DataFrame:
    """The report of a table's rules: one aggregation for all that mark single rows, and one more
    for each distinct count after the first (together they would copy every row per column)."""
    from starforge.operators.profile import _one_row_pair
    rules = rules_for(table) if rules is None else rules
    whole = [i for i, r in enumerate(rules) if r.rows is None]
    a = df.agg(F.count(F.lit(1)).alias("_sf_total"),
               *[r.bad_rows().alias(f"r{i}") for i, r in enumerate(rules) if i not in whole[1:]])
    for i in whole[1:]:
        a = _one_row_pair(a, df.agg(rules[i].bad_rows().alias(f"r{i}")))
    stack = ", ".join(f"'{r.name}', '{r.severity}', CAST(r{i} AS BIGINT)"
                      for i, r in enumerate(rules))
    long = a.selectExpr("_sf_total", f"stack({len(rules)}, {stack}) as (rule, severity, bad_rows)")
    return long.select(F.lit(table).alias("table_name"), "rule", "severity", "bad_rows",
                       F.col("_sf_total").alias("total_rows"),
                       percent("bad_rows", "_sf_total").alias("bad_pct"))


# V4-V6: what the extracts report besides their rules: (metric, column it needs, aggregate)
def _METRICS() -> dict:
    return {
        "products": [("products_with_photos", "product_photos_qty",
                      F.count_if(F.coalesce(F.col("product_photos_qty") > 0, F.lit(False))))],
        "payments": [("max_payment_sequential", "payment_sequential", F.max("payment_sequential"))],
        "reviews": [("reviews_with_title", "review_comment_title", F.count("review_comment_title")),
                    ("reviews_with_message", "review_comment_message", F.count("review_comment_message")),
                    ("reviews_with_answer", "review_answer_timestamp", F.count("review_answer_timestamp"))],
    }


def extract_metrics(df: DataFrame, table: str) -> DataFrame:
    """V4-V6: (table_name, metric, value, total_rows), one row per metric whose column is there, in one pass."""
    found = [(name, agg) for name, c, agg in _METRICS().get(table, []) if c in df.columns]
    if not found:
        return df.sparkSession.createDataFrame([], "table_name string, metric string, value long, total_rows long")
    a = df.agg(F.count(F.lit(1)).alias("_sf_total"), *[m.cast("long").alias(name) for name, m in found])
    stack = ", ".join(f"'{name}', `{name}`" for name, _ in found)
    return (a.selectExpr("_sf_total", f"stack({len(found)}, {stack}) as (metric, value)")
            .select(F.lit(table).alias("table_name"), "metric", "value", F.col("_sf_total").alias("total_rows")))


class ValidationError(ValueError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a ``raise`` rule failed; return the report unchanged."""
    failed = (report.where((F.col("severity") == "raise") & (F.col("bad_rows") > 0))
              .select("table_name", "rule", "bad_rows").collect())   # <= one row per rule
    _stop(failed)
    return report


def _stop(failed) -> None:
    if failed:
        msg = ", ".join(f"{table}.{rule}={bad}" for table, rule, bad in failed)
        raise ValidationError(f"critical validation failed: {msg}")


def enforce_rows(rows: list[tuple]) -> list[tuple]:
    """``enforce`` for the rows of ``Observed``."""
    _stop([(table, rule, bad) for table, rule, severity, bad, *_ in rows if severity == "raise" and bad])
    return rows


def unmapped_keys(fact_with_keys: DataFrame) -> DataFrame:
    """V7: orders whose customer / product / payment type found no key."""
    return fact_with_keys.agg(
        F.count_if(F.col("customer_key").isNull()).alias("unmapped_customers"),
        F.count_if(F.col("product_key").isNull()).alias("unmapped_products"),
        F.count_if(F.col("payment_type_key").isNull()).alias("unmapped_payment_types"))
