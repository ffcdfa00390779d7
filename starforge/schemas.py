"""Typed target tables (K8) and source schemas, plus ``conform``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SIMPLE = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
           "date": T.DateType(), "boolean": T.BooleanType(), "double": T.DoubleType(),
           "timestamp_ntz": T.TimestampNTZType()}


def _type(name: str) -> T.DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return T.DecimalType(int(m.group(1)), int(m.group(2))) if m else _SIMPLE[name]


def _schema(spec: str) -> T.StructType:
    """'name type[!], ...' -> StructType; '!' marks NOT NULL."""
    fields = []
    for name, typ, bang in re.findall(r"(\w+)\s+(decimal\(\d+,\d+\)|\w+)(!?)", spec):
        fields.append(T.StructField(name, _type(typ), not bang))
    return T.StructType(fields)


# The warehouse's declared tables, columns and types, in their order.
TARGETS = {
    "dim_date": _schema(
        "date_key int!, full_date date!, year int!, quarter int!, month int!, month_name string!,"
        " week int!, day_of_month int!, day_of_week int!, day_name string!, is_weekend boolean!,"
        " is_holiday boolean!, fiscal_year int!, fiscal_quarter int!, created_at timestamp_ntz!"),
    "dim_products": _schema(
        "product_key bigint!, product_id string!, product_category_name string,"
        " product_category_english string, product_category_segment string, product_weight_g int,"
        " product_length_cm int, product_height_cm int, product_width_cm int,"
        " product_volume_cm3 decimal(12,2), product_photos_qty int, has_photos boolean,"
        " created_at timestamp_ntz!"),
    "dim_payment_type": _schema(
        "payment_type_key bigint!, payment_type string!, payment_category string!,"
        " created_at timestamp_ntz!"),
    "dim_customers": _schema(
        "customer_key bigint!, customer_id string!, customer_unique_id string, customer_city string,"
        " customer_state string, customer_region string, customer_segment string,"
        " first_order_date timestamp_ntz, last_order_date timestamp_ntz, total_orders int,"
        " delivered_orders int, total_spent decimal(12,2), avg_order_value decimal(12,2),"
        " lifetime_value decimal(12,2), days_as_customer int, purchase_frequency_annual decimal(12,2),"
        " created_at timestamp_ntz!, updated_at timestamp_ntz!"),
    "fact_orders": _schema(
        "order_key bigint!, customer_key bigint, product_key bigint, order_date_key int,"
        " delivery_date_key int, payment_type_key bigint, order_id string!, order_status string,"
        " seller_id string, order_item_count int, order_subtotal decimal(12,2),"
        " order_freight_total decimal(12,2), order_total_value decimal(12,2),"
        " payment_value decimal(12,2), payment_installments int, delivery_days int,"
        " estimated_delivery_days int, delivery_delay_days int, is_late_delivery boolean,"
        " is_completed_order boolean, review_score int, has_review boolean,"
        " order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        " created_at timestamp_ntz!"),
    "fact_cohort_retention": _schema(
        "cohort_retention_key bigint!, cohort_month date!, months_since_first_purchase int!,"
        " cohort_size int!, retained_customers int!, retention_rate decimal(5,2)!,"
        " created_at timestamp_ntz!"),
}

# Declared unique columns (primary keys and UNIQUE constraints), for Q11/Q12.
UNIQUE_KEYS = {
    "dim_date": (("date_key",), ("full_date",)),
    "dim_products": (("product_key",), ("product_id",)),
    "dim_payment_type": (("payment_type_key",), ("payment_type",)),
    "dim_customers": (("customer_key",), ("customer_id",)),
    "fact_orders": (("order_key",), ("order_id",)),
    "fact_cohort_retention": (("cohort_retention_key",), ("cohort_month", "months_since_first_purchase")),
}

# Declared VARCHAR lengths, for Q13.
MAX_LENGTHS = {
    "dim_date": {"month_name": 20, "day_name": 20},
    "dim_products": {"product_id": 50, "product_category_name": 100,
                     "product_category_english": 100, "product_category_segment": 50},
    "dim_payment_type": {"payment_type": 50, "payment_category": 50},
    "dim_customers": {"customer_id": 50, "customer_unique_id": 50, "customer_city": 100,
                      "customer_state": 2, "customer_region": 50, "customer_segment": 20},
    "fact_orders": {"order_id": 50, "order_status": 50, "seller_id": 50},
}

# Source files (CSV with header), FIXTURES.md section 1.
SOURCES = {
    "orders": _schema(
        "order_id string!, customer_id string!, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz"),
    "order_items": _schema(
        "order_id string!, order_item_id int, product_id string!, seller_id string,"
        " price decimal(12,2), freight_value decimal(12,2)"),
    "customers": _schema(
        "customer_id string!, customer_unique_id string!, customer_city string, customer_state string"),
    "products": _schema(
        "product_id string!, product_category_name string, product_weight_g int,"
        " product_length_cm int, product_height_cm int, product_width_cm int, product_photos_qty int"),
    "payments": _schema(
        "order_id string!, payment_sequential int, payment_type string, payment_installments int,"
        " payment_value decimal(12,2)"),
    "reviews": _schema(
        "review_id string!, order_id string!, review_score int, review_comment_title string,"
        " review_comment_message string, review_creation_date timestamp_ntz,"
        " review_answer_timestamp timestamp_ntz"),
}


def conform(df: DataFrame, schema: T.StructType, only_present: bool = False) -> DataFrame:
    """Select the target columns in order and cast them to the target types.

    only_present=False (P2): a missing column is an error.
    only_present=True (P1): missing columns are skipped.
    Casts are ANSI: a value that does not fit its declared type fails the job,
    as the typed table would reject it.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name not in have:
            if only_present:
                continue
            raise ValueError(f"missing column {f.name!r}")
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)


UNFIT = "_sf_unfit"
REJECTS = "table_name string, business_key string, column_name string, value string, reject_reason string"


def flag_unfit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K8 without an abort: cast the columns of ``schema`` that ``df`` has with ``try_cast``
    and list in ``_sf_unfit`` (array of structs column, value, reason) what the declared
    type can't hold: ``out_of_range`` values and ``missing`` ones of NOT NULL columns.
    The value itself becomes NULL; other columns pass through.
    """
    cols, bad = [], []
    targets = {f.name: f for f in schema.fields}
    for c in df.columns:
        f = targets.get(c)
        if f is None:
            cols.append(F.col(c))
            continue
        fit = F.col(c).try_cast(f.dataType)
        cols.append(fit.alias(c))
        why = F.when(F.col(c).isNotNull() & fit.isNull(), "out_of_range")
        if not f.nullable:
            why = why.when(F.col(c).isNull(), "missing")
        bad.append(F.when(why.isNotNull(), F.struct(F.lit(c).alias("column_name"),
                                                    F.col(c).cast("string").alias("value"),
                                                    why.alias("reject_reason"))))
    return df.select(*cols, F.array_compact(F.array(*bad)).alias(UNFIT))


def is_unfit():
    return F.size(UNFIT) > 0


def unfit_rows(flagged: DataFrame, table: str, key: str) -> DataFrame:
    """One reject per value of ``flag_unfit`` that does not fit (columns of ``REJECTS``)."""
    return (flagged.where(is_unfit())
            .select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("business_key"),
                    F.explode(UNFIT).alias("u"))
            .select("table_name", "business_key", "u.column_name", "u.value", "u.reject_reason"))


def conform_split(df: DataFrame, schema: T.StructType, table: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(typed, rejected): rows whose every value fits the declared types, in the target columns,
    and one reject per value that does not.  ``df`` is evaluated for both: pass a written table."""
    flagged = flag_unfit(df, schema)
    typed = flagged.where(~is_unfit())
    return conform(typed, schema), unfit_rows(flagged, table, key)


def table_columns(name: str, without=("created_at", "updated_at")) -> list[str]:
    return [f.name for f in TARGETS[name].fields if f.name not in without]
