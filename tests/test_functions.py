"""Scalar functions on the hand-made edge rows of FIXTURES.md section 5."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starforge.functions.dates import (date_key, iso_weekday, month_start,
                                       months_between_starts, whole_days_between)
from starforge.functions.scalars import (customer_segment, lifetime_value, positive_flag,
                                         round_ratio, share_pct)
from starforge.plans.dims import date_attributes, region_of
from starforge.rules import FIXTURE_RULES, SHIPPED_RULES

T = dt.datetime


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_whole_days_floor(spark):
    rows = [(T(2018, 1, 1, 12), T(2018, 1, 2)),       # early by 12 h
            (T(2018, 1, 2, 12), T(2018, 1, 1, 18)),   # late by 18 h
            (T(2018, 1, 3), T(2018, 1, 2)),           # late by exactly one day
            (None, T(2018, 1, 2))]                    # never delivered
    got = _one(spark, rows, "a timestamp_ntz, b timestamp_ntz", whole_days_between("a", "b"))
    assert got == [-1, 0, 1, None]


def test_late_flag_uses_whole_days(spark):
    rows = [(T(2018, 1, 2, 12), T(2018, 1, 1, 18)), (T(2018, 1, 3), T(2018, 1, 2)), (None, None)]
    got = _one(spark, rows, "a timestamp_ntz, b timestamp_ntz",
               positive_flag(whole_days_between("a", "b")))
    assert got == [False, True, False]


def test_iso_week_and_weekday(spark):
    days = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2018, 12, 31),)], "full_date date")
    r = {x.full_date: x for x in date_attributes(days).collect()}
    sun = r[dt.date(2017, 1, 1)]
    assert (sun.week, sun.day_of_week, sun.is_weekend, sun.day_name) == (52, 7, True, "Sunday")
    mon = r[dt.date(2018, 12, 31)]
    assert (mon.week, mon.day_of_week, mon.quarter, mon.month_name) == (1, 1, 4, "December")
    assert sun.date_key == 20170101


def test_shipped_calendar(spark):
    from starforge.plans.dims import dim_date
    d = dim_date(spark, SHIPPED_RULES)
    s = d.agg(F.count("*"), F.count_if("is_weekend"), F.count_if("is_holiday")).first()
    assert tuple(s) == (791, 226, 24)


def test_region_rules(spark):
    df = spark.createDataFrame([(None,), ("XX",), ("SP",)], "customer_state string")
    got = {r.customer_state: r.customer_region for r in region_of(df, SHIPPED_RULES).collect()}
    assert got == {None: "Unknown", "XX": "Other", "SP": "Southeast"}


def test_segments_shipped_rules(spark):
    rows = [(0, Decimal("0")), (1, Decimal("4999.99")), (1, Decimal("5000")), (5, Decimal("10")),
            (6, Decimal("0"))]
    got = _one(spark, rows, "n int, v decimal(12,2)", customer_segment("n", "v", SHIPPED_RULES))
    assert got == ["Inactive", "New", "VIP", "Returning", "VIP"]


def test_segment_gap_fixture_rules(spark):
    got = _one(spark, [(10, Decimal("0"))], "n int, v decimal(12,2)",
               customer_segment("n", "v", FIXTURE_RULES))
    assert got == ["Loyal"]


def test_product_categories(spark):
    from starforge.plans.dims import enrich_products
    rows = [("p1", None, 1), ("p2", "xyz", 0), ("p3", "moveis_escritorio", 2), ("p4", "livros", None)]
    df = spark.createDataFrame(rows, "product_id string, product_category_name string,"
                                     " product_photos_qty int")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("product_weight_g", "product_length_cm",
                                                       "product_height_cm", "product_width_cm")])
    got = {r.product_id: (r.product_category_english, r.product_category_segment, r.has_photos)
           for r in enrich_products(df, SHIPPED_RULES).collect()}
    assert got == {"p1": ("uncategorized", "Other", True), "p2": ("xyz", "Other", False),
                   "p3": ("office_furniture", "Home & Furniture", True),
                   "p4": ("books", "Other", False)}


def test_one_day_customer_clv(spark):
    got = _one(spark, [(Decimal("100.00"), 1)], "s decimal(12,2), d int",
               lifetime_value("s", "d", SHIPPED_RULES))
    assert got == [Decimal("36500.00")]


def test_rounding_half_up(spark):
    got = _one(spark, [(125, 1000), (-125, 1000), (1, 3), (2, 3), (5, 0)], "n long, d long",
               round_ratio("n", "d", 2))
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("0.33"), Decimal("0.67"), None]
    assert _one(spark, [(1, 3)], "n long, d long", share_pct("n", "d")) == [33.33]


def test_month_offset(spark):
    rows = [(T(2017, 12, 5), T(2018, 3, 30))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(months_between_starts(month_start("b"), month_start("a"))).first()[0]
    assert got == 3


def test_date_key_and_weekday(spark):
    got = spark.createDataFrame([(dt.date(2016, 9, 1),)], "d date") \
        .select(date_key("d"), iso_weekday("d")).first()
    assert tuple(got) == (20160901, 4)
