"""Row-level expressions of the warehouse.

All are built-in Column expressions, so they run inside whole-stage codegen.
Money stays DECIMAL; rounding of ratios is done exactly (half up) in integer
arithmetic so that the result does not depend on binary floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starforge.rules import DELIVERED, Rules

MONEY = "decimal(12,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def item_total(price="price", freight="freight_value") -> Column:
    """price + freight; NULL if either is NULL (one digit more than its parts)."""
    return _c(price) + _c(freight)


def product_volume(length="product_length_cm", height="product_height_cm",
                   width="product_width_cm") -> Column:
    """length x height x width, rounded to 2 places."""
    return F.round(_c(length).cast("decimal(20,2)") * _c(height) * _c(width), 2)


def positive_flag(x) -> Column:
    """X > 0 with NULL counted as false."""
    return F.coalesce(_c(x) > 0, F.lit(False))


def is_completed(status="order_status") -> Column:
    """status = 'delivered'; NULL status is false."""
    return F.coalesce(_c(status) == DELIVERED, F.lit(False))


WHOLE = "decimal(38,0)"


def round_ratio(num, den, scale: int = 2) -> Column:
    """num / den rounded half away from zero to ``scale`` places, exactly.

    ``num`` and ``den`` are integer-valued (counts, or money in cents) of up to 30 digits;
    the arithmetic is DECIMAL, so a large amount doesn't overflow on the way.
    Returns DECIMAL(38, scale); NULL when den is 0 or NULL.
    """
    n = _c(num).cast(WHOLE)
    d = F.when(_c(den) != 0, _c(den).cast(WHOLE))
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    twice = F.lit(2) * F.abs(n) * F.lit(10 ** scale) + F.abs(d)
    units = int_div(twice, F.lit(2) * F.abs(d))
    return ((sign * units).cast(WHOLE) / F.lit(10 ** scale)).cast(f"decimal(38,{scale})")


def int_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers, exact (no floating point)."""
    a, b = a.cast(WHOLE), b.cast(WHOLE)
    return ((a - F.pmod(a, b)) / b).cast(WHOLE)


def cents(money) -> Column:
    """Money as a whole number of cents."""
    return (_c(money).cast("decimal(38,2)") * 100).cast(WHOLE)


def percent(part, whole) -> Column:
    """part / whole * 100 as DOUBLE, 0 when whole is 0."""
    return F.coalesce(F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * 100.0,
                      F.lit(0.0))


def share_pct(part, whole) -> Column:
    """ROUND(part * 100.0 / whole, 2) as DOUBLE, exact half-up."""
    return round_ratio(_c(part) * 100, whole, 2).cast("double")


def customer_segment(total_orders, lifetime_value, rules: Rules) -> Column:
    """F16: Inactive / VIP / New / Returning / Loyal, tested in that order."""
    n = _c(total_orders)
    ltv = F.coalesce(_c(lifetime_value).cast("double"), F.lit(0.0))
    return (F.when(n == 0, "Inactive")
            .when((n >= rules.vip_min_orders) | (ltv >= F.lit(float(rules.vip_min_value))), "VIP")
            .when(n <= rules.new_max_orders, "New")
            .when(n <= rules.returning_max_orders, "Returning")
            .otherwise("Loyal"))


def lifetime_value(total_spent, days_as_customer, rules: Rules) -> Column:
    """aov x annual frequency x (lifespan / 365), rounded to 2 places.

    aov = spent / orders and frequency = orders / days x 365, so the product
    is spent x lifespan / days; computed exactly on cents.  The value may be larger than
    the target column holds: ``conform`` decides.
    """
    return round_ratio(cents(total_spent) * F.lit(rules.lifespan_days), _c(days_as_customer) * 100, 2)


def review_sentiment(score="review_score") -> Column:
    """>= 4 positive, 3 neutral, <= 2 negative."""
    s = _c(score)
    return (F.when(s >= 4, "positive").when(s == 3, "neutral").when(s <= 2, "negative"))


def text_prefix(text, n: int = 200) -> Column:
    """first n characters."""
    return F.substring(_c(text), 1, n)
