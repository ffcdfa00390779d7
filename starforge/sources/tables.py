"""The six source tables that a build reads."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass
class Sources:
    """The six source tables in the warehouse's source schemas."""
    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    payments: DataFrame
    reviews: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]
