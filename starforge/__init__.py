"""starforge: a retail star-schema warehouse built on Spark DataFrames.

Sources are read into typed DataFrames, validated, shaped into four dimensions
(date, product, payment type, customer) and two facts (orders, cohort
retention), checked for quality and written as Parquet or CSV.  Every step is
a DataFrame / Spark SQL expression; no Python UDF runs in the hot path.
"""

from starforge.rules import Rules, SHIPPED_RULES, FIXTURE_RULES

__all__ = ["Rules", "SHIPPED_RULES", "FIXTURE_RULES"]
