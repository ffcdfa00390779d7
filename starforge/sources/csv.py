"""CSV sources.

Every column is read as text (no inference) and then converted with the
lenient ``try_*`` casts: an unparsable value becomes NULL and the row is
kept (S7).  Columns of the declared schema that the file does not have are
skipped ("parse if present").  Quoted fields may hold
line breaks and doubled quotes (S6).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions.scalars import item_total, positive_flag, product_volume
from starforge.operators.validate import Observed, rules_for
from starforge.schemas import SOURCES, TARGETS
from starforge.sources.tables import Sources


def lenient(col: str, dtype: T.DataType):
    """Text -> ``dtype``; empty or unparsable text gives NULL."""
    if isinstance(dtype, T.StringType):
        return F.col(col)
    c = F.trim(F.col(col))
    c = F.when(c != "", c)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.try_to_timestamp(c).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.to_date(F.try_to_timestamp(c))
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNotNull(), F.lower(c).isin("true", "1", "t", "yes"))
    return c.try_cast(dtype)


CORRUPT = "_sf_record"
NULLED = "_sf_nulled"
# free text: quoted fields that hold line breaks, one task per file
MULTILINE = frozenset({"reviews"})


def _options(reader, multiline: bool):
    if multiline:
        reader = reader.option("lineSep", "\n")       # leave other line ends inside quotes as they are
    return (reader.option("header", True).option("multiLine", multiline)
            .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE").option("encoding", "UTF-8"))


def read_csv_table(spark: SparkSession, path: str, table: str,
                   multiline: bool | None = None) -> DataFrame:
    """Read one source CSV (header line, UTF-8) into its declared schema.

    ``multiline`` defaults to the tables with free text: Spark can't split such a file, so
    it is one task; the others are split.
    """
    if multiline is None:
        multiline = table in MULTILINE
    raw = _options(spark.read.option("inferSchema", False), multiline).csv(path)
    schema = SOURCES[table]
    cols = [lenient(f.name, f.dataType).alias(f.name) for f in schema.fields
            if f.name in raw.columns]
    return raw.select(*cols)


def derived_columns(df: DataFrame, table: str) -> DataFrame:
    """What the extract adds to a source: item_total (F1) on order items, volume (F2) and photo
    flag (F3) on products, where the columns they come from are there."""
    have = set(df.columns)
    if table == "order_items" and {"price", "freight_value"} <= have:
        df = df.withColumn("item_total", item_total())
    if table == "products":
        if {"product_length_cm", "product_height_cm", "product_width_cm"} <= have:
            df = df.withColumn("product_volume_cm3", product_volume())
        if "product_photos_qty" in have:
            df = df.withColumn("has_photos", positive_flag("product_photos_qty"))
    return df


def scan_csv(spark: SparkSession, path: str, table: str, multiline: bool | None = None) -> DataFrame:
    """S1-S7 with a record of what was lost: the columns of ``read_csv_table``, plus
    ``_sf_record``, the whole line where it has more or fewer fields than the header (NULL
    otherwise), and ``_sf_nulled``, the columns whose text could not be converted.

    The first line of the (first) file names the columns; a file whose header differs
    fails the scan instead of being read by position.
    """
    if multiline is None:
        multiline = table in MULTILINE
    header = _options(spark.read.option("inferSchema", False), multiline).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    # every field is parsed, also of columns that nobody reads: else the length of a line isn't checked
    raw = _options(spark.read.schema(schema).option("enforceSchema", False).option("columnPruning", False)
                   .option("columnNameOfCorruptRecord", CORRUPT), multiline).csv(path)
    cols, lost = [], []
    for f in SOURCES[table].fields:
        if f.name not in header:
            continue
        value = lenient(f.name, f.dataType)
        cols.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            lost.append(F.when((F.trim(f.name) != "") & value.isNull(), F.lit(f.name)))
    lost = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return raw.select(*cols, CORRUPT, lost.alias(NULLED))


def ledger_of(scanned: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, rows_read, malformed_rows, values_nulled), one row per column, in one pass."""
    cols = [c for c in scanned.columns if c not in (CORRUPT, NULLED)]
    whole = F.col(CORRUPT).isNull()
    a = scanned.agg(F.count(F.lit(1)).alias("_sf_rows"), F.count(CORRUPT).alias("_sf_bad"),
                    *[F.count_if(whole & F.array_contains(NULLED, c)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (a.selectExpr("_sf_rows", "_sf_bad", f"stack({len(cols)}, {stack}) as (column_name, values_nulled)")
            .select(F.lit(table).alias("table_name"), "column_name", F.col("_sf_rows").alias("rows_read"),
                    F.col("_sf_bad").alias("malformed_rows"), "values_nulled"))


def read_staged_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A warehouse table from its staged CSV, repaired to the declared types.

    Times of a fact that can't be parsed become NULL; anything else that can't be
    converted, a dimension's date for instance, fails the read.
    """
    raw = _options(spark.read.option("inferSchema", False), False).csv(path)
    cols = []
    for f in TARGETS[table].fields:
        soft = table.startswith("fact_") and isinstance(f.dataType, T.TimestampNTZType)
        cols.append((lenient(f.name, f.dataType) if soft else F.col(f.name).cast(f.dataType)).alias(f.name))
    return raw.select(*cols)


@dataclass
class Extract:
    """Sources read from files, and what reading them lost."""
    sources: Sources
    malformed: DataFrame        # table_name, record: the lines that are in no source
    ledger: DataFrame           # see ``ledger_of``
    checks: list[tuple]         # V1-V6, one row per rule that marks single rows (``Observed``)


def read_sources(spark: SparkSession, paths: dict[str, str]) -> Extract:
    """The six source tables from CSV files or folders (``paths`` by source name).

    Every file is parsed once, into a staged typed table that the build then reads.  Lines
    with a wrong number of fields are kept in ``malformed``, not in the sources; values that
    can't be converted are NULL and counted per column in ``ledger``.  The rules V1-V6 that
    mark single rows are counted by the same pass.
    """
    from starforge.sinks import stage
    tables, malformed, ledger, checks = {}, None, None, []
    for f in fields(Sources):
        lines = scan_csv(spark, paths[f.name], f.name)
        seen = Observed(lines, f.name, [r for r in rules_for(f.name) if r.rows is not None],
                        where=F.col(CORRUPT).isNull())
        scanned = stage(seen.df, f"csv-{f.name}")
        checks += seen.rows()
        tables[f.name] = derived_columns(scanned.where(F.col(CORRUPT).isNull()).drop(CORRUPT, NULLED), f.name)
        bad = scanned.where(F.col(CORRUPT).isNotNull()).select(F.lit(f.name).alias("table_name"),
                                                                F.col(CORRUPT).alias("record"))
        malformed = bad if malformed is None else malformed.unionByName(bad)
        one = ledger_of(scanned, f.name)
        ledger = one if ledger is None else ledger.unionByName(one)
    return Extract(Sources(**tables), malformed, ledger, checks)
