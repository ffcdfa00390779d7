"""Keys and "first row" operators.

dense_key assigns 1..n in sort order without funnelling rows through one
task: a distributed range sort, a per-partition position, and a running
offset over the per-partition counts (one number per partition, so what
reaches the driver is bounded by the partition count, not by the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.session import scratch_path, shuffles_dropped

_POS_BITS = 33                      # monotonically_increasing_id: partition << 33 | row
_POS_MASK = (1 << _POS_BITS) - 1


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dense_key(df: DataFrame, order_by, key: str = "key", first: bool = True,
              after: int = 0) -> DataFrame:
    """Add ``key`` = after + 1 .. after + n following ``order_by`` (ascending, NULLs first).
    ``after`` is the largest key already given out (K4).

    1. The rows are range-sorted across the cluster, tagged with
       monotonically_increasing_id (partition << 33 | position) and written
       once to the shared checkpoint folder, so every later step reads the
       same materialised order (a re-evaluated range sort may sample
       different bounds).
    2. Rows per sort partition are counted (one column read); the result has
       one row per non-empty partition, so it is bounded by the partition
       count, not by the data, and its running offsets are computed on the
       driver.
    3. The offsets go back as a small local table in a broadcast join:
       key = offset + position + 1.
    Ties in ``order_by`` get distinct keys in an arbitrary order; callers
    order by a unique key.
    """
    spark = df.sparkSession
    order_cols = [c.asc_nulls_first() for c in _cols(order_by)]
    path = scratch_path(spark, f"dense_key-{key}")
    # a content hash as the last sort key spreads rows that repeat the
    # requested key over several range partitions (a repeated key cannot
    # pile up in one sort task); rows equal in every column stay together
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    with shuffles_dropped(spark):
        (df.orderBy(*order_cols, spread)
           .withColumn("_sf_pos", F.monotonically_increasing_id())
           .write.mode("overwrite").parquet(path))
    staged = spark.read.parquet(path)
    part = F.shiftright(F.col("_sf_pos"), _POS_BITS)
    counts = sorted((r[0], r[1]) for r in
                    staged.groupBy(part.alias("p")).agg(F.count(F.lit(1))).collect())
    offsets, running = [], after
    for p, n in counts:
        offsets.append((int(p), running))
        running += n
    schema = T.StructType([T.StructField("_sf_part", T.LongType(), False),
                           T.StructField("_sf_offset", T.LongType(), False)])
    table = spark.createDataFrame(offsets, schema)
    keyed = (staged.join(F.broadcast(table), part == F.col("_sf_part"), "inner")
             .withColumn(key, (F.col("_sf_offset") + F.col("_sf_pos").bitwiseAND(F.lit(_POS_MASK))
                               + 1).cast("long"))
             .drop("_sf_part", "_sf_offset", "_sf_pos"))
    if first:
        keyed = keyed.select(key, *[c for c in keyed.columns if c != key])
    return keyed


def first_by(value, order_by) -> Column:
    """Value of the row with the smallest ``order_by`` tuple in a group.

    "First" in file order has no meaning on a distributed table; the tuple
    of explicit columns is the deterministic stand-in.  Partial aggregation
    keeps a hot group from landing whole in one task.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.struct(*_cols(order_by)))


def number_ids(ids: DataFrame, id_col: str, key: str, after: int = 0) -> DataFrame:
    """(id_col, key): the distinct non-NULL ids numbered after + 1 .. after + n in id order.

    Only the id column is range-sorted.  A wide table gets its keys by joining this narrow
    one on the id, for which it is usually partitioned already.
    """
    return dense_key(ids.select(id_col).where(F.col(id_col).isNotNull()).distinct(), [id_col], key,
                     first=False, after=after)


def key_and_conform(df: DataFrame, table: str, order_by, key: str, business_key: str,
                    stamps: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """W2 + K8 for a dimension: (typed rows keyed 1..n, rejected values), written once.

    Rows that hold a value the target can't (``flag_unfit``) are sorted behind the others,
    so the others have the keys 1..n without a gap, and both results read one staged table.
    """
    from starforge.schemas import TARGETS, conform, flag_unfit, is_unfit, unfit_rows
    flagged = flag_unfit(df, TARGETS[table])
    keyed = dense_key(flagged, [is_unfit(), *order_by], key)
    typed = keyed.where(~is_unfit()).withColumns(stamps)
    return conform(typed, TARGETS[table]), unfit_rows(keyed, table, business_key)


def _any_null(keys) -> Column:
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return null


def _best(df: DataFrame, keys, order_by) -> DataFrame:
    """keys, _sf_best: the smallest row of each key by (order_by, whole row), without the keys.

    Every column is in the struct once: those of ``order_by``, then the rest in their order.
    """
    rank, held = [], {*keys, "_sf_n"}
    for i, c in enumerate(order_by):
        if not isinstance(c, str):
            rank.append(c.alias(f"_sf_by{i}"))
        elif c not in held:
            rank.append(F.col(c))
            held.add(c)
    rest = [F.col(c) for c in df.columns if c not in held]
    # a table may have no column but its keys
    return df.groupBy(*keys).agg(F.min(F.struct(*rank, *rest, F.lit(0).alias("_sf_end"))).alias("_sf_best"))


def first_rows(df: DataFrame, key, order_by) -> DataFrame:
    """K6, the rows kept: for each non-NULL ``key`` the row with the smallest ``order_by``
    tuple (then the smallest whole row, so the choice is total).  One aggregation with
    map-side partial aggregation, so a hot key never lands whole in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    best = _best(df.where(~_any_null(keys)), keys, order_by)
    # the grouping columns themselves stay, so the result remains known as
    # hash-partitioned by the key for a following join
    return best.select(*[F.col(c) if c in keys else F.col(f"_sf_best.{c}").alias(c)
                         for c in df.columns])


def extra_rows(df: DataFrame, key, order_by, reason: str = "duplicate_key",
               repeated: DataFrame | None = None) -> DataFrame:
    """K6, the rows quarantined: all that ``first_rows`` leaves out, exact copies of the
    row kept included, with a ``reject_reason`` column (``null_key`` or ``reason``).

    Rows are counted per key first (the key column alone is read); only the rows of keys
    that repeat are fetched, collapsed to one per distinct row and staged.  A table
    without repeats costs one narrow count: few keys that repeat are sent to its rows, which
    are not shuffled for them.  ``repeated``: the keys that repeat, where they are known already.
    """
    keys = [key] if isinstance(key, str) else list(key)
    null = _any_null(keys)
    present = df.where(~null)
    if repeated is None:
        repeated = (present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sf_rows"))
                    .where(F.col("_sf_rows") > 1).select(*keys))
    dupes = beyond_first(present.join(few_keys(repeated), keys, "left_semi").select(*df.columns), key, order_by,
                         reason)
    return dupes.unionByName(df.where(null).withColumn("reject_reason", F.lit("null_key")))


KEYS_SENT = 250_000


def few_keys(keys: DataFrame) -> DataFrame:
    """The narrow table ``keys``, staged and counted; a broadcast only if it has few rows."""
    from starforge.sinks import stage
    staged = stage(keys, "keys")
    return F.broadcast(staged) if staged.count() <= KEYS_SENT else staged


def beyond_first(df: DataFrame, key, order_by, reason: str) -> DataFrame:
    """All that ``first_rows`` leaves out of rows whose keys are not NULL, with a ``reject_reason``:
    the rows are collapsed to one per distinct row and staged, so pass only those of keys that repeat."""
    from starforge.sinks import stage
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    rows = stage(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_sf_n")), "repeated")
    won = F.lit(True)
    for c in cols:
        if c not in keys:
            won = won & F.col(c).eqNullSafe(F.col(f"_sf_best.{c}"))
    rest = (rows.join(_best(rows, keys, order_by), keys)
            .select(*cols, (F.col("_sf_n") - won.cast("int")).alias("_sf_left"))
            .where(F.col("_sf_left") > 0))
    return _expand_copies(rest, "_sf_left").select(*cols).withColumn("reject_reason", F.lit(reason))


def keep_first(df: DataFrame, key, order_by, reason: str = "duplicate_key"):
    """K6: split rows into (kept, quarantined) on a unique business key, see ``first_rows``
    and ``extra_rows``; kept + quarantined = input, row for row."""
    return first_rows(df, key, order_by), extra_rows(df, key, order_by, reason)


COPY_CHUNK = 1 << 20


def _expand_copies(df: DataFrame, count_col: str) -> DataFrame:
    """Turn a row with multiplicity m back into m rows without one task
    emitting them all: m is cut into chunks of at most COPY_CHUNK, the chunk
    rows are spread over the cluster by a hash of row and chunk, then each explodes."""
    m = F.col(count_col).cast("long")
    chunks = df.withColumn("_sf_chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((m - 1) / COPY_CHUNK).cast("long"))))
    sized = chunks.withColumn(
        "_sf_size", F.least(F.lit(COPY_CHUNK).cast("long"), m - F.col("_sf_chunk") * COPY_CHUNK))
    spread = sized.repartition(*sized.columns)
    return (spread.withColumn("_sf_copy", F.explode(F.sequence(F.lit(1).cast("long"),
                                                              F.col("_sf_size"))))
            .drop("_sf_chunk", "_sf_size", "_sf_copy"))


def duplicate_count(key) -> Column:
    """W5 as an aggregate expression: rows minus distinct values, NULL
    counted as one value (what ``duplicated().sum()`` reports)."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.count(F.lit(1)) - F.count_distinct(k)
            - F.when(F.count_if(k.isNull()) > 0, 1).otherwise(0)).cast("long")
