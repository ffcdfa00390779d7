"""Exact quantiles by narrowing histograms (A10 median, A11 quartiles, B9 median CLV,
D2 price cut-off).

``percentile`` / ``median`` are exact but keep every distinct value of the group in one
aggregation buffer; over a whole table that group is the table.  Here nothing is sorted,
staged or held whole:

1. one pass counts the values and finds the smallest and largest of every column;
2. one pass counts them per bucket: each range that holds a wanted rank is cut into
   ``BUCKETS`` equal parts, counted with map-side partial aggregation (a task sends at most
   that many rows per range, however many values it read), with the smallest and largest
   value of every part;
3. the part that holds the rank is the next range, cut again, until it holds one distinct
   value, or few enough rows to be listed by value.

Every pass reads only the columns asked for and serves all columns and ranks at once; a
range shrinks by the number of buckets, so a handful of passes reach any DOUBLE.  The two
values around a position are interpolated like Spark's ``percentile``:
pos = p (n - 1), value = (hi - pos) v[lo] + (pos - lo) v[hi].
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 2048
LISTED_ROWS = 20_000        # a range with at most so many rows is listed by value


def _bounds(d: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """Per column (values, smallest, largest, -infinities, infinities, NaNs); the first three of finite values."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        finite = (v > float("-inf")) & (v < float("inf"))           # NaN is larger than infinity
        aggs += [F.count_if(finite).alias(f"n{i}"), F.min(F.when(finite, v)).alias(f"a{i}"),
                 F.max(F.when(finite, v)).alias(f"z{i}"), F.count_if(v == float("-inf")).alias(f"l{i}"),
                 F.count_if(v == float("inf")).alias(f"h{i}"), F.count_if(F.isnan(v)).alias(f"x{i}")]
    row = d.agg(*aggs).first()
    return {c: tuple(row[f"{k}{i}"] for k in "nazlhx") for i, c in enumerate(cols)}


def _histogram(d: DataFrame, ranges: list[tuple[str, float, float]]) -> dict[int, list[tuple]]:
    """Per range its parts (rows, smallest, largest) in value order; one pass."""
    entries = []
    for i, (c, low, high) in enumerate(ranges):
        v = F.col(c)
        # halves, so that the width of a range never overflows
        part = F.least(F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * BUCKETS), F.lit(BUCKETS - 1))
        entries.append(F.when((v >= low) & (v <= high), F.struct(
            F.lit(i).alias("i"), part.cast("int").alias("b"), v.alias("v"))))
    parts = (d.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
             .groupBy("e.i", "e.b").agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("a"), F.max("e.v").alias("z")))
    out: dict[int, list[tuple]] = {}
    for r in parts.collect():                           # BUCKETS rows a range at most
        out.setdefault(r["i"], []).append((r["a"], r["z"], r["n"]))
    return {i: [(n, a, z) for a, z, n in sorted(found)] for i, found in out.items()}


def _listed(d: DataFrame, ranges: list[tuple[str, float, float]]) -> dict[int, list[tuple]]:
    """Per range its distinct values as parts (rows, value, value) in order; one pass."""
    entries = [F.when((F.col(c) >= low) & (F.col(c) <= high), F.struct(F.lit(i).alias("i"), F.col(c).alias("v")))
               for i, (c, low, high) in enumerate(ranges)]
    values = (d.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
              .groupBy("e.i", "e.v").agg(F.count(F.lit(1)).alias("n")))
    out: dict[int, list[tuple]] = {}
    for r in values.collect():                          # LISTED_ROWS a range at most
        out.setdefault(r["i"], []).append((r["v"], r["n"]))
    return {i: [(n, v, v) for v, n in sorted(found)] for i, found in out.items()}


def values_at(df: DataFrame, wanted: dict[str, set[int]], bounds: dict[str, tuple]) -> dict[tuple[str, int], float]:
    """(column, rank) -> the value at that rank (from 0) among the column's sorted values."""
    out: dict[tuple[str, int], float] = {}
    open_ranks: dict[tuple[str, float, float], list[tuple[int, int]]] = {}     # range -> (rank, rank within it)
    rows_in: dict[tuple[str, float, float], int] = {}
    for c, ranks in wanted.items():
        n, low, high, before, after, _ = bounds[c]
        for k in ranks:
            if k < before:
                out[c, k] = float("-inf")
            elif k >= before + n:
                out[c, k] = float("inf") if k < before + n + after else float("nan")
            elif low == high:
                out[c, k] = low
            else:
                open_ranks.setdefault((c, low, high), []).append((k, k - before))
                rows_in[c, low, high] = n
    while open_ranks:
        # a range that can't be halved any more holds a few values, however many rows
        many = [r for r in open_ranks if rows_in[r] > LISTED_ROWS and r[2] / 2 - r[1] / 2 > 0]
        few = [r for r in open_ranks if r not in many]
        parts = {many[i]: p for i, p in _histogram(df, many).items()} if many else {}
        parts |= {few[i]: p for i, p in _listed(df, few).items()} if few else {}
        narrowed: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
        for r, ranks in open_ranks.items():
            for rank, inside in ranks:
                for n, low, high in parts[r]:
                    if inside < n:
                        break
                    inside -= n
                if low == high:
                    out[r[0], rank] = low
                else:
                    narrowed.setdefault((r[0], low, high), []).append((rank, inside))
                    rows_in[r[0], low, high] = n
        open_ranks = narrowed
    return out


def percentiles_of(df: DataFrame, wanted: dict[str, dict[str, float]]) -> dict[str, dict[str, float | None]]:
    """Exact percentiles of several columns at once: column -> name -> p gives column -> name -> value.

    NULLs are ignored; NaN is the largest value; a column without values gives None.
    """
    cols = list(wanted)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    bounds = _bounds(d, cols)
    sizes = {c: b[0] + b[3] + b[4] + b[5] for c, b in bounds.items()}
    positions = {c: {name: p * (sizes[c] - 1) for name, p in ps.items()} for c, ps in wanted.items() if sizes[c]}
    ranks = {c: {k for pos in ps.values() for k in (math.floor(pos), math.ceil(pos))} for c, ps in positions.items()}
    found = values_at(d, ranks, bounds) if ranks else {}
    out: dict[str, dict[str, float | None]] = {c: dict.fromkeys(ps) for c, ps in wanted.items()}
    for c, ps in positions.items():
        for name, pos in ps.items():
            low, high = math.floor(pos), math.ceil(pos)
            a, b = found[c, low], found[c, high]
            out[c][name] = a if low == high or a == b else (high - pos) * a + (pos - low) * b
    return out


def exact_percentiles(df: DataFrame, col: str, ps: dict[str, float], where=None) -> DataFrame:
    """One row, one DOUBLE column per name in ``ps`` (NULL on no rows)."""
    found = percentiles_of(df if where is None else df.where(where), {col: ps})[col]
    return df.sparkSession.createDataFrame([tuple(found[k] for k in ps)], ", ".join(f"{k} double" for k in ps))
