"""Audit of how filters interact: what each filter removes at each place of every order.

Documents are reduced to counts per part and pattern of failed filters, a table of 32 cells a
part.  The counts of a part are a tensor of shape 2 x 2 x 2 x 2 x 2, one axis per filter (0
passes, 1 fails).  Every figure of the report is a contraction of that tensor in which each
axis is reduced to its passes, its failures, or both; one ``einsum`` does it for all steps of
all orders.

Filters (words are maximal runs of characters other than space and tab to carriage return):

* A: fewer than 200 words;
* B: distinct words are under 50 percent of the words;
* C: over 2 percent of the code points are ``A`` to ``Z``;
* D: holds one of ``#$%&*|``;
* E: the text equals the text of a smaller doc_id.

Texts are compared by SHA-256.  The reduction to cells is DataFrame work: rows of one text are
counted per part before they are shuffled, so a text, a part or a doc_id may hold any share of
the rows.  What the numpy step reads has one row per part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
MARKS = "[#$%&*|]"
GAP = r"[\x20\x09-\x0D]+"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def patterns(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text_key, fails, n): rows by id, part and text; ``fails`` has bit 3 for A to bit 0 for D."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, GAP), "")
    flags = [F.size(words) < LEAST_WORDS,
             F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
             F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * CAPITAL_PERCENT,
             text.rlike(MARKS)]
    fails = sum((flag.cast("int") * (8 >> i) for i, flag in enumerate(flags)), F.lit(0))
    return (docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"),
                        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"), fails.alias("fails"))
            .groupBy("doc_id", "part", "text_key", "fails").agg(F.count("*").alias("n")))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cell, n, good, toxic): counts by pattern; ``cell`` has bit 4 for A to bit 0 for E.

    ``good`` and ``toxic`` count the rows that ``labels`` marks so; an id that is labelled
    several times takes its highest labels.  A row with a null doc_id has no label and no
    smaller doc_id, and is none's smaller doc_id.
    """
    marks = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")))
    rows = patterns(docs)
    known = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = rows.where("doc_id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    rows = known.unionByName(nameless).withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # one row per text, part and label: how many rows, and how many of them have the smallest id
    texts = rows.groupBy("text_key", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    smallest = F.min("first").over(Window.partitionBy("text_key"))
    texts = texts.withColumn("passes", F.col("n_null") + F.when(F.col("first") == smallest, F.col("n_first"))
                             .otherwise(0))
    split = texts.select("part", "good", "toxic", F.explode(F.array(
        F.struct((F.col("fails") * 2).alias("cell"), F.col("passes").alias("n")),
        F.struct((F.col("fails") * 2 + 1).alias("cell"), (F.col("n") - F.col("passes")).alias("n")))).alias("c"))
    return (split.where("c.n > 0").groupBy("part", F.col("c.cell").alias("cell"))
            .agg(F.sum("c.n").alias("n"), F.sum(F.expr("if(good, c.n, 0)")).alias("good"),
                 F.sum(F.expr("if(toxic, c.n, 0)")).alias("toxic")))


def selectors(choose) -> list[np.ndarray]:
    """One matrix per filter: a row for each order and step, holding what ``choose`` selects of that axis.

    ``choose(place, step)`` tells it from the filter's place in the order and the step, from 0.
    """
    return [np.array([choose(order.index(f), step) for order in ORDERS for step in range(len(FILTERS))], np.int64)
            for f in FILTERS]


KEPT = selectors(lambda place, step: PASS if place <= step else ALL)
REMOVED = selectors(lambda place, step: PASS if place < step else FAIL if place == step else ALL)
FAILING = selectors(lambda place, step: FAIL if place == step else ALL)
ONLY = selectors(lambda place, step: FAIL if place == step else PASS)
AT = np.array([FILTERS.index(f) for order in ORDERS for f in order])      # the filter of every step


def contract(counts: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """Sums of ``counts`` (parts x measures x 2 x 2 x 2 x 2 x 2) for every step: parts x steps x measures."""
    return np.einsum("pmabcde,sa,sb,sc,sd,se->psm", counts, *chosen, optimize=True)


def figures(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Figures of every part and step from counts of shape parts x 3 (all, good, toxic) x 32."""
    tensor = counts.reshape(len(counts), 3, *(2,) * len(FILTERS))
    rows = tensor[:, :1]
    removed = contract(tensor, REMOVED)
    out = {"kept": contract(rows, KEPT)[..., 0], "removed": removed[..., 0],
           "redundant": contract(rows, FAILING)[..., 0] - removed[..., 0],
           "unique_fails": contract(rows, ONLY)[..., 0],
           "good_lost": removed[..., 1], "toxic_lost": removed[..., 2]}
    by_filter = np.einsum("ps,sf->pf", removed[..., 0], np.eye(len(FILTERS), dtype=np.int64)[AT])
    return out | {"shapley": by_filter[:, AT]}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step (columns of ``REPORT``), zeros included.

    kept, removed: rows left after, and taken at, this step; redundant: rows that fail its
    filter but were taken before; unique_fails: rows that fail no other; good_lost and
    toxic_lost: taken rows that are labelled so; shapley: rows its filter takes, summed over
    all orders.  A part is a source; null sources are the part of the empty string.  Null
    texts are empty.  Rows that repeat an id each count; equal texts of one id don't fail E.
    An empty table gives an empty table; other columns are ignored.
    """
    tensors = cells(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))      # 32 at most

    def run(batches) -> Iterator:
        import pandas as pd

        size = len(ORDERS) * len(FILTERS)
        orders = np.repeat(ORDERS, len(FILTERS))
        steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.iloc[at:at + 64]
                counts = np.zeros((len(some), 3, 1 << len(FILTERS)), np.int64)
                for i, found in enumerate(some["cells"]):
                    for c in found:
                        counts[i, :, c["cell"]] = c["n"], c["good"], c["toxic"]
                table = {"part": np.repeat(some["part"].to_numpy(), size),
                         "filter_order": np.tile(orders, len(some)), "step": np.tile(steps, len(some))}
                yield pd.DataFrame(table | {k: v.ravel() for k, v in figures(counts).items()})

    return tensors.mapInPandas(run, REPORT)
