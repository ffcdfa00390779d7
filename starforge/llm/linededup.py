"""Fuzzy line de-duplication by MinHash, in DataFrame operations only.

A line is what stands between two line feeds.  Lines that are equal, or whose sets of
character shingles have a Jaccard similarity of at least ``threshold``, are linked; of each
connected component one line stays, the first by (doc_id, line number).

* Shingles: the ``WINDOW`` characters from *every* position, signed and verified alike; a
  shorter line is one shingle.  An insertion changes only the shingles that hold it.
* Signature: minima of ``bands * rows`` permutations of the shingle hashes, reduced within
  each task before they are shuffled; the lines themselves are not.
* Banding: one key per band; members of a bucket are candidates.  With 8 bands of 3 rows a
  pair at the threshold is found with a probability of 0.997, at 0.9 of 0.99997.
* Verification: exact Jaccard similarity over all shingles of both lines, of candidates only.
* Union-find: ``components.connected_components``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import checked_small, stage
from starforge.llm.components import PARITIES, bucket_components, parities

BANDS, ROWS = 8, 3
WINDOW = 8
THRESHOLD = 0.8


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, line_id) of every line that is not blank; line_no counts all lines from 0.

    line_id is a 64-bit hash of the line: equal lines are equal line_ids.
    """
    return (docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .where("line rlike '[^ \\\\t\\\\r]'")
            .select("doc_id", "line_no", "line", F.xxhash64("line").alias("line_id")))


def _mask(i: int) -> int:
    """i-th 32-bit mask, from a fixed rule (linear congruential steps)."""
    x = 0x9E3779B97F4A7C15
    for _ in range(i + 1):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
    x >>= 32
    return x - (1 << 32) if x >> 31 else x


def dense_hashes(line: str):
    """Array of the distinct 32-bit hashes of the shingles from every position; a shorter line is one shingle."""
    # cut out by place of characters of 4 bytes; a variable of ``transform`` is computed once
    every = F.transform(F.array(F.encode(line, "UTF-32")), lambda wide: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(line) - (WINDOW - 1), F.lit(1))),
        lambda i: F.hash(F.substring(wide, 4 * i - 3, F.lit(4 * WINDOW)))))
    return F.array_distinct(every[0])


def _minima(found: DataFrame, count: int, whole: bool) -> DataFrame:
    """(line_id, m0 ..): the minima of ``count`` permutations over the shingles from every position of the lines.

    In a line of n positions a minimum is looked for among the lowest 32 to 64 of n values that a
    permutation is expected to have there; it is null where none of them occurs (a line that
    repeats itself).  ``whole`` looks among all values.
    """
    places = F.greatest(F.length("line") - (WINDOW - 1), F.lit(1))
    top = F.lit(0) if whole else F.greatest(F.floor(F.log2(places)) - 5, F.lit(0))
    below = F.expr("cast(-2147483648 + shiftright(4294967295L, top) as int)")
    # every character as 4 bytes, so that a shingle is cut out by its place
    wide = (found.select("line_id", "line", F.encode("line", "UTF-32").alias("wide"), places.alias("places"), top.cast("int").alias("top"))
            .select("line_id", "wide", "places", below.alias("below")))
    hashes = (wide.select("line_id", "wide", "below", F.explode(F.sequence(F.lit(1), F.col("places"))).alias("i"))
              .select("line_id", "below", F.expr(f"hash(substring(wide, 4 * i - 3, {4 * WINDOW}))").alias("h")))
    ranks = [f"h ^ {_mask(i)}" for i in range(count)]
    return hashes.groupBy("line_id").agg(*[
        F.expr(f"min({r}) filter (where ({r}) <= below)").alias(f"m{i}") for i, r in enumerate(ranks)])


def band_keys(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(line_id, keys): one key per band for every distinct line, from written tables.

    A permutation of the shingle hashes is ``hash XOR mask``, one mask each: which shingle
    comes first under a mask is as likely for any of them, so two lines have the same
    minimum with the probability of their similarity.
    """
    keys = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{b * rows + j}") for j in range(rows)]) for b in range(bands)])
    found, known = lines(docs), " and ".join(f"m{i} is not null" for i in range(bands * rows))
    signed = stage(_minima(found, bands * rows, False).select("line_id", F.when(F.expr(known), keys).alias("keys")), "lines")
    again = stage(signed.where("keys is null").select("line_id"), "lines")
    if not again.head(1):
        return signed
    rest = _minima(found.join(checked_small(again), "line_id", "left_semi"), bands * rows, True)
    return signed.where("keys is not null").union(stage(rest.select("line_id", keys.alias("keys")), "lines"))


def line_components(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(node, component): line_ids linked to another line, with the smallest line_id of their component."""
    signed = band_keys(docs, bands, rows)
    members = signed.select(F.explode("keys").alias("key"), F.col("line_id").alias("node"))

    def bodies(ids: DataFrame) -> DataFrame:
        found = (lines(docs).join(ids.withColumnRenamed("node", "line_id"), "line_id", "left_semi")
                 .groupBy(F.col("line_id").alias("node")).agg(F.first("line").alias("body")))
        counted = parities(found.select("node", F.explode(dense_hashes("body")).alias("e")))
        return found.join(counted, "node").select("node", F.col("n").alias("size"), "body", *[
            F.coalesce(p, F.lit(0)).cast("long").alias(p) for p in PARITIES])

    def alike(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b", dense_hashes("body_a").alias("set_a"), dense_hashes("body_b").alias("set_b"))
        sizes = F.struct(F.size("set_a").alias("a"), F.size("set_b").alias("b"),
                         F.size(F.array_intersect("set_a", "set_b")).alias("common"))
        return both.select("a", "b", sizes.alias("n")).where(
            F.col("n.common") >= threshold * (F.col("n.a") + F.col("n.b") - F.col("n.common"))).select("a", "b")

    def elements(found: DataFrame) -> DataFrame:
        return found.select("node", "size", dense_hashes("body").alias("elements"))

    return bucket_components(members, bodies, alike, elements, threshold)


def line_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per line that is not blank: (doc_id, line_no, class_doc, class_line, kept).

    class_doc and class_line place the first line of the class, the one that stays; ``kept``
    is true there.  Blank lines are not lines of a class and always stay.  Null and empty
    texts have no lines.  Rows that repeat a doc_id are read as one document: their equal
    line numbers count as one place.  An empty table gives an empty table; other columns
    are ignored.
    """
    components = stage(line_components(docs, threshold), "lines")
    places = lines(docs).select("doc_id", "line_no", "line_id")
    # first place of each distinct line, reduced before any join: a line may be a third of all rows
    firsts = stage(places.groupBy("line_id").agg(F.min(F.struct("doc_id", "line_no")).alias("first")), "lines")
    grouped = components.withColumnRenamed("node", "line_id").join(firsts, "line_id")
    best = grouped.groupBy("component").agg(F.min("first").alias("best"))
    moved = stage(grouped.join(best, "component").select("line_id", "best"), "lines")
    named = (firsts.join(checked_small(moved), "line_id", "left")
             .select("line_id", F.coalesce("best", "first").alias("best")))
    return (places.join(named, "line_id")
            .select("doc_id", "line_no", F.col("best.doc_id").alias("class_doc"),
                    F.col("best.line_no").alias("class_line"),
                    (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
                     & (F.col("line_no") == F.col("best.line_no"))).alias("kept")))


def keep_first_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with only the first line of each class left in the texts; n_chars follows where there is one.

    Blank lines stay.  A document whose lines were all repeats of others is dropped; one
    that had no line before (null, empty or blank text) stays as it is.
    """
    gone = (line_classes(docs, threshold).where("not kept")
            .groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone_lines")))
    cut = docs.join(gone, "doc_id", "left")
    parts = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "_gone_lines")
    text = F.when(F.col("_gone_lines").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    changed = cut.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns],
                         "_gone_lines")
    rest = changed.where("_gone_lines is null or text rlike '[^ \\\\t\\\\r\\\\n]'").drop("_gone_lines")
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType),
                                                     F.col("n_chars")))
    return rest
