"""SimHash near-duplicates by deletion variants of fingerprint segments."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
from pyspark.sql import functions as F

from starforge.llm.common import checked_small, stage
from starforge.llm.components import connected_components

# LANES[b]: the eight bits of byte b, least significant first, one per 8-bit lane
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1,
                      bitorder="little").view(np.uint64).ravel()
LANE_ROWS = 255          # so many rows fit an 8-bit lane


def majority_bits(hashes: np.ndarray) -> int:
    """64-bit number whose bit is 1 where over half of ``hashes`` have it set."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, LANE_ROWS * 256):
        lanes = LANES[hashes[at:at + LANE_ROWS * 256].view(np.uint8).reshape(-1, 8)]
        short = -len(lanes) % LANE_ROWS
        if short:
            lanes = np.concatenate([lanes, np.zeros((short, 8), np.uint64)])
        sums = lanes.reshape(-1, LANE_ROWS, 8).sum(axis=1)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text: XXH64 (seed 42) of its word shingles, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()     # bytes: only A-Z change, ASCII white space
    if not words:
        return 0
    grams = (map(b" ".join, zip(*(words[i:] for i in range(shingle))))
             if len(words) >= shingle else [b" ".join(words)])
    return majority_bits(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64))


def fingerprints(docs, shingle: int = 3):
    """(doc_id, fp): the fingerprint of every whole text as a signed long; null text counts as empty."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            values = np.array([simhash(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))],
                                             names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of distance // 2 + 1 segments: two fingerprints that differ in at
    most ``distance`` bits agree, but for one bit at most, in one of the segments."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def variants(fps, distance: int):
    """(key, slot, fp): each segment with one bit deleted; ``slot`` numbers segment and deleted bit."""
    cells = [(lo, width, lo + bit) for lo, width in _segments(distance) for bit in range(width)]
    struct = [F.struct(F.lit(i).alias("slot"),
                       F.expr(f"fp & {_signed(((1 << w) - 1) << lo & ~(1 << at))}").alias("part"))
              for i, (lo, w, at) in enumerate(cells)]
    return (fps.select("fp", F.explode(F.array(*struct)).alias("v"))
            .select("v.slot", "v.part", "fp"))


def _signed(mask: int) -> str:
    mask &= (1 << 64) - 1
    value = mask - (1 << 64) if mask >> 63 else mask
    return f"CAST('{value}' AS BIGINT)"


def link_fingerprints(fps, distance: int = 2, crowded: int = 64):
    """Links (a, b) whose components are those of all pairs at ``distance`` or fewer bits.

    ``fps``: distinct fingerprints.  Buckets of one-deletion variants are found by an
    equality join; in buckets of at most ``crowded`` members every pair is verified in the
    join.  Larger buckets are not compared pair by pair: their members are indexed again by
    the whole fingerprint without ``distance`` of its bits.  Members of such a class are all
    within the distance of each other, so linking each to the smallest loses nothing.
    """
    rows = variants(fps, distance)
    shared = stage(rows.groupBy("slot", "part").agg(F.count("*").alias("n")).where("n > 1"), "simhash")
    members = stage(rows.join(checked_small(shared), ["slot", "part"]), "simhash")
    few = members.where(F.col("n") <= crowded)
    # the files of repeated fingerprints are so small that Spark would send millions of rows to all executors
    near = (few.alias("x").join(few.alias("y").hint("merge"), (F.col("x.slot") == F.col("y.slot"))
                                & (F.col("x.part") == F.col("y.part")) & (F.col("x.fp") < F.col("y.fp"))
                                & (F.expr("bit_count(x.fp ^ y.fp)") <= distance))
            .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct())
    many = stage(members.where(F.col("n") > crowded).select("fp").distinct(), "simhash")
    if not many.head(1):
        return near
    masks = [sum(1 << bit for bit in bits) for bits in combinations(range(64), distance)]
    # C(64, distance) masks, a table fixed by the distance
    keep = [k - (1 << 64) if k >> 63 else k for k in ((1 << 64) - 1 - m for m in masks)]
    classes = (many.select("fp", F.posexplode(F.lit(keep)).alias("hole", "keep"))
               .select("hole", F.expr("fp & keep").alias("rest"), "fp"))
    least = classes.groupBy("hole", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    return near.union(classes.join(least, ["hole", "rest"]).where("fp <> a")
                      .select("a", F.col("fp").alias("b")).distinct())


def near_duplicates(docs, distance: int = 2, shingle: int = 3):
    """One row per document: (doc_id, fp long, component_id).

    Words are runs of non-white-space (space and U+0009 to U+000D) of the text with A-Z
    lower-cased; a fingerprint is the bitwise majority of the XXH64 of its word shingles,
    repeats included.  Documents whose fingerprints differ in at most ``distance`` bits are
    linked; component_id is the smallest doc_id reachable.

    Null and empty texts have fingerprint 0 and are linked like any other.  Texts of fewer
    words than a shingle are one shingle.  Repeated rows stay, each with its component.
    An empty table gives an empty table; other columns are ignored.
    """
    marked = stage(fingerprints(docs, shingle), "simhash")
    fps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash")
    roots = connected_components(stage(link_fingerprints(fps.select("fp"), distance), "simhash"))
    placed = stage(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                   .select("fp", "first", F.coalesce("component", "fp").alias("root")), "simhash")
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs, distance: int = 2, shingle: int = 3):
    """The documents whose doc_id is the smallest of their component, all columns kept.

    A null doc_id is never a duplicate.  Rows that repeat a kept doc_id are reduced to one.
    """
    found = near_duplicates(docs, distance, shingle)
    dropped = found.where("doc_id <> component_id").select("doc_id").distinct()
    rest = docs.join(dropped, "doc_id", "left_anti")
    return rest.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(
        rest.where("doc_id is null"))
