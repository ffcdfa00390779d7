"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Keys and virtual nodes are points of a ring of 2**32 positions (the first 32 bits of MD5).
A key belongs to the shard of the next virtual node clockwise.  A shard takes at most
``n // shards`` rows, plus one on the first ``n % shards`` shards; what is over continues
clockwise to the next shard with room.  So the counts of any two shards differ by one at
most (the law ``rows``), and rows move only where a shard is full.

All keys between two virtual nodes meet the shards in the same order.  The overflow is
therefore settled on counts of these arcs, at most ``shards * nodes`` numbers whatever the
size of the table; the rows themselves are only ranked within their arc.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import stage

SHARDS = 8
NODES = 64                 # virtual nodes of a shard
RING = 1 << 32
SLOTS = 1 << 12            # equal slices of the ring, to find an arc without a search
RANKED_ROWS = 4096         # mean rows that are ranked together
COPIES = 100_000           # repeated rows that one array unfolds


def ring(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, in clockwise order."""
    return sorted((int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[:8], 16), s)
                  for s in range(shards) for v in range(nodes))


def clockwise(points: list[tuple[int, int]], arc: int, shards: int) -> list[int]:
    """The shards in the order in which keys of an arc meet them."""
    order: list[int] = []
    for i in range(len(points)):
        s = points[(arc + i) % len(points)][1]
        if s not in order:
            order.append(s)
            if len(order) == shards:
                break
    return order


def settle(counts: dict[int, int], points: list[tuple[int, int]], shards: int) -> list[tuple]:
    """(arc, shard, from_rank, rows, first slot): how many rows of each arc go to which shard.

    Round by round every arc offers what is left to the next shard clockwise; a shard takes
    the arcs in ring order until it is full.
    """
    n = sum(counts.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    used = [0] * shards
    left = {arc: c for arc, c in sorted(counts.items()) if c}
    placed = {arc: 0 for arc in left}
    order = {arc: clockwise(points, arc, shards) for arc in left}
    out = []
    for step in range(shards):
        for arc in sorted(left):
            s = order[arc][step]
            take = min(left[arc], room[s] - used[s])
            if take:
                out.append((arc, s, placed[arc], take, used[s]))
                used[s] += take
                placed[arc] += take
                left[arc] -= take
    return out


def shard(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, key: str = "doc_id") -> DataFrame:
    """One row per document: (doc_id, size, text_crc32, shard, slot, home).

    size: UTF-8 bytes of the text plus 1; ``slot`` counts the rows of a shard from 0 without
    gaps; ``home`` is the shard the ring alone would give, so ``shard <> home`` marks the
    rows that moved on.  Null texts have size 1 and the crc32 of the empty text, null keys
    share one place on the ring.  Rows that repeat a key, or are equal, each get a slot of
    their own.  Ties are broken by key, size and crc32.  An empty table gives an empty
    table; other columns are ignored.
    """
    points = ring(shards, nodes)
    places = [p for p, _ in points]
    width = RING // SLOTS
    first = [sum(p < i * width for p in places) for i in range(SLOTS + 1)]
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 8)
    rows = (docs.select(
        F.col(key).alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.conv(digits, 16, 10).cast("long").alias("at"))
        .withColumn("cut", (F.col("at") / width).cast("int"))
        .withColumn("low", F.get(F.lit(first), F.col("cut"))))
    before = F.slice(F.lit(places), F.col("low") + 1, F.get(F.lit(first), F.col("cut") + 1) - F.col("low"))
    arc = (F.col("low") + F.size(F.filter(before, lambda p: p < F.col("at")))) % len(points)
    rows = rows.withColumn("arc", arc.cast("int"))
    # equal rows are counted before they are shuffled: one key may be a third of the table
    rows = stage(rows.groupBy("arc", "at", "doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")), "ring")
    counts = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.sum("copies").alias("n")).collect()}
    table = docs.sparkSession.createDataFrame(
        settle(counts, points, shards), "arc int, shard int, from_rank long, taken long, first_slot long")

    slices = max(1, sum(counts.values()) // RANKED_ROWS)
    rows = rows.withColumn("slice", (F.col("at") / (RING / slices)).cast("int"))
    sums = rows.groupBy("arc", "slice").agg(F.sum("copies").alias("n"))
    along = Window.partitionBy("arc").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("arc", "slice", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("arc", "slice").orderBy("at", "doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (rows.withColumn("skip", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
              .join(base, ["arc", "slice"])
              .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1,
                                                F.lit(COPIES).cast("long"))).alias("chunk")))
    ranked = ranked.select(
        "doc_id", "size", "text_crc32", "arc",
        F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + COPIES, F.col("copies")) - 1)).alias("copy"),
        (F.col("base") + F.col("skip")).alias("start")).withColumn("rank", F.col("start") + F.col("copy"))
    r, t = ranked.alias("r"), F.broadcast(table).alias("t")     # shards * nodes * shards rows at most
    return (r.join(t, (F.col("r.arc") == F.col("t.arc")) & (F.col("rank") >= F.col("from_rank"))
                   & (F.col("rank") < F.col("from_rank") + F.col("taken")))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("from_rank")).alias("slot"),
                    F.get(F.lit([s for _, s in points]), F.col("r.arc")).alias("home")))
