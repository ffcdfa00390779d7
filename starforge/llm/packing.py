"""Packing of token sequences by multiway Karmarkar-Karp differencing.

Every document is cut into pieces of ``window`` ids; the last, shorter piece is what has to be
packed.  Rest pieces are dealt into groups of about ``GROUP`` and each group is packed in one
task: every rest begins as a partition with one used window; the two partitions with the
largest spread are merged, the fullest window of one with the emptiest of the other, until one
partition is left, whose windows are nearly equal.  If a window is over capacity, the group
gets more windows and starts again, so no window ever is.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import stage

WINDOW = 2048
GROUP = 512
END = 1

PIECES = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,
            offset long"""


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """The window (0 to k - 1) of each item, with near-equal sums (largest differencing method)."""
    if k == 1:
        return np.zeros(len(sizes), np.int64)
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, np.array([i]), np.array([0])))     # spread, tie, sums, items, their windows
    heapq.heapify(heap)
    tie = len(sizes)
    place = np.empty(k, np.int64)
    while len(heap) > 1:
        _, _, a, left, left_at = heapq.heappop(heap)
        _, _, b, right, right_at = heapq.heappop(heap)
        sums = a + b[::-1]                                   # descending with ascending
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        place[order] = np.arange(k)
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tie, sums, np.concatenate([left, right]),
                              np.concatenate([place[left_at], place[k - 1 - right_at]])))
        tie += 1
    _, _, _, items, at = heap[0]
    result = np.empty(len(sizes), np.int64)
    result[items] = at
    return result


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of items whose sums are at most ``capacity``; more windows are taken until all fit."""
    if not sizes:
        return []
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        at = differencing(sizes, k)
        most = int(np.bincount(at, sizes).max())
        if most <= capacity:
            order = np.argsort(at, kind="stable")
            return [w.tolist() for w in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)]
        k = max(k + 1, k * most // capacity)


def encoded(docs: DataFrame, tokenizer: str, end: int = END, window: int = WINDOW) -> DataFrame:
    """(row, doc_id, doc_tokens, crcs): the ids of every whole text with ``end``, as crc32 of each piece."""
    import pyarrow as pa

    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        from starforge.llm.tokens import encoder

        coder, row = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, counts, crcs = [], [], []
            for text in batch.column(1).to_pylist():
                raw = coder.ids(text or "") + tail
                rows.append(row)
                row += 1
                counts.append(len(raw) // 4)
                crcs.append([zlib.crc32(raw[i:i + 4 * window]) for i in range(0, len(raw), 4 * window)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column(0), pa.array(counts, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64()))], names=["row", "doc_id", "doc_tokens", "crcs"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "row long, doc_id long, doc_tokens long, crcs array<long>")


def pack_group(group, window: int):
    """The pieces of one group of documents (a pandas frame with the columns of ``encoded`` and ``grp``)."""
    import pandas as pd

    group = group.sort_values("row", kind="stable")
    tokens = group["doc_tokens"].to_numpy()
    full, rest = tokens // window, tokens % window
    short = np.flatnonzero(rest)
    base = int(group["grp"].iloc[0]) << 32
    out = []
    number = 0
    docs, crcs = group["doc_id"].tolist(), group["crcs"].tolist()
    for i in np.flatnonzero(full).tolist():
        for j in range(int(full[i])):
            out.append((docs[i], j * window, window, int(crcs[i][j]), int(tokens[i]), base + number, 0))
            number += 1
    for members in windows(rest[short].tolist(), window):
        offset = 0
        for m in members:
            i = int(short[m])
            size = int(rest[i])
            out.append((docs[i], int(full[i]) * window, size, int(crcs[i][-1]), int(tokens[i]),
                        base + number, offset))
            offset += size
        number += 1
    names = [c.split()[0] for c in PIECES.split(",")]
    return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})


def pack(docs: DataFrame, tokenizer: str, end: int = END, window: int = WINDOW) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is cut at multiples of ``window``; whole windows are sequences of their own,
    the rests share windows.  Null texts count as empty: one piece with the end id.  Null
    doc_ids and rows that repeat one are documents of their own.  An empty table gives an
    empty table; other columns are ignored.  Groups are dealt by row, not by doc_id or
    source, so a key that is a third of all rows does not fill one group.
    """
    coded = stage(encoded(docs, tokenizer, end, window), "pack")
    groups = max(1, round(coded.count() / GROUP))
    dealt = coded.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))

    def run(group):
        return pack_group(group, window)

    return dealt.groupBy("grp").applyInPandas(run, PIECES)
