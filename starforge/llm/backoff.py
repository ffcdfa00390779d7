"""Language-model scores by stupid backoff, from n-gram tables joined to the documents' n-grams.

The units are the ids of a public tokenizer.  A token's score is the relative frequency of the
longest n-gram that ends with it and was seen in *another* document (its own counts are taken
off), times ``BACKOFF`` for each order given up; a token seen nowhere else counts as half an
occurrence.

Every task writes its documents in blocks of about ``BLOCK`` ids, and a block's n-grams are
counted before anything is shuffled, so a frequent n-gram is one entry per block.  The count table is
partitioned by a hash of the n-gram: a block's entries of one part are one row, as arrays
(sorted differences, compressed), because single rows would take several times the space of
the texts.  Each part is summed over the blocks and returns to each block what the other blocks
add to its entries, in the order in which it sent them and without the n-grams, which the
block has itself.  There the documents' scores are summed up.  Both the length
of a block and the n-grams of a part are bounded whatever the size of the corpus (a document
is never divided, so a longer one is a block of its own).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import shuffle_partitions, stage

ORDER = 3
BACKOFF = 0.4
ID_BITS = 20               # ids below 2 ** 20, three of them in a long
BLOCK = 1 << 21            # ids that a task counts together
PART = 1 << 23             # bytes of text per part of the count table


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """The n-grams that end at each place from n - 1 on, as longs (1 to 3 ids)."""
    out = np.zeros(max(0, len(ids) - n + 1), np.int64)
    for i in range(n):
        out = (out << ID_BITS) | ids[i:i + len(out)].astype(np.int64)
    return out


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of the count table that holds an n-gram."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Non-negative longs, byte plane after byte plane, compressed."""
    import zstandard

    if not len(values):
        return b""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    import zstandard

    if not raw:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted n-grams as their differences."""
    return pack(np.diff(keys, prepend=0))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw))


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of sorted n-grams by part, the parts that have any, and where each begins in that order."""
    part = _part(keys, parts)
    if parts <= 1 << 16:
        part = part.astype(np.uint16)                      # a stable sort of these is linear
    order = np.argsort(part, kind="stable")
    begins = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
    return order, part[order][begins].astype(np.int64), begins


def _ends_in_texts(sizes: np.ndarray, n: int) -> np.ndarray:
    """The places of a block, document after document, at which an n-gram of one document ends."""
    starts = np.cumsum(sizes) - sizes
    return np.flatnonzero(np.arange(int(sizes.sum())) - np.repeat(starts, sizes) >= n - 1)


def block_grams(ids: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """The n-grams of a block's documents by place of their end, none over the end of a document."""
    return grams(ids, n)[_ends_in_texts(sizes, n) - (n - 1)]


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of longs from 0; with room for their places they are sorted as values, which is faster."""
    room = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + room < 64:
        return np.sort(keys << room | np.arange(len(keys))) & ((1 << room) - 1)
    return np.argsort(keys, kind="stable")


def log_scores(ids: np.ndarray, sizes: np.ndarray, totals, n_tokens: int,
               order: int = ORDER, backoff: float = BACKOFF) -> np.ndarray:
    """The sum of the natural logarithms of the token scores of each of a block's documents.

    ``totals(n, kinds, own)``: the counts in the whole corpus, with this block, of its sorted
    distinct n-grams ``kinds``, which it holds ``own`` times.
    """
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    lost = np.arange(len(ids), dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
    np.minimum(lost, order - 1, out=lost)              # orders that a token of this place could lose
    score = below = rank = None
    for n in range(1, order + 1):                      # longer n-grams replace what shorter ones gave
        ends = _ends_in_texts(sizes, n)
        # an n-gram is the rank of what stands before its last id, and that id: the same order in fewer bits
        found = ids[ends].astype(np.int64)
        if n > 1:
            found |= rank[ends - 1].astype(np.int64) << ID_BITS
        by = _order(found)                             # equal n-grams stay in the order of their documents
        found, ends = found[by], ends[by]
        new = np.diff(found, prepend=-1) != 0
        del by, found
        begins = np.flatnonzero(new)
        kinds = grams(ids, n)[ends[begins] - (n - 1)]
        rank = np.zeros(len(ids), np.int32)
        rank[ends] = np.cumsum(new, dtype=np.int32) - 1
        counts = np.diff(begins, append=len(ends))
        owners = np.flatnonzero(new | (np.diff(doc[ends], prepend=-1) != 0))
        own = np.diff(owners, append=len(ends))        # occurrences in the document itself
        over = np.repeat(totals(n, kinds, counts), counts) - np.repeat(own, own)
        np.maximum(over, 0, out=over)
        del new, kinds, begins, counts, owners, own
        others = np.zeros(len(ids), np.int32 if len(over) == 0 or over.max() < 1 << 31 else np.int64)
        others[ends] = over
        if n == 1:
            score = np.maximum(others, 0.5)
            score /= np.maximum(n_tokens - sizes, 1)[doc]
            score = np.log(score, out=score) + np.log(backoff) * lost
        else:
            under = below[ends - 1]
            seen = np.flatnonzero((over > 0) & (under > 0))
            at = ends[seen]
            score[at] = np.log(over[seen] / under[seen]) + np.log(backoff) * (lost[at] - (n - 1))
        below = others
    return np.bincount(doc, score, minlength=len(sizes))


def scores(docs: DataFrame, tokenizer: str, order: int = ORDER, backoff: float = BACKOFF,
           block_ids: int = BLOCK) -> DataFrame:
    """One row per document: (doc_id, n_tokens, log_score, per_token).

    log_score is the sum over all tokens, per_token their mean.  Null, empty and tokenless
    texts have 0 tokens and scores 0.  Repeated rows and copies are documents of their own,
    and each is "another document" to the others.  An empty table gives an empty table;
    other columns are ignored.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // PART))

    def entries(block: int, ids: np.ndarray, sizes: np.ndarray):
        """The block's rows of the count table, one per part and length of n-gram."""
        for n in range(1, order + 1):
            keys, c = np.unique(block_grams(ids, sizes, n), return_counts=True)
            order_of, held, begins = _by_part(keys, parts)
            for part, at in zip(held.tolist(), np.split(order_of, begins[1:])):
                yield {"block": block, "part": part, "n": n, "grams": pack_keys(keys[at]), "counts": pack(c[at])}

    def write(block: int, keys: list, ids: list[np.ndarray]):
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([keys], pa.list_(pa.string())),
             pa.array([[len(x) for x in ids]], pa.list_(pa.int32())),
             pa.array([pack(np.concatenate(ids))], pa.binary())], names=["block", "doc_ids", "sizes", "ids"])

    def encode(batches):
        from pyspark import TaskContext

        from starforge.llm.tokens import encoder

        coder, block = encoder(tokenizer), TaskContext.get().partitionId() << 32
        keys, ids, length = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(coder.ids(text or ""), "<u4")
                if keys and length + len(new) > block_ids:
                    yield write(block, keys, ids)
                    keys, ids, length, block = [], [], 0, block + 1
                keys.append(None if key is None else str(key))        # a list with nulls would become floats
                ids.append(new)
                length += len(new)
        if keys:
            yield write(block, keys, ids)

    def count(batches):
        for batch in batches:
            for block, sizes, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for some in entries(block, unpack(raw), np.array(sizes, np.int64)):
                    yield pa.RecordBatch.from_pylist([some], schema=pa.schema(
                        [("block", pa.int64()), ("part", pa.int64()), ("n", pa.int32()),
                         ("grams", pa.binary()), ("counts", pa.binary())]))

    coded = stage(docs.select("doc_id", "text").mapInArrow(
        encode, "block long, doc_ids array<string>, sizes array<int>, ids binary"), "backoff")
    n_tokens = coded.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0

    def total(group):
        """What other blocks add to the entries of one part, a row per block that anything is added to."""
        import pandas as pd

        keys = [unpack_keys(x) for x in group["grams"]]
        own = np.concatenate([unpack(x) for x in group["counts"]])
        kinds, at = np.unique(np.concatenate(keys), return_inverse=True)
        added = np.bincount(at, own, minlength=len(kinds)).astype(np.int64)[at] - own
        out = []
        for block, more in zip(group["block"], np.split(added, np.cumsum([len(x) for x in keys])[:-1])):
            if more.any():
                out.append((block, group["n"].iloc[0], group["part"].iloc[0], pack(more)))
        return pd.DataFrame(out, columns=["block", "n", "part", "added"])

    shared = (coded.select("block", "sizes", "ids")
              .mapInArrow(count, "block long, part long, n int, grams binary, counts binary")
              .groupBy("part", "n").applyInPandas(total, "block long, n int, part long, added binary"))

    def score(group, added):
        import pandas as pd

        if not len(group):
            return pd.DataFrame(columns=["doc_id", "n_tokens", "log_score", "per_token"])
        keys_of, sizes = group["doc_ids"].iloc[0], np.array(group["sizes"].iloc[0], np.int64)

        def totals(n: int, kinds: np.ndarray, own: np.ndarray) -> np.ndarray:
            order_of, held, begins = _by_part(kinds, parts)
            slices = dict(zip(held.tolist(), np.split(order_of, begins[1:])))
            every, mine = own.astype(np.int64), added[added["n"] == n]
            for part, more in zip(mine["part"], mine["added"]):
                every[slices[part]] += unpack(more)
            return every

        logs = log_scores(unpack(group["ids"].iloc[0]), sizes, totals, int(n_tokens), order, backoff)
        return pd.DataFrame({"doc_id": pd.array([None if k is None else int(k) for k in keys_of], "Int64"),
                             "n_tokens": sizes, "log_score": logs, "per_token": logs / np.maximum(sizes, 1)})

    return (coded.groupBy("block").cogroup(shared.groupBy("block"))
            .applyInPandas(score, "doc_id long, n_tokens long, log_score double, per_token double"))
