"""Token ids in a binary format of byte or bit planes.

Ids are cut into blocks of ``BLOCK``; a block is transposed into planes (plane b holds byte b,
or bit b, of every id), and each plane is compressed with zstandard.  A segment holds whole
documents, at least ``SEGMENT`` ids of them if there are so many, and is one row of a Parquet
table: the ids of its documents, the chunk index (place, length, block and plane of each
compressed plane) and the planes themselves.  Parquet carries the bytes, so that any store
that Spark can write to will do and a lost task leaves no half-written file.

``shard`` numbers the range partitions of doc_id and ``segment`` the segments of a shard, so
(shard, segment, position) is ascending doc_id order.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starforge.llm.common import shuffle_partitions

BLOCK = 65_536
SEGMENT = 1 << 20
END = 2

SCHEMA = """shard int, segment int, first_id long, n_ids long, doc_ids array<long>, doc_lengths array<long>,
            unit string, block_ids array<int>, plane array<int>, at array<long>, length array<int>, planes binary"""


def split_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of one block, lowest first; planes of zeros are left empty."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        columns = [np.packbits(bits[:, b], bitorder="little") for b in range(32)]
    else:
        columns = [np.ascontiguousarray(raw[:, b]) for b in range(4)]
    return [c.tobytes() if c.any() else b"" for c in columns]


def join_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    """The ids of a block from its planes."""
    if unit == "bit":
        bits = np.zeros((n, 32), np.uint8)
        for b, plane in enumerate(planes):
            if plane:
                bits[:, b] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little")[:n]
        return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    raw = np.zeros((n, 4), np.uint8)
    for b, plane in enumerate(planes):
        if plane:
            raw[:, b] = np.frombuffer(plane, np.uint8)
    return raw.view("<u4").ravel()


def pack(ids: np.ndarray, unit: str, block: int = BLOCK) -> dict:
    """The chunk index and the compressed planes of a segment."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3)
    sizes, plane, at, length, body = [], [], [], [], bytearray()
    for i in range(0, len(ids), block):
        part = ids[i:i + block]
        for b, raw in enumerate(split_planes(part, unit)):
            chunk = squeeze.compress(raw) if raw else b""
            sizes.append(len(part))
            plane.append(b)
            at.append(len(body))
            length.append(len(chunk))
            body += chunk
    return {"unit": unit, "block_ids": sizes, "plane": plane, "at": at, "length": length, "planes": bytes(body)}


def unpack(row: dict) -> np.ndarray:
    """All ids of a segment."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    per_block = 32 if row["unit"] == "bit" else 4
    out = [np.zeros(0, "<u4")]
    for i in range(0, len(row["plane"]), per_block):
        chunks = [row["planes"][a:a + n] for a, n in
                  zip(row["at"][i:i + per_block], row["length"][i:i + per_block])]
        out.append(join_planes([expand.decompress(c) if c else b"" for c in chunks], row["block_ids"][i],
                               row["unit"]))
    return np.concatenate(out)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = END, unit: str = "byte",
              segment: int = SEGMENT) -> None:
    """Encode every whole text, append ``end`` to each document and write the segments to ``path``.

    Documents are range-partitioned by doc_id and sorted within a partition; nulls come
    first, rows that repeat a doc_id are ordered by their text.  Null texts count as empty
    and give the one id ``end``.  An empty table gives an empty file table.
    """
    import pyarrow as pa

    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        from starforge.llm.tokens import encoder

        shard, number, first = TaskContext.get().partitionId(), 0, 0
        coder = encoder(tokenizer)
        keys: list = []
        parts: list[bytes] = []
        size = 0

        def close():
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = {"shard": shard, "segment": number, "first_id": first, "n_ids": len(ids), "doc_ids": keys,
                   "doc_lengths": [len(p) // 4 for p in parts]} | pack(ids, unit)
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = coder.ids(text or "") + tail
                keys.append(key)
                parts.append(part)
                size += len(part) // 4
                if size >= segment:
                    yield close()
                    number, first, keys, parts, size = number + 1, first + size, [], [], 0
        if keys:
            yield close()

    arrow = _arrow(pa)
    spread = (docs.select("doc_id", "text")
              .repartitionByRange(shuffle_partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first())
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    spread.mapInArrow(run, SCHEMA).write.parquet(path)


def _arrow(pa):
    """SCHEMA as Arrow types."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SCHEMA.split(","))])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read from the files: (doc_id, start, n_tokens, ids_crc32, shard, segment).

    ``start`` counts the ids of all documents before it.  Segments are decoded where they
    are read; only the sizes of the shards, one row per partition, are summed up in one place.
    """
    import pyarrow as pa

    table = spark.read.schema(SCHEMA).parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                raw = unpack(row).tobytes()
                ends = np.cumsum(row["doc_lengths"], dtype=np.int64)
                starts = ends - np.asarray(row["doc_lengths"], np.int64)
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first_id"]),
                     pa.array(ends - starts), pa.array(sums, pa.int64()),
                     pa.array([row["shard"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "segment"])

    found = table.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, segment int")
    sizes = table.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (found.join(F.broadcast(base), "shard")      # one row per shard, that is per partition written
            .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32",
                    "shard", "segment"))
