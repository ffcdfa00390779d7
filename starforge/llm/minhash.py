"""Document fingerprints by MinHash, with near-duplicate classes.

A fingerprint is the minima of ``PERMUTATIONS`` universal hash functions (multiply-add-shift,
64 to 32 bits) over the hashes of all word 5-grams of a text, computed in numpy for many
documents at once.  Signature bands are joined in Spark; candidates are verified by the exact
Jaccard similarity of their 5-gram sets.

Words are runs of non-white-space with A-Z in lower case.  A text of fewer than 5 words has one
shingle, an empty text none: its fingerprint is all ones and is like another empty one only.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import checked_small, shuffle_partitions, stage
from starforge.llm.components import bucket_components

PERMUTATIONS = 120
BANDS, ROWS = 24, 5          # recall over 0.9999 at a similarity of 0.8
SHINGLE = 5
THRESHOLD = 0.8
CHUNK = 1 << 16              # shingles that are hashed together

EMPTY = np.uint32(0xFFFFFFFF)


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the hash functions, from a fixed rule."""
    rng = np.random.default_rng(1)
    return (rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, n, dtype=np.uint64))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's word shingles, repeats included."""
    import xxhash

    words = text.encode("utf-8").lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(7)), np.uint64, len(words))
    n = max(1, len(h) - size + 1) if len(h) else 0
    out = np.zeros(n, np.uint64)
    for i in range(min(size, len(h))):
        out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def signatures(sets: list[np.ndarray], n: int = PERMUTATIONS) -> np.ndarray:
    """(documents, n) minima; documents without shingles have all ones."""
    a, b = _functions(n)
    result = np.full((len(sets), n), EMPTY, np.uint32)
    todo = [i for i, s in enumerate(sets) if len(s)]
    while todo:
        some, size = [], 0
        while todo and (not some or size + len(sets[todo[-1]]) <= CHUNK):
            some.append(todo.pop())
            size += len(sets[some[-1]])
        x = np.concatenate([sets[i] for i in some])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in some])[:-1]])
        for j in range(n):
            result[some, j] = np.minimum.reduceat(x * a[j] + b[j], starts) >> np.uint64(32)
    return result


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(axis=1)


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by the first as many code points of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


_COLUMNS = """doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary,
              near_edited double, near_next double, set_key binary, edge int, part int, text string"""


def set_key(shingles_of: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    return hashlib.sha256(np.unique(shingles_of).tobytes()).digest()[:16]


def _rows(part: int, docs: list[tuple], after: list[tuple], edge: int = 0):
    """Arrow batch of the results of consecutive (doc_id, text), each with the one that follows."""
    import pyarrow as pa

    texts, nexts = [t for _, t in docs], [t for _, t in after]
    new = [edited(t, n) for t, n in zip(texts, nexts)]
    sets = [shingles(t) for t in texts + nexts[-1:]]
    own = signatures(sets)
    other = signatures([shingles(t) for t in new])
    following = np.concatenate([own[1:len(texts)], own[-1:]])
    mine = own[:len(texts)]
    n = len(docs)
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in docs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in new]),
         pa.array([r.tobytes() for r in mine], pa.binary()), pa.array([r.tobytes() for r in other], pa.binary()),
         pa.array(likeness(mine, other)), pa.array(likeness(mine, following)),
         pa.array([set_key(x) for x in sets[:n]], pa.binary()),
         pa.array([edge] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([None] * n, pa.string())],
        names=[c.split()[0] for c in _COLUMNS.split(",")])


def _edge(part: int, kind: int, doc: tuple):
    """A row that hands a partition's first (1) or last (2) document on, to be matched afterwards."""
    import pyarrow as pa

    values = [[doc[0]], [0], [""], [b""], [b""], [0.0], [0.0], [b""], [kind], [part], [doc[1]]]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(),
             pa.binary(), pa.int32(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)],
                                      names=[c.split()[0] for c in _COLUMNS.split(",")])


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edit with the next document by descending doc_id.

    Documents are range-partitioned and sorted by descending doc_id (nulls last, rows that
    repeat a doc_id by a hash of their text, so that they need not be in one task); their
    texts are compressed on the way.  The last document of a partition is followed by the
    first of the next partition that has any, and the last of all by the first of all: these
    pairs, one per partition, are joined afterwards.  The result is read from written tables.
    """
    def squeeze(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.slice(at, 1000)
                packed = [press(t.encode("utf-8")) if t else b"" for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(packed, pa.binary())],
                                                 names=["doc_id", "tie", "packed"])

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        opened = zstandard.ZstdDecompressor().decompress
        part, held, seen = TaskContext.get().partitionId(), None, False
        for batch in batches:
            for at in range(0, len(batch), 200):
                some = batch.slice(at, 200)
                rows = [(k, opened(z).decode("utf-8") if z else "")
                        for k, z in zip(some.column(0).to_pylist(), some.column(2).to_pylist())]
                if not seen:
                    yield _edge(part, 1, rows[0])
                    seen = True
                rows = ([held] if held is not None else []) + rows
                held = rows[-1]
                if len(rows) > 1:
                    yield _rows(part, rows[:-1], rows[1:])
        if held is not None:
            yield _edge(part, 2, held)

    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    spread = (docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
              .mapInArrow(squeeze, "doc_id long, tie long, packed binary")
              .repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order))
    first = stage(spread.mapInArrow(run, _COLUMNS), "minhash")
    ends = first.where("edge > 0")
    parts = sorted(r["part"] for r in ends.where("edge = 1").select("part").collect())     # one per partition
    if not parts:
        return first.drop("edge", "part", "text")
    following = {p: parts[(i + 1) % len(parts)] for i, p in enumerate(parts)}
    table = docs.sparkSession.createDataFrame(list(following.items()), "part int, then int")
    pairs = (ends.where("edge = 2").select("part", "doc_id", "text").join(F.broadcast(table), "part")
             .join(ends.where("edge = 1").select(F.col("part").alias("then"), F.col("text").alias("after")), "then")
             .select("part", "doc_id", "text", "after"))

    def finish(batches):
        for batch in batches:
            part, keys, texts, after = (batch.column(i).to_pylist() for i in range(4))
            for row in zip(part, keys, texts, after):
                yield _rows(row[0], [(row[1], row[2])], [(None, row[3])])

    last = stage(pairs.mapInArrow(finish, _COLUMNS), "minhash")
    return first.where("edge = 0").union(last).drop("edge", "part", "text")


def classes(docs: DataFrame, signed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(set_key, class_id) of the sets of documents with a near-duplicate; class_id is the smallest
    doc_id of the component.

    ``signed``: (doc_id, fingerprint, set_key), from written tables.  Documents with one set of
    shingles are one node, so nothing is merged that was not compared; a node's number is
    given when the nodes are written.
    """
    width = 4 * ROWS
    keys = [F.xxhash64(F.lit(b), F.substring("fp", b * width + 1, width)) for b in range(BANDS)]
    nodes = (signed.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"),
                                           F.first("fingerprint").alias("fp"))
             .select(F.monotonically_increasing_id().alias("node"), "set_key", "first", "n", F.array(*keys).alias("keys")))
    nodes = stage(nodes, "minhash")
    members = nodes.select(F.explode("keys").alias("key"), "node")

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            found = [np.unique(shingles(t or "")) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(x) for x in found], pa.binary()), pa.array([len(x) for x in found], pa.int32()),
                 pa.array([x.tobytes() for x in found], pa.binary())], names=["set_key", "size", "body"])

    def bodies(ids: DataFrame) -> DataFrame:
        wanted = stage(nodes.select("node", "set_key", "first").join(ids, "node", "left_semi"), "minhash")
        # the rows of the smallest doc_id of each set; an id that is repeated brings other sets too
        named = docs.select("doc_id", "text").join(
            checked_small(stage(wanted.select(F.col("first").alias("doc_id")).distinct(), "minhash")), "doc_id", "left_semi")
        texts = named.select("text").union(docs.where("doc_id is null").select("text"))
        found = texts.mapInArrow(sets, "set_key binary, size int, body binary")
        return (found.join(checked_small(wanted.select("node", "set_key")), "set_key").select("node", "size", "body")
                .dropDuplicates(["node"]))

    def elements(found: DataFrame) -> DataFrame:
        def short(batches):
            import pyarrow as pa

            for batch in batches:
                own = [(np.frombuffer(x, np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                       for x in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32()))],
                                                 names=["node", "size", "elements"])
        return found.select("node", "size", "body").mapInArrow(short, "node long, size int, elements array<int>")

    def alike(pairs: DataFrame) -> DataFrame:
        def compare(batches):
            import pyarrow as pa

            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(common >= threshold * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                                 names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        return pairs.mapInArrow(compare, "a long, b long")

    found = stage(bucket_components(members, bodies, alike, elements, threshold), "minhash")
    named = nodes.select("node", "set_key", "first", "n").join(found, "node", "left").where("n > 1 or component is not null")
    smallest = (named.groupBy(F.coalesce("component", "node").alias("component"))
                .agg(F.min("first").alias("class_id")))
    return (named.withColumn("component", F.coalesce("component", "node")).join(smallest, "component")
            .select("set_key", "class_id"))


def fingerprints(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the columns of ``with_edits`` (fingerprints in hex) and class_id.

    Null texts count as empty.  Equal texts have equal fingerprints; documents without a
    near-duplicate are a class of their own.  Rows that repeat a doc_id are each returned
    with the class of their own text, and are followed by each other.  A null doc_id is a
    document like any other, but names no class.  An empty table gives an empty table;
    other columns are ignored.
    """
    signed = with_edits(docs)
    found = stage(classes(docs, signed.select("doc_id", "fingerprint", "set_key"), threshold), "minhash")
    return (signed.join(checked_small(found), "set_key", "left")
            .select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
                    F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
                    F.coalesce("class_id", "doc_id").alias("class_id")))
