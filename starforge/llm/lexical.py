"""Ranked lexical search over a K2-treap of the term-document grid.

Index: documents are read in blocks, wherever they lie.  The grid of a block has a row for each
of its terms (frequent terms first) and a column for each document (by doc_id); a cell that
holds the term has an impact, the part of the score that depends on the two.  The grid is cut
into square tiles as wide as the block, and every tile is a quadtree: a node covers a square of
rows and documents and stores the highest impact in it, as the difference from its parent's;
four bits tell which quarters hold anything; a square with one cell is not divided further.

Search: the terms of an item descend together over ranges of documents.  A range knows, for
each term, the node on the path of the term's row; the sum of weight times maximum is a bound
of every score in the range, and is the score where the range is one document.  The ranges
with the highest bounds are halved first, and ranges under the tenth best score are left.  So
the ten best documents are exact, ties by doc_id included.

The index is a table, one row a block, and holds every term of every document.  Searching it
takes the items in slices of bounded size, each against all blocks; a task keeps ten documents
an item over its blocks, and these are ranked once more by Spark.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import stage

BLOCK_DOCUMENTS = 1 << 14
BLOCK_CELLS = 1 << 20
SLICE_BYTES = 16 << 20
TOP = 10
WIDEST = 1024              # ranges halved at once
# ASCII letters and digits and all other bytes from 128 on belong to terms; A to Z are lower-cased
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
             for b in range(256))
COUNT = np.array([bin(m).count("1") for m in range(16)], np.int64)
BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)
INDEX = ("terms binary, df binary, documents array<long>, bits int, nodes array<int>, alone binary, "
         "mask binary, below binary, rest binary")


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, repeats included."""
    return text.encode().translate(FOLD).split()


def impact(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term that occurs ``tf`` times in a document of ``n`` terms adds, before its weight."""
    m = 100 - 90 + (90 * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of x (32 at most) moved to the even places."""
    x = x.astype(np.int64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << shift)) & keep
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    """The bits of x at the even places."""
    x = x & 0x5555555555555555
    for shift, keep in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF),
                        (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> shift)) & keep
    return x


def _pack(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(a.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def build(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, bits: int) -> dict:
    """The quadtrees of a grid of distinct cells; tiles are 2**bits wide.

    Level by level: ``nodes`` their number, ``alone`` whether a node holds one cell, ``mask``
    the quarters of the others, ``below`` how far a maximum is under the parent's (at the
    roots, the maximum), ``rest`` the place of a lone cell within its node.
    """
    code = (rows >> bits) << (2 * bits) | _spread(rows & ((1 << bits) - 1)) << 1 | _spread(columns)
    order = np.argsort(code)
    code, value = code[order], impacts[order]
    nodes, alone, masks, below, rest = [], [], [], [], []
    parent = None
    for level in range(bits + 1):
        shift = 2 * (bits - level)
        node = code >> shift
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, int)
        size = np.diff(np.append(first, len(node)))
        best = np.maximum.reduceat(value, first) if len(first) else value[:0]
        number = node[first]
        if level:
            above, places = number >> 2, (1 << (number & 3)).astype(np.uint8)
            begin = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(above) else first
            masks.append(np.bitwise_or.reduceat(places, begin) if len(begin) else places)
            below.append(np.repeat(parent, np.diff(np.append(begin, len(above)))) - best)
        else:
            below.append(best)
        single = size == 1
        nodes.append(len(first))
        alone.append(single)
        rest.append(code[first[single]] & ((1 << shift) - 1))
        parent = best[~single]
        inside = np.repeat(~single, size)
        code, value = code[inside], value[inside]
    return {"nodes": nodes, "alone": _pack(np.packbits(np.concatenate(alone))),
            "mask": _pack(np.concatenate(masks) if masks else np.zeros(0, np.uint8)),
            "below": _pack(np.concatenate(below).astype("<u4")), "rest": _pack(np.concatenate(rest).astype("<u4"))}


class Treap:
    """Quadtrees read back: of every node its maximum, and its children or its lone cell."""

    def __init__(self, bits: int, nodes: list[int], alone: bytes, mask: bytes, below: bytes, rest: bytes):
        self.bits = bits
        total = sum(nodes)
        single = np.unpackbits(_unpack(alone, np.uint8), count=total).astype(bool)
        masks, below, rest = _unpack(mask, np.uint8), _unpack(below, "<u4").astype(np.int64), _unpack(rest, "<u4")
        # one more node at the end: nothing there
        self.mask, self.child = np.zeros(total + 1, np.uint8), np.zeros(total + 1, np.int64)
        self.best = np.zeros(total + 1, np.int64)
        self.row, self.column = np.full(total + 1, -1), np.full(total + 1, -1)
        self.nothing = total
        at = mask_at = rest_at = 0
        code, parent_best = np.arange(nodes[0]), None
        for level, n in enumerate(nodes):
            lone = single[at:at + n]
            best = below[at:at + n] if parent_best is None else parent_best - below[at:at + n]
            self.best[at:at + n] = best
            many = np.flatnonzero(~lone)
            lone = np.flatnonzero(lone)
            place = code[lone] << (2 * (bits - level)) | rest[rest_at:rest_at + len(lone)]
            low = place & ((1 << (2 * bits)) - 1)
            self.row[at + lone] = (place >> (2 * bits)) << bits | _gather(low >> 1)
            self.column[at + lone] = _gather(low)
            own = masks[mask_at:mask_at + len(many)]
            children = COUNT[own]
            self.mask[at + many] = own
            self.child[at + many] = at + n + np.cumsum(children) - children
            quarters = np.nonzero(np.unpackbits(own[:, None], axis=1, bitorder="little")[:, :4])[1]
            code = np.repeat(code[many] * 4, children) + quarters
            parent_best = np.repeat(best[many], children)
            at, mask_at, rest_at = at + n, mask_at + len(many), rest_at + len(lone)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        """The node at which the path of each row begins; -1 is a row that isn't there."""
        return self._own(np.where(rows < 0, self.nothing, rows >> self.bits), rows)

    def _own(self, nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Nodes whose lone cell is of another row hold nothing."""
        return np.where((self.row[nodes] >= 0) & (self.row[nodes] != rows), self.nothing, nodes)

    def halves(self, nodes: np.ndarray, rows: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
        """The paths (ranges x rows) one level further down, in the lower and the upper half of the documents."""
        shift = (self.bits - 1 - level)[:, None]
        quarter = ((rows[None, :] >> shift) & 1) * 2
        mask, lone = self.mask[nodes], self.row[nodes] >= 0
        upper = (self.column[nodes] >> shift) & 1
        out = []
        for half in (0, 1):
            q = quarter + half
            down = np.where((mask >> q) & 1, self.child[nodes] + BEFORE[mask, q], self.nothing)
            out.append(self._own(np.where(lone & (upper == half), nodes, down), rows[None, :]))
        return out

    def search(self, rows: np.ndarray, weights: np.ndarray, top: int, floor: int = 1) -> list[tuple[int, int]]:
        """(score, column) of the ``top`` highest scores that reach ``floor``, best first, ties by column."""
        nodes = self.roots(rows)[None, :]
        bound = self.best[nodes] @ weights
        level, begin = np.zeros(1, np.int64), np.zeros(1, np.int64)
        found: list[tuple[int, int]] = []
        wide = 16
        while True:
            keep = bound >= floor
            if not keep.all():
                nodes, bound, level, begin = nodes[keep], bound[keep], level[keep], begin[keep]
            done = level == self.bits
            if done.any():
                found = sorted(found + list(zip((-bound[done]).tolist(), begin[done].tolist())))[:top]
                if len(found) == top:
                    floor = max(floor, -found[-1][0])
                done = ~done & (bound >= floor)
                nodes, bound, level, begin = nodes[done], bound[done], level[done], begin[done]
            if not len(bound):
                return [(-s, c) for s, c in found]
            if len(bound) > wide:
                first = np.argpartition(-bound, wide)
                now, later = first[:wide], first[wide:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, int)
            wide = min(2 * wide, WIDEST)
            low, high = self.halves(nodes[now], rows, level[now])
            width = 1 << (self.bits - 1 - level[now])
            parts = np.concatenate([low, high])
            nodes = np.concatenate([parts, nodes[later]])
            bound = np.concatenate([self.best[parts] @ weights, bound[later]])
            begin = np.concatenate([begin[now], begin[now] + width, begin[later]])
            level = np.concatenate([level[now] + 1, level[now] + 1, level[later]])


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all their terms with repeats)."""
    import pyarrow as pa

    inside = np.frombuffer(FOLD, np.uint8) != 32

    def run(batches):
        for batch in batches:
            documents = total = 0
            for text in batch.column(0).to_pylist():
                member = inside[np.frombuffer((text or "").encode(), np.uint8)]
                n = int(np.count_nonzero(member[1:] & ~member[:-1]) + member[0]) if len(member) else 0
                documents, total = documents + (n > 0), total + n
            yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([total])], names=["n", "total"])

    sums = docs.select("text").mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return sums[0] or 0, sums[1] or 0


class _Block:
    """Documents gathered until they make a block."""

    def __init__(self, most_documents: int, most_cells: int):
        self.most_documents, self.most_cells = most_documents, most_cells
        self.rows: dict[bytes, int] = {}
        self.ids, self.lengths, self.cells, self.size = [], [], [], 0

    def add(self, ids: list, texts: list) -> None:
        found = [terms(t or "") for t in texts]
        lengths = np.array([len(f) for f in found], np.int64)
        flat = [self.rows.setdefault(t, len(self.rows)) for f in found for t in f]
        code = np.repeat(np.arange(len(ids)) + len(self.ids), lengths) << 32 | np.array(flat, np.int64)
        cells, tf = np.unique(code, return_counts=True)
        self.cells.append((cells, tf))
        self.ids += ids
        self.lengths.append(lengths)
        self.size += len(cells)

    def full(self) -> bool:
        return self.size >= self.most_cells or len(self.ids) >= self.most_documents

    def row(self, documents: int, total: int) -> dict:
        """The block as a row of the index."""
        cells, tf = (np.concatenate(a) for a in zip(*self.cells))
        ids = np.array([(i is None, i or 0) for i in self.ids], np.int64).reshape(-1, 2)
        order = np.lexsort((ids[:, 1], ids[:, 0]))              # by id, nulls last
        column = np.empty_like(order)
        column[order] = np.arange(len(order))
        document, term = cells >> 32, cells & 0xFFFFFFFF
        df = np.bincount(term, minlength=len(self.rows))
        frequent = np.argsort(-df, kind="stable")
        row = np.empty_like(frequent)
        row[frequent] = np.arange(len(frequent))
        bits = max(1, int(len(ids) - 1).bit_length())
        grid = build(row[term], column[document], impact(tf, np.concatenate(self.lengths)[document], documents, total),
                     bits)
        names = list(self.rows)
        return {"terms": _pack(np.frombuffer(b" ".join(names[k] for k in frequent), np.uint8)),
                "df": _pack(df[frequent].astype("<u4")), "documents": [self.ids[k] for k in order], "bits": bits} | grid


def index(docs: DataFrame, documents: int, total: int, block_documents: int = BLOCK_DOCUMENTS,
          block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The index of every row of ``docs`` (doc_id, text), one row a block; see ``corpus_size`` for the numbers.

    A block ends with the 256 documents in which it reaches one of the two sizes.  Null and
    empty texts, and texts without a term, are in no cell.
    """
    import pyarrow as pa

    columns = INDEX.replace(",", "").split()[::2]
    kinds = pa.schema([("terms", pa.binary()), ("df", pa.binary()), ("documents", pa.list_(pa.int64())),
                       ("bits", pa.int32()), ("nodes", pa.list_(pa.int32())), ("alone", pa.binary()),
                       ("mask", pa.binary()), ("below", pa.binary()), ("rest", pa.binary())])

    def run(batches):
        block = _Block(block_documents, block_cells)
        step = min(256, block_documents)
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                block.add(part.column(0).to_pylist(), part.column(1).to_pylist())
                if block.full():
                    yield pa.RecordBatch.from_pylist([block.row(documents, total)], schema=kinds)
                    block = _Block(block_documents, block_cells)
        if block.size:
            yield pa.RecordBatch.from_pylist([block.row(documents, total)], schema=kinds)

    return docs.select("doc_id", "text").mapInArrow(run, INDEX).select(*columns)


def _names(data: bytes) -> list[bytes]:
    return _unpack(data, np.uint8).tobytes().split(b" ")


def document_frequencies(blocks: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each wanted term occurs."""
    import pyarrow as pa

    sent = blocks.sparkSession.sparkContext.broadcast(wanted)       # terms of one slice of items

    def run(batches):
        for batch in batches:
            for names, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hits = [(t, int(n)) for t, n in zip(_names(names), _unpack(df, "<u4")) if t in sent.value]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in hits], pa.binary()),
                                                  pa.array([n for _, n in hits], pa.int64())], names=["term", "n"])

    counted = blocks.select("terms", "df").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n"))
    return {bytes(t): n for t, n in counted.collect()}


def _search(blocks: DataFrame, items: list[tuple[int | None, set[bytes]]], documents: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): of each item the best documents of every task's blocks."""
    import pyarrow as pa

    df = document_frequencies(blocks, set().union(*[found for _, found in items]))
    queries = []
    for item, found in items:
        known = sorted(t for t in found if t in df)
        queries.append((item, known, np.array([weight(df[t], documents) for t in known], np.int64)))
    sent = blocks.sparkSession.sparkContext.broadcast(queries)      # one slice of items

    def run(batches):
        best: list[list[tuple]] = [[] for _ in sent.value]          # (-score, null id, doc_id), best first
        for batch in batches:
            for block in batch.to_pylist():
                place = {t: k for k, t in enumerate(_names(block["terms"]))}
                treap = Treap(*[block[c] for c in ("bits", "nodes", "alone", "mask", "below", "rest")])
                ids = block["documents"]
                for mine, (_, known, weights) in zip(best, sent.value):
                    here = [(place[t], w) for t, w in zip(known, weights) if t in place]
                    if not here:
                        continue
                    rows, w = np.array(here, np.int64).T
                    floor = -mine[-1][0] if len(mine) == top else 1
                    hits = [(-s, ids[c] is None, ids[c] or 0) for s, c in treap.search(rows, w, top, floor)]
                    mine[:] = sorted(mine + hits)[:top]
        out = [(item, None if null else doc, -s) for (item, _, _), mine in zip(sent.value, best) for s, null, doc in mine]
        columns = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return blocks.select("terms", "documents", "bits", "nodes", "alone", "mask", "below", "rest").mapInArrow(
        run, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, slice_bytes: int = SLICE_BYTES,
           block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item, highest score first.

    Equal scores are ranked by ascending doc_id, null ids last.  Rows of ``items`` (item_id,
    text) that share an id, null included, are one item with the terms of all of them; its
    terms count once each.  Items without a known term, and null texts, have no row; scores
    are above 0.  Rows that repeat a doc_id are documents of their own.  Without documents or
    items the table is empty; other columns are ignored.
    """
    documents, total = corpus_size(docs)
    texts = stage(items.select("item_id", "text").where("text is not null").distinct(), "items")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if not total or not size:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = stage(index(docs, documents, total, block_documents), "treap")
    slices = -(-size // slice_bytes)
    found = None
    for k in range(slices):
        grouped: dict[int | None, set[bytes]] = {}
        for r in texts.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k).collect():     # one slice
            grouped.setdefault(r["item_id"], set()).update(terms(r["text"]))
        asked = sorted(grouped.items(), key=lambda g: (g[0] is None, g[0] or 0))
        some = _search(blocks, asked, documents, top)
        found = some if found is None else found.union(some)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
