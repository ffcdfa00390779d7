"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared in lower case with runs of white space as one space.  A passage of an item
of ``m`` bytes may differ by ``k = rate * m`` edits.

* Count filter: a region within ``k`` edits of the item shares at least ``m - q + 1 - k * q``
  of its byte q-grams with it, all on diagonals (place in the text minus place in the item)
  within ``k`` of each other.  Shared q-grams are counted in overlapping diagonal bands: bands
  are ``2 k + 1`` wide and start every ``k + 1`` diagonals, so one holds them all.
* Verification: the regions that meet the bound are aligned with the item by a banded edit
  distance whose ends in the text are free; those within ``k`` edits are kept.

``q`` is the largest of at most 8 for which the item's bound is positive.  Every byte of every
text is looked up; the index of the items is sent to the tasks, after its size was checked,
and built once per worker.

Repetitive texts and items would share q-grams everywhere.  A q-gram that an item holds more
than ``OFTEN`` times is not paired with its places; such an item, or one with more than
``BANDS_ALIGNED`` bands over the bound in one text, is aligned once over the whole stretch in
which it shares anything, in time linear in the text (``nearest``).
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.1
Q = 8                       # longest q-gram; shorter ones only for items too short for it
OFTEN = 8                   # times that an item may hold a q-gram whose places are looked up
BANDS_ALIGNED = 64          # bands of one item in one text that are aligned one by one
INDEX_BYTES = 16 << 20      # benchmark text that goes to every task; larger ones go in slices
FILTER_BITS = 22
BEFORE = b"\xff"            # stands before the start of a text; in no UTF-8 text

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8")


def budget(m: int, rate: float = RATE) -> tuple[int, int]:
    """(edits allowed, q-grams that must be shared) of an item of ``m`` bytes."""
    k = int(rate * m)
    q = gram_size(m, k)
    return k, max(1, m - q + 1 - k * q)


def gram_size(m: int, k: int) -> int:
    """The largest q up to ``Q`` with m - q + 1 - k q >= 1."""
    return max(1, min(Q, m // (k + 1)))


def qgrams(raw: bytes, q: int = Q) -> np.ndarray:
    """The ``q``-grams of all places as 64-bit numbers (q at most 8)."""
    n = len(raw) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if q < 8:
        raw += bytes(8 - q)
    every = np.ndarray((n,), "<u8", raw, strides=(1,))          # the 8 bytes from every place
    return every & np.uint64((1 << 8 * q) - 1)


def aligned(item: bytes, text: bytes, k: int) -> tuple[int, int]:
    """(edits, end): least edit distance of ``item`` to any substring of ``text`` that begins in
    its first ``2 k + 1`` bytes, and where it ends; edits over ``k`` are reported as k + 1.

    Row by row over the item; only the diagonals 0 to 4 k are kept.
    """
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(text, np.uint8)
    width = 4 * k + 1
    far = k + 1
    steps = np.arange(width)
    b = np.concatenate([b, np.zeros(len(a) + width, np.uint8)])
    limit = len(text)
    row = np.where(steps <= min(2 * k, limit), 0, far)            # row[d]: prefix of length i ends at text[i + d]
    for i in range(1, len(a) + 1):
        ends = i + steps
        new = row + (b[i - 1:i - 1 + width] != a[i - 1])           # match or change
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)               # byte of the item left out
        new[ends > limit] = far
        new = np.minimum(np.minimum.accumulate(new - steps) + steps, far)   # bytes put in
        new[ends > limit] = far
        row = new
        if row.min() > k:
            return far, 0
    best = int(row.argmin())
    return int(row[best]), len(a) + best


def nearest(item: bytes, text: bytes) -> tuple[int, int]:
    """(edits, end): least edit distance of ``item`` to any substring of ``text``, and its first end.

    The column of the edit matrix is kept as two bit vectors of the differences between
    neighbouring rows, as long as the item; one step per byte of the text.
    """
    m = len(item)
    full, last = (1 << m) - 1, 1 << (m - 1)
    at = [0] * 256
    for i, c in enumerate(item):
        at[c] |= 1 << i
    up, down, edits = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        match = at[c]
        v = match | down
        h = (((match & up) + up) ^ up) | match
        more, less = (down | ~(h | up)) & full, up & h
        if more & last:
            edits += 1
        elif less & last:
            edits -= 1
        more, less = (more << 1) & full, (less << 1) & full
        up, down = (less | ~(v | more)) & full, more & v
        if edits < best:
            best, end = edits, j
            if not best:
                break
    return best, end


class _Grams:
    """The q-grams of the items of one q, sorted, with a bit table in front; each once per item if it is
    held more than ``OFTEN`` times (place -1)."""

    def __init__(self, q: int, items: list[tuple[int, bytes]]):
        self.q = q
        grams, owners, places = [], [], []
        for i, raw in items:
            g = qgrams(raw, q)
            kinds, at, times = np.unique(g, return_inverse=True, return_counts=True)
            rare = np.flatnonzero(times[at] <= OFTEN)
            common = kinds[times > OFTEN]
            grams += [g[rare], common]
            owners.append(np.full(len(rare) + len(common), i, np.int32))
            places.append(np.concatenate([rare, np.full(len(common), -1)]).astype(np.int32))
        grams = np.concatenate(grams)
        order = np.argsort(grams, kind="stable")
        self.grams = grams[order]
        self.owners, self.places = np.concatenate(owners)[order], np.concatenate(places)[order]
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[self._slot(self.grams)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return ((grams * _MULTIPLIER) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def shared(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in the item or -1, place in the text) of every shared q-gram."""
        g = qgrams(raw, self.q)
        at = np.flatnonzero(self.table[self._slot(g)])
        lo = np.searchsorted(self.grams, g[at], "left")
        n = np.searchsorted(self.grams, g[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) \
            else np.zeros(0, np.int64)
        return self.owners[rows].astype(np.int64), self.places[rows].astype(np.int64), np.repeat(at, n)


class Index:
    """The items and their q-grams."""

    def __init__(self, items: list[tuple[int, bytes]], rate: float = RATE):
        self.items = [(key, raw) for key, raw in items if raw]
        self.bounds = [budget(len(raw), rate) for _, raw in self.items]
        self.least = np.array([least for _, least in self.bounds], np.int64)
        self.steps = np.array([k + 1 for k, _ in self.bounds], np.int64)
        self.short = [i for i, (k, _) in enumerate(self.bounds) if not k]       # found as exact text
        by_q: dict[int, list[tuple[int, bytes]]] = {}
        for i, (_, raw) in enumerate(self.items):
            if self.bounds[i][0]:
                by_q.setdefault(gram_size(len(raw), self.bounds[i][0]), []).append((i, raw))
        self.grams = [_Grams(q, some) for q, some in sorted(by_q.items())]

    def find(self, raw: bytes) -> list[tuple[int, int, int, int]]:
        """(item id, edits, begin, end) of the best region of each item that a normal text holds."""
        out = []
        for i in self.short:
            at = raw.find(self.items[i][1])
            if at >= 0:
                out.append((self.items[i][0], 0, at, at + len(self.items[i][1])))
        for grams in self.grams:
            out += self._near(raw, *grams.shared(raw))
        return out

    def _near(self, raw: bytes, owner: np.ndarray, place: np.ndarray, at: np.ndarray) -> list[tuple]:
        if not len(owner):
            return []
        best: dict[int, tuple] = {}
        for i in np.unique(owner[place < 0]).tolist():          # items with q-grams that repeat
            mine = owner == i
            self._stretches(raw, i, at[mine], best)
            owner, place, at = owner[~mine], place[~mine], at[~mine]
        # the bands of 2 k + 1 diagonals, or a little more, in which enough q-grams are shared: a
        # band is two neighbouring slices of k + 1
        wide = np.int64(1) << 32
        slices = owner * wide + np.floor_divide(at - place, self.steps[owner]) + (wide >> 1)
        order = np.argsort(slices, kind="stable")
        slices, owner, place, at = slices[order], owner[order], place[order], at[order]
        cells, counts = np.unique(np.concatenate([slices, slices - 1]), return_counts=True)
        enough = counts >= self.least[cells // wide]
        cells = cells[enough][np.argsort(-counts[enough], kind="stable")]
        many = np.bincount(cells // wide, minlength=len(self.items)) > BANDS_ALIGNED if len(cells) else []
        for i in np.flatnonzero(many).tolist():
            lo, hi = np.searchsorted(owner, [i, i + 1])         # slices are sorted by item first
            self._stretches(raw, i, at[lo:hi], best)
            cells = cells[cells // wide != i]
        for cell in cells.tolist():
            i, b = divmod(cell, int(wide))
            key, item = self.items[i]
            if i in best and best[i][1] == 0:
                continue
            # a q-gram of the item counts once, however often the band repeats it
            lo, hi = np.searchsorted(slices, [cell, cell + 2])
            if len(np.unique(place[lo:hi])) < self.least[i]:
                continue
            k = self.bounds[i][0]
            first = (b - int(wide >> 1)) * (k + 1) - k
            # a band may begin before the text: bytes that no UTF-8 text has stand there
            region = BEFORE * max(0, -first) + raw[max(0, first):max(0, first + len(item) + 5 * k + 2)]
            exact = region.find(item)
            if exact >= 0:
                best[i] = (key, 0, first + exact, first + exact + len(item))
                continue
            # all diagonals of an alignment lie within the first 2 k + 1 of one band
            edits, end = aligned(item, region[k:], k)
            if edits <= k and (i not in best or edits < best[i][1]):
                best[i] = (key, edits, max(0, first + k), max(0, first + k + end))
        return list(best.values())

    def _stretches(self, raw: bytes, i: int, at: np.ndarray, best: dict[int, tuple]) -> None:
        """Align item ``i`` over every stretch of the text in which it shares q-grams at ``at``."""
        key, item = self.items[i]
        k = self.bounds[i][0]
        reach = len(item) + k
        at = np.unique(at)
        cuts = np.flatnonzero(np.diff(at) > 2 * reach) + 1
        for some in np.split(at, cuts):
            begin, stop = max(0, int(some[0]) - reach), int(some[-1]) + reach + 1
            exact = raw.find(item, begin, stop)
            if exact >= 0:
                best[i] = (key, 0, exact, exact + len(item))
                return
            edits, end = nearest(item, raw[begin:stop])
            if edits <= k and (i not in best or edits < best[i][1]):
                best[i] = (key, edits, max(0, begin + end - len(item) - k), begin + end)


_built: dict[str, Index] = {}


def worker_index(token: str, items: list[tuple[int, bytes]], rate: float) -> Index:
    """The index of a slice of items, built once per Python worker; the last one is kept."""
    if token not in _built:
        _built.clear()
        _built[token] = Index(items, rate)
    return _built[token]


def _slices(benchmark: DataFrame, bound: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(1, -(-int(size) // bound))


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, bound: int = INDEX_BYTES) -> DataFrame:
    """One row per document and item found in it: (doc_id, item_id, edits, begin, end).

    begin and end are bytes of the text in lower case with single spaces.  The items go to
    every task in slices of at most about ``bound`` bytes of text, one pass over the
    documents each.  Null and empty texts and items are found nowhere.  Rows that repeat a
    document or an item are each reported.  Empty tables give an empty table; other columns
    are ignored.
    """
    import pyarrow as pa

    spark, n = docs.sparkSession, _slices(benchmark, bound)
    schema = "doc_id long, item_id long, edits int, begin long, end long"
    found = None
    for part in range(n):
        mine = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part)
        items = [(r["item_id"], normal(r["text"])) for r in mine.select("item_id", "text").collect()]
        sent = spark.sparkContext.broadcast(items)

        def run(batches, sent=sent, token=uuid.uuid4().hex):
            index = worker_index(token, sent.value, rate)
            for batch in batches:
                out = [(key, *hit) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                       for hit in index.find(normal(text))]
                columns = list(zip(*out)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                                 names=["doc_id", "item_id", "edits", "begin", "end"])

        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        found = one if found is None else found.unionByName(one)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents in which no item was found, all columns and rows kept.  Null doc_ids are kept
    where their own text is clean."""
    from starforge.llm.common import stage

    hit = stage(leaks(docs, benchmark, rate).select("doc_id").distinct(), "leaks")
    return docs.join(hit.where("doc_id is not null"), "doc_id", "left_anti")
