"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

A text is a sequence of tokens: runs of letters, runs of digits, and runs of other marks.  Its
features are hashed n-grams of two kinds:

* words: 1- and 2-grams of the lower-cased tokens;
* shapes: 1- to 3-grams of what kind of token stands there (lower case, capitalised, upper case,
  digits, the first mark of a run), or that it repeats the token before it.  Shapes are what carries
  over to words that the sample does not hold.

A document is a sparse vector: per feature log(1 + times), scaled to length 1.  A score is the
logistic function of the sparse dot product with the weights; scoring reads every whole text
and needs no shuffle.

The weights are learned from at most ``SAMPLE`` labelled documents with at most ``LONGEST``
distinct features each (about half of them of either label, chosen by a hash of the id); both
bounds are parameters.  Follow-the-regularised-leader keeps, per feature, the sum of its
gradients and of their squares; the L1 penalty leaves features that do not matter at zero.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import stage

SAMPLE = 4000
LONGEST = 8192
BITS = 20
UPDATES = 16_000           # rows seen in training, all passes together, and at least
EPOCHS = 4                 # passes
DECISION = 0.3
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
TOKENS_KEPT = 400_000      # tokens that a worker remembers
REPEATS = 1                # shape of a token that equals the one before
MIX = np.uint64(0x9E3779B97F4A7C15)


class Tokens(dict):
    """Number of every token met; ``words`` and ``shapes`` hold its two hashes at that place."""

    def __init__(self):
        super().__init__()
        self.words, self.shapes = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)

    def __missing__(self, token: str) -> int:
        import xxhash

        if token[0].isalpha():
            kind = "A" if token.isupper() else "Aa" if token[0].isupper() else "a"
        else:
            kind = "9" if token[0].isdigit() else token[0]
        at = self[token] = len(self)
        if at == len(self.words):
            self.words, self.shapes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.words, self.shapes))
        self.words[at] = xxhash.xxh64_intdigest(token.lower())
        self.shapes[at] = xxhash.xxh64_intdigest("shape " + kind) | 2
        return at

    def hashes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The word hashes and the shape hashes of a text's tokens."""
        if len(self) > TOKENS_KEPT:
            self.clear()
        tokens = TOKEN.findall(text)
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return self.words[at], self.shapes[at]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes to feature numbers."""
    h = (h ^ (h >> np.uint64(31))) * MIX
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def vector(text: str, known: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers ascending, their values) of a text; none for a text without a token."""
    words, shapes = known.hashes(text)
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    shapes[1:][words[1:] == words[:-1]] = REPEATS
    two = shapes[:-1] * MIX + shapes[1:]
    features, times = np.unique(mixed(np.concatenate([
        words, words[:-1] * MIX + words[1:], shapes, two, two[:-1] * MIX + shapes[2:]])), return_counts=True)
    values = np.log1p(times)
    return features, (values / np.sqrt((values * values).sum())).astype(np.float32)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int | None = None, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 0.05, l2: float = 0.01) -> tuple[np.ndarray, float]:
    """(weights, bias) after ``epochs`` passes over the rows in an order fixed by their number.

    Either label has half of the weight, however many rows have it.  By default there are as
    many passes as ``EPOCHS`` and ``UPDATES`` ask for.  Without rows, or with one label only,
    all weights are 0 and the bias says the label (0.5 without rows).
    """
    if len(set(labels)) < 2:
        return np.zeros(1 << BITS, np.float32), 4.0 * (2 * labels[0] - 1) if labels else 0.0
    epochs = max(EPOCHS, -(-UPDATES // len(rows))) if epochs is None else epochs
    share = np.bincount(labels, minlength=2)
    weigh = len(labels) / (2 * share)
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)       # the last place is the bias
    order = np.random.default_rng(7)
    full = [(np.append(i, 1 << BITS), np.append(v, 1.0)) for i, v in rows]

    def leader(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for k in order.permutation(len(full)):
            at, x = full[k]
            w = leader(at)
            g = weigh[labels[k]] * (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - labels[k]) * x
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    weights = leader(np.arange((1 << BITS) + 1))
    return weights[:-1].astype(np.float32), float(weights[-1])


def vectors(docs: DataFrame) -> DataFrame:
    """``docs`` (label int, text string) as (label, features, values)."""
    import pyarrow as pa

    def run(batches):
        known = Tokens()
        for batch in batches:
            found = [vector(t or "", known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([i for i, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float32()))], names=["label", "features", "values"])

    return docs.select("label", "text").mapInArrow(run, "label int, features array<int>, values array<float>")


def train(docs: DataFrame, labels: DataFrame, learn, sample: int = SAMPLE,
          longest: int = LONGEST) -> tuple[np.ndarray, float]:
    """(weights, bias) from at most ``sample`` rows of ``docs`` (doc_id, text) whose label row meets ``learn``.

    Rows with a null label or id are left out.  A doc_id that is labelled twice has its higher
    label; one that has several texts is learned from one of them, the same in every run.
    """
    known = (labels.where(learn).where("quality is not null and doc_id is not null")
             .groupBy("doc_id").agg((F.max("quality") >= 1).cast("int").alias("label")))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return ftrl([], [])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(0.9 * sample / 2 / n)) for k, n in sizes.items()])
    chosen = stage(known.where(place < share).limit(sample), "sample")
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")     # ``sample`` rows at most
             .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    rows = vectors(texts).where(F.size("features").between(1, longest)).collect()
    rows = sorted((r["label"], r["features"], r["values"]) for r in rows)
    return ftrl([(np.array(i, np.int32), np.array(v, np.float32)) for _, i, v in rows], [r[0] for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], decision: float = DECISION) -> DataFrame:
    """One row per document: (doc_id, score, predicted, features).

    score: 0 to 1, higher where label 1 is likelier; predicted: 1 if it is ``decision`` or more;
    features: how many distinct n-grams the text has.  Null texts, and texts without a token,
    have the score of the bias alone.  Repeated rows are each scored; an empty table gives an
    empty table; other columns are ignored.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(model)      # 2**BITS numbers

    def run(batches):
        known = Tokens()
        weights, bias = sent.value
        for batch in batches:
            z, size = np.zeros(len(batch)), np.zeros(len(batch), np.int32)
            for k, text in enumerate(batch.column(1).to_pylist()):
                features, values = vector(text or "", known)
                z[k], size[k] = bias + np.dot(weights[features], values), len(features)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= decision).astype(np.int32)), pa.array(size)],
                names=["doc_id", "score", "predicted", "features"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, features int")
