"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence has a score, the logistic function of a sum over
its hashed features; a document is toxic if any of its sentences is, so its score is the
noisy-or ``1 - prod(1 - p)``.  Only documents are labelled: the gradient of the document's
log-likelihood is shared out over its sentences, which is how the model finds the offending
ones.  Scoring reads every whole text and needs no shuffle.

The model is fitted on at most ``SAMPLE`` labelled documents (about half of them of either
label, chosen by a hash of the id); the bound is a parameter.  Words are reduced to one hashed
feature for the word and one for each prefix of 3 to 5 letters, so that inflected forms share
what was learned.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import stage

SAMPLE = 3000
BITS = 20
EPOCHS = 120
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5)
WORDS_KEPT = 200_000       # words whose features a worker remembers
DECISION = 0.7


def sentences(text: str) -> list[tuple[int, int]]:
    """(begin, end) of the sentences of a text; a text without any is one empty sentence."""
    return [m.span() for m in SENTENCE.finditer(text)] or [(0, 0)]


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-cased word."""
    import xxhash

    forms = [f"w {word}"] + [f"p {word[:n]}" for n in PREFIXES if len(word) > n]
    return [xxhash.xxh64_intdigest(f) & ((1 << BITS) - 1) for f in forms]


class Fitted:
    """Weights by feature and the bias of a sentence."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
            found = self.known[word] = float(sum(self.weights[f] for f in word_features(word)))
        return found

    def sentence(self, words) -> float:
        return self.bias + sum(map(self.word, set(words)))

    def sentence_scores(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        spans = sentences(text)
        lower = text.lower()
        if len(lower) == len(text):         # places are the same: lower-cased at once
            z = np.array([self.sentence(WORD.findall(lower, a, b)) for a, b in spans])
        else:
            z = np.array([self.sentence(w.lower() for w in WORD.findall(text, a, b)) for a, b in spans])
        return spans, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: str) -> float:
        """Noisy-or of the sentences."""
        return float(1 - np.exp(np.log1p(-np.minimum(self.sentence_scores(text)[1], 1 - 1e-12)).sum()))


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = 0.3,
        sparse: float = 1e-3, least: int = 8) -> Fitted:
    """Full-batch AdaGrad on the noisy-or log-likelihood, with an L1 penalty."""
    vocabulary: dict[int, int] = {}
    features, owner, bag = [], [], []
    count = 0
    for b, text in enumerate(texts):
        text = text or ""
        mine: list[int] = []
        places: list[int] = []
        for m in SENTENCE.finditer(text) if text.strip() else ():
            for word in WORD.findall(text, *m.span()):
                for f in word_features(word.lower()):
                    mine.append(vocabulary.setdefault(f, len(vocabulary)))
                    places.append(count)
            bag.append(b)
            count += 1
        features.append(np.array(mine, np.int32))
        owner.append(np.array(places, np.int32))
    if not count or len(set(labels)) < 2:
        return Fitted(np.zeros(1 << BITS, np.float32), -4.0)
    features, owner, bag = np.concatenate(features), np.concatenate(owner), np.array(bag, np.int64)
    # only features of several documents can be learned; each counts once in a sentence
    pairs = np.unique(features.astype(np.int64) * len(labels) + bag[owner])
    common = np.bincount(pairs // len(labels), minlength=len(vocabulary)) >= least
    use = np.unique(owner.astype(np.int64) * len(vocabulary) + features)
    owner, features = use // len(vocabulary), use % len(vocabulary)
    owner, features = owner[common[features]], features[common[features]]
    y = np.array(labels, float)
    w, bias = np.zeros(len(vocabulary)), -4.0
    seen, seen_bias = np.full(len(w), 1e-8), 1e-8
    balance = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    for _ in range(epochs):
        z = bias + np.bincount(owner, w[features], minlength=count)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_clean = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        doc = np.clip(1 - np.exp(log_clean), 1e-9, 1 - 1e-9)
        # d log-likelihood / dz of a sentence: p for clean documents, -p (1 - P) / P for toxic ones
        per_bag = balance * np.where(y > 0, -(1 - doc) / doc, 1.0)
        g = per_bag[bag] * p
        gw = np.bincount(features, g[owner], minlength=len(w))
        gb = g.sum()
        seen += gw * gw
        seen_bias += gb * gb
        step = rate / np.sqrt(seen)
        w -= step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)       # features that don't matter stay at 0
        bias -= rate * gb / np.sqrt(seen_bias)
    weights = np.zeros(1 << BITS, np.float32)
    weights[np.fromiter(vocabulary, np.int64, len(vocabulary))] = w
    return Fitted(weights, float(bias))


def train(docs: DataFrame, labels: DataFrame, learn, sample: int = SAMPLE) -> Fitted:
    """Fit on at most ``sample`` documents of ``docs`` (doc_id, text) whose label row meets ``learn``.

    Rows with a null label or id are left out; a doc_id that is labelled twice counts once,
    with its higher label.
    """
    known = (labels.where(learn).where("toxic is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {int(r["toxic"]): r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, 0.9 * sample / 2 / n) for k, n in sizes.items()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    want = F.coalesce(*[F.when(F.col("toxic") == k, place < v) for k, v in share.items()], F.lit(False))
    if not share:
        return fit([], [])
    # ``sample`` rows at most are sent; of an id with several texts one is learned, the same in every run
    ids = stage(known.where(want).limit(sample), "sample")
    chosen = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
              .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    rows = sorted(chosen.collect(), key=lambda r: r["doc_id"])
    return fit([r["text"] for r in rows], [int(r["toxic"]) for r in rows])


def score(docs: DataFrame, model: Fitted, decision: float = DECISION) -> DataFrame:
    """One row per document: (doc_id, score, predicted, sentence_begin, sentence_end, sentence_score, offending).

    score: noisy-or of all sentences; predicted: 1 if it is ``decision`` or more; the next
    three columns locate the sentence with the highest score (code points); offending: an
    array of (begin, end, score) of every sentence whose own score is ``decision`` or more,
    in order.  Null and empty
    texts are one empty sentence.  Repeated rows are each scored; other columns are ignored.
    """
    import pyarrow as pa

    weights = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))    # 2**BITS numbers

    def run(batches):
        own = Fitted(*weights.value)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                spans, p = own.sentence_scores(text or "")
                whole = float(1 - np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))
                best = int(p.argmax())
                bad = [{"begin": spans[i][0], "end": spans[i][1], "score": float(p[i])}
                       for i in np.flatnonzero(p >= decision).tolist()]
                out.append((min(max(whole, 0.0), 1.0), int(whole >= decision), *spans[best], float(p[best]), bad))
            columns = list(zip(*out)) or [[]] * 6
            kinds = (pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(),
                     pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["doc_id", "score", "predicted", "sentence_begin", "sentence_end", "sentence_score", "offending"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, predicted int, sentence_begin long, sentence_end long, "
             "sentence_score double, offending array<struct<begin: long, end: long, score: double>>")
