"""Language identification by a linear-chain conditional random field over words.

Every word gets a language; text that switches between languages is what the learned
transitions are for.  A word's emission is the sum of learned weights of its features: affixes
of 1 to 3 letters, letter 2- and 3-grams, and lexicon features (the word itself, where the
sample holds it several times).  Forward-backward gives each word's posterior; a document's
score for a language is the mean posterior of its words.

Words are labelled by their document's language for learning, from at most ``SAMPLE``
documents (the same number of each language, chosen by a hash of the id) and whole lines of
them; the bound is a parameter.  Prediction reads every whole text and needs no shuffle.
"""

from __future__ import annotations

import re
from itertools import chain as linked

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 1200
BITS = 18
EPOCHS = 40
WORD = re.compile(r"[^\W\d_]+")
LEXICON = 4                # times that the sample holds a word of the lexicon
WORDS_KEPT = 400_000       # words whose emissions a worker remembers
TOGETHER = 1024            # chains that run side by side, at most
TEXTS = 1 << 18            # characters of the texts that are labelled together
ROWS = 500                 # rows of a batch that are read at once
CELLS = 1 << 17            # places (chains times words of the longest) that they have together
UNKNOWN = "und"


class _Slots(dict):
    """Hashed slots of the short letter groups of one kind, remembered."""

    def __init__(self, kind: str):
        super().__init__()
        self.kind = kind

    def __missing__(self, group: str) -> int:
        import xxhash

        slot = self[group] = xxhash.xxh64_intdigest(f"{self.kind} {group}") & ((1 << BITS) - 1)
        return slot


class _Ends(dict):
    """The slots of the 1, 2 and 3 letters at one end of a word, by those three."""

    def __init__(self, kind: str, cut):
        super().__init__()
        self.slots, self.cut = _Slots(kind), cut

    def __missing__(self, end: str) -> list[int]:
        slots = self[end] = [self.slots[group] for group in {self.cut(end, n) for n in (1, 2, 3)}]
        return slots


_heads, _tails, _grams = _Ends("a", lambda x, n: x[:n]), _Ends("z", lambda x, n: x[-n:]), _Slots("g")


def word_features(word: str) -> list[int]:
    """Hashed affix and n-gram features of a lower-cased word, and last its lexicon feature."""
    import xxhash

    n = len(word)
    groups = {word[i:i + 2] for i in range(n - 1)} | {word[i:i + 3] for i in range(n - 2)}
    return [*_heads[word[:3]], *_tails[word[-3:]], *map(_grams.__getitem__, groups),
            xxhash.xxh64_intdigest(f"w {word}") & ((1 << BITS) - 1)]


def has_letter(word: str) -> bool:
    """Numerals such as fractions and superscripts belong to words, but are no letters."""
    return word.isalpha() or any(map(str.isalpha, word))


def places(text: str) -> list[list[tuple[int, int]]]:
    """(begin, end) of the words of each line that has any; a line is a chain, however long."""
    out, at = [], 0
    for line in text.split("\n"):
        found = [(at + m.start(), at + m.end()) for m in WORD.finditer(line) if has_letter(m[0])]
        if found:
            out.append(found)
        at += len(line) + 1
    return out


def chains(text: str) -> list[list[str]]:
    """The lower-cased words of each line that has any."""
    out = []
    for line in text.lower().split("\n"):
        words = WORD.findall(line)
        if words and not "".join(words).isalpha():
            words = [w for w in words if has_letter(w)]
        if words:
            out.append(words)
    return out


def posteriors(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray, begin: np.ndarray,
               counts: bool = False):
    """Forward-backward over many chains side by side.

    ``emissions``: (words, labels) log-scores, chain after chain.  Returns the (words, labels)
    posteriors, the log-likelihood denominator and, if asked, the expected number of moves.
    """
    labels = emissions.shape[1]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    result = np.empty_like(emissions)
    scores = np.ascontiguousarray(emissions.T)
    top = scores.max(axis=0)
    scores = np.exp(scores - top)
    step, first = np.exp(moves), np.exp(begin)[:, None]
    back = np.ascontiguousarray(step.T)
    total = float(top.sum())
    expected = np.zeros((labels, labels))
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        # long chains run with few others: what is kept of them is their length times their number
        some = order[at:at + min(TOGETHER, max(1, CELLS // max(1, int(lengths[order[at]]))))]
        at += len(some)
        n = lengths[some]                                      # descending
        longest = int(n[0])
        alive = np.searchsorted(-n, -np.arange(longest), "left")   # chains longer than t
        # the words of all chains at one place are neighbours: step t is a slice
        ends = np.cumsum(alive)
        cuts = list(zip((ends - alive).tolist(), ends.tolist(), alive.tolist()))
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        words = np.empty(len(place), np.int64)
        words[(ends - alive)[place] + np.repeat(np.arange(len(some)), n)] = np.repeat(starts[some], n) + place
        own = scores[:, words]
        alpha, norm = np.empty_like(own), np.empty(len(words))
        before = 0
        for x, y, m in cuts:
            a = (back @ alpha[:, before:before + m] if x else first) * own[:, x:y]
            z = a.sum(axis=0)
            np.divide(a, z, out=alpha[:, x:y])
            norm[x:y] = z
            before = x
        total += float(np.log(norm).sum())
        own /= norm
        beta = np.ones((labels, len(some)))
        for t in range(longest - 1, -1, -1):
            x, y, m = cuts[t]
            if t:
                right = own[:, x:y] * beta[:, :m]
                before = cuts[t - 1][0]
                if counts:
                    expected += step * (alpha[:, before:before + m] @ right.T)
            alpha[:, x:y] *= beta[:, :m]
            if t:
                beta[:, :m] = step @ right
        alpha /= alpha.sum(axis=0)
        result[words] = alpha.T
    return (result, total, expected) if counts else (result, total)


class Fitted:
    """Labels, hashed feature weights, moves between labels and first labels."""

    def __init__(self, labels: list[str], weights: np.ndarray, moves: np.ndarray, begin: np.ndarray):
        self.labels, self.weights, self.moves, self.begin = labels, weights, moves, begin
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(labels)))

    def emission_rows(self, words: list[str]) -> np.ndarray:
        """Row numbers in ``rows`` of the words' emissions."""
        new = set(words).difference(self.known)
        if len(new) + len(self.known) > WORDS_KEPT:
            self.known.clear()
            new = set(words)
        new, at = list(new), len(self.known)
        while at + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for i in range(0, len(new), TOGETHER):
            lists = [word_features(word) for word in new[i:i + TOGETHER]]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            for size in np.unique(sizes).tolist():     # lists of one length, so that each is summed in its order
                of = np.flatnonzero(sizes == size)
                features = np.fromiter(linked.from_iterable(lists[j] for j in of), np.int64, size * len(of))
                self.rows[at + i + of] = self.weights[features.reshape(-1, size)].sum(axis=1)
        self.known.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, mean posterior of its words) of each text; ``und`` where there is no letter."""
        lengths, words, owner = [], [], []
        for i, text in enumerate(texts):
            for chain in chains(text):
                lengths.append(len(chain))
                owner.append(i)
                words += chain
        if not words or not self.labels:
            return [(UNKNOWN, 0.0)] * len(texts)
        sizes = np.array(lengths, np.int64)
        at = self.emission_rows(words)
        p, _ = posteriors(self.rows[at], sizes, self.moves, self.begin)
        of = np.repeat(np.array(owner, np.int64), sizes)
        n = np.bincount(of, minlength=len(texts))
        mean = np.stack([np.bincount(of, p[:, j], minlength=len(texts)) for j in range(len(self.labels))], 1)
        mean /= np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)
        return [(self.labels[b], float(min(1.0, mean[i, b]))) if n[i] else (UNKNOWN, 0.0)
                for i, b in enumerate(best.tolist())]


    def runs(self, text: str) -> list[tuple[int, int, str, float]]:
        """(begin, end, language, mean posterior) of each run of words of a line with one label."""
        lines = places(text)
        if not lines or not self.labels:
            return []
        at = self.emission_rows([text[a:b].lower() for line in lines for a, b in line])
        p, _ = posteriors(self.rows[at], np.array([len(line) for line in lines], np.int64), self.moves, self.begin)
        best, out, i = p.argmax(axis=1), [], 0
        for line in lines:
            own = best[i:i + len(line)]
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(line)]
            for x, y in zip(cuts, cuts[1:]):
                label = int(own[x])
                out.append((line[x][0], line[y - 1][1], self.labels[label], float(p[i + x:i + y, label].mean())))
            i += len(line)
        return out


def fit(texts: list[str], langs: list[str], epochs: int = EPOCHS, rate: float = 0.5) -> Fitted:
    """Full-batch AdaGrad on the conditional log-likelihood of the words' languages."""
    labels = sorted(set(langs))
    words, lengths, gold = [], [], []
    for text, lang in zip(texts, langs):
        for chain in chains(text or ""):
            words += chain
            lengths.append(len(chain))
            gold += [labels.index(lang)] * len(chain)
    k = len(labels)
    weights, moves, begin = np.zeros((1 << BITS, k)), np.zeros((k, k)), np.zeros(k)
    if not words or k < 2:
        return Fitted(labels, weights, moves, begin)
    kinds: dict[str, int] = {}
    kind = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words))
    times = np.bincount(kind)
    lists = [word_features(w)[:None if times[i] >= LEXICON else -1] for w, i in kinds.items()]
    who = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    columns, what = np.unique(np.concatenate([np.array(x, np.int64) for x in lists]), return_inverse=True)
    gold, sizes = np.array(gold, np.int64), np.array(lengths, np.int64)
    n = len(words)
    w, gw2, gm2, gb2 = np.zeros((len(columns), k)), 1e-8, 1e-8, 1e-8
    truth = np.stack([np.bincount(kind, gold == j, minlength=len(lists)) for j in range(k)], 1)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    follows = np.ones(n, bool)
    follows[heads] = False
    true_moves = np.zeros((k, k))
    np.add.at(true_moves, (gold[np.flatnonzero(follows) - 1], gold[follows]), 1)
    true_heads = np.bincount(gold[heads], minlength=k)
    for _ in range(epochs):
        table = np.stack([np.bincount(who, w[what, j], minlength=len(lists)) for j in range(k)], 1)
        p, _, expected = posteriors(table[kind], sizes, moves, begin, counts=True)
        off = np.stack([np.bincount(kind, p[:, j], minlength=len(lists)) for j in range(k)], 1) - truth
        g = np.stack([np.bincount(what, off[who, j], minlength=len(columns)) for j in range(k)], 1) / n + 1e-7 * w
        gm = (expected - true_moves) / n + 1e-3 * moves
        gb = (np.array([p[heads, j].sum() for j in range(k)]) - true_heads) / n
        gw2, gm2, gb2 = gw2 + g * g, gm2 + gm * gm, gb2 + gb * gb
        w -= rate * g / np.sqrt(gw2)
        moves = moves - rate * 0.2 * gm / np.sqrt(gm2)
        begin = begin - rate * 0.2 * gb / np.sqrt(gb2)
    weights[columns] = w
    return Fitted(labels, weights.astype(np.float32), moves, begin)


def train(docs: DataFrame, learn, sample: int = SAMPLE) -> Fitted:
    """Fit on at most ``sample`` documents (doc_id, text, lang) that meet ``learn``.

    Rows with a null text, lang or id are left out.
    """
    known = docs.where(learn).where("text is not null and lang is not null and doc_id is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return fit([], [])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    want = F.lit(False)
    for lang, n in sizes.items():
        want = want | ((F.col("lang") == lang) & (place < min(1.0, 0.9 * sample / len(sizes) / n)))
    rows = sorted(known.where(want).select("doc_id", "text", "lang").limit(sample).collect())
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def labelled(model: Fitted, texts) -> list[tuple[str, float]]:
    """``model.predict`` over an Arrow column, about ``TEXTS`` characters at a time."""
    out, some, size = [], [], 0
    for at in range(0, len(texts), ROWS):
        for text in texts.slice(at, ROWS).to_pylist():
            some.append(text or "")
            size += len(some[-1])
            if size >= TEXTS:
                out += model.predict(some)
                some, size = [], 0
    return out + model.predict(some)


def identify(docs: DataFrame, model: Fitted) -> DataFrame:
    """One row per document: (doc_id, lang_pred, score).

    score: mean posterior of the predicted language over the words.  Texts that are null or
    have no letter give ``und`` and 0.  Ties go to the first label in alphabetical order;
    repeated rows are each predicted; other columns are ignored.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.moves, model.begin))

    def run(batches):
        own = Fitted(*sent.value)
        for batch in batches:
            out = labelled(own, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in out], pa.string()),
                 pa.array([x for _, x in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_runs(docs: DataFrame, model: Fitted) -> DataFrame:
    """One row per document: (doc_id, runs), the words labelled one by one by forward-backward.

    runs: array of (begin, end, language, posterior), places in code points of the text, in
    order: neighbouring words of a line with one label are one run, posterior is their mean.
    Null texts and texts without a letter have no runs; repeated rows are each labelled; an
    empty table gives an empty table; other columns are ignored.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.moves, model.begin))
    run_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("language", pa.string()),
                                   ("posterior", pa.float64())]))

    def run(batches):
        own = Fitted(*sent.value)
        for batch in batches:
            found = [[dict(zip(("begin", "end", "language", "posterior"), r)) for r in own.runs(t or "")]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, run_type)], names=["doc_id", "runs"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, runs array<struct<begin: long, end: long, language: string, posterior: double>>")


def keep_identified(docs: DataFrame, learn, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The documents whose language is known with a score of ``least`` or more, all columns kept.

    Rejected: null texts, texts without letters, and texts of which no language covers the
    share ``least``.  The label column is used to learn only, from rows that meet ``learn``.
    """
    from starforge.llm.common import small_batches, stage

    model = train(docs, learn, sample)
    if not model.labels:
        return docs
    with small_batches(docs.sparkSession):
        found = stage(identify(docs, model).where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least))
                      .select("doc_id").distinct(), "langid")
    return docs.join(found.where("doc_id is not null"), "doc_id", "left_anti")
