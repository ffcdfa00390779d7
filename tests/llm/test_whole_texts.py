"""Whole texts and whole words: long lines, repetitive text, numerals, upper case, every offending sentence."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from starforge.llm import decontaminate, langid, toxicity
from starforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ toxicity
def toxic_model():
    clean = [f"word{i} and more here. another one" for i in range(40)]
    return toxicity.fit(clean + [f"{t}. you nasty beast! fine" for t in clean], [0] * 40 + [1] * 40)


def slow_score(model, text):
    """Noisy-or over the sentences, sentence scores from the weights of their distinct words."""
    clean = 1.0
    for a, b in toxicity.sentences(text):
        words = {w.lower() for w in toxicity.WORD.findall(text[a:b])}
        z = model.bias + sum(float(model.weights[f]) for w in words for f in toxicity.word_features(w))
        clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def test_toxicity_matches_scoring_by_hand(spark):
    model = toxic_model()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(200)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        assert got[r.doc_id].score == pytest.approx(slow_score(model, r.text or ""), abs=1e-6)
        assert got[r.doc_id].predicted == (got[r.doc_id].score >= 0.7)


def test_upper_case_counts_whatever_else_the_text_holds():
    model = toxic_model()
    plain = model.score("Such a NASTY BEAST.")
    assert plain > 0.7 and model.score("Such a NASTY BEAST. \u0130") == pytest.approx(plain, abs=0.1)


def test_every_offending_sentence_is_located(spark):
    text = "nothing here. you nasty beast! fine. YOU NASTY BEAST! the end"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "word1 and more here.")], "doc_id long, text string").withColumn(
        "offending", F.lit(0))
    got = {r.doc_id: r for r in toxicity.score(docs, toxic_model()).collect()}
    assert [text[r.begin:r.end].strip().lower() for r in got[1].offending] == ["you nasty beast!"] * 2
    assert got[2].offending == [] and got[3].offending == []


def test_training_takes_one_text_of_a_repeated_id(spark):
    rows = [(i % 6, f"text {i} you nasty beast" if i % 2 else f"plain words {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)] + [(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    models = [toxicity.train(docs.repartition(n), labels, F.lit(True)) for n in (1, 5)]
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias
    assert toxicity.train(docs, labels.limit(0), F.lit(True)).score("x") < 0.7


# --------------------------------------------------------------- language ID
@pytest.fixture(scope="module")
def languages(spark):
    known = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog of the house", "en"), ("der hund und die katze das haus", "de")] * 20)],
        "doc_id long, text string, lang string")
    return langid.train(known, F.lit(True))


def test_numerals_are_no_letters(languages):
    for text in ("\u00bd \u00b2", "12 \u2460 \u0664", "_ \u2167"):
        assert languages.predict([text]) == [(("und", 0.0))]
    assert languages.predict(["\u00bd the house"])[0][0] == "en"


def test_long_lines_are_one_chain(languages):
    """Posteriors of a line of any length, with others beside it, are those of the line alone."""
    words = ("the cat and the house der hund und das haus " * 300).split()
    text = " ".join(words)
    at = languages.emission_rows(words)
    e = languages.rows[at]
    # forward-backward in plain loops, in logs
    k, n = e.shape[1], len(words)
    forward, backward = np.zeros((n, k)), np.zeros((n, k))
    forward[0] = languages.begin + e[0]
    for t in range(1, n):
        forward[t] = e[t] + np.logaddexp.reduce(forward[t - 1][:, None] + languages.moves, axis=0)
    for t in range(n - 2, -1, -1):
        backward[t] = np.logaddexp.reduce(languages.moves + (e[t + 1] + backward[t + 1])[None, :], axis=1)
    p = np.exp(forward + backward - np.logaddexp.reduce(forward[-1]))
    best = int(p.mean(axis=0).argmax())
    for texts in ([text], ["the cat", text, "das haus\nthe dog"]):
        lang, score = languages.predict(texts)[texts.index(text)]
        assert lang == languages.labels[best] and score == pytest.approx(float(p[:, best].mean()), abs=1e-9)


def test_words_of_code_switched_text_are_labelled(spark, languages):
    text = "the cat and the dog\nder hund und die katze the house of the cat \u00bd.\n\nDAS HAUS"
    runs = languages.runs(text)
    assert [(text[a:b], lang) for a, b, lang, _ in runs] == [
        ("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the house of the cat", "en"), ("DAS HAUS", "de")]
    assert all(0.5 <= p <= 1 for *_, p in runs)
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, "12")], "doc_id long, text string").withColumn(
        "runs", F.lit(0))
    got = {r.doc_id: [(x.begin, x.end, x.language) for x in r.runs] for r in langid.language_runs(docs, languages).collect()}
    assert got == {1: [(a, b, lang) for a, b, lang, _ in runs], 2: [], 3: [], None: []}
    assert langid.language_runs(docs.limit(0), languages).count() == 0


def test_word_labels_of_mixed_documents(spark):
    """Lines of documents of two languages in turn, labelled by a model that never saw them."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("text is not null and lang is not null")
    model = langid.train(docs, F.col("doc_id") % 2 == 0)
    lines = {}
    for r in docs.where("doc_id % 2 = 1").orderBy("doc_id").limit(300).collect():
        lines.setdefault(r.lang, []).extend(x for x in r.text.split("\n") if len(x) > 60)
    right = total = 0
    for a, b in zip(lines["en"], lines["fr"]):
        text = a + " " + b
        for begin, end, lang, _ in model.runs(text):
            cut = min(max(len(a), begin), end)
            right += (cut - begin) * (lang == "en") + (end - cut) * (lang == "fr")
            total += end - begin
    assert total > 2000 and right / total > 0.9, right / total


# ----------------------------------------------------------- decontamination
def letters(rng, alphabet, n):
    return bytes(rng.choice(np.frombuffer(alphabet, np.uint8), n))


def slow_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(3))
def test_repetitive_text_matches_full_alignment(seed):
    rng = np.random.default_rng(seed)
    for turn in range(80):
        unit = letters(rng, b"ab", int(rng.integers(1, 5)))
        m = int(rng.integers(10, 80))
        item = bytearray((unit * m)[:m])
        if turn % 2:
            item[int(rng.integers(m))] = ord("z")
        item = bytes(item)
        text = bytearray((unit * 200)[:int(rng.integers(0, 300))])
        for _ in range(int(rng.integers(0, 30))):
            if text:
                text[int(rng.integers(len(text)))] = int(rng.choice(list(b"abz")))
        text = bytes(text)
        edits, allowed = slow_edits(item, text), decontaminate.budget(m)[0]
        found = decontaminate.Index([(1, item)]).find(text)
        assert [h[1] for h in found] == ([edits] if edits <= allowed else []), (item, text)
        assert all(slow_edits(item, text[a:b]) <= allowed for _, _, a, b in found)


def test_nearest_is_the_least_edit_distance():
    rng = np.random.default_rng(9)
    for _ in range(200):
        item = letters(rng, b"abc", int(rng.integers(1, 90)))
        text = letters(rng, b"abc", int(rng.integers(0, 120)))
        edits, end = decontaminate.nearest(item, text)
        assert edits == slow_edits(item, text)
        assert edits == len(item) or slow_edits(item, text[:end]) == edits


@pytest.mark.parametrize("m", [10, 14, 20, 23, 24, 30, 31, 40])
def test_short_items_have_their_edits(m):
    """Every item of ten bytes or more may differ by a tenth of its bytes."""
    rng = np.random.default_rng(m)
    k, least = decontaminate.budget(m)
    assert k == m // 10 and least >= 1
    for _ in range(30):
        item = letters(rng, b"abcdefgh", m)
        index = decontaminate.Index([(1, item)])
        for edits in range(k + 2):
            raw = bytearray(item)
            for at in rng.choice(m, edits, replace=False):
                raw[int(at)] = ord("z")
            text = b"qq " + bytes(raw) + b" rr"
            least_edits = slow_edits(item, text)
            assert [h[1] for h in index.find(text)] == ([least_edits] if least_edits <= k else [])


def test_a_million_equal_characters():
    text = b"-" * 1_000_000
    began = time.time()
    for item in (b"-" * 200, b"-" * 100 + b"+" * 5 + b"-" * 95, b"ab" * 100):
        found = decontaminate.Index([(1, item)]).find(text)
        assert [h[1] for h in found] == {0: [0], 5: [5], 200: []}[slow_edits(item, text[:400])]
    assert time.time() - began < 60


def test_op9_on_the_whole_table_finds_what_full_alignment_finds(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(40).collect()
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op9_qgram_decontamination"](spark, SMALL).collect()}
    assert got
    items = {r.item_id: decontaminate.normal(r.text) for r in bench}
    texts = {r.doc_id: decontaminate.normal(r.text) for r in docs}
    for d, text in texts.items():
        for i, item in items.items():
            edits, _ = decontaminate.nearest(item, text)
            assert got.get((d, i)) == (edits if edits <= decontaminate.budget(len(item))[0] else None), (d, i)
