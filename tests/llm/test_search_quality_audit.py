"""Filter audit (op13), K2-treap search (op12) and n-gram quality (op11) against brute force and held-out labels."""

import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starforge.llm import filteraudit, lexical, quality
from starforge.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ------------------------------------------------------------------ op13
def failures(rows):
    """Per row the letters of the filters that it fails."""
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORDS.findall(text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        out.append(fails + "E" * (doc_id is not None and smallest[text] < doc_id))
    return out


def audited(rows, labels):
    fails = failures(rows)
    good, toxic = ({d for d, q, x in labels if (q, x)[k] == 1 and d is not None} for k in (0, 1))
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        taken = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                taken[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == f for r in mine),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(taken[order[step - 1]])
    return out


def collected(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                               r.shapley] for r in df.collect()}


MANY = " ".join(f"w{i}" for i in range(250))
ODD = [(5, None, "x"), (3, "", "x"), (9, MANY, None), (9, MANY, None), (None, MANY, ""), (7, MANY, "x"), (8, "A# " * 300, "y"),
       (4, " \t\x0b\x85", "x"), (11, "é" + MANY, "x"), (12, MANY.upper(), "y"), (13, MANY + " |", "y"), (13, MANY + " |", "x")]
ODD_LABELS = [(9, 1, 0), (9, 0, 1), (7, 1, None), (None, 1, 1), (8, None, 1), (13, 1, 0), (99, 1, 1)]


def test_audit_matches_applying_the_filters(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string").withColumns(
        {c: F.lit("clash") for c in ("part", "fails", "n", "cell", "good", "toxic", "text_key")})
    labels = spark.createDataFrame(ODD_LABELS, "doc_id long, quality int, toxic int").withColumn("text", F.lit(1))
    got = collected(filteraudit.audit(docs, labels))
    assert got == audited(ODD, ODD_LABELS)
    assert collected(filteraudit.audit(docs, labels.limit(0))) == audited(ODD, [])
    assert filteraudit.audit(docs.limit(0), labels).count() == 0


def test_audit_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert collected(QUERIES["op13_filter_audit"](spark, SF)) == audited(rows, labels)


def test_shapley_shares_out_all_that_is_removed():
    counts = np.random.default_rng(1).integers(0, 50, (4, 3, 32))
    f = filteraudit.figures(counts)
    total = counts[:, 0].sum(axis=1)
    for p in range(4):
        last = f["kept"][p, 4::5]
        assert (last == counts[p, 0, 0]).all()
        assert f["removed"][p].sum() == 120 * (total[p] - counts[p, 0, 0])
        assert sum(dict(zip(filteraudit.AT.tolist(), f["shapley"][p].tolist())).values()) == f["removed"][p].sum()


# ------------------------------------------------------------------ op12
def folded(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERMS.findall(text or "")]


def best(docs, items, top=10):
    """(item_id, rank, doc_id, score) by scoring every document."""
    bags = [(d, Counter(folded(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    terms = {}
    for item, text in items:
        if text is not None:
            terms.setdefault(item, set()).update(folded(text))
    out = []
    for item, asked in terms.items():
        scored = []
        for doc_id, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, k, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def listed(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x180))) + " ÀB É x İß 中文字 don't A1_b2 \x7f~z"
    assert [t.decode() for t in lexical.terms(text)] == folded(text)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_treap_search_matches_all_scores(data):
    documents = data.draw(st.integers(1, 40))
    n_rows = data.draw(st.integers(1, 90))
    cells = data.draw(st.sets(st.tuples(st.integers(0, n_rows - 1), st.integers(0, documents - 1)), min_size=1, max_size=150))
    rows, columns = np.array(sorted(cells)).T
    values = np.array([data.draw(st.integers(1, 6)) for _ in rows])
    bits = max(1, (documents - 1).bit_length())
    # every tile of rows has a root only if it holds something: rows are the terms that occur
    used, rows = np.unique(rows, return_inverse=True)
    treap = lexical.Treap(bits, **lexical.build(rows, columns, values, bits))
    asked = np.array(data.draw(st.lists(st.integers(-1, len(used) - 1), min_size=1, max_size=12, unique=True)))
    weights = np.array([data.draw(st.integers(0, 4)) for _ in asked])
    scores = np.zeros(documents, int)
    for r, c, v in zip(rows, columns, values):
        scores[c] += int((weights[asked == r] * v).sum())
    want = sorted((-s, c) for c, s in enumerate(scores.tolist()) if s > 0)
    for top in (1, 3, 60):
        assert treap.search(asked, weights, top) == [(-s, c) for s, c in want[:top]]
    floor = int(data.draw(st.integers(1, 30)))
    assert treap.search(asked, weights, 60, floor) == [(-s, c) for s, c in want if -s >= floor]


def test_search_of_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert listed(QUERIES["op12_treap_search"](spark, SF)) == best(docs, items)


SEARCHED = [(5, None), (3, ""), (9, "One two three"), (9, "One two three"), (None, "two TWO"), (7, " \n --"), (8, "long " * 3000),
            (2, "é ́x 中文字 three"), (4, "two three"), (1, "two three"), (6, "three three")]
ASKED = [(1, "two three unknown"), (1, "Long"), (2, None), (3, ""), (None, "中文字 é"), (4, "unknown"), (5, "two two"), (5, "two two")]


@pytest.mark.parametrize("slice_bytes, block", [(16 << 20, 1 << 14), (8, 2), (20, 3)])
def test_search_of_odd_rows(spark, slice_bytes, block):
    docs = spark.createDataFrame(SEARCHED, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("score", "rank", "item_id", "terms")})
    items = spark.createDataFrame(ASKED, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for top in (2, 10):
        got = listed(lexical.ranked(docs.coalesce(2), items, top, slice_bytes, block))
        assert got == best(SEARCHED, ASKED, top)
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(docs.where("text is null"), items).count() == 0


# ------------------------------------------------------------------ op11
def test_ftrl_matches_one_coordinate_at_a_time():
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for _ in range(60):
        at = np.unique(rng.integers(0, 30, 6)).astype(np.int32)
        rows.append((at, rng.random(len(at)).astype(np.float32)))
        labels.append(int(at.min() < 6))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.05, 0.01
    weights, bias = quality.ftrl(rows, labels, 3, alpha, beta, l1, l2)
    z, n = Counter(), Counter()

    def leader(k):
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)
    weigh = [30 / (60 - sum(labels)), 30 / sum(labels)]
    order = np.random.default_rng(7)
    for _ in range(3):
        for i in order.permutation(60):
            x = {**dict(zip(rows[i][0].tolist(), rows[i][1].tolist())), "bias": 1.0}
            w = {k: leader(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = weigh[labels[i]] * (p - labels[i]) * v
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * w[k]
                n[k] += g * g
    assert bias == pytest.approx(leader("bias"), abs=1e-6)
    for k in range(30):
        assert weights[k] == pytest.approx(leader(k), abs=1e-5)
    assert not weights[30:].any()


def test_vector_counts_words_and_shapes():
    known = quality.Tokens()
    features, values = quality.vector("The the THE the $$ 12", known)
    assert (np.diff(features) > 0).all() and (values ** 2).sum() == pytest.approx(1)
    again, same = quality.vector("The the THE the $$ 12", quality.Tokens())
    assert (again == features).all() and (same == values).all()
    for empty in ("", " \n", " "):
        assert len(quality.vector(empty, known)[0]) == 0


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_ngram_quality"](spark, SF).collect()}
    assert sorted(got) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    for doc_id, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(got[d].predicted, q) for d, q in labels.items() if d in got and got[d].held_out]
    good, bad = [p for p, q in held if q == 1], [p for p, q in held if q == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2, (np.mean(good), np.mean(bad))


def test_quality_of_odd_rows(spark):
    rows = [(1, "fine plain words here", 1), (2, "## ## ##", 0), (2, "## ## ## ##", 0), (3, None, 1), (4, "", 0), (None, "x", 1),
            (5, "more plain words " * 5000, 1), (6, "$$ ##", 0), (7, "again plain words", 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("score", "label", "features", "quality")})
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(1, None), (2, 0)], "doc_id long, quality int").withColumn(
        "text", F.lit("other"))
    model = quality.train(docs, labels, F.lit(True))
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows)
    scores = {r.doc_id: r.score for r in got}
    assert scores[6] < scores[7]
    assert scores[3] == scores[4] == pytest.approx(1 / (1 + math.exp(-model[1])))
    again = quality.train(docs.repartition(3), labels, F.lit(True))
    assert (again[0] == model[0]).all() and again[1] == model[1]
    assert quality.score(docs.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("quality is null"), labels.withColumn("doc_id", F.lit(None).cast("long"))):
        weights, bias = quality.train(docs, none, F.lit(True))
        assert not weights.any() and bias == 0
    assert quality.train(docs, labels.where("quality = 1"), F.lit(True))[1] > 0
