"""Toxicity, language ID, decontamination and backoff scores: held-out accuracy and brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starforge.llm import backoff, decontaminate, langid, toxicity
from starforge.llm.common import crc32_remainder
from starforge.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"


def odd_documents(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (3, "the and of the", "en"), (None, "der die das", "de"),
            (5, "the and of " * 4000, "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))


def test_toxicity_on_held_out_labels(spark):
    got = QUERIES["op6_toxic_sentences"](spark, SF)
    both = got.join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out")
    rate = {r["toxic"]: r["p"] for r in both.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert rate[1] > 0.85 and rate[0] < 0.05
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.count() == n and got.where("score < 0 or score > 1").count() == 0


def test_toxicity_finds_the_sentence_and_takes_odd_rows(spark):
    clean = [f"word{i} and more here. another one" for i in range(40)]
    model = toxicity.fit(clean + [f"{t}. you nasty beast! fine" for t in clean], [0] * 40 + [1] * 40)
    text = "nothing here. such a nasty beast. the end"
    spans, p = model.sentence_scores(text)
    assert text[slice(*spans[int(p.argmax())])].strip() == "such a nasty beast."
    assert model.score(text) > 0.7 > model.score(clean[0])
    out = toxicity.score(odd_documents(spark), model)
    assert out.count() == 6 and toxicity.score(odd_documents(spark).limit(0), model).count() == 0
    empty = toxicity.fit([], [])
    assert 0 <= empty.score("") <= 1


def test_forward_backward_matches_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 4, 3])
    e, moves, begin = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, total, expected = langid.posteriors(e, lengths, moves, begin, counts=True)
    want, log_z, want_moves = np.zeros_like(e), 0.0, np.zeros((3, 3))
    at = 0
    for n in lengths:
        paths = np.array(np.meshgrid(*[range(3)] * n, indexing="ij")).reshape(n, -1).T
        weight = np.array([math.exp(begin[p[0]] + sum(e[at + t, p[t]] for t in range(n))
                                    + sum(moves[p[t - 1], p[t]] for t in range(1, n))) for p in paths])
        log_z += math.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            for t in range(n):
                want[at + t, p[t]] += w
                if t:
                    want_moves[p[t - 1], p[t]] += w
        at += n
    assert np.allclose(got, want) and np.isclose(total, log_z) and np.allclose(expected, want_moves)


def test_language_id_held_out_and_odd_rows(spark):
    got = QUERIES["op10_crf_language_id"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    hit = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert hit > 0.95
    known = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog of the house", "en"), ("der hund und die katze das haus", "de")] * 20)],
        "doc_id long, text string, lang string")
    model = langid.train(known, F.lit(True))
    out = {(r.doc_id, r.lang_pred) for r in langid.identify(odd_documents(spark), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (3, "en"), (None, "de"), (5, "en")} == out
    kept = langid.keep_identified(odd_documents(spark), F.lit(True), least=0.3)
    assert {r.doc_id for r in kept.collect()} >= {None, 5} and kept.columns == odd_documents(spark).columns
    assert langid.identify(odd_documents(spark).limit(0), model).count() == 0
    assert langid.keep_identified(odd_documents(spark).limit(0), F.lit(True)).count() == 0


def slow_edits(item, text):
    """Least edit distance of item to any substring of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(4))
def test_leaks_match_full_alignment(seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words, n))
    items = [(i, decontaminate.normal(text(int(rng.integers(5, 30))))) for i in range(12)]
    index = decontaminate.Index(items)
    for _ in range(25):
        key, item = items[int(rng.integers(12))]
        raw = bytearray(item)
        for _ in range(int(rng.integers(0, len(item) // 8))):
            at, kind = int(rng.integers(len(raw))), rng.integers(3)
            if kind == 0:
                raw[at:at + 1] = b"x"
            elif kind == 1:
                del raw[at]
            else:
                raw[at:at] = b"y"
        whole = decontaminate.normal(text(20) + " " + raw.decode() + " " + text(20))
        found = {h[0]: h for h in index.find(whole)}
        for k, it in items:
            edits, allowed = slow_edits(it, whole), decontaminate.budget(len(it))[0]
            assert (k in found) == (edits <= allowed), (k, edits, allowed)
            if k in found:
                assert found[k][1] == edits
                assert slow_edits(it, whole[found[k][2]:found[k][3]]) <= allowed


@pytest.mark.parametrize("seed", range(4))
def test_leaks_at_the_edges_of_a_text(seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words, n))
    item = decontaminate.normal(text(20))
    index, k = decontaminate.Index([(1, item)]), decontaminate.budget(len(item))[0]
    for lost in range(0, k + 1):
        front, back = item[lost:].lstrip(), item[:len(item) - lost].rstrip()
        for whole in (front, back, front + b" " + text(9).encode(), text(9).encode() + b" " + back,
                      item[lost:lost + 1] + item[2 * lost + 1:], b"zz" + front, item[:9] + item[9 + lost:]):
            edits = slow_edits(item, whole)
            found = index.find(whole)
            assert [h[1] for h in found] == ([edits] if edits <= k else []), (lost, whole)
            assert all(0 <= a <= b <= len(whole) and slow_edits(item, whole[a:b]) <= k for _, _, a, b in found)
    for offset in range(3 * k):                   # bytes left out after a part that matches, at every place
        for whole in (b"#" * offset + item[:20] + item[20 + k:], b"#" * offset + item[:-20 - k] + item[-20:]):
            edits = slow_edits(item, whole)
            assert [h[1] for h in index.find(whole)] == ([edits] if edits <= k else []), offset


def test_leaks_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, "The AND   of the"), (2, None), (3, ""), (4, "of")], "item_id long, text string")
    got = decontaminate.leaks(odd_documents(spark), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(3, 1), (3, 4), (5, 1), (5, 4)}
    assert {r.doc_id for r in decontaminate.drop_leaks(odd_documents(spark), bench).collect()} == {1, 2, None}
    assert decontaminate.leaks(odd_documents(spark).limit(0), bench).count() == 0
    assert decontaminate.drop_leaks(odd_documents(spark), bench.limit(0)).count() == 6
    sliced = decontaminate.leaks(odd_documents(spark), bench, bound=8)
    assert sorted(sliced.collect()) == sorted(got.collect())


def test_backoff_matches_counting_by_hand(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    extra = spark.createDataFrame([(900, None), (901, ""), (902, "the"), (902, "the")], "doc_id long, text string")
    docs = docs.union(extra)
    path = vocabulary("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    texts = [(r.doc_id, coder.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    counts = Counter()
    for _, ids in texts:
        for n in (1, 2, 3):
            counts.update(tuple(ids[i:i + n]) for i in range(len(ids) - n + 1))
    total = sum(len(ids) for _, ids in texts)
    want = []
    for key, ids in texts:
        own = Counter(tuple(ids[i:i + n]) for n in (1, 2, 3) for i in range(len(ids) - n + 1))
        rest, score = max(total - len(ids), 1), 0.0

        def others(g):
            return counts[g] - own[g]
        for i in range(len(ids)):
            lost = 0.0
            for n in range(min(3, i + 1), 0, -1):
                g = tuple(ids[i - n + 1:i + 1])
                if n == 1:
                    score += lost + math.log(max(others(g), 0.5) / rest)
                elif others(g) > 0 and others(g[:-1]) > 0:
                    score += lost + math.log(others(g) / others(g[:-1]))
                    break
                lost += math.log(0.4)
        want.append((key, len(ids), round(score, 6)))
    got = [(r.doc_id, r.n_tokens, round(r.log_score, 6)) for r in backoff.scores(docs, path).collect()]
    assert sorted(got) == sorted(want)
    blocks = [(r.doc_id, r.n_tokens, round(r.log_score, 6))         # many blocks, none wider than a document
              for r in backoff.scores(docs, path, block_ids=500).collect()]
    assert sorted(blocks) == sorted(want)
    assert backoff.scores(docs.limit(0), path).count() == 0
    odd = spark.createDataFrame([(None, "the cat"), (2 ** 60 + 1, ""), (None, None)], "doc_id long, text string")
    found = sorted(((r.doc_id or 0, r.n_tokens) for r in backoff.scores(odd, path).collect()))
    assert found == [(0, 0), (0, 2), (2 ** 60 + 1, 0)]


def test_backoff_orders_entries_by_part():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5000))
    for parts in (1, 7, 1 << 17):
        order, held, begins = backoff._by_part(keys, parts)
        cut = np.split(order, begins[1:])
        assert sum(map(len, cut)) == len(keys) and len(cut) == len(held) == len(set(held.tolist()))
        for part, at in zip(held, cut):
            assert (backoff._part(keys[at], parts) == part).all() and (np.diff(at) > 0).all()


def test_backoff_order_is_stable_with_and_without_room():
    for top in (1, 50, 1 << 61):
        keys = np.random.default_rng(2).integers(0, top, 3000)
        assert (backoff._order(keys) == np.argsort(keys, kind="stable")).all()
    assert len(backoff._order(np.zeros(0, np.int64))) == 0


def test_fold_of_an_id(spark):
    import zlib
    got = {r.id: r.m for r in spark.range(50).select("id", crc32_remainder("id", 3).alias("m")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 for i in range(50)}
