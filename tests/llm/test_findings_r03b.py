"""Findings of round 3, third pass: places of chains that run together, words looked up together, components that go on."""

from __future__ import annotations

import tracemalloc

import numpy as np

from starforge.llm.components import connected_components
from starforge.llm.langid import Fitted, posteriors, word_features


def test_chains_take_their_own_places_only():
    rng = np.random.default_rng(5)
    lengths = np.array([1] * 100 + [1024] + [1] * 27)
    emissions, moves, begin = rng.normal(size=(lengths.sum(), 4)), rng.normal(size=(4, 4)), rng.normal(size=4)
    tracemalloc.start()
    got, _, expected = posteriors(emissions, lengths, moves, begin, counts=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000                 # 1,151 places of 4 labels, not 128 times 1,024
    alone = [posteriors(x, np.array([len(x)]), moves, begin, counts=True)
             for x in np.split(emissions, np.cumsum(lengths)[:-1])]
    assert np.allclose(got, np.concatenate([p for p, _, _ in alone]))
    assert np.allclose(expected, sum(e for _, _, e in alone))
    first = np.exp(begin + emissions[0])
    assert np.allclose(got[0], first / first.sum())


def test_words_are_looked_up_together():
    weights = np.random.default_rng(6).normal(size=(1 << 18, 3)).astype(np.float32)
    calls = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            calls.append(key)
            return super().__getitem__(key)
    model = Fitted(["a", "b", "c"], weights.view(Counted), np.zeros((3, 3)), np.zeros(3))
    words = [f"w{i}rd" for i in range(1500)] * 2
    at = model.emission_rows(words)
    rows = np.asarray(model.rows)[at]
    assert len(calls) <= 40                 # one for each number of features
    assert np.array_equal(rows[:1500], rows[1500:])
    assert np.allclose(rows[7], weights[word_features(words[7])].sum(axis=0), atol=1e-5)


def test_components_go_on_from_earlier_ones(spark, tmp_path):
    schema = "a long, b long"
    path = str(tmp_path / "before")
    connected_components(spark.createDataFrame([(i, i + 1) for i in range(20, 40)] + [(3, 4), (90, 91)], schema)).write.parquet(path)
    more = spark.createDataFrame([(40, 4), (5, 39), (60, 61), (21, 22)], schema)
    got = {r.node: r.component for r in connected_components(more, before=spark.read.parquet(path)).collect()}
    assert got == {n: 3 for n in [3, 4, 5, *range(20, 41)]} | {60: 60, 61: 60, 90: 90, 91: 90}
