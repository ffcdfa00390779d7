"""Findings of round 3: what the corpus operators hold in memory, deal to tasks and write to disk."""

import os

import numpy as np
import pyarrow as pa

from starforge.llm import langid
from starforge.llm.common import small_batches, stage
from starforge.llm.components import PARITIES, connected_components, reach


def test_texts_are_labelled_in_small_groups():
    class Model:
        groups = []

        def predict(self, texts):
            self.groups.append(sum(map(len, texts)))
            return [(t[:5], 1.0) for t in texts]
    texts = [None if i % 97 == 0 else f"{i:05d}" + "x" * 995 for i in range(3000)] + ["y" * 600_000, ""]
    got = langid.labelled(Model(), pa.chunked_array([texts[:1100], texts[1100:]], pa.string()).combine_chunks())
    assert [x for x, _ in got] == [(t or "")[:5] for t in texts]
    assert sum(Model.groups) == sum(len(t or "") for t in texts)
    assert all(n < (1 << 18) + 1000 for n in Model.groups if n < 600_000)


def test_few_links_take_few_tasks(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    root = {n: n for p in pairs for n in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    used = {n for a, b in pairs if a != b for n in (a, b)}
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    sc = spark.sparkContext
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sc.setJobGroup("few-links", "")
        found = connected_components(stage(spark.createDataFrame(pairs, "a long, b long"), "test"))
        sc.setJobGroup("after", "")
        assert {r.node: r.component for r in found.collect()} == {n: root[n] for n in used}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("few-links") for s in status.getJobInfo(j).stageIds}
    # a round took about six stages of 64 tasks
    assert sum(i.numCompletedTasks for i in map(status.getStageInfo, stages) if i) < 800


def test_parities_bound_the_difference_and_no_copy_of_the_sets_is_written(spark):
    rng = np.random.default_rng(4)
    common = rng.integers(-2**31, 2**31, 150).tolist()
    sets = {i: sorted({*common[:rng.integers(0, 150)], *rng.integers(-2**31, 2**31, rng.integers(0, 60)).tolist()})
            for i in range(40)} | {40: [], 41: [5], 42: [5]}
    rows = stage(spark.createDataFrame([(n, len(x), x) for n, x in sets.items()],
                                       "node long, size int, elements array<int>"), "test")
    folder = os.path.dirname(rows.staged_path).removeprefix("file:")
    before = set(os.listdir(folder))
    got = {r.node: r for r in reach(rows, rows.select("node", "size")).collect()}
    assert {x.split("-")[0] for x in set(os.listdir(folder)) - before} == {"reach"}
    assert {n: r["size"] for n, r in got.items()} == {n: len(x) for n, x in sets.items()}
    for a, x in sets.items():
        assert got[a].most == sum(any(e in y for b, y in sets.items() if b != a) for e in x)
        for b, y in sets.items():
            bits = sum(((got[a][p] ^ got[b][p]) & (2**64 - 1)).bit_count() for p in PARITIES)
            assert bits <= len(set(x) ^ set(y)) and (a == b or bits or x == y)


def test_texts_are_sent_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(b)], pa.int64())], names=["n"])
    with small_batches(spark, 10):
        got = [r.n for r in spark.range(95).coalesce(1).mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 95 and max(got) <= 10
    assert spark.conf.get(name) == before
