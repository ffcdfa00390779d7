"""Findings of round 4 on line de-duplication, its buckets and broadcasts."""

import os
import random

from pyspark.sql import functions as F

from starforge.llm import components, linededup, simhash
from starforge.llm.common import checked_small, stage
from starforge.llm.components import PARITIES, bucket_components, connected_components, parities


def word(rng, n):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))


def test_lines_are_signed_at_every_position(spark):
    """similar lines whose words begin where they differ; the starts of words alone were signed (0.55 alike)."""
    rng = random.Random(1)
    rows = []
    for i in range(40):
        same = " ".join(word(rng, 8) for _ in range(40))
        rows += [(2 * i + j, same + " " + " ".join(word(rng, 1) for _ in range(15))) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.line_classes(docs).collect()
    assert {(r.doc_id, r.class_doc) for r in got} == {(i, i - i % 2) for i in range(80)}


def test_lines_that_repeat_themselves_are_signed_whole(spark):
    """A minimum that is not among the lowest values is looked for among all; short lines are one shingle."""
    rng = random.Random(2)
    long = "x" * 5000
    texts = [long, long + "x", "ab " * 900, "ab " * 901, "short", "shoru", "é中\U0001F600 字", word(rng, 3000)]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line_id long, line string")
    some = {r.line_id: r for r in linededup._minima(found, 24, False).collect()}
    every = {r.line_id: r for r in linededup._minima(found, 24, True).collect()}
    assert any(v is None for v in some[0]) and len(every) == len(texts)
    for i, r in every.items():
        assert None not in r
        assert all(a is None or a == b for a, b in zip(some[i], r))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys = {r.line_id: r["keys"] for r in linededup.band_keys(docs, 8, 3).collect()}
    assert len(keys) == len(texts) and all(len(k) == 8 for k in keys.values())
    got = {r.doc_id: r.class_doc for r in linededup.line_classes(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6, 7: 7}


def test_sets_of_lines_count_characters(spark):
    lines = ["abcdefghi", "abc", "a\U0001F600cdefgh中", "aaaaaaaaaaaaaaa", "é" * 9 + "x"]
    df = spark.createDataFrame([(t,) for t in lines], "line string")
    got = [r[0] for r in df.select(linededup.dense_hashes("line")).collect()]
    want = [{t[i:i + linededup.WINDOW] for i in range(max(1, len(t) - linededup.WINDOW + 1))} for t in lines]
    assert [len(x) for x in got] == [len(x) for x in want] and all(len(set(x)) == len(x) for x in got)


def test_lines_are_staged_as_text(spark):
    """the sets of lines were written as 4 bytes for each character, and shuffled so with every pair."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        t = " ".join(word(rng, rng.randint(2, 9)) for _ in range(90))
        rows += [(2 * i, t), (2 * i + 1, t + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = os.path.dirname(stage(docs.limit(0), "test").staged_path).removeprefix("file:")
    before = set(os.listdir(folder))
    found = linededup.line_components(docs)
    assert found.count() == 600 and found.select("component").distinct().count() == 300
    made = [x for x in set(os.listdir(folder)) - before if x.startswith("bodies-")]
    size = sum(os.path.getsize(os.path.join(folder, x, f)) for x in made for f in os.listdir(os.path.join(folder, x)))
    assert made and size < 1.5 * sum(len(t) for _, t in rows)


def test_pairs_of_unlike_parities_are_not_compared(spark, monkeypatch):
    """sets that share a bucket and half their elements; all of them were fetched and compared."""
    rng = random.Random(4)
    common = rng.sample(range(-2**31, 2**31), 100)
    sets = {n: common + rng.sample(range(-2**31, 2**31), 100) for n in range(1, 31)}
    sets |= {-n: x[:-1] for n, x in sets.items()}
    store = stage(spark.createDataFrame(list(sets.items()), "node long, body array<int>"), "test")
    members = stage(spark.createDataFrame([(k, n) for k in (1, 2) for n in sets if k == 1 or abs(n) < 20], "key long, node long"), "test")

    def bodies(ids):
        counted = parities(store.select("node", F.explode("body").alias("e")))
        return (store.join(ids, "node", "left_semi").join(counted, "node")
                .select("node", F.col("n").alias("size"), "body", *[F.coalesce(p, F.lit(0)).alias(p) for p in PARITIES]))

    compared = []

    def alike(pairs):
        compared.append(pairs.count())
        both = pairs.withColumn("c", F.size(F.array_intersect("body_a", "body_b")))
        return both.where("c >= 0.8 * (size(body_a) + size(body_b) - c)").select("a", "b")

    found = bucket_components(members, bodies, alike, lambda x: x.withColumnRenamed("body", "elements"), 0.8)
    assert sorted(map(tuple, found.collect())) == sorted((s * n, -n) for n in range(1, 31) for s in (1, -1))
    assert sum(compared) <= 60


def test_no_more_than_100_000_rows_are_sent_to_every_executor(spark):
    """up to a million rows were broadcast, three such tables in one query, each built in the driver's memory."""
    many = stage(spark.range(150_000).select(F.col("id").alias("node")), "test")
    few = stage(spark.range(90_000).select(F.col("id").alias("node")), "test")
    plan = [x._jdf.queryExecution().logical().toString() for x in (checked_small(many), checked_small(few))]
    assert "broadcast" not in plan[0] and "broadcast" in plan[1]


def test_rounds_are_composed_before_the_nodes_are_joined(spark):
    """every round of a contraction was joined to all nodes in one query, with as many broadcasts."""
    pairs = [(i, i + 1) for i in range(0, 3000)] + [(i, i + 1) for i in range(5000, 5002)]
    links = stage(spark.createDataFrame(pairs, "a long, b long"), "test")
    found = connected_components(links)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(3001)} | {(i, 5000) for i in range(5000, 5003)}
    assert components.BROADCAST_ROWS <= 100_000 and plan.count("Aggregate") <= 3


def test_variants_of_fingerprints_are_not_sent_to_every_executor(spark):
    """their table is small as a file and large as rows; it was broadcast by the size of its file."""
    fps = stage(spark.createDataFrame([(i << 3,) for i in range(200)] + [(i << 3 | 1,) for i in range(200)], "fp long"), "test")
    links = simhash.link_fingerprints(fps, 2)
    plan = links._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [slot" in plan and "BroadcastHashJoin [slot" not in plan
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in links.collect()}
    assert all(bin(a ^ b).count("1") <= 2 for a, b in got) and all((i << 3, i << 3 | 1) in got for i in range(200))
