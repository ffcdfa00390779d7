"""SimHash near-duplicates against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starforge.llm import simhash
from starforge.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams) for bit in range(64)]
    return sum(1 << bit for bit, n in enumerate(counts) if n * 2 > len(grams))


def slow_components(fps, distance):
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fps = {r.doc_id: slow_fingerprint(r.text) for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    want = slow_components(fps, 2)
    assert got == {k: (fps[k], want[k]) for k in fps}


@pytest.mark.parametrize("crowded", [2, 64])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_of_crowded_buckets(spark, crowded, distance):
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(-2**63, 2**63, 3):
        for _ in range(60):
            x = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(bit)
            x &= 2**64 - 1
            fps.add(x - 2**64 if x >> 63 else x)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = simhash.link_fingerprints(df, distance, crowded)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= distance for r in links.collect())
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = slow_components({x: x & (2**64 - 1) for x in fps}, distance)
    assert {x: got.get(x, x) for x in fps} == want


def test_odd_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (9, "one two", 3), (9, "one two", 3), (None, "ONE\tTWO", 4),
            (7, " \n ", 5), (8, "x " * 5000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumn("fp", F.lit("x"))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert (by[5].fp, by[5].component_id, by[7].component_id) == (0, 3, 3)
    assert by[None].component_id == by[9].component_id == 9
    kept = simhash.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 8, 9]
    assert kept.columns == docs.columns
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 300)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 300)}
    assert connected_components(df.limit(0)).count() == 0


def test_members_of_many_buckets_are_compared_with_one_centre(spark):
    """Copies that share all buckets cost one pair each, not one for every bucket."""
    from starforge.llm.components import bucket_components
    members = spark.range(60).select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(24).cast("long"))).alias("key"),
                                     F.col("id").alias("node"))
    compared = []

    def alike(pairs):
        compared.append(pairs.count())
        return pairs.select("a", "b")

    found = bucket_components(
        members, lambda ids: ids.select("node", F.lit(3).alias("size"), F.array(F.lit(1), F.lit(2), F.lit(3)).alias("body")),
        alike, lambda sets: sets.withColumnRenamed("body", "elements"), 0.8)
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(60)]
    assert sum(compared) == 59
