"""Connected components and verified links from hash buckets, as Spark joins.

``connected_components`` contracts: every node joins its neighbour of lowest rank, and only
links between different groups go on to the next round, under new ranks.  A round is one
aggregation and two joins, the links stay distributed, and a neighbour is found by a
pre-aggregated minimum, so a node with very many links costs one row per task before the
shuffle.  Links that were counted as few are dealt to as few tasks and joined by broadcasts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import BROADCAST_ROWS, checked_small, discard, few_tasks, stage


STAR_ROUNDS = 6
FEW_PAIRS = 8
CROWDED = 64
PARITIES = [f"p{i}" for i in range(16)]    # 64 classes each


def _joined_groups(edges: DataFrame, rows: int) -> list[tuple[DataFrame, int]]:
    """The rounds of a contraction, (u, m, done) each: group u becomes part of group m.

    ``edges``: (u, v), ranks of different groups, distinct, ``rows`` of them, from a staged
    table, which is discarded.  A rank is renewed by a hash (one to one on longs), so no order of
    the ids makes long chains of them: the number of groups is expected to halve with every round.
    """
    rounds = []
    few = rows <= BROADCAST_ROWS // 2              # links, so at most twice as many groups
    while rows and not (rounds and edges.isEmpty()):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select(
            "u", F.xxhash64(F.least("u", "v"), F.lit(len(rounds))).alias("m"))
        low = stage(few_tasks(low, rows), "cc")
        sent = F.broadcast(low) if few else low
        left = (edges.join(sent.withColumnRenamed("m", "x"), "u")
                .join(sent.select(F.col("u").alias("v"), F.col("m").alias("y")), "v").where("x <> y")
                .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
        old, edges = edges, stage(few_tasks(left, rows), "cc")
        discard(old)
        rounds.append((low, few))
    discard(edges)
    return rounds


def connected_components(links: DataFrame, a: str = "a", b: str = "b", before: DataFrame | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link.

    Nodes are longs.  Nulls, self links and repeated links change nothing; no
    links give an empty table.  ``before``: a result of this function, from a staged table, whose
    components are joined by the links.
    """
    links = links.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b"))
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if before is None:
        known, nodes = 0, nodes.withColumn("component", F.col("node"))
    else:
        known, sent = before.count() + 2 * links.count(), checked_small(before)
        links = (links.join(sent.toDF("a", "x"), "a", "left").join(sent.toDF("b", "y"), "b", "left")
                 .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).where("a <> b"))
        nodes = before.union(nodes.join(sent.select("node"), "node", "left_anti").withColumn("component", F.col("node")))
    # the first rank is a hash too: the nodes themselves may be in any order
    edges = stage(links.select(F.xxhash64("a").alias("x"), F.xxhash64("b").alias("y"))
                  .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "cc")
    rows = edges.count()
    known = max(known, 2 * rows)
    named = few_tasks(nodes, known).withColumn("u", F.xxhash64("component"))
    last = None                             # (u, m) from a round to the last one; the rounds shrink, the nodes don't
    for low, few in reversed(_joined_groups(edges, rows)):
        if last is not None:
            low = (low.join(last.select(F.col("u").alias("m"), F.col("m").alias("then")), "m", "left")
                   .select("u", F.coalesce("then", "m").alias("m")))
        last = F.broadcast(low) if few else low
    if last is not None:
        named = named.join(last, "u", "left").select("node", "component", F.coalesce("m", "u").alias("u"))
    smallest = named.groupBy("u").agg(F.min("component").alias("component"))
    return few_tasks(named.select("node", "u").join(smallest, "u").select("node", "component"), known)


def reach(sets: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(node, size, most, p0 ..): how many elements a set has, how many of them any other set has
    too, and its parities.

    ``sets``: (node long, size int, elements array), elements hashed to 32 bits, once each; ``sizes``:
    (node, size) of the same sets where that costs less to read.  Two sets share at most the smaller
    ``most``; hashes that collide only make it larger.  Bit i of the parities tells whether an odd
    number of elements fall into class i: elements that two sets share cancel out, so two sets differ
    in at least as many elements as their parities in bits.
    """
    alone = (sets.select("node", F.explode(F.array_distinct("elements")).alias("e"))
             .groupBy("e").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
             .groupBy("node").agg(F.count("*").alias("own")))
    sizes = sets if sizes is None else sizes
    return stage(sizes.select("node", "size").join(alone, "node", "left")
                 .join(parities(sets.select("node", F.explode("elements").alias("e"))), "node", "left")
                 .select("node", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("most"),
                         *[F.coalesce(p, F.lit(0)).cast("long").alias(p) for p in PARITIES]), "reach")


def parities(rows: DataFrame) -> DataFrame:
    """(node, n, p0 ..): the number and the parities of the elements of (node, e int), each once."""
    return rows.groupBy("node").agg(F.count("*").cast("int").alias("n"), *[
        F.expr(f"bit_xor(shiftleft(1L, e & 63)) filter (where ((e >> 6) & {len(PARITIES) - 1}) = {i})").alias(p)
        for i, p in enumerate(PARITIES)])


def bucket_components(members: DataFrame, bodies: Callable[[DataFrame], DataFrame],
                      alike: Callable[[DataFrame], DataFrame], elements: Callable[[DataFrame], DataFrame],
                      threshold: float) -> DataFrame:
    """(node, component) over all verified links between members of a bucket.

    ``members``: (key long, node long), one row per bucket and node; it is read several
    times, so it should come from a written table.  ``bodies`` takes nodes (node) and returns
    (node, size int, body), the size of a node's set and whatever ``alike`` compares, and may
    add the parities p0 ..; it is called once, for all members of buckets with several, and
    its result is staged.
    ``alike`` takes pairs (a, b, body_a, body_b) and returns those that are links (a, b),
    which have a Jaccard similarity of ``threshold`` or more.  ``elements`` turns rows of
    ``bodies`` into sets as ``reach`` reads them.

    Rounds: in every bucket one member, another one each round and (after the first) in each
    bucket, is the centre, and the members of other components are verified against it, which is linear in
    the bucket.  Pairs inside one component are never built: they can't change the result.
    Pairs whose sizes or parities (once there are any) exclude the threshold are dropped before
    a body is joined.  After the first round, if there are parities, the pairs of buckets with
    at most ``CROWDED`` members outside their largest component are verified at once, and the
    members of the buckets that still hold several components are counted by ``reach``: two sets that
    share at most m elements have at most the similarity m / (sizes - m).  Members that no
    partner can be similar enough to leave, pairs under the bound are not compared, and members
    with few elements of their own are the likelier centres.  In a group of copies with
    different edits that settles nearly all pairs.
    The rounds end when what is left to compare (members outside a bucket's largest
    component, against the members of its other components) is no more than a few pairs per
    member, or when a round found no link; those pairs are then verified too, so no link
    between two members of a bucket is lost.
    """
    # most keys have one member: they are counted alone, in rows of two numbers
    shared = stage(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "buckets")
    placed = stage(members.join(checked_small(shared), "key"), "buckets")
    # buckets of the same members (by number and hash) are compared once
    once = stage(placed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                           F.min("node").alias("first"))
                 .groupBy("n", "x", "first").agg(F.min("key").alias("key")).select("key"), "buckets")
    several = stage(placed.join(checked_small(once), "key"), "buckets")
    discard(shared, placed, once)
    # similar sets repeat each other's elements beyond the reach of a weaker codec
    store = stage(bodies(checked_small(stage(several.select("node").distinct(), "buckets"))), "bodies", "zstd")
    sizes = store.select("node", "size")
    fields = ["comp", "size", "most"]
    several = several.join(checked_small(sizes), "node").select(
        "key", "node", F.col("node").alias("comp"), "size", F.col("size").alias("most"))
    found = bounds = None
    sketch = store.select("node", "size", *PARITIES) if PARITIES[0] in store.columns else None

    def plausible(pairs: DataFrame) -> DataFrame:
        """Staged pairs without those whose parities differ too much."""
        if sketch is None:
            return pairs
        marks = sketch.select("node", "size", F.array(*PARITIES))
        apart = " + ".join(f"bit_count(pa[{i}] ^ pb[{i}])" for i in range(len(PARITIES)))
        near = stage(pairs.join(marks.toDF("a", "na", "pa"), "a").join(marks.toDF("b", "nb", "pb"), "b")
                     .where(F.expr(f"(na + nb - ({apart})) / 2 * {1 + threshold} + 1e-9 >= {threshold} * (na + nb)"))
                     .select("a", "b"), "pairs")
        discard(pairs)
        return near

    def verify(pairs: DataFrame) -> DataFrame:
        mine, used = store, None
        if found is not None or sketch is not None:     # the first round may compare nearly all sets
            used = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "pairs")
            mine = store.join(checked_small(used), "node", "left_semi")
        more = stage(alike(pairs.join(mine.select(F.col("node").alias("a"), F.col("body").alias("body_a")), "a")
                           .join(mine.select(F.col("node").alias("b"), F.col("body").alias("body_b")), "b")
                           .select("a", "b", "body_a", "body_b")), "links")
        discard(used)
        return more

    def grow(pairs: DataFrame) -> int:
        nonlocal found
        ordered = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        ordered = plausible(stage(ordered, "pairs"))
        more = verify(ordered)
        discard(ordered)
        new = more.count()
        if new or found is None:
            old, found = found, stage(connected_components(more, before=found), "found")
            discard(old)
        discard(more)
        return new

    def possible(x: str, y: str):
        return F.expr(f"least({x}most, {y}most) * {1 + threshold} + 1e-9 >= {threshold} * ({x}size + {y}size)"
                      f" and least({x}size, {y}size) + 1e-9 >= {threshold} * greatest({x}size, {y}size)")

    def compare(rows: DataFrame) -> None:
        """Verify all pairs of different components in a bucket."""
        x, y = rows.alias("x"), rows.alias("y")
        rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
                      & (F.col("x.comp") != F.col("x.largest"))
                      & ((F.col("y.comp") == F.col("y.largest")) | (F.col("x.node") < F.col("y.node")))
                      & possible("x.", "y."))
        grow(rest.select(F.col("x.node").alias("x"), F.col("y.node").alias("y")))

    def place(rows: DataFrame) -> DataFrame:
        return (rows.select("key", "node", "size", "most").join(checked_small(found), "node", "left")
                .select("key", "node", F.coalesce("component", "node").alias("comp"), "size", "most"))

    def unsettled(placed: DataFrame):
        """The members of buckets that hold several components, and the numbers of pairs and rows."""
        counts = placed.groupBy("key", "comp").agg(F.count("*").alias("c"))
        state = stage(counts.groupBy("key").agg(F.sum("c").alias("n"), F.max("c").alias("c"),
                                                F.max_by("comp", F.struct("c", "comp")).alias("largest"))
                      .where("n > c"), "buckets")
        rows = stage(placed.join(checked_small(state.select("key", "largest", (F.col("n") - F.col("c")).alias("others"))), "key"),
                     "buckets")
        sums = state.agg(F.sum(F.expr("(n - c) * n")).alias("pairs"), F.sum("n").alias("rows")).first()
        discard(state)
        return rows, sums

    for step in range(STAR_ROUNDS):
        # one order for all buckets at first: members that share many of them get one centre, one pair
        salt = F.xxhash64("key", F.lit(step)) if step else F.lit(0)
        weight = (F.col("size") - F.col("most") + 1) * (1 + F.pmod(F.xxhash64("node", salt), F.lit(16)))
        centre = several.groupBy("key").agg(F.min_by(F.struct("node", *fields), F.struct(
            weight, F.xxhash64("node", salt))).alias("centre"))
        pairs = several.join(centre, "key").where("node <> centre.node and comp <> centre.comp").where(
            possible("", "centre."))
        new = grow(pairs.select(F.col("node").alias("x"), F.col("centre.node").alias("y")))
        placed = place(several)
        if bounds is None:                  # a bucket of two was settled by the first round
            placed = placed.join(several.groupBy("key").agg(F.count("*").alias("n")).where("n > 2").select("key"), "key")
        old = several if step else None         # the first one is a projection of a staged table
        several, left = unsettled(placed)
        discard(old)
        if left["rows"] and bounds is None and sketch is not None:
            compare(several.where(f"others <= {CROWDED}"))
            old = several
            several, left = unsettled(place(several.where(f"others > {CROWDED}")))
            discard(old)
        if left["rows"] and bounds is None:
            rest = checked_small(stage(several.select("node").distinct(), "buckets"))
            bounds = reach(elements(store.join(rest, "node", "left_semi")), sizes.join(rest, "node", "left_semi"))
            if sketch is None:
                sketch = bounds
            old = several
            several, left = unsettled(several.select("key", "node", "comp").join(bounds.select("node", "size", "most"), "node")
                                      .where(f"most + 1e-9 >= {threshold} * size")
                                      .select("key", "node", "comp", "size", "most"))
            discard(old)
        if not left["rows"]:
            return found
        if step and (not new or left["pairs"] <= FEW_PAIRS * left["rows"]):
            break
    compare(several)
    return found
