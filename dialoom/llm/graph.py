"""Connected components of a distributed edge list, by DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.storage import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for each node of an edge list (a, b): the least node that it can reach.

    Each round gives a node the least label of its neighbours, then the label's own label (pointer jumping), so the
    rounds grow with the logarithm of the diameter. Labels and edges are tables of their own, so that a hub's rows can
    be split between tasks; minima are aggregated before the shuffle. The driver sees one count per round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.save(both.where("a <> b"), "edges")
    labels = scratch.save(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a, "left").select("node", "label", F.least("label", "near").alias("next"))
        over = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        jumped = step.join(over, step.next == over.n2, "left").select("node", F.least("next", F.coalesce("l2", "next")).alias("new"), "label")
        done = scratch.save(jumped, "labels")
        changed = done.where("new <> label").limit(1).count()
        if not changed:
            scratch.drop(both)
            return done.select("node", F.col("new").alias("component"))
        scratch.drop(labels)
        path = done.scratch_path
        labels = done.select("node", F.col("new").alias("label"))
        labels.scratch_path = path


def bucket_components(banded: DataFrame, linked: Callable[[DataFrame], DataFrame], scratch: Scratch, refined: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, component) of the links between nodes that share a bucket; nodes without links are left out.

    ``banded`` has a row (bucket, node) for each bucket of a node, ``linked`` gives a table of those of the pairs (a, b)
    that are links. Each bucket first compares its members with one of them, the one that meets most nodes in all its buckets: of
    near copies, that is the text they were made from, or the copy closest to it. What lies in different components
    after that is compared as well, so every pair of a bucket has been compared or lies in one component, while a
    bucket of n near copies of one text costs about n comparisons.

    ``refined`` gives a table of other buckets for those in several components, (bucket, hub, node, component), in which every pair
    of such a bucket that can be a link meets again. It is asked once, so that texts that are alike but not alike enough
    part ways before they are compared one by one.
    """
    shared, links, found = _stars(banded, None, linked, scratch)
    torn = _torn(shared, found, scratch)
    if refined is not None and torn.limit(1).count():
        finer = refined(torn)
        scratch.drop(torn)
        shared, more, found = _stars(finer, links, linked, scratch, found)
        scratch.drop(finer)
        links = scratch.save(links.unionByName(more), "links")
        torn = _torn(shared, found, scratch)
    sizes = torn.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = scratch.save(sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("m")).select("bucket", F.col("m.component").alias("main")), "largest")
    # two nodes may share many buckets: they meet in the least of them alone
    owned = torn.where("node <> hub").groupBy("node").agg(F.collect_list("bucket").alias("own"))
    sides = torn.where("node <> hub").join(largest, "bucket").join(owned, "node")
    sides = scratch.save(sides.select("bucket", "node", "component", (F.col("component") != F.col("main")).alias("out"), "own"), "sides")
    outside = scratch.save(sides.where("out").select("bucket", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("own").alias("ox")), "outside")
    once = F.array_min(F.array_intersect("own", "ox")) == sides["bucket"]
    across = sides.join(outside, (sides["bucket"] == outside["bucket"]) & F.expr("component <> cx and (not out or node < x)") & once)
    across = across.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()
    more = linked(scratch.save(across, "across"))
    scratch.drop(torn, sides, outside)
    return components(links.unionByName(more), scratch)


def _stars(banded: DataFrame, before: DataFrame | None, linked: Callable[[DataFrame], DataFrame], scratch: Scratch, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bucket, node, hub) of buckets with company; the links between members and hubs; the components of all links.
    Pairs known to lie in one component are not compared again."""
    sizes = scratch.save(banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = scratch.save(banded.join(sizes, "bucket"), "shared")
    met = scratch.save(shared.groupBy("node").agg(F.sum("n").alias("met")), "met")
    hubs = scratch.save(shared.join(met, "node").groupBy("bucket").agg(F.max_by("node", "met").alias("hub")), "hubs")
    crowded = scratch.save(shared.drop("n").join(hubs, "bucket"), "crowded")
    scratch.drop(sizes, shared, met, hubs)
    pairs = crowded.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    if known is not None:
        ends = [known.withColumnsRenamed({"node": x, "component": f"c{x}"}) for x in ("a", "b")]
        placed = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
        pairs = placed.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    pairs = scratch.save(pairs, "pairs")
    links = linked(pairs)
    scratch.drop(pairs)
    return crowded, links, components(links if before is None else before.unionByName(links), scratch)


def _torn(shared: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(bucket, hub, node, component) of the buckets whose members, hub aside, may hold pairs not compared yet. It takes
    the place of ``shared``, which is dropped."""
    placed = scratch.save(shared.join(found, "node", "left").select("bucket", "hub", "node", F.coalesce("component", "node").alias("component")), "placed")
    torn = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo < hi and n > 2").select("bucket")
    torn = scratch.save(torn, "torn")
    rest = scratch.save(placed.join(torn, "bucket", "left_semi"), "rest")
    scratch.drop(shared, placed, torn)
    return rest
