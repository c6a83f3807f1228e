"""From candidate buckets to classes: verified links without all pairs, then components.

A bucket holds nodes that share a band of their signatures. Comparing every pair of a bucket
grows with its square, so pairs are compared only as far as they can change the classes:

1. every member is compared with the bucket's leader (its smallest node);
2. members that fail are compared with a few pivots: the most central members that passed (the
   most similar to the leader, with a little noise). One link is enough, since the members
   that passed are already connected through the leader;
3. in buckets of at most ``SMALL`` nodes, members that still fail are compared with one another
   and with all that passed whose distance to the leader allows a link: 1 - similarity obeys
   the triangle inequality for (weighted) Jaccard similarities, so |d(x, leader) - d(y, leader)|
   <= 1 - threshold is necessary;
4. the members of larger buckets in which some failed go through an exact similarity join with
   a prefix filter (``across_keys``), which loses no pair of them, whatever buckets they share.

So two nodes of one bucket that are similar enough end in one class, a hot bucket of n alike nodes
costs about n comparisons, and one of n unlike nodes that share a passage meets only where
two of them share one of their rarest shingles. There are no rounds: at most three sets of
pairs are compared, each written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristar.session import write_stage

PIVOTS = 4
SMALL = 64
BLOCK = 512   # rows of a side that one salted block of a frequent key holds


def tune_bands(threshold: float, recall: float, rows: int) -> int:
    """Fewest bands of ``rows`` values that find a pair at the threshold with this recall."""
    bands = 1
    while 1 - (1 - threshold ** rows) ** bands < recall:
        bands += 1
    return bands


def _shared(members: DataFrame) -> DataFrame:
    """Members of buckets with two nodes or more, with the bucket's leader."""
    size = (members.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last"),
                                          F.count("*").alias("size"))
            .filter("leader != last").drop("last"))
    return members.join(size, "bucket")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def across_keys(keys: DataFrame, threshold: float, name: str) -> DataFrame:
    """(a, b): candidate pairs of nodes with different ``anchor``, among them every pair of at
    least this similarity.

    ``keys`` has (node, key, rest, total, anchor): the elements of each node's prefix, ``rest``
    the weight of this element and all after it in the common order, ``total`` the weight
    of the whole set. The least element that two sets share bounds what they share by the
    smaller ``rest``, so a pair stays only if that can be enough at one of its keys.

    Nodes of one anchor are connected already. Of each key, the nodes of its most frequent
    anchor are therefore only met by the others, and a key with one anchor meets nothing.
    Frequent keys are cut into blocks of about ``BLOCK`` by ``BLOCK`` rows."""
    each = keys.groupBy("key", "anchor").agg(F.count("*").alias("n"))
    many = (each.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "anchor")).alias("top"))
            .filter("size > top.n")
            .select("key", F.col("top.anchor").alias("top"),
                    F.ceil((F.col("size") - F.col("top.n")) / BLOCK).alias("lefts"),
                    F.ceil(F.col("size") / BLOCK).alias("rights")))
    met = write_stage(keys.join(many, "key"), f"{name}-keys")
    last = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    left = (met.filter("anchor != top")
            .withColumn("i", F.pmod(F.xxhash64("node"), F.col("lefts")))
            .withColumn("j", F.explode(last("rights")))
            .select("key", "i", "j", "top", F.col("node").alias("x"), F.col("anchor").alias("ax"),
                    F.col("rest").alias("rx"), F.col("total").alias("tx")))
    right = (met.withColumn("j", F.pmod(F.xxhash64("node"), F.col("rights")))
             .withColumn("i", F.explode(last("lefts")))
             .select("key", "i", "j", F.col("node").alias("y"), F.col("anchor").alias("ay"),
                     F.col("rest").alias("ry"), F.col("total").alias("ty")))
    return (left.join(right, ["key", "i", "j"])
            .filter("ax != ay AND (ay = top OR x < y)")
            .filter(F.least("rx", "ry") * (1 + threshold)
                    >= (F.col("tx") + F.col("ty")) * (threshold * (1 - 1e-6)))
            .select(*_pair("x", "y")).distinct())


def link(members: DataFrame, compare: Callable[[DataFrame], DataFrame], threshold: float,
         name: str, prefixes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): verified links. ``members``: distinct (bucket, node); ``compare`` adds ``sim`` to
    distinct pairs (a, b); ``prefixes(nodes)`` gives (node, key, rest, total) of nodes, see
    ``across_keys``."""
    shared = write_stage(_shared(members), f"{name}-buckets")

    def verify(pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """Compares the pairs that are not known yet; returns them with the known ones."""
        pairs = pairs.select("a", "b").distinct()
        if known is not None:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        # Written first: their nodes are read again to sieve the texts.
        found = write_stage(compare(write_stage(pairs, f"{name}-candidates")), f"{name}-pairs")
        return found if known is None else known.unionByName(found)

    followers = shared.filter("node != leader")
    known = verify(followers.select(F.col("leader").alias("a"), F.col("node").alias("b")))
    status = write_stage(followers.join(
        known.select(F.col("a").alias("leader"), F.col("b").alias("node"), "sim"),
        ["leader", "node"]), f"{name}-status")
    passed, failed = status.filter(F.col("sim") >= threshold), status.filter(F.col("sim") < threshold)
    # Failed members close enough to the leader that a passed one may still be similar.
    close = failed.filter(F.col("sim") >= 2 * threshold - 1)
    pivots = passed.groupBy("bucket").agg(*(
        F.max_by("node", F.col("sim") + 0.02 * i * F.pmod(F.xxhash64("node", F.lit(i)), 1024)
                 / 1024).alias(f"p{i}") for i in range(PIVOTS)))
    tried = (close.join(pivots, "bucket")
             .select("bucket", "node",
                     F.explode(F.array_distinct(F.array(*(f"p{i}" for i in range(PIVOTS)))))
                     .alias("pivot"))
             .select("bucket", "node", *_pair("node", "pivot")))
    known = verify(tried, known)
    done = write_stage(tried.join(known, ["a", "b"]).filter(F.col("sim") >= threshold)
                       .select("bucket", "node").distinct(), f"{name}-attached")
    settled = passed.unionByName(failed.join(done, ["bucket", "node"], "left_semi"))

    few = failed.filter(F.col("size") <= SMALL)
    among = (few.select("bucket", F.col("node").alias("a"))
             .join(few.select("bucket", F.col("node").alias("b")), "bucket").filter("a < b"))
    others = settled.filter(F.col("size") <= SMALL).select(
        "bucket", F.col("node").alias("other"), F.col("sim").alias("other_sim"))
    inside = (close.filter(F.col("size") <= SMALL).join(done, ["bucket", "node"], "left_anti")
              .join(others, "bucket")
              .filter(F.abs(F.col("sim") - F.col("other_sim")) <= 1 - threshold))
    pairs = among.select("a", "b").unionByName(inside.select(*_pair("node", "other")))

    open_buckets = (failed.filter(F.col("size") > SMALL).join(done, ["bucket", "node"], "left_anti")
                    .select("bucket").distinct())
    anchors = settled.groupBy("node").agg(F.min("leader").alias("anchor"))
    open_nodes = write_stage(
        shared.join(open_buckets, "bucket", "left_semi").select("node").distinct()
        .join(anchors, "node", "left").select("node", F.coalesce("anchor", "node").alias("anchor")),
        f"{name}-open")
    if not open_nodes.isEmpty():
        keys = write_stage(prefixes(open_nodes.select("node")).join(open_nodes, "node"),
                           f"{name}-prefixes")
        pairs = pairs.unionByName(across_keys(keys, threshold, name))
    return verify(pairs, known).filter(F.col("sim") >= threshold).select("a", "b")


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node of each connected component, for all nodes with a
    link. Alternating large-star and small-star steps; every step only groups by node for a
    minimum (combined map-side) and joins it back, so a hub is no hot group."""
    edges = write_stage(links.filter("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-edges")
    while True:
        centers = edges.select(F.col("v").alias("u")).distinct()
        counts = edges.agg(F.count("*").alias("n"), F.count_distinct("u").alias("u")).first()
        if counts["n"] == counts["u"] and edges.join(centers, "u", "left_semi").isEmpty():
            break  # every edge leads to its component's center: a forest of stars
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = write_stage(small, f"{name}-edges")
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
                            .distinct())
