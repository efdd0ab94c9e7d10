"""Connected components and linking inside hash buckets, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import workspace
from .workspace import Workspace

#: Rounds in which bucket members are compared with one other member go on while more than this share of the comparisons links, so many times at most,
#: before what still stands apart is compared in full. Both only spare comparisons.
WORTHWHILE, STAR_ROUNDS = 0.05, 12


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(id, label) for every end of an edge (a, b): the smallest id that its links reach.

    Smallest labels spread over edges, and each label is replaced by its own label, so that the number of rounds
    grows with the logarithm of the longest path. Self-links and repeated links change nothing; no edges give no rows.
    """
    one = edges.where(F.col("a") != F.col("b")).select("a", "b")
    both = ws.save(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = ws.save(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label"), F.lit(True).alias("moved")), "labels")
    few = labels.count() <= workspace.SENT_ROWS  # the nodes stay the same in all rounds
    small = F.broadcast if few else (lambda rows: rows)
    while True:
        near = both.join(small(labels.select(F.col("id").alias("b"), "label")), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("m"))
        step = near.join(small(labels), "id").select("id", F.col("label").alias("old"), F.least("label", "m").alias("mid"))
        jump = labels.select(F.col("id").alias("mid"), F.col("label").alias("far"))
        nxt = step.join(small(jump), "mid").select("id", F.least("mid", "far").alias("label"), (F.least("mid", "far") != F.col("old")).alias("moved"))
        nxt = ws.save(nxt, "labels")
        ws.drop(labels)
        labels = nxt
        if labels.where("moved").isEmpty():
            ws.drop(both)
            return labels


def ordered(pairs: DataFrame) -> DataFrame:
    """(id, id2, comp, comp2) as distinct (a, b, hub, ca, cb) with a < b; the hub is the end that stands in more pairs, if any, id2."""
    first = F.col("id") < F.col("id2")
    named = pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"), F.col("id2").alias("hub"), F.when(first, F.col("comp")).otherwise(F.col("comp2")).alias("ca"), F.when(first, F.col("comp2")).otherwise(F.col("comp")).alias("cb"))
    return named.groupBy("a", "b", "ca", "cb").agg(F.min("hub").alias("hub"))


def _star(own: DataFrame, near: Callable[[Column, Column], Column] | None, r: int) -> DataFrame:
    """For each member (key, id, comp) at most one candidate of another component, out of the members that were drawn by hash to stand for its buckets in round r: in the first
    round that of most buckets, later one drawn by hash, so that a pair that isn't linked isn't taken again and again."""
    drawn = F.min(F.struct(F.xxhash64("id", F.lit(r)).alias("rank"), "id", "comp")).alias("c")
    hubs = own.groupBy("key").agg(drawn).select("key", F.col("c.id").alias("id2"), F.col("c.comp").alias("comp2"))
    pairs = own.join(hubs, "key").where("comp != comp2")
    if near is not None:
        pairs = pairs.where(near(F.col("id"), F.col("id2")))
    shared = pairs.groupBy("id", "comp", "id2", "comp2").agg(F.count(F.lit(1)).alias("n"))
    order = -F.col("n") if r == 0 else F.xxhash64("id", "id2", F.lit(r))
    best = shared.groupBy("id", "comp").agg(F.min(F.struct(order.alias("order"), "id2", "comp2")).alias("c"))
    return best.select("id", "c.id2", "comp", "c.comp2")


def link_buckets(
    ws: Workspace,
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    near: Callable[[Column, Column], Column] | None = None,
    exhaust: Callable[[DataFrame], DataFrame] | None = None,
    candidates: DataFrame | None = None,
    star_rounds: int = STAR_ROUNDS,
) -> DataFrame:
    """(id, label) of ids that verified links connect, given the members (key, id) of buckets, and further candidates (a, b), if any.

    verify takes distinct candidates (a, b) with a < b, and which of the two is the hub of a round, and returns (a, b) of those that are links; near, if given, is a condition on two ids that
    all links meet. Only links between different components change the result. So in each round a member is compared with at most one other, of
    those that stand for its buckets; a group of n copies costs about n comparisons, not n * n. At last all pairs that still
    stand in different components of a bucket are compared, without a cap: by exhaust, if given, which turns (key, id, comp) of the
    buckets with several components into links (a, b) of components.
    """
    labels: DataFrame | None = None
    mixed: DataFrame | None = None
    last = False
    for r in range(star_rounds + 1):
        last = last or r == star_rounds
        if labels is None:
            own = members.withColumn("comp", F.col("id"))
        else:
            own = members.join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("comp"))
            several = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
            old = mixed
            mixed = own = ws.save(own.join(several, "key", "left_semi"), "mixed")  # only fewer buckets are mixed later
            members = own.select("key", "id")
            if old is not None:
                ws.drop(old)
            if own.isEmpty():
                break
        if last and exhaust is not None:
            links = exhaust(own)
        else:
            if not last:
                pairs = _star(own, near, r)
            else:
                other = own.select(F.col("key").alias("key2"), F.col("id").alias("id2"), F.col("comp").alias("comp2"))
                pairs = own.join(other, (F.col("key") == F.col("key2")) & (F.col("comp") < F.col("comp2")) & (near(F.col("id"), F.col("id2")) if near is not None else F.lit(True))).select("id", "id2", "comp", "comp2")
            pairs = ordered(pairs)
            if r == 0 and candidates is not None:
                pairs = pairs.unionByName(candidates.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"), F.col("a").alias("hub"))).dropDuplicates(["a", "b"])
            pairs = ws.save(pairs, "pairs")
            links = verify(pairs.select("a", "b", "hub")).join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        links = ws.save(links, "links")
        found = links.count()
        done = last
        last = last or found <= WORTHWHILE * pairs.count()
        if not (done and exhaust is not None):
            ws.drop(pairs)
        if found:
            merged = connected_components(ws, links).select("id", "label")
            labels = merged if labels is None else _relabelled(ws, labels, merged)
        ws.drop(links)
        if done:
            break
    if mixed is not None:
        ws.drop(mixed)
    return members.select("id", F.col("id").alias("label")).limit(0) if labels is None else labels


def _relabelled(ws: Workspace, labels: DataFrame, merged: DataFrame) -> DataFrame:
    """Labels of all ids, given those so far and the new labels of components."""
    old = labels.join(merged.select(F.col("id").alias("label"), F.col("label").alias("new")), "label", "left").select("id", F.coalesce("new", "label").alias("label"))
    return ws.save(old.unionByName(merged.join(labels, "id", "left_anti")), "labels")
