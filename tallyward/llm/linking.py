"""Connected components from candidate groups that may be very large.

A group is all nodes that share a key. Its pairs are never listed: every member first meets one
representative, and only members that stay apart from the group's main component meet the others.
Two nodes of a group that end in one component need no check, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.session import materialise

Verify = Callable[[DataFrame], DataFrame]
Admit = Callable[[Column, Column], Column]


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the ends of ``(a, b)`` edges; a component is its smallest node.

    Each round gives every node the smallest label around it and then that label's own label, so
    long chains halve. Rounds go on until nothing changes. Labels are written each round.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.filter("a <> b").distinct(), "edges")
    labels = materialise(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")),
        "labels",
    )
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(around, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        moved = materialise(
            step.join(jump, "mid", "left").select(
                "node", F.least("mid", F.coalesce("far", "mid")).alias("component"), "old"
            ),
            "labels",
        )
        if moved.filter("component <> old").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")


def shared_groups(groups: DataFrame) -> DataFrame:
    """Distinct ``(key, node)`` of the keys with several nodes, and the ``size`` of each; written.

    Counting folds before the shuffle, and rows of a frequent key are matched by a join that can
    be split, so neither gathers a key in one task.
    """
    spread = groups.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    several = materialise(spread.filter("least <> most").select("key"), "shared-keys")
    found = materialise(groups.join(several, "key", "left_semi").distinct(), "shared")
    sizes = materialise(found.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "sizes")
    return materialise(found.join(sizes, "key"), "groups")


def link(shared: DataFrame, verify: Verify, refine: Verify | None = None, admit: Admit | None = None) -> DataFrame:
    """``(node, component)`` of all nodes that verified links within the groups connect.

    ``shared`` comes from ``shared_groups``; ``verify`` takes distinct candidate pairs ``(a, b)``,
    a < b, and returns those that are links. ``refine`` may give narrower groups ``(key, node)`` for
    nodes whose groups did not end in one component; any two of them that are linked must share one.
    These may tell more ``about`` a node's place in a group, from which ``admit`` says of two members
    whether they can be linked: at least one group of any two that are must admit them.
    """
    # The member that meets most others is the best one to compare all with.
    fame = shared.groupBy("node").agg(F.sum("size").alias("fame"))
    first = (
        shared.join(fame, "node")
        .groupBy("key")
        .agg(F.max_by("node", F.struct("fame", "node")).alias("first"))
    )
    seen = _pairs(shared.join(first, "key").select(F.col("node").alias("a"), F.col("first").alias("b")))
    seen = materialise(seen, "pairs")
    labels = components(materialise(verify(seen), "links"))
    mixed = _mixed(shared, labels)
    allowed = F.lit(True)
    if refine:
        narrow = shared_groups(refine(materialise(mixed.select("node").distinct(), "apart")))
        mixed = _mixed(narrow, labels)
        if admit:
            allowed = admit(F.col("about_a"), F.col("about_b"))
    if "about" not in mixed.columns:
        mixed = mixed.withColumn("about", F.lit(0))
    # Members that stay apart meet one of the main component in each group, another one in each, so
    # that hardly any is left for the comparison with all.
    apart = mixed.filter("component <> main")
    chosen = mixed.filter("component = main").groupBy("key").agg(
        F.max_by(F.struct("node", "about"), F.xxhash64("key", "node")).alias("chosen")
    )
    chosen = chosen.select("key", F.col("chosen.node").alias("b"), F.col("chosen.about").alias("about_b"))
    met = apart.select("key", F.col("node").alias("a"), F.col("about").alias("about_a")).join(chosen, "key")
    pairs = _pairs(met.filter(allowed).select("a", "b"))
    pairs = materialise(pairs.join(seen, ["a", "b"], "left_anti"), "pairs")
    labels, grown = _grow(labels, verify(pairs))
    if grown:
        mixed = _mixed(mixed.select("key", "node", "about"), labels)
    others = mixed.filter("component <> main")
    others = others.select("key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("about").alias("about_a"))
    rest = mixed.select("key", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("about").alias("about_b"))
    rest = others.join(rest, "key").filter((F.col("ca") != F.col("cb")) & allowed)
    rest = _pairs(rest.select("a", "b")).join(seen.union(pairs), ["a", "b"], "left_anti")
    return _grow(labels, verify(materialise(rest, "pairs")))[0]


def _grow(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """Components with more links, and whether there are any more."""
    links = materialise(links, "links")
    if links.isEmpty():
        return labels, False
    known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(links)), True


def _mixed(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, node, component, main)`` of the groups that have several components, and ``about``."""
    also = [c for c in groups.columns if c == "about"]
    placed = groups.join(labels, "node", "left").select(
        "key", "node", *also, F.coalesce("component", "node").alias("component")
    )
    placed = materialise(placed, "placed")
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = (
        parts.groupBy("key")
        .agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"))
        .filter("parts > 1")
        .select("key", "main")
    )
    return materialise(placed.join(main, "key"), "mixed")


def _pairs(pairs: DataFrame) -> DataFrame:
    return (
        pairs.filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
