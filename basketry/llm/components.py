"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import split_join, staged


def _core(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of staged edges (a, b).

    Every round, a node takes the smallest name among its own and its neighbours', then the name
    of that node, which halves paths. Rounds end when no name changes. Each round is written to the
    shared folder. Neighbours are reduced by a minimum before they are shuffled.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    names = both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component"))
    while True:
        names = staged(names, "names")
        own = names.select(F.col("node").alias("b"), F.col("component").alias("near"))
        nearest = both.join(own, "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = staged(
            names.join(nearest, names["node"] == nearest["a"], "left")
            .select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")), "names")
        target = lower.select(F.col("node").alias("component"), F.col("component").alias("end"))
        jumped = staged(lower.join(target, "component", "left").select(
            "node", "old", F.least("component", "end").alias("component")), "names")
        names = jumped.select("node", "component")
        if jumped.filter("component <> old").isEmpty():
            return names


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); a component is named by its smallest node.

    The graph is contracted before its names are spread. Every node keeps one edge, to its smallest
    neighbour below it; its other edges downwards become edges from those neighbours to the smallest one,
    of which equal ones are one. So a node that is nobody's smaller neighbour, as most members of a large
    group are, has one edge in all: it takes no part in the rounds and gets its name at the end.
    """
    down = staged(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    least = staged(down.groupBy("a").agg(F.min("b").alias("least")), "least")
    leaders = staged(down.select(F.col("b").alias("a")).distinct(), "leaders")
    others = split_join(down, least, ["a"]).filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    core = _core(staged(
        least.join(leaders, "a", "left_semi").select("a", F.col("least").alias("b")).unionByName(others).distinct(), "core"))
    named = staged(
        leaders.join(core, leaders["a"] == core["node"], "left")
        .select("a", F.coalesce("component", "a").alias("component")), "leaders")
    leaves = least.join(leaders, "a", "left_anti").select(F.col("a").alias("node"), F.col("least").alias("a"))
    return split_join(leaves, named, ["a"]).select("node", "component").unionByName(
        named.select(F.col("a").alias("node"), "component"))
