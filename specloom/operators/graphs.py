"""Closures over edge tables, level by level: each level is one join of the frontier with the edges and one anti-join with what was reached."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import cut


def closure(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``seed, node, depth``: all nodes reachable from each seed, at their least depth; a seed reaches itself at 0.

    ``edges`` has ``parent, child``, ``seeds`` has ``node``. Cycles end by the anti-join, so levels go on until one is empty; a ``max_depth``
    below the last level raises. Lineage is cut at every level. Null ends are no edges.
    """
    links = cut(edges.where("parent IS NOT NULL AND child IS NOT NULL").select("parent", "child").distinct())
    frontier = cut(seeds.where("node IS NOT NULL").select(F.col("node").alias("seed"), "node").distinct().withColumn("depth", F.lit(0)))
    reached, depth = frontier, 0
    while True:
        depth += 1
        step = frontier.join(links, frontier["node"] == links["parent"]).select("seed", F.col("child").alias("node")).distinct()
        frontier = cut(step.join(reached, ["seed", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return reached
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"nodes beyond depth {max_depth}")
        reached = reached.unionByName(frontier)
        if depth % 16 == 0:
            reached = cut(reached)


def ancestors(parents: DataFrame) -> DataFrame:
    """``node, root, hops, in_cycle``: the end of each node's chain of parents, by pointer doubling.

    ``parents`` has ``node, parent``; of several parents the smallest counts. A null parent makes a root; a parent that is no node ends the
    chain and is its root. A chain of n hops takes log2(n) joins; what still moves after as many doublings as the number of nodes
    needs is in a cycle or leads into one, and has null root and hops.
    """
    own = parents.where("node IS NOT NULL").groupBy("node").agg(F.min("parent").alias("parent"))
    at = cut(own.select("node", F.coalesce("parent", "node").alias("up"), F.col("parent").isNotNull().cast("long").alias("hops"), F.col("parent").isNull().alias("done")))
    for _ in range(max(at.count(), 1).bit_length() + 1):
        if at.where("NOT done").isEmpty():
            break
        target = at.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("hops").alias("more"), F.col("done").alias("ends"))
        moved = at.where("NOT done").join(target, "up", "left").select(
            "node", F.coalesce("next", "up").alias("up"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.coalesce("ends", F.lit(True)).alias("done")
        )
        at = cut(at.where("done").unionByName(moved))
    return at.select("node", F.when(F.col("done"), F.col("up")).alias("root"), F.when(F.col("done"), F.col("hops")).alias("hops"), (~F.col("done")).alias("in_cycle"))


def prefix_nodes(paths: DataFrame, path: str, separator: str = "/") -> DataFrame:
    """``node, name, parent, depth``: every prefix of each path once, as a taxonomy."""
    parts = F.filter(F.split(F.col(path), separator), lambda p: p != "")
    depths = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts)))
    spread = paths.select(parts.alias("parts"), F.explode(depths).alias("depth"))
    node = lambda d: F.array_join(F.slice("parts", F.lit(1), d), separator)
    return spread.select(
        node(F.col("depth")).alias("node"), F.element_at("parts", F.col("depth")).alias("name"),
        F.when(F.col("depth") > 1, node(F.col("depth") - 1)).alias("parent"), "depth",
    ).distinct()


def nearest_ancestor(paths: DataFrame, path: str, pages: DataFrame, separator: str = "/") -> DataFrame:
    """``path, ancestor``: the longest proper prefix of each path that has a page (``pages`` has ``node``); null where none has."""
    parts = F.filter(F.split(F.col("path"), separator), lambda p: p != "")
    prefixes = paths.select(F.col(path).alias("path")).distinct().select(
        "path", F.explode_outer(F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), separator).alias("node"))))).alias("p")
    )
    known = pages.select("node").distinct().withColumn("found", F.lit(True))
    hit = prefixes.select("path", "p.depth", "p.node").join(known, "node", "left")
    return hit.groupBy("path").agg(F.max_by("node", F.when(F.col("found"), F.col("depth"))).alias("ancestor"))
