"""Consensus trees from splits: majority rule and greedy, as a table of nodes and as a Newick string.

Trees are compared on the tips that all of them have. A split is known by the side without the least tip, its cluster, as
sums of tip hashes (splits.py), and every cluster remembers one node of one tree that has it. Clusters of more than half
of the trees are compatible. The greedy tree adds rarer ones, most frequent first, where they cross none taken before: a
cluster is taken once no undecided one that it crosses comes earlier, and puts out those that it crosses, so that each
round decides many; rounds are written. Two clusters cross if they share tips and neither holds the other, which counts of
shared tips tell, joined on the tip. Compatible clusters are nested: a cluster's parent is the smallest one above it that
holds its least tip.

Defined cases: no trees, or under four common tips, give no clusters and a star; equally frequent clusters go by size, the
larger first, then by hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import saved
from .newick import _name
from .splits import clade_sums, leaves, rest


def common_tips(nodes: DataFrame) -> DataFrame:
    """tip: the labels that every tree has."""
    n = nodes.agg(F.count_distinct("tree_id").alias("trees"))  # one row
    return leaves(nodes).groupBy("tip").agg(F.count(F.lit(1)).alias("k")).crossJoin(F.broadcast(n)).where("k = trees").select("tip")


def clusters(nodes: DataFrame, common: DataFrame) -> DataFrame:
    """cluster, support (share of trees), tree_id, node_id, last, outside (is it what the node doesn't hold) of each cluster of two tips or more, and as many others."""
    shared = common.select(F.col("tip").alias("label"), F.lit(True).alias("kept"))
    marked = nodes.join(shared, "label", "left")
    held = clade_sums(marked, ["tree_id"], F.coalesce("kept", F.lit(False))).where("parent_id is not null and clade.n >= 2 and whole.n - clade.n >= 2")
    least = common.agg(F.min("tip").alias("label"))  # one row
    at = nodes.where("is_leaf").join(F.broadcast(least), "label").groupBy("tree_id").agg(F.min("node_id").alias("least"))
    found = held.join(nodes.select("tree_id", "node_id", "last"), ["tree_id", "node_id"]).join(at, "tree_id").withColumn("outside", F.col("least").between(F.col("node_id"), F.col("last")))
    side = F.when(F.col("outside"), rest(F.col("whole"), F.col("clade"))).otherwise(F.col("clade")).alias("cluster")
    one = found.select("tree_id", "node_id", "last", "outside", side).groupBy("cluster").agg(F.count_distinct("tree_id").alias("k"), F.min(F.struct("tree_id", "node_id", "last", "outside")).alias("of"))
    n = nodes.agg(F.count_distinct("tree_id").alias("trees"))
    return one.crossJoin(F.broadcast(n)).select("cluster", (F.col("k") / F.col("trees")).alias("support"), "of.*")


def members(chosen: DataFrame, nodes: DataFrame, common: DataFrame) -> DataFrame:
    """cluster, tip: what each cluster holds, from the tree that it remembers."""
    tips = nodes.where("is_leaf").join(common.withColumnRenamed("tip", "label"), "label").select("tree_id", F.col("node_id").alias("leaf"), F.col("label").alias("tip"))
    inside = F.col("leaf").between(F.col("node_id"), F.col("last"))
    return chosen.join(tips, "tree_id").where(inside != F.col("outside")).select("cluster", "tip")


def majority(found: DataFrame, share: float = 0.5) -> DataFrame:
    """The clusters of more than `share` (a half or more) of the trees."""
    if share < 0.5:
        raise ValueError("below a half clusters may cross: use greedy()")
    return found.where(F.col("support") > share)


def greedy(found: DataFrame, nodes: DataFrame, common: DataFrame, least: float = 0.0) -> DataFrame:
    """The clusters of more than `least` of the trees that the greedy consensus takes."""
    found = saved(found.where(F.col("support") > least), "clusters")
    rank = F.struct(-F.col("support"), -F.col("cluster.n"), F.col("cluster"))
    held = members(found, nodes, common).join(found.select("cluster", rank.alias("rank")), "cluster")
    x, y = (held.select(F.col("cluster").alias(c), F.col("rank").alias(f"r{c}"), "tip") for c in "xy")
    # of two clusters the later one may be put out; two of the majority never cross
    both = x.join(y, "tip").where((F.col("rx") < F.col("ry")) & (F.col("ry.col1") >= -0.5)).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    crossing = saved(both.where((F.col("n") < F.col("x.n")) & (F.col("n") < F.col("y.n"))).select("x", "y"), "crossing")
    out = found.select("cluster").limit(0)
    while not crossing.isEmpty():
        first = crossing.select(F.col("x").alias("c")).distinct().join(crossing.select(F.col("y").alias("c")).distinct(), "c", "left_anti")
        lost = saved(crossing.join(first, F.col("x") == F.col("c"), "left_semi").select(F.col("y").alias("cluster")).distinct(), "lost")
        out = saved(out.unionByName(lost), "out")
        gone = lost.withColumnRenamed("cluster", "c")
        crossing = saved(crossing.join(gone, F.col("x") == F.col("c"), "left_anti").join(gone, F.col("y") == F.col("c"), "left_anti"), "crossing")
    return found.join(out, "cluster", "left_anti")


def assembled(chosen: DataFrame, nodes: DataFrame, common: DataFrame) -> DataFrame:
    """name, parent, support, is_leaf of the tree of nested clusters: leaves by label, clusters by a hash, the root `root`."""
    name = F.sha2(F.concat_ws(":", "cluster.n", "cluster.h1", "cluster.h2", "cluster.h3"), 256)
    chosen = chosen.select("*", name.alias("name"))
    held = members(chosen, nodes, common).join(chosen.select("cluster", "name"), "cluster").select("name", F.col("cluster.n").alias("n"), "tip")
    above = held.select(F.col("name").alias("parent"), F.col("n").alias("size"), "tip")
    first = held.groupBy("name", "n").agg(F.min("tip").alias("tip"))
    inner = first.join(above, "tip").where("size > n").groupBy("name").agg(F.min_by("parent", "size").alias("parent"))
    inner = chosen.select("name", "support").join(inner, "name", "left").select("name", F.coalesce("parent", F.lit("root")).alias("parent"), "support", F.lit(False).alias("is_leaf"))
    tips = common.join(above.groupBy("tip").agg(F.min_by("parent", "size").alias("parent")), "tip", "left")
    tips = tips.select(F.col("tip").alias("name"), F.coalesce("parent", F.lit("root")).alias("parent"), F.lit(None).cast("double").alias("support"), F.lit(True).alias("is_leaf"))
    return inner.unionByName(tips)


def as_newick(tree: DataFrame, digits: int = 3) -> DataFrame:
    """newick: one row with the whole string, children in order of their least tip, inner labels the support. Made in one task, as one string is one row."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        below: dict = {}
        for r in rows.itertuples():
            below.setdefault(r.parent, []).append(r)
        said: dict = {}  # (least tip, text) of each node
        stack = [("root", False)]
        while stack:
            name, ready = stack.pop()
            if not ready:
                stack.append((name, True))
                stack += [(c.name, False) for c in below.get(name, []) if not c.is_leaf]
                continue
            parts = sorted((c.name, _name(c.name)) if c.is_leaf else (said[c.name][0], said[c.name][1] + f"{c.support:.{digits}f}") for c in below.get(name, []))
            said[name] = (parts[0][0] if parts else "", "(" + ",".join(p for _, p in parts) + ")")
        return pd.DataFrame({"newick": [said["root"][1] + ";"]})

    return tree.groupBy().applyInPandas(run, "newick string")
