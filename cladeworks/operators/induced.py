"""Trees on some of their tips: what is left when the other tips go and nodes with one child are passed over, lengths summed.

On preorder intervals an induced tree needs no walk. Between two kept leaves that follow each other lies their last common
ancestor, above the shallowest node there; these ancestors are all inner nodes of the induced tree. A node's parent is the
deeper of the ancestors that its first kept leaf has with the kept leaf before and its last one with the kept leaf after. A
branch's length is the difference of two distances from the root, which are sums of lengths entered less lengths left. So
a tree costs a few windows and joins over its nodes, whatever its depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .splits import clade_sums


def sums_from_root(nodes: DataFrame, value: Column, name: str) -> DataFrame:
    """tree_id, node_id and the sum of a value over the node and those above it: what was entered less what was left before."""
    order = Window.partitionBy("tree_id").orderBy("node_id")
    valued = nodes.select("tree_id", "node_id", "last", value.alias("value"))
    closed = valued.groupBy("tree_id", F.col("last").alias("node_id")).agg(F.sum("value").alias("closed"))  # left after this node
    entered = F.sum("value").over(order.rowsBetween(Window.unboundedPreceding, 0))
    left = F.sum(F.coalesce("closed", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return valued.join(closed, ["tree_id", "node_id"], "left").select("tree_id", "node_id", (entered - F.coalesce(left, F.lit(0))).alias(name))


def induced_trees(nodes: DataFrame, kept: DataFrame) -> DataFrame:
    """tree_id and NODES of each tree on its kept tips (tree_id, tip).

    The first node has no parent and no length. A tree without a kept tip has no rows, one with a single tip is that tip.
    Lengths are null in trees without any; elsewhere a missing one counts as 0.
    """
    wanted = kept.select("tree_id", F.col("tip").alias("label"), F.lit(True).alias("kept")).distinct()
    flagged = nodes.join(wanted, ["tree_id", "label"], "left").withColumn("kept", F.col("is_leaf") & F.col("kept").isNotNull())
    order = Window.partitionBy("tree_id").orderBy("node_id")
    before = F.coalesce(F.sum(F.col("kept").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    ranked = flagged.withColumn("rank", before)  # kept leaves before the node
    # a kept leaf, with the ancestor that it shares with the kept leaf before it
    gaps = ranked.groupBy("tree_id", "rank").agg(F.max(F.when(F.col("kept"), F.col("node_id"))).alias("leaf"), F.min_by("parent_id", "depth").alias("above"), F.min("depth").alias("deep"))
    gaps = gaps.where("leaf is not null").select("tree_id", "rank", "leaf", *[F.when(F.col("rank") > 0, F.col(c)).alias(c) for c in ("above", "deep")])
    left = gaps.where("above is not null").select("tree_id", F.col("above").alias("node_id")).union(gaps.select("tree_id", "leaf")).distinct()
    place = left.withColumn("id", (F.row_number().over(order) - 1).cast("int"))
    ends = ranked.select("tree_id", F.col("node_id").alias("last"), (F.col("rank") + F.col("kept").cast("int") - 1).alias("high"))
    spans = place.join(ranked.select("tree_id", "node_id", "last", F.col("rank").alias("low"), "label", "is_leaf"), ["tree_id", "node_id"]).join(ends, ["tree_id", "last"]).drop("last")
    first = gaps.select("tree_id", F.col("rank").alias("low"), F.col("above").alias("a"), F.col("deep").alias("da"))
    after = gaps.select("tree_id", (F.col("rank") - 1).alias("high"), F.col("above").alias("b"), F.col("deep").alias("db"))
    final = gaps.select("tree_id", F.col("rank").alias("high"), F.col("leaf").alias("end"))
    spans = spans.join(first, ["tree_id", "low"], "left").join(after, ["tree_id", "high"], "left").join(final, ["tree_id", "high"])
    spans = spans.withColumn("up", F.when(F.col("db").isNull() | (F.col("da") >= F.col("db")), F.col("a")).otherwise(F.col("b")))
    far = sums_from_root(nodes, F.coalesce("length", F.lit(0.0)), "far")
    measured = nodes.groupBy("tree_id").agg((F.count("length") > 0).alias("measured"))
    named = lambda old, new: place.select("tree_id", F.col("node_id").alias(old), F.col("id").alias(new))
    out = spans.join(named("up", "parent_id"), ["tree_id", "up"], "left").join(named("end", "last"), ["tree_id", "end"]).join(measured, "tree_id")
    out = out.join(far, ["tree_id", "node_id"]).join(far.select("tree_id", F.col("node_id").alias("up"), F.col("far").alias("from")), ["tree_id", "up"], "left")
    length = F.when(F.col("measured"), F.col("far") - F.col("from"))
    out = out.select("tree_id", F.col("id").alias("node_id"), "parent_id", "label", length.alias("length"), "is_leaf", "last")
    deep = sums_from_root(out, F.lit(1), "depth").withColumn("depth", (F.col("depth") - 1).cast("int"))
    return out.join(deep, ["tree_id", "node_id"]).select("tree_id", "node_id", "parent_id", "label", "length", "is_leaf", "depth", "last")


def internal_branches(nodes: DataFrame) -> DataFrame:
    """tree_id, node_id, support, clade (its set of tips) of each inner branch; support is null where the node's label is no number."""
    support = nodes.where("not is_leaf and parent_id is not null").select("tree_id", "node_id", F.trim("label").try_cast("double").alias("support"))
    return support.join(clade_sums(nodes, ["tree_id"]).select("tree_id", "node_id", "clade"), ["tree_id", "node_id"])
