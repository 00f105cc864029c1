"""Clades and splits by sums of tip hashes: a set of tips is known by its size and three 40-bit sums of SHA-256 of its labels.

Sums add up: a clade is a run of leaves in preorder, so its sum is the difference of two running sums over the node table,
and its complement is the tree's sum less its own. Nothing holds a list of tips, and a tree of n nodes costs n log n whatever
its shape. Restricting a tree to some tips is counting the others as nothing.

Defined cases: a label that a tree has twice counts twice; trees without a readable Newick string have no nodes and no
rows; sums hold for trees of up to 2 ** 23 tips, beyond which Spark reports an overflow rather than a wrong sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUMS = ("n", "h1", "h2", "h3")


def tip_sums(label: Column) -> list[Column]:
    """n, h1, h2, h3 of one tip."""
    sha = F.sha2(label.cast("string"), 256)
    return [F.lit(1).cast("long").alias("n"), *[F.conv(F.substring(sha, 1 + 10 * k, 10), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(3)]]


def as_set(prefix: str = "") -> Column:
    """The sums of a set as one value."""
    return F.struct(*[F.col(prefix + c).alias(c) for c in SUMS])


def rest(whole: Column, part: Column) -> Column:
    """The set of what is in the whole and not in its part."""
    return F.struct(*[(whole[c] - part[c]).alias(c) for c in SUMS])


def clade_sums(nodes: DataFrame, key: list[str], counts: Column | None = None) -> DataFrame:
    """key, node_id, parent_id, clade, whole (sets) of each inner node. nodes: key and NODES; counts: the leaves that count, null for all."""
    own = F.col("is_leaf") if counts is None else F.col("is_leaf") & counts
    values = nodes.select(*key, "node_id", "parent_id", "is_leaf", "last", *[F.when(own, v).otherwise(F.lit(0).cast("long")).alias(v_) for v, v_ in zip(tip_sums(F.col("label")), SUMS)])
    upto = Window.partitionBy(*key).orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key)
    run = values.select(*key, "node_id", "parent_id", "is_leaf", "last", F.struct(*[F.sum(c).over(upto).alias(c) for c in SUMS]).alias("upto"), F.struct(*[F.sum(c).over(whole).alias(c) for c in SUMS]).alias("whole"))
    ends = run.select(*key, F.col("node_id").alias("last"), F.col("upto").alias("end"))
    return run.where("not is_leaf").join(ends, [*key, "last"]).select(*key, "node_id", "parent_id", rest(F.col("end"), F.col("upto")).alias("clade"), "whole")


def splits(nodes: DataFrame, key: list[str], counts: Column | None = None) -> DataFrame:
    """key, side, n_tips: each split with two tips or more on both sides, once; side is the smaller of the two sets, by size and then by sums."""
    inner = clade_sums(nodes, key, counts).where("parent_id is not null")
    both = inner.withColumn("other", rest(F.col("whole"), F.col("clade"))).where("clade.n >= 2 and other.n >= 2")
    return both.select(*key, F.least("clade", "other").alias("side"), F.col("whole.n").alias("n_tips")).distinct()


def leaves(nodes: DataFrame) -> DataFrame:
    """tree_id, tip: each label once."""
    return nodes.where("is_leaf").select("tree_id", F.col("label").alias("tip")).distinct()


def shared_tips(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, tip: the leaves that both trees of a pair have."""
    tips = leaves(nodes)
    x, y = tips.withColumnRenamed("tree_id", "a"), tips.withColumnRenamed("tree_id", "b")
    return pairs.select("a", "b").join(x, "a").join(y, ["b", "tip"]).select("a", "b", "tip")


def readable_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose trees both have nodes."""
    known = nodes.where("parent_id is null").select("tree_id")
    return pairs.select("a", "b").join(known.withColumnRenamed("tree_id", "a"), "a", "left_semi").join(known.withColumnRenamed("tree_id", "b"), "b", "left_semi")


def pair_splits(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, which, side: splits of both trees of each pair on their shared tips."""
    shared = shared_tips(pairs, nodes).select("a", "b", F.col("tip").alias("label"), F.lit(True).alias("kept"))
    out = None
    for which in ("a", "b"):
        own = pairs.select("a", "b").join(nodes.withColumnRenamed("tree_id", which), which)
        mine = splits(own.join(shared, ["a", "b", "label"], "left"), ["a", "b"], F.coalesce("kept", F.lit(False))).withColumn("which", F.lit(which))
        out = mine if out is None else out.unionByName(mine)
    return out


def rf_distance(pairs: DataFrame, nodes: DataFrame, cap: int | None = None) -> DataFrame:
    """a, b, n_shared, rf, normalized_rf of each pair of trees. Fewer than three shared tips: 0; more than cap: null."""
    sizes = shared_tips(pairs, nodes).groupBy("a", "b").agg(F.count(F.lit(1)).cast("int").alias("n_shared"))
    lone = pair_splits(pairs, nodes).groupBy("a", "b", "side").agg(F.count(F.lit(1)).alias("k")).where("k = 1")
    rf = lone.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rf"))
    out = readable_pairs(pairs, nodes).join(sizes, ["a", "b"], "left").join(rf, ["a", "b"], "left").fillna(0, ["n_shared", "rf"])
    ok = F.lit(True) if cap is None else F.col("n_shared") <= cap
    norm = F.when(F.col("n_shared") <= 3, 0.0).otherwise(F.col("rf") / (2 * (F.col("n_shared") - 3)))
    return out.select("a", "b", "n_shared", F.when(ok, F.col("rf")).alias("rf"), F.when(ok, norm).alias("normalized_rf"))


def group_sums(tips: DataFrame, by: list[str]) -> DataFrame:
    """by and grp, the set of the tips (column tip, each once) of each group."""
    one = tips.select(*by, *tip_sums(F.col("tip")))
    return one.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS]).select(*by, as_set().alias("grp"))


def clade_sets(nodes: DataFrame) -> DataFrame:
    """tree_id, clade: the sets of a tree's inner nodes, each once."""
    return clade_sums(nodes, ["tree_id"]).select("tree_id", "clade").distinct()


def monophyly(nodes: DataFrame, taxa_long: DataFrame) -> DataFrame:
    """tree_id, rank, proportion, n_total, n_mono: taxa that, or whose complement, are a clade; two tips or more on both sides. No row: not measurable."""
    tips = leaves(nodes)
    whole = group_sums(tips, ["tree_id"]).withColumnRenamed("grp", "whole")
    named = tips.join(taxa_long.select("tip", "rank", "taxon").distinct(), "tip")
    groups = group_sums(named, ["tree_id", "rank", "taxon"]).join(whole, "tree_id").withColumn("oth", rest(F.col("whole"), F.col("grp"))).where("grp.n >= 2 and oth.n >= 2")
    asked = groups.select("tree_id", "rank", "taxon", F.explode(F.array("grp", "oth")).alias("clade"))
    hit = asked.join(clade_sets(nodes), ["tree_id", "clade"], "left_semi").select("tree_id", "rank", "taxon").distinct().withColumn("mono", F.lit(1))
    return (
        groups.join(hit, ["tree_id", "rank", "taxon"], "left").groupBy("tree_id", "rank")
        .agg(F.avg(F.coalesce("mono", F.lit(0)).cast("double")).alias("proportion"), F.count(F.lit(1)).alias("n_total"), F.count("mono").alias("n_mono"))
    )


def is_monophyletic(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """tree_id, taxon, n, monophyletic: are a taxon's tips on the tree exactly a clade (rooted); a single tip is. members: tip, taxon."""
    groups = group_sums(leaves(nodes).join(members.select("tip", "taxon").distinct(), "tip"), ["tree_id", "taxon"]).withColumnRenamed("grp", "clade")
    hit = groups.join(clade_sets(nodes), ["tree_id", "clade"], "left_semi").select("tree_id", "taxon", F.lit(True).alias("hit"))
    out = groups.join(hit, ["tree_id", "taxon"], "left")
    return out.select("tree_id", "taxon", F.col("clade.n").cast("int").alias("n"), (F.col("hit").isNotNull() | (F.col("clade.n") == 1)).alias("monophyletic"))
