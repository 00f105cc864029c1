"""Quartets by intervals: the shape of four tips follows from the depths of three last common ancestors.

Leaves are numbered in preorder. The last common ancestor of two neighbours lies one above the shallowest node between
them, and that of any two leaves is as deep as the shallowest of their neighbours' between them, a range minimum: a table
of minima over runs of 1, 2, 4, ... leaves answers it by two equi-joins. Of four leaves in that order the outer two pairs
part the quartet if either ancestor lies below the middle one's, the middle pair does if its ancestor lies below both others',
else it is a star. Quartets are chosen by their places in lexicographic order, by a table function in a lateral join, so
that only the chosen ones are made and no list of tips travels.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from .splits import readable_pairs, shared_tips


def unrank(n: int, index: int, k: int = 4) -> list[int]:
    """The combination of k of range(n) at a place in lexicographic order, by bisection over skipped blocks."""
    out, low = [], 0
    for left in range(k, 0, -1):
        # combinations of range(low, n) whose first is below x: C(n - low, left) - C(n - x, left)
        a, b, whole = low, n - left, math.comb(n - low, left)
        while a < b:
            mid = (a + b + 1) // 2
            a, b = (mid, b) if whole - math.comb(n - mid, left) <= index else (a, mid - 1)
        index -= whole - math.comb(n - a, left)
        out.append(a)
        low = a + 1
    return out


@udtf(returnType="i long, r1 int, r2 int, r3 int, r4 int")
class QuartetPicks:
    """Table function: chosen quartets of n sorted tips. The first `first`, every nth so that about `stride_to` remain, `drawn` at random with seed 0, or `spread` at even distances; all nulls: every one."""

    def eval(self, n: int, first: int, stride_to: int, drawn: int, spread: int):
        total = math.comb(n, 4)
        if spread is not None:
            places = [int(i * (total / spread)) for i in range(spread)] if total > spread else range(total)
        elif drawn is not None:
            places = sorted(random.Random(0).sample(range(total), min(drawn, total)))
        else:
            step = max(1, total // stride_to) if stride_to else 1
            most = first if first is not None else (stride_to if stride_to else total)
            places = range(0, min(total, step * most), step)
        for i in places:
            yield (i, *unrank(n, i))


def register(spark) -> None:
    """Makes quartet_picks(n, first, stride_to, drawn, spread) available to SQL, as in FROM sizes, LATERAL quartet_picks(n, NULL, 200, NULL, NULL)."""
    spark.udtf.register("quartet_picks", QuartetPicks)


def numbered_leaves(nodes: DataFrame) -> DataFrame:
    """tree_id, tip, rank, drop: leaves by preorder, and the depth of the last common ancestor with the leaf before."""
    before = Window.partitionBy("tree_id").orderBy("node_id").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum(F.col("is_leaf").cast("int")).over(before), F.lit(0)).cast("int")
    return nodes.withColumn("rank", rank).groupBy("tree_id", "rank").agg(F.max_by("label", F.col("is_leaf").cast("int")).alias("tip"), (F.min("depth") - 1).alias("drop"))


def minima(leaves: DataFrame, levels: int) -> DataFrame:
    """tree_id, rank, low: the least drop of the 1, 2, 4, ... leaves from this one on."""
    order, out = Window.partitionBy("tree_id").orderBy("rank"), leaves.select("tree_id", "rank", F.col("drop").alias("m0"))
    for k in range(1, levels):
        out = out.withColumn(f"m{k}", F.least(f"m{k - 1}", F.lead(f"m{k - 1}", 1 << (k - 1)).over(order)))
    return out.select("tree_id", "rank", F.array(*[f"m{k}" for k in range(levels)]).alias("low"))


def picked(pairs: DataFrame, nodes: DataFrame, first: int | None, stride_to: int | None, drawn: int | None, spread: int | None) -> DataFrame:
    """a, b, i, j, tip: the four tips (j from 1, by label) of each chosen quartet of shared tips."""
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy("tip")) - 1
    tips = shared_tips(pairs, nodes).withColumn("r", place)
    sizes = tips.groupBy("a", "b").agg(F.count(F.lit(1)).cast("int").alias("n"))
    options = [F.lit(x).cast("int") for x in (first, stride_to, drawn, spread)]
    chosen = sizes.lateralJoin(QuartetPicks(F.col("n").outer(), *options)).select("a", "b", "i", F.posexplode(F.array("r1", "r2", "r3", "r4")).alias("j", "r"))
    return chosen.join(tips, ["a", "b", "r"]).select("a", "b", "i", (F.col("j") + 1).alias("j"), "tip")


def shapes(asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """asked's a, b, which, i with partner: which of the other three tips (by label) goes with the first, 0 for a star. asked: a, b, which, tree_id, i, j, tip."""
    leaves = numbered_leaves(nodes)
    most = leaves.agg(F.max("rank")).first()[0]  # one number
    if most is None:
        return asked.select("a", "b", "which", "i", F.lit(0).alias("partner")).limit(0)
    low = minima(leaves, max(1, most.bit_length()))
    placed = asked.join(leaves.select("tree_id", "tip", "rank"), ["tree_id", "tip"])
    four = placed.groupBy("a", "b", "which", "tree_id", "i").agg(F.array_sort(F.collect_list(F.struct("rank", "j"))).alias("q"))
    gap = lambda g: F.col("q")[g + 1]["rank"] - F.col("q")[g]["rank"]
    level = lambda g: F.floor(F.log2(gap(g).cast("double"))).cast("int")
    ask = [F.struct(F.lit(g).alias("g"), level(g).alias("k"), at.cast("int").alias("rank")) for g in range(3) for at in (F.col("q")[g]["rank"] + 1, F.col("q")[g + 1]["rank"] - F.call_function("shiftleft", F.lit(1), level(g)) + 1)]
    looked = four.select("*", F.explode(F.array(*ask)).alias("ask")).select("a", "b", "which", "tree_id", "i", "q", "ask.*").join(low, ["tree_id", "rank"])
    depths = looked.groupBy("a", "b", "which", "i").agg(F.any_value("q").alias("q"), *[F.min(F.when(F.col("g") == g, F.get("low", F.col("k")))).alias(f"d{g}") for g in range(3)])
    j = lambda at: F.col("q")[at]["j"]
    mate = lambda x, y: F.when(j(x) == 1, j(y)).when(j(y) == 1, j(x))
    outer = F.coalesce(mate(0, 1), mate(2, 3))
    middle = F.coalesce(mate(1, 2), mate(0, 3))
    partner = F.when((F.col("d0") > F.col("d1")) | (F.col("d2") > F.col("d1")), outer).when((F.col("d1") > F.col("d0")) & (F.col("d1") > F.col("d2")), middle).otherwise(0)
    return depths.select("a", "b", "which", "i", partner.alias("partner"))


def quartet_agreement(pairs: DataFrame, nodes: DataFrame, limit: int | None = 200, stride_to: int | None = None, drawn: int | None = None, spread: int | None = None) -> DataFrame:
    """a, b, n_quartets, agreement: how often both trees join the same two tips. Under four shared tips: null."""
    q = picked(pairs, nodes, limit, stride_to, drawn, spread)
    asked = q.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("which")).withColumn("tree_id", F.when(F.col("which") == "a", F.col("a")).otherwise(F.col("b")))
    same = shapes(asked, nodes).groupBy("a", "b", "i").agg((F.min("partner") == F.max("partner")).alias("same"))
    found = same.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_quartets"), F.avg(F.col("same").cast("double")).alias("agreement"))
    return readable_pairs(pairs, nodes).join(found, ["a", "b"], "left").withColumn("n_quartets", F.coalesce("n_quartets", F.lit(0)))
