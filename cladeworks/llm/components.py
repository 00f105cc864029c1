"""Connected components by alternating large-star and small-star steps, in tables only."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import hot_keys, skewed_join
from .store import Workspace


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """v, root (smallest vertex of its component) for each vertex but the roots; edges has columns u, v of one orderable type.

    Each round writes its edges, so that a lost executor costs a reread, and rounds go on until every component is a star
    (their number grows with the logarithm of the vertices): a vertex then has one neighbour or only larger ones, which a
    count of its neighbours tells without the steps. The neighbours of a vertex that very many edges share are summed
    before the shuffle and dealt over many tasks in the joins.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = work.save(pairs, f"{name}0")
    for i in itertools.count(1):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = work.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), f"{name}-least{i}")
        if least.where("m < u and n > 1").isEmpty():
            work.drop(f"{name}-least{i}")
            return pairs.select(F.col("u").alias("v"), F.col("v").alias("root"))
        large = skewed_join(both, least.select("u", "m"), ["u"], hot_keys(least, "n", ["u"]), F.xxhash64("v"))
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")  # a vertex's neighbours are now smaller ones, of which it has few
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        pairs = work.save(small.where("u <> v").distinct(), f"{name}{i}")
        work.drop(f"{name}{i - 1}", f"{name}-least{i}")
