"""Gene states and marker occupancy from hits, sparse: an absent cell is a missing row unless it had a poor hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gene_states(hits: DataFrame, floor: float | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """genome_id, marker_id, state by the number of distinct targets with a score of floor or more. by: columns that a genome has once, kept."""
    n = F.count_distinct(F.when(F.col("score") >= floor, F.col("target")))
    counts = hits.groupBy(*by, "genome_id", "marker_id").agg(n.alias("n"))
    return counts.select(*by, "genome_id", "marker_id", F.when(F.col("n") == 0, "absent").when(F.col("n") == 1, "single_copy").otherwise("multi_copy").alias("state"))


def occupancy(states: DataFrame, genomes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """marker_id, n_single, n_multi, occupancy, multi_rate over all genomes (of a group with `by`), those without a hit included."""
    total = genomes.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))  # one row, or one a group
    counts = states.groupBy(*by, "marker_id").agg(F.count_if(F.col("state") == "single_copy").alias("n_single"), F.count_if(F.col("state") == "multi_copy").alias("n_multi"))
    both = counts.join(total, list(by)) if by else counts.crossJoin(F.broadcast(total))
    return both.select(*by, "marker_id", "n_single", "n_multi", (F.col("n_single") / F.col("total")).alias("occupancy"), (F.col("n_multi") / F.col("total")).alias("multi_rate"))


def weighted_occupancy(states: DataFrame, genomes: DataFrame) -> DataFrame:
    """marker_id, occupancy: the weight of genomes (genome_id, weight; null counts as 1) with one copy over all weight."""
    weights = genomes.select("genome_id", F.coalesce("weight", F.lit(1.0)).alias("weight"))
    total = weights.agg(F.sum("weight").alias("total"))
    found = states.join(weights, "genome_id").groupBy("marker_id").agg(F.sum(F.when(F.col("state") == "single_copy", F.col("weight")).otherwise(0.0)).alias("w"))
    return found.crossJoin(F.broadcast(total)).select("marker_id", (F.col("w") / F.col("total")).alias("occupancy"))


def occupancy_rank(occ: DataFrame) -> DataFrame:
    """marker_id, occupancy, rank from 1, occupancy falling, then by id. One row a marker, so one task ranks them."""
    return occ.select("marker_id", "occupancy", F.row_number().over(Window.orderBy(F.col("occupancy").desc(), "marker_id")).alias("rank"))


def densify(states: DataFrame, genomes: DataFrame, markers: DataFrame) -> DataFrame:
    """Every genome and marker with its state; only where zeros must be seen."""
    return genomes.crossJoin(markers).join(states, ["genome_id", "marker_id"], "left").withColumn("state", F.coalesce("state", F.lit("absent")))
