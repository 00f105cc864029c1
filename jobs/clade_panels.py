"""Marker panels by clade: which markers to take for each clade, and from which genome which sequence.

A user who builds trees clade by clade needs, for every clade, thresholds that follow its genomes' quality, the panel of
markers that reach them, and a list of the sequences to extract. One row a selected marker and genome that has it:

    clade, marker_id, rank, occupancy, genome_id, state, target, score, length

Thresholds, gene states, occupancy, panel and best hits are the library's operators, by clade. Output is partitioned by
clade and written with dynamic partition overwrite: a run replaces the clades it computes (all, or `only`) and no other,
so that a run that is repeated, or was interrupted, ends in the same files. A clade without a marker gets no partition; a
run over all clades replaces the whole output, so that none is left from an earlier table.

    python -m jobs.clade_panels --input DIR --output DIR [--config FILE]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.operators import occupancy as O
from cladeworks.operators import quality as Q
from cladeworks.operators import selection as M

from .common import log, main, view, written

BY = ("clade",)
HITS_A_TASK = 500_000  # what a task sorts; more hits are more tasks


def inputs(spark: SparkSession, source: str, config: dict) -> tuple[DataFrame, DataFrame]:
    """(genomes with their clade, hits), as the configuration names their columns."""
    read = lambda kind, columns: view(spark.read.parquet(f"{source}/{config[kind]}.parquet"), config[columns])
    genomes = read("genomes_table", "genomes").join(read("group_table", "groups"), "group_id").join(read("clade_table", "clades"), "clade_id")
    if config["only"]:
        genomes = genomes.where(F.col("clade").isin(*config["only"]))
    hits = read("hits_table", "hits")
    n = hits.count()
    log.info("read %d genomes of %s and %d hits of %s in %s", genomes.count(), config["genomes_table"], n, config["hits_table"], source)
    dealt = hits.repartition(max(spark.sparkContext.defaultParallelism, -(-n // HITS_A_TASK)), "genome_id")  # states and best hits need no other order
    return genomes.select("genome_id", "clade", "completeness", "contamination"), dealt


def panels(genomes: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows of the output."""
    params = Q.adaptive_params(genomes, BY)
    # a clade's floor goes to its genomes, a row each, and from there to hits by genome: hits are never dealt by clade
    floors = genomes.select("genome_id", "clade").join(params.select("clade", "score_floor"), "clade")
    states = O.gene_states(hits.join(floors, "genome_id"), F.col("score_floor"), BY)
    panel = M.greedy_by(O.occupancy(states, genomes, BY), params, BY)
    found = states.where("state <> 'absent'").join(panel, [*BY, "marker_id"])
    best = M.best_hits(hits).select("genome_id", "marker_id", "target", "score", "length")
    return found.join(best, ["genome_id", "marker_id"]).select("clade", "marker_id", "rank", F.round("occupancy", 6).alias("occupancy"), "genome_id", "state", "target", "score", "length")


def run(spark: SparkSession, input: str, output: str, config: dict) -> DataFrame:
    """Writes the panel and extraction list of each clade, and returns the output as it stands."""
    genomes, hits = inputs(spark, input, config)
    mode = "dynamic" if config["only"] else "static"
    rows = panels(genomes, hits).repartition("clade", F.pmod(F.xxhash64("genome_id"), F.lit(16)))  # a hot clade is several files
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("clade").parquet(output)
    return written(spark.read.schema(rows.schema).parquet(output).select(*rows.columns), "extraction list", output)


if __name__ == "__main__":
    sys.exit(main("clade_panels", run, {"input": "folder of the Parquet tables", "output": "folder of the list"}))
