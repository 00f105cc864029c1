"""Occupancy over newly arriving hits: the same counts, kept up by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HITS = "genome_id long, marker_id long, target long, score double"


def read(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(HITS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def qualifying(hits: DataFrame, floor: float) -> DataFrame:
    """genome_id, marker_id, n of hits of floor or more, for update or complete mode; a genome's hits arrive in one file."""
    return hits.where(F.col("score") >= floor).dropDuplicates(["genome_id", "marker_id", "target"]).groupBy("genome_id", "marker_id").agg(F.count(F.lit(1)).alias("n"))


def start(counts: DataFrame, table: str, checkpoint: str):
    """Writes each update's states into an in-memory table (tests) by complete mode."""
    state = counts.withColumn("state", F.when(F.col("n") == 1, "single_copy").otherwise("multi_copy"))
    return state.writeStream.outputMode("complete").format("memory").queryName(table).option("checkpointLocation", checkpoint).start()
