"""Sequence ledger: sequences that arrive over time are profiled once, and each marker's content is known without reading old ones again.

A user adds sequences to per-marker sets and must know, after each delivery, whether they are sound and which markers'
alignments and trees are out of date. A file stream takes the files that its checkpoint has not seen (availableNow: what
is there, then it ends); each micro-batch writes two tables, partitioned by batch:

    OUT/profiles/batch_id=N   marker_id, taxon, n_sites, gc, n_ambiguous, control_chars, sha (of the sequence)
    OUT/content/batch_id=N    marker_id, n, s1, s2: sums that fingerprint the batch's sequences of the marker

A batch replaces its own partition, so one that is repeated after a failure is written once. Then

    OUT/markers               marker_id, n_sequences, fingerprint, last_batch

is made anew from the sums, a row a marker and batch, and never from sequences: a marker's tree built at batch b is stale
if last_batch > b or its fingerprint differs. Later rows of one taxon are sequences of their own. Null texts are empty
sequences; null markers are a marker.

    python -m jobs.sequence_ledger --input DIR --output DIR --checkpoint DIR [--config FILE]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.functions import scalars as S
from cladeworks.operators import provenance as V

from .common import log, main, view, written


def arriving(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The stream of a Parquet folder's files, or of one file."""
    schema = spark.read.parquet(path).schema
    head, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{head}/{name[:-1]}[{name[-1]}]")  # a pattern of one name, for a file stream takes no plain file


def profiles(rows: DataFrame) -> DataFrame:
    """A row a sequence (marker_id, taxon, raw, seq)."""
    ambiguous = F.aggregate(S.letter_counts(F.col("seq"), "".join(c for c in S.AMBIGUOUS if c.isalpha())), F.lit(0), lambda a, x: a + x)
    gc = F.round(S.gc_content(F.col("seq"), F.lit(False)), 6)
    return rows.select("marker_id", "taxon", F.length("seq").alias("n_sites"), gc.alias("gc"), ambiguous.alias("n_ambiguous"), S.has_control_chars(F.col("raw")).alias("control_chars"), F.sha2("seq", 256).alias("sha"))


def put(df: DataFrame, batch_id: int, path: str) -> DataFrame:
    """Replaces the batch's partition, and reads it again; an empty batch has an empty one."""
    part = f"{path}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(part)
    return df.sparkSession.read.parquet(part)


def markers(content: DataFrame) -> DataFrame:
    """A row a marker from the sums of its batches."""
    sums = content.groupBy("marker_id").agg(F.sum("n").alias("n_sequences"), F.sum("s1").cast("decimal(38,0)").alias("s1"), F.sum("s2").cast("decimal(38,0)").alias("s2"), F.max("batch_id").cast("long").alias("last_batch"))
    return sums.select("marker_id", "n_sequences", F.sha2(F.concat_ws(":", F.col("n_sequences"), F.col("s1"), F.col("s2")), 256).alias("fingerprint"), "last_batch")


def run(spark: SparkSession, input: str, output: str, checkpoint: str, config: dict) -> DataFrame:
    """Takes the files that are new, and returns each profile beside its marker's content as the output stands."""

    def batch(df: DataFrame, batch_id: int) -> None:
        done = put(profiles(view(df, config["sequence"])), batch_id, f"{output}/profiles")
        put(V.content_sums(done, "marker_id", "taxon", "sha"), batch_id, f"{output}/content")
        written(done, f"profiles of batch {batch_id}", output)

    path = f"{input}/{config['table']}.parquet"
    query = arriving(spark, path, config["files_per_batch"]).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d new rows of %s in %d batches", sum(p["numInputRows"] for p in query.recentProgress), path, sum(p["numInputRows"] > 0 for p in query.recentProgress))
    content = spark.read.parquet(f"{output}/content")
    markers(content).coalesce(1).write.mode("overwrite").parquet(f"{output}/markers")  # a row a marker
    known = written(spark.read.parquet(f"{output}/markers"), "markers", output).withColumnRenamed("marker_id", "_marker")
    every = spark.read.parquet(f"{output}/profiles").drop("batch_id")
    return every.join(known, F.col("marker_id").eqNullSafe(F.col("_marker"))).drop("_marker")


if __name__ == "__main__":
    sys.exit(main("sequence_ledger", run, {"input": "folder of the Parquet tables", "output": "folder of the ledger", "checkpoint": "folder of the stream's checkpoint"}))
