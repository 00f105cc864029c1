"""The corpus pipeline: quality, lines, near-duplicates, benchmark leaks, mix. Each stage's output is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm import decontaminate, line_dedup, mixing, near, quality
from cladeworks.llm.store import Workspace
from cladeworks.ship import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(docs, labels).where("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; n_chars follows the text."""
    out = line_dedup.drop_common_lines(docs)
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with copies (1 or 2) and the counts behind them."""
    return mixing.mix_sources(docs).where("copies > 0")


def shipped(stage):
    """The stage, once executors can import the package."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("mix", mix),
]
STAGES = [(name, shipped(stage)) for name, stage in STAGES]

ORACLE_SQL = None  # calibrated bounds, components and the latent search are beyond SQL; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), name)
        if k:
            work.drop(STAGES[k - 1][0])
    return docs
