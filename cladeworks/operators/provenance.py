"""Provenance: content hashes of databases and files, cached trees that must be rebuilt, placeholders refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLACEHOLDER = r"(?i)^\s*(|na|n/a|none|null|todo|tbd|unknown|placeholder|x+)\s*$"


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, sha of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha"))


def folder_hash(hashes: DataFrame) -> DataFrame:
    """One row: the hash of all file hashes in path order."""
    ordered = F.array_sort(F.collect_list(F.struct("path", "sha")))  # a database's files
    return hashes.agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["sha"]), ""), 256).alias("sha"))


def compare(hashes: DataFrame, expected: DataFrame) -> DataFrame:
    """path, result: ok, changed, missing or extra."""
    a, b = hashes.alias("a"), expected.alias("b")
    result = F.when(F.col("a.sha").isNull(), "missing").when(F.col("b.sha").isNull(), "extra").when(F.col("a.sha") == F.col("b.sha"), "ok").otherwise("changed")
    return a.join(b, F.col("a.path") == F.col("b.path"), "full_outer").select(F.coalesce("a.path", "b.path").alias("path"), result.alias("result"))


def to_rebuild(current: DataFrame, cached: DataFrame) -> DataFrame:
    """marker_id of inputs (marker_id, sha) whose cached tree is absent or of other content."""
    return current.join(cached, ["marker_id", "sha"], "left_anti").select("marker_id")


def content_sums(rows: DataFrame, key: str, *fields: str) -> DataFrame:
    """key, n, s1, s2 (decimals): sums of 2 x 60 bits of SHA-256 over a key's rows of these fields, whatever their order.

    Sums of parts add up to the sum of the whole, so that a growing table's fingerprint is kept up from what is new.
    """
    said = F.concat_ws("", *[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in (F.col(f).cast("string") for f in fields)])
    part = lambda at: F.sum(F.conv(F.substring("_sha", at, 15), 16, 10).cast("decimal(38,0)")).alias(f"s{1 if at == 1 else 2}")
    return rows.select(key, F.sha2(said, 256).alias("_sha")).groupBy(key).agg(F.count(F.lit(1)).alias("n"), part(1), part(16))


def incomplete(records: DataFrame) -> DataFrame:
    """field, n: fields with placeholder or missing values."""
    bad = [F.count_if(F.col(c).isNull() | F.col(c).cast("string").rlike(PLACEHOLDER)).alias(c) for c in records.columns]
    return records.agg(*bad).unpivot([], list(records.columns), "field", "n").where("n > 0")
