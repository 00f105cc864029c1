"""Intermediate tables in the folder that all executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names. Where it names none, one machine gets a temporary one and a cluster is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Workspace:
    """A folder of intermediate Parquet tables. Writing one cuts the lineage: a lost executor costs a reread, not a rerun."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._last)

    def save(self, df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        """Writes and rereads df, in folders by the column `partition`. The shuffle files behind it go as soon as it is written."""
        path, before = f"{self.path}/{name}", self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").partitionBy(*[partition] if partition else []).parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.path}/{name}")

    def _last(self) -> None:
        try:
            remove(self.spark, self.path)
        except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clear
            pass
