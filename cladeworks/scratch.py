"""Tables written once and read often, in the folder that all executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder's name below spark.checkpoint.dir. Where the session names none, one machine gets a temporary one and a cluster is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this program's own."""
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clear
        pass


def written(df: DataFrame, name: str, *by: str) -> str:
    """The new folder that df is written to, parted by some columns, if any. Gone when the program ends."""
    path = fresh(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    atexit.register(remove, df.sparkSession, path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written and read again: what is read many times is computed once, and a lost executor costs a reread. Gone when the program ends."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))
