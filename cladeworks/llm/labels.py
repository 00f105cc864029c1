"""Joining documents with their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000  # about 50 MB as a hash table; more labels go through a shuffle


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """docs that have one value of labels[column] (0 or 1), with it as `label`.

    A doc_id labelled twice with different values has none; null ids and null labels have none. The label side is
    broadcast only if it is counted to have BROADCAST_ROWS rows at most.
    """
    one = labels.where(f"doc_id is not null and {column} is not null").groupBy("doc_id")
    one = one.agg(F.min(column).alias("label"), F.max(column).alias("_most")).where("label = _most").select("doc_id", "label")
    if labels.count() <= BROADCAST_ROWS:
        one = F.broadcast(one)
    return docs.drop("label").join(one, "doc_id")
