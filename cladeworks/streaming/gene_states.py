"""Gene states over arriving hits with bounded state: exact over batches and late rows, forgotten when a genome is done.

A gene's state needs no more than two of its different targets, so that is all a key holds; a key is given up `patience`
after its last hit by event time, when its state is final. Hits older than the watermark are late: their key may be final
already, so they are dropped and not counted anew. Keys are (genome_id, marker_id): a hot marker is many keys.

Each update is a row, (genome_id, marker_id, state, n, final); latest() makes of the updates what the batch operator says.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HITS = "genome_id long, marker_id long, target long, score double, arrived timestamp"
UPDATE = "genome_id long, marker_id long, state string, n int, final boolean"
NAMES = ("absent", "single_copy", "multi_copy")


def read(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(HITS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def updates(hits: DataFrame, floor: float, patience: str = "1 hour") -> DataFrame:
    """UPDATE of each gene whose hits arrive, and once more when it is final."""
    wait = int(pd.Timedelta(patience).total_seconds() * 1000)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        targets, last = state.get if state.exists else ([], 0)
        targets = list(targets)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(*key, NAMES[len(targets)], len(targets), True)], columns=[x.split()[0] for x in UPDATE.split(", ")])
            return
        mark, seen = state.getCurrentWatermarkMs(), False
        for batch in batches:
            when = batch.arrived.astype("datetime64[ms, UTC]" if batch.arrived.dt.tz is not None else "datetime64[ms]").astype("int64")
            batch = batch[when >= mark]
            if len(batch):
                seen, last = True, max(last, int(when[when >= mark].max()))
                for target in batch.target[batch.score >= floor].unique().tolist():
                    if target not in targets and len(targets) < 2:
                        targets.append(target)
        if seen:
            state.update((targets, last))
            state.setTimeoutTimestamp(max(last + wait, mark + 1))
            yield pd.DataFrame([(*key, NAMES[len(targets)], len(targets), False)], columns=[x.split()[0] for x in UPDATE.split(", ")])

    watched = hits.where("genome_id is not null and marker_id is not null").withWatermark("arrived", patience)
    return watched.groupBy("genome_id", "marker_id").applyInPandasWithState(step, UPDATE, "targets array<long>, last long", "update", GroupStateTimeout.EventTimeTimeout)


def start(rows: DataFrame, output: str, checkpoint: str):
    """Writes the updates by batch; a batch that is repeated replaces its own. Takes what is there, then ends."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return rows.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(written: DataFrame) -> DataFrame:
    """genome_id, marker_id, state, final: the last update of each gene. written: what start() wrote."""
    turn = F.row_number().over(Window.partitionBy("genome_id", "marker_id").orderBy(F.col("batch_id").desc(), F.col("final")))
    return written.withColumn("turn", turn).where("turn = 1").select("genome_id", "marker_id", "state", "final")
