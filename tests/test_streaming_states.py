"""Gene states over a stream with bounded state, against the batch operator."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from cladeworks.operators import occupancy as O
from cladeworks.streaming import gene_states as G

START = datetime.datetime(2026, 1, 1, tzinfo=datetime.timezone.utc)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def deliver(spark, tmp_path, rows, name):
    spark.createDataFrame(rows, G.HITS).coalesce(1).write.parquet(str(tmp_path / name))
    (tmp_path / "in").mkdir(exist_ok=True)
    for k, part in enumerate(sorted((tmp_path / name).glob("part-*.parquet"))):
        part.rename(tmp_path / "in" / f"{name}-{k}.parquet")


def take(spark, tmp_path, patience="1 hour"):
    q = G.start(G.updates(G.read(spark, str(tmp_path / "in"), 1), 15.0, patience), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination()
    return q


def known(spark, tmp_path):
    return {(r.genome_id, r.marker_id): r.state for r in G.latest(spark.read.parquet(str(tmp_path / "out"))).collect()}


def test_a_genome_over_three_files_with_late_rows(spark, tmp_path):
    """Hits of a gene lie in any of three files, some older than what came before, within the watermark."""
    r = random.Random(3)
    rows = [(r.randrange(12), r.randrange(6), r.choice([1, 2, 3]), r.choice([5.0, 20.0, 50.0]), at(r.randrange(50))) for _ in range(400)]
    for k in range(3):
        deliver(spark, tmp_path, rows[k::3], f"f{k}")
        take(spark, tmp_path)
    want = {(x.genome_id, x.marker_id): x.state for x in O.gene_states(spark.createDataFrame(rows, G.HITS), 15.0).collect()}
    assert known(spark, tmp_path) == want and set(want.values()) == {"absent", "single_copy", "multi_copy"}


def test_state_is_given_up_and_too_late_rows_are_dropped(spark, tmp_path):
    deliver(spark, tmp_path, [(g, 1, g, 20.0, at(g)) for g in range(40)] + [(None, 1, 1, 20.0, at(1))], "a")
    take(spark, tmp_path)
    deliver(spark, tmp_path, [(100, 1, 1, 20.0, at(500))], "b")
    take(spark, tmp_path)
    deliver(spark, tmp_path, [(101, 1, 1, 20.0, at(501)), (3, 1, 999, 50.0, at(3))], "c")  # genome 3 was final long ago
    q = take(spark, tmp_path)
    left = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert left[-1] <= 2  # of 42 genes
    got = known(spark, tmp_path)
    assert got[3, 1] == "single_copy" and len(got) == 42
    final = G.latest(spark.read.parquet(str(tmp_path / "out"))).where(F.col("final")).count()
    assert final >= 40
