"""Hits of the clade panels are never dealt by clade, of which there are few."""

from __future__ import annotations

from jobs import clade_panels
from jobs.common import configured

SF = "/root/testdata/sf0.001"


def test_hits_are_not_joined_by_clade(spark):
    """Above the scan of the hits and below their first aggregate, no join has the clade as its key."""
    genomes, hits = clade_panels.inputs(spark, SF, configured("clade_panels"))
    lines = clade_panels.panels(genomes, hits)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    seen = 0
    for k, line in enumerate(lines):
        if "l_suppkey" in line and "Relation" in line:
            level, seen = depth(line), seen + 1
            for above in reversed(lines[:k]):
                if depth(above) < level:
                    level = depth(above)
                    if "Aggregate" in above:
                        break
                    assert not ("Join" in above and "clade" in above), above
    assert seen >= 2


def test_tasks_grow_with_the_hits(spark, monkeypatch):
    """No task gets more than about HITS_A_TASK hits, and no other shuffle deals them anew."""
    monkeypatch.setattr(clade_panels, "HITS_A_TASK", 100)
    _, hits = clade_panels.inputs(spark, SF, configured("clade_panels"))
    assert hits.rdd.getNumPartitions() == -(-hits.count() // 100) > 8
