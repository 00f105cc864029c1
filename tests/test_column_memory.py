"""Column counts are added up by Spark: no Python worker gets all counts of a block."""

from __future__ import annotations

import random
from collections import Counter

from cladeworks.operators import alignment as A


def test_counts_of_a_block_are_not_gathered_in_python(spark):
    r = random.Random(3)
    rows = [("m", i, "".join(r.choices("ACG-", k=40))) for i in range(300)]
    got = A.site_counts(spark.createDataFrame(rows, "marker_id string, taxon int, seq string").repartition(60))  # 60 tasks' counts of one block
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    columns = [Counter(s[i] for _, _, s in rows) for i in range(40)]
    want = (sum(sum(n >= 2 and c != "-" for c, n in x.items()) >= 2 for x in columns), 40, sum(x["-"] for x in columns) / 12000)
    assert [(x.pis, x.effective_columns, x.gap_fraction) for x in got.collect()] == [want]
