"""tree_splits lists the tips of each split's side; tree_split_sums has the same splits by sums."""

from __future__ import annotations

import re

import duckdb

from cladeworks.plans import proxy, registry

SF = "/root/testdata/sf0.001"


def test_splits_list_their_tips(spark):
    """From the Newick strings by plain Python: a clade of tips, or all others, whichever has the first tip in order."""
    want, sizes = set(), {}
    for tree_id, text in proxy.trees(spark, SF).collect():
        every, open_, clades = set(re.findall(r"t\d+", text)), [], []
        for x in re.findall(r"[()]|t\d+", text):
            if x == "(":
                open_.append(set())
            elif x == ")":
                clades.append(open_.pop())
                if open_:
                    open_[-1] |= clades[-1]
            else:
                open_[-1].add(x)
        sizes[tree_id] = len(every)
        for c in clades:
            if len(c) >= 2 and len(every - c) >= 2:
                want.add((tree_id, ",".join(sorted(c if min(every) in c else every - c))))
    got = registry.QUERIES["tree_splits"](spark, SF)
    assert got.columns == ["tree_id", "side"] and len(got.collect()) == len(want) and {tuple(r) for r in got.collect()} == want
    sums = registry.QUERIES["tree_split_sums"](spark, SF).collect()
    assert sorted((r.tree_id, r.n) for r in sums) == sorted((t, min(side.count(",") + 1, sizes[t] - side.count(",") - 1)) for t, side in want)


def test_splits_agree_with_their_sql(spark):
    for t in ("supplier", "nation"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("lineitem", "region", "documents", "part"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    assert {tuple(r) for r in registry.QUERIES["tree_splits"](spark, SF).collect()} == set(duckdb.sql(registry.ORACLES["tree_splits"]).fetchall())
