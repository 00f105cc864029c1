"""Merkle manifest against a tree built plainly in Python."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from cladeworks.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, path string, key string, leaf string"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row)


def plain(nodes):
    """root, and for each node its steps (siblings before, after)."""
    above, paths, owner = list(nodes), [[] for _ in nodes], list(range(len(nodes)))
    while len(above) > 1:
        for p, at in zip(paths, owner):
            run = above[at // 16 * 16 : at // 16 * 16 + 16]
            p.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        above = [H(above[i : i + 16]) for i in range(0, len(above), 16)]
        owner = [at // 16 for at in owner]
    return above[0], paths


def brute(rows):
    """(doc_id, source, leaf) -> sorted list of (subroot, root, path)."""
    groups = {}
    for row in rows:
        groups.setdefault((row[1] is not None, (row[1] or "").encode()), []).append(row)
    tops, made = [], []
    for g in sorted(groups):
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = plain([leaf(r) for r in members])
        tops.append(top)
        made.append((members, top, paths))
    root, upper = plain(tops)
    out = []
    for (members, top, paths), up in zip(made, upper):
        out += [(r[0], r[1], leaf(r), top, root, p + up) for r, p in zip(members, paths)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "p", "k", "l") for r in rows], SCHEMA)


def found(spark, rows):
    out = M.proofs(frame(spark, rows)).collect()
    return sorted([(r.doc_id, r.source, r.leaf, r.subroot, r.root, [(s.before, s.after) for s in r.path]) for r in out], key=repr)


def rows_of(sizes, seed=1):
    r, ids = random.Random(seed), itertools.count()
    rows = [(next(ids), source, r.choice(["en", None, "de"]), r.choice([None, 5, 7]), r.choice([None, "", "Ünï", "x" * r.randrange(300)])) for source, n in sizes for _ in range(n)]
    r.shuffle(rows)
    return rows


def test_groups_of_every_shape(spark):
    """One leaf, whole runs, one over, whole blocks and one over, a third round; a null and an empty group; groups beyond one run."""
    rows = rows_of([(None, 3), ("", 17), ("a", 1), ("b", 16), ("c", 256), ("d", 257), ("é", 33), ("hot", 4097), *[(f"s{i}", 2) for i in range(12)]])
    assert found(spark, rows) == brute(rows)


def test_ties_repeats_nulls_and_long_texts(spark):
    rows = [(1, "a", "en", 1, "x")] * 5 + [(None, "a", None, None, None)] * 2 + [(1, "a", "en", 1, "y"), (-3, "a", "en", 1, "w " * 400_000), (2, None, "en", 1, "")]
    assert found(spark, rows) == brute(rows)


def test_lone_leaf_and_empty_table(spark):
    rows = [(7, "a", "en", 1, "x")]
    assert found(spark, rows) == [(7, "a", leaf(rows[0]), leaf(rows[0]), leaf(rows[0]), [])] and found(spark, []) == []
    assert M.roots(frame(spark, rows)).collect()[0].n_leaves == 1


def test_changed_rows_dont_fold_to_the_root(spark):
    rows = rows_of([("a", 40), ("b", 5)])
    out = M.proofs(frame(spark, rows), more={"other": M.leaf_hash("doc_id", "source", "lang", "n_chars", F.concat(F.coalesce("text", F.lit("")), F.lit("!")))})
    out = out.select("root", M.folded(F.col("leaf"), F.col("path")).alias("same"), M.folded(F.col("other"), F.col("path")).alias("other")).collect()
    assert len(out) == 45 and all(r.same == r.root and r.other != r.root for r in out)


@pytest.mark.parametrize("levels,n", [(0, 1), (1, 1), (1, 16), (2, 17), (2, 256), (3, 257), (3, 4096), (3, 600)])
def test_traversal(levels, n):
    """Paths of a block whose tree has this many levels, a lone run included."""
    leaves = [H([str(i)]) for i in range(n)]
    for i, steps in enumerate(M.traversal(leaves, levels)):
        assert len(steps) == levels
        node, at = leaves[i], i
        for before, after in steps:
            assert len(before) == 64 * (at % 16)
            node, at = H([before, node, after]), at // 16
        assert node == M.folded_block(leaves, levels)


def test_stack_is_logarithmic():
    stack = M.Treehash(3)
    for i in range(4095):
        stack.feed(str(i))
        assert all(len(run) < 16 for run in stack.open) and not stack.done
