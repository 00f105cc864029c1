"""Majority and greedy consensus trees against plain sets."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from cladeworks.operators import consensus as K
from cladeworks.operators import newick as N
from cladeworks.operators import trees as R


def trees(seed, n, tips):
    """Trees near each other: each swaps a few tips of one base tree; some lack a tip that others have."""
    r, out = random.Random(seed), []

    def build(names):
        nodes = list(names)
        while len(nodes) > 2:
            k = random.Random(f"{seed} {len(nodes)}").randrange(len(nodes) - 1)
            nodes[k : k + 2] = [f"({nodes[k]},{nodes[k + 1]})"]
        return f"({','.join(nodes)});"

    for i in range(n):
        names = [f"t{k:02}" for k in range(tips)]
        for _ in range(r.randrange(4)):
            a = r.randrange(tips - 1)
            names[a], names[a + 1] = names[a + 1], names[a]
        out.append(build([*names, "extra"] if i % 2 else names))
    return out


def plain(texts, share=None, least=0.0):
    """(clusters with support) of the majority or greedy consensus."""
    found = [N.leaf_sets(N.parse(t)) for t in texts]
    common = set.intersection(*[f[0] for f in found])
    first, counts = min(common), Counter()
    for f in found:
        sides = {frozenset(s & common) for s in f.values()}
        counts.update({frozenset(common - s) if first in s else s for s in sides if len(s) >= 2 and len(common - s) >= 2})
    support = {c: k / len(texts) for c, k in counts.items()}
    if share is not None:
        return {c: s for c, s in support.items() if s > share}, common
    return {c: s for c, s in support.items() if s > least}, common


def crosses(a, b):
    return bool(a & b) and not a <= b and not b <= a


def read(text):
    tree = N.parse(text)
    sets = N.leaf_sets(tree)
    return {frozenset(s): float(tree.label[i]) for i, s in sets.items() if tree.children[i] and i}, sets[0]


@pytest.mark.parametrize("seed,n,tips", [(1, 7, 12), (2, 10, 9), (3, 3, 20), (4, 5, 4), (5, 4, 3)])
def test_against_plain_sets(spark, seed, n, tips):
    texts = trees(seed, n, tips)
    nodes = R.nodes(spark.createDataFrame(list(enumerate(texts)), "tree_id int, newick string")).persist()
    common = K.common_tips(nodes)
    found = K.clusters(nodes, common)
    want, every = plain(texts, 0.5)
    got, tip_set = read(K.as_newick(K.assembled(K.majority(found), nodes, common)).first().newick)
    assert tip_set == every and {c: round(s, 3) for c, s in want.items()} == got
    known, _ = plain(texts)
    got, tip_set = read(K.as_newick(K.assembled(K.greedy(found, nodes, common), nodes, common)).first().newick)
    assert tip_set == every and set(want) <= set(got) and all(abs(known[c] - s) < 6e-4 for c, s in got.items())
    taken = list(got)
    assert not any(crosses(a, b) for a in taken for b in taken)
    for c, s in known.items():  # what is left out crosses a cluster taken that comes before it, or as early
        if c not in got:
            assert any(crosses(c, t) and (known[t], len(t)) >= (s, len(c)) for t in taken)


def test_a_share_below_a_half_is_refused(spark):
    with pytest.raises(ValueError):
        K.majority(spark.createDataFrame([], "cluster struct<n:long>, support double"), 0.3)
