"""Midpoint roots of trees beyond the limit of minimal ancestor deviation: walks instead of a matrix of nodes by tips."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from cladeworks.operators import newick as N


def drawn(r, n, length):
    nodes = [f"t{i}" for i in range(n)]
    while len(nodes) > 3:
        a, b = (nodes.pop(r.randrange(len(nodes))) for _ in range(2))
        nodes.append(f"({a}:{length()},{b}:{length()})")
    return f"({','.join(f'{x}:{length()}' for x in nodes)});"


def by_matrix(text):
    """The root on the middle of the first longest path, from all distances between nodes and tips."""
    tree = N.parse(text)
    near = N._graph(tree)
    tips = [i for i, c in enumerate(tree.children) if not c]
    d = np.stack([N._reach(near, t) for t in tips], axis=1)
    pair = d[tips]
    i, j = np.unravel_index(np.nanargmax(pair), pair.shape)
    half = pair[i, j] / 2
    for u in range(len(near)):
        for v in near[u]:
            if u < v:
                for a, b in ((u, v), (v, u)):
                    if abs(d[a, i] + near[a][b] + d[b, j] - pair[i, j]) < 1e-9 and d[a, i] <= half <= d[a, i] + near[a][b] + 1e-12:
                        return N._write(tree, near, a, b, half - d[a, i])


@pytest.mark.parametrize("kind", ["whole", "zero", "some", "real"])
def test_midpoint_is_that_of_all_distances(kind):
    """Lengths with many ties, without any, some of zero, and of no round value."""
    r = random.Random(kind)
    length = {"whole": lambda: r.randint(1, 3), "zero": lambda: 0, "some": lambda: r.randint(0, 1), "real": r.random}[kind]
    for _ in range(60):
        text = drawn(r, r.randint(3, 40), length)
        assert N.mad_root(text, 2) == (by_matrix(text), "midpoint", None)


def test_midpoint_of_a_large_tree_holds_no_matrix():
    text = "(" + ",".join(f"t{i}" for i in range(3000)) + ");"
    tracemalloc.start()
    assert N.mad_root(text)[1] == "midpoint"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # 3000 * 3001 distances are 72 MB


def test_a_ladder_is_written_in_one_pass():
    """A deep tree keeps its tips, and its root lies in the middle of the longest path."""
    n = 20_000
    text = "(" * (n - 1) + "t0:1" + "".join(f",t{i}:1):1" for i in range(1, n - 1)) + f",t{n - 1}:1);"
    out, method, _ = N.mad_root(text)
    near = N.parse(out)
    assert method == "midpoint" and sum(not c for c in near.children) == n and {near.label[i] for i, c in enumerate(near.children) if not c} == {f"t{i}" for i in range(n)}
