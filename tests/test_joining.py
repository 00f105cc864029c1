"""Neighbour joining by bounds gives the tree of the plain search over all pairs, letter by letter, and takes some rows a join."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from cladeworks.operators import joining as J
from cladeworks.operators import newick as N


def plain(names, seqs):
    """All pairs in each step, on a matrix of all distances; of equal Q the first in order."""
    gaps = set(b"-.~")
    rows = [s.encode() for s in seqs]
    n = len(rows)
    d = np.zeros((n, n))
    for i in range(n):
        for j in range(i):
            both = [(x, y) for x, y in zip(rows[i], rows[j]) if x not in gaps and y not in gaps]
            d[i, j] = d[j, i] = sum(x != y for x, y in both) / max(len(both), 1)
    label, alive = [N._name(x) for x in names], list(range(n))
    while (m := len(alive)) > 3:
        sub = d[np.ix_(alive, alive)]
        r = sub.sum(1)
        q = (m - 2) * sub - r[:, None] - r[None, :]
        np.fill_diagonal(q, np.inf)
        i, j = sorted(np.unravel_index(np.argmin(q), q.shape))
        a, b = alive[i], alive[j]
        la = max(sub[i, j] / 2 + (r[i] - r[j]) / (2 * (m - 2)), 0.0)
        label[a] = f"({label[a]}:{la:.6g},{label[b]}:{max(sub[i, j] - la, 0.0):.6g})"
        d[a] = d[:, a] = (d[a] + d[b] - d[a, b]) / 2
        d[a, a] = 0
        del alive[j]
    x, y, z = alive
    ends = ((d[x, y] + d[x, z] - d[y, z]) / 2, (d[x, y] + d[y, z] - d[x, z]) / 2, (d[x, z] + d[y, z] - d[x, y]) / 2)
    return "(" + ",".join(f"{label[k]}:{max(e, 0):.6g}" for k, e in zip(alive, ends)) + ");"


def evolved(rng, n, length, letters, changes):
    pool = ["".join(rng.choice(letters) for _ in range(length))]
    while len(pool) < n:
        s = list(rng.choice(pool))
        for _ in range(min(rng.randrange(changes + 1), len(s))):
            s[rng.randrange(len(s))] = rng.choice(letters)
        pool.append("".join(s[: rng.randrange(len(s) // 2, len(s) + 1)]) if rng.random() < 0.3 else "".join(s))
    return pool


@pytest.mark.parametrize("letters", ["AC", "ACDEFGHIKLMNPQRSTVWY", "AC-", "AB.~-é"])
@pytest.mark.parametrize("length", [0, 3, 60, 2100])
def test_the_same_tree_as_by_all_pairs(letters, length):
    """Copies, cut and empty sequences and gaps: many pairs of one Q, which the order decides."""
    rng = random.Random(length)
    for n in (4, 5, 17, 40 if length < 2000 else 20):
        for changes in (0, 5, 40):
            seqs = evolved(rng, n, length, letters, changes)
            names = [f"t {k}" if k % 5 == 0 else f"t{k}" for k in range(n)]
            assert N.neighbour_joining(names, seqs) == plain(names, seqs)


def test_two_thousand_sequences_in_seconds():
    """3 s; 59 s by all pairs in each step and pairs of sequences one at a time."""
    rng = random.Random(1)
    seqs = ["".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=rng.randrange(400))) for _ in range(1950)] + ["ACDEF" * 40] * 50
    start = time.monotonic()
    text = N.neighbour_joining([f"t{k}" for k in range(2000)], seqs)
    assert time.monotonic() - start < 25
    assert {label for _, _, label, _, leaf, _, _ in N.rows(N.parse(text)) if leaf} == {f"t{k}" for k in range(2000)}


def test_a_ladder_of_joins_is_written_once():
    n = 20000
    text = N.joined([f"t{k}" for k in range(n)], [(0, k, 0.5, 0.25) for k in range(1, n - 2)], [0, n - 2, n - 1], np.ones((3, 3)) - np.eye(3))
    assert text.count("(") == n - 2 and text.endswith(f",t{n - 2}:0.5,t{n - 1}:0.5);")


def test_distances_of_whole_columns():
    assert J.distances(["AC-GT", "ACTG", "", "~~~~~~~~~C"]).tolist() == [[0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]]
    long = "A" * 5000
    assert J.distances([long, "C" * 4097, long[:-1] + "C"])[0].tolist() == [0, 1, 1 / 5000]
