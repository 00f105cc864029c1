"""Neighbour joining in rounds that hold some rows of the distances: the tree of one task with the whole matrix, letter by letter."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_joining import evolved, plain

from cladeworks.operators import held as H
from cladeworks.operators import joining as J
from cladeworks.operators import newick as N
from cladeworks.operators import trees


def by_rounds(names, seqs, cells):
    """some_joins until all distances fit; and how many rows a round held at most."""
    full = J.across(seqs)(seqs)
    sums = full.sum(axis=1)
    np.fill_diagonal(full, J._FAR)
    nodes, out, most, number = H.begin(sums, J.kinds(seqs), *H.nearest(full, sums / (len(seqs) - 2))), [], 0, 0
    while True:
        held, place = H.wanted(nodes, cells), nodes["place"]
        d = full[np.ix_(place[held], place)]
        d[np.arange(len(held)), held] = 0
        if len(held) == len(place):
            joins, left, last = J.joins(d, nodes["kind"])
            return N.joined(names, out + [(place[a], place[b], x, y) for a, b, x, y in joins], list(place[left]), last), most, number
        most, number = max(most, len(held) * len(place) - len(nodes["needed"]) * len(place)), number + 1
        joins, nodes, new = H.some_joins(nodes, held, d, number)
        assert joins or len(nodes["needed"])
        out += joins
        for p, row in new:
            full[p, nodes["place"]] = full[nodes["place"], p] = row


@pytest.mark.parametrize("letters", ["AC", "ACDEFGHIKLMNPQRSTVWY", "AC-"])
@pytest.mark.parametrize("length", [0, 3, 60])
def test_rows_held_decide_the_same_joins(letters, length):
    """Copies, cut and empty sequences and gaps: many pairs of one Q, which the order decides."""
    rng = random.Random(length)
    for n, cells in ((5, 16), (17, 100), (60, 400), (60, 1500)):
        for changes in (0, 5, 40):
            seqs = evolved(rng, n, length, letters, changes)
            names = [f"t{k}" for k in range(n)]
            text, _, rounds = by_rounds(names, seqs, cells)
            assert text == plain(names, seqs) and rounds


def test_no_more_distances_are_held_than_given():
    rng = random.Random(2)
    seqs = ["".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=rng.randrange(300))) for _ in range(500)]
    names = [f"t{k}" for k in range(500)]
    text, most, rounds = by_rounds(names, seqs, 25_000)
    assert text == N.neighbour_joining(names, seqs) and most <= 25_000 and rounds < 100


def test_rounds_over_tasks(spark):
    """Markers over the limits go by rounds and strips, a null one too, small ones by one task; all are whole and the same."""
    rng = random.Random(3)
    markers = {"a": evolved(rng, 90, 60, "ACDEFG", 12), None: evolved(rng, 70, 30, "AC-", 8), "small": evolved(rng, 9, 40, "ACDE", 5), "three": ["A", "C", "AC"], "long": evolved(rng, 12, 3000, "ACDE", 900)}
    aln = spark.createDataFrame([(m, k, s) for m, seqs in markers.items() for k, s in enumerate(seqs)], "marker_id string, taxon long, seq string").repartition(3)
    got = {r.marker_id: r for r in trees.neighbour_joining(aln, cells=1500, strip_bytes=10_000).collect()}
    assert got.keys() == markers.keys() and got["three"].newick is None and got["three"].reason
    for m, seqs in markers.items():
        if m != "three":
            assert got[m].newick == N.neighbour_joining([str(k) for k in range(len(seqs))], seqs) and got[m].method == "nj-builtin"
