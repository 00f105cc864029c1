"""Kendall's tau by counted inversions and column counters by blocks, against plain counts and at size."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeworks.operators import alignment as A
from cladeworks.operators import evaluation as E
from cladeworks.functions.scalars import AMBIGUOUS, GAPS


def plain_tau(rows):
    n, s, ta, tb = 0, 0, 0, 0
    for i, (a, b) in enumerate(rows):
        for c, d in rows[:i]:
            n += 1
            s += ((a > c) - (a < c)) * ((b > d) - (b < d))
            ta += a == c
            tb += b == d
    return s / math.sqrt((n - ta) * (n - tb)) if (n - ta) * (n - tb) else None


@pytest.mark.parametrize("values,n,buckets", [(1, 5, 4), (2, 40, 3), (5, 200, 4), (1000, 300, 7), (12, 400, 200)])
def test_tau_against_all_pairs(spark, values, n, buckets):
    """Ties in each column and in both, repeated rows, fewer values than buckets."""
    r = random.Random(n)
    rows = [(float(r.randrange(values)), float(r.randrange(values)) / 3) for _ in range(n)]
    df = spark.createDataFrame(rows + [(None, 1.0), (1.0, None), (float("nan"), 2.0)], "a double, b double")
    got, want = E.kendall_tau(df, buckets).first().tau, plain_tau(rows)
    assert got == want if want is None else abs(got - want) < 1e-12


def test_tau_of_nothing_and_one(spark):
    for rows in ([], [(1.0, 2.0)]):
        assert E.kendall_tau(spark.createDataFrame(rows, "a double, b double")).first().tau is None


def test_tau_with_a_frequent_value(spark):
    """A third of the rows share one a and another third one b."""
    r = random.Random(8)
    rows = [(0.5, r.random()) for _ in range(200)] + [(r.random(), 0.25) for _ in range(200)] + [(r.random(), r.random()) for _ in range(200)]
    assert abs(E.kendall_tau(spark.createDataFrame(rows, "a double, b double"), 8).first().tau - plain_tau(rows)) < 1e-12


def test_balance_is_of_all_pairs():
    r = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 17, 64, 100):
        cells = Counter(zip(r.integers(0, 9, n).tolist(), r.integers(0, 9, n).tolist()))
        x, y, w = (np.array(v) for v in zip(*[(a, b, m) for (a, b), m in cells.items()])) if cells else (np.zeros(0, int),) * 3
        want = sum(int(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) * w[i] * w[j]) for i in range(len(x)) for j in range(i))
        assert E.balance(x, y, w) == want


def test_tau_of_a_million_pairs(spark, capsys):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("a"), (F.col("id") * 7919 % n + 1000 * (F.col("id") % 2)).cast("double").alias("b"))
    began = time.time()
    got = E.kendall_tau(df)
    tau = got.first().tau
    took = time.time() - began
    a = np.arange(n)
    b = a + 1000 * ((a * pow(7919, -1, n)) % n % 2)
    order = np.argsort(b, kind="stable")
    at = np.empty(n, int)
    at[order] = np.arange(n)
    tree, lost = np.zeros(n + 1, int), 0  # inversions by a plain index of sums
    for i, k in enumerate(at.tolist()):
        seen, j = 0, k + 1
        while j > 0:
            seen += tree[j]
            j &= j - 1
        lost += i - seen
        j = k + 1
        while j <= n:
            tree[j] += 1
            j += j & -j
    _, c = np.unique(b, return_counts=True)
    ties = int((c * (c - 1) // 2).sum())
    total = n * (n - 1) // 2
    assert abs(tau - (total - ties - 2 * lost) / math.sqrt(total * (total - ties))) < 1e-9 and took < 60
    got.explain()
    assert "NestedLoopJoin BuildRight, Inner, (" not in capsys.readouterr().out


def test_every_resample_has_as_many_draws(spark):
    rows = spark.range(37).select(F.col("id").alias("place"))
    got = E.resampled(rows, "place", 37, 50, 3).groupBy("k").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("different")).collect()
    assert len(got) == 50 and {r.n for r in got} == {37} and 20 < sum(r.different for r in got) / 50 < 27  # 1 - 1/e of 37 is 23.4


def test_bootstrap_interval(spark):
    """Near the interval of plain resampling; nothing called, nothing named and repeated names have a result."""
    r = random.Random(5)
    names = [(f"m{i}", r.random() < 0.4) for i in range(300)]
    called = [(m,) for m, t in names if r.random() < (0.8 if t else 0.1)]
    frame = lambda rows: spark.createDataFrame(rows, "marker_id string")
    truth = [(m,) for m, t in names if t]
    got = E.bootstrap_f1(frame(truth), frame(called), frame([(m,) for m, _ in names] * 2), 2000).first()
    kind = {m: ((m,) in set(truth), (m,) in set(called)) for m, _ in names}

    def f1(ms):
        tp, miss = sum(all(kind[m]) for m in ms), sum(kind[m][0] != kind[m][1] for m in ms)
        return 2 * tp / (2 * tp + miss) if tp else 0.0

    plain = sorted(f1(r.choices(list(kind), k=300)) for _ in range(2000))
    assert abs(got.f1 - f1(list(kind))) < 1e-12 and abs(got.low - plain[50]) < 0.01 and abs(got.high - plain[1949]) < 0.01
    assert tuple(E.bootstrap_f1(frame(truth), frame([]), frame(truth), 20).first()) == (0.0, 0.0, 0.0)
    assert tuple(E.bootstrap_f1(frame([]), frame([]), frame([]), 20).first()) == (None, None, None)


def plain_sites(rows):
    out = {}
    for marker in {m for m, _ in rows}:
        seqs = [s for m, s in rows if m == marker and s is not None]
        width = max(map(len, seqs), default=0)
        pis = solid = gaps = 0
        for i in range(width):
            counts = Counter(s[i] for s in seqs if i < len(s))
            pis += sum(n >= 2 and c not in GAPS + AMBIGUOUS + " " for c, n in counts.items()) >= 2
            solid += any(c not in GAPS for c in counts)
            gaps += sum(n for c, n in counts.items() if c in GAPS) + sum(i >= len(s) for s in seqs)
        if width:
            out[marker] = (pis, solid, gaps / (width * len(seqs)))
    return out


def test_columns_in_blocks(spark, monkeypatch):
    """Sequences of several blocks and chunks, letters of any script, empty and null ones, a marker of a third of all rows."""
    r = random.Random(6)
    monkeypatch.setattr(A, "SITES", 16)
    monkeypatch.setattr(A, "CHUNK", 400)
    monkeypatch.setattr(A, "PIECE", 50)
    rows = [(r.choice(["hot", "hot", "m1", "m2", "m3"]), "".join(r.choices("ACGT-.~X?* aé漢😀", k=r.choice([0, 1, 5, 15, 16, 17, 90])))) for _ in range(150)] + [("hot", None), ("m4", ""), ("m5", None), ("m6", "AC")]
    df = spark.createDataFrame([(m, i, s) for i, (m, s) in enumerate(rows)], "marker_id string, taxon int, seq string")
    got = {x.marker_id: (x.pis, x.effective_columns, round(x.gap_fraction, 12)) for x in A.site_counts(df).collect()}
    assert got == {m: (p, s, round(g, 12)) for m, (p, s, g) in plain_sites(rows).items()} and A.site_counts(df.limit(0)).count() == 0
