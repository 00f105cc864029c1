"""Digests of supermatrix rows and parts of concatenated rows, against rows written out in full."""

from __future__ import annotations

import hashlib
import random

import pytest

from cladeworks.operators import alignment as A
from cladeworks.plans import marker_queries, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def drawn(spark):
    """Taxa of several markers, of one, of empty and null sequences alone, letters of any script."""
    r = random.Random(4)
    rows = [(f"m{m}", t, "".join(r.choices("ACDé漢-", k=r.choice([0, 1, 7, 30])))) for m in range(5) for t in range(40) if r.random() < 0.4] + [("m1", 90, ""), ("m2", 91, None), ("m4", 92, "AC")]
    return rows, spark.createDataFrame(rows, "marker_id string, taxon int, seq string")


def full(rows):
    """{taxon: its whole row} and the parts (marker, first, last)."""
    width = {m: max(len(s or "") for n, _, s in rows if n == m) for m, _, _ in rows}
    own = {(m, t): s or "" for m, t, s in rows}
    line = {t: "".join(own.get((m, t), "").ljust(width[m], "-") for m in sorted(width)) for _, t, _ in rows}
    at, parts = 1, []
    for m in sorted(width):
        parts.append((m, at, at + width[m] - 1))
        at += width[m]
    return line, parts


def test_digests_are_those_of_whole_rows(spark, drawn, monkeypatch):
    rows, df = drawn
    line, _ = full(rows)
    want = {t: (hashlib.sha256(s.encode()).hexdigest(), len(s)) for t, s in line.items()}
    assert {r.taxon: (r.sha, r.sites) for r in A.supermatrix_digests(df).collect()} == want
    monkeypatch.setattr(A, "GAP_BYTES", memoryview(b"-" * 3))  # gaps of several buffers
    assert {r.taxon: (r.sha, r.sites) for r in A.supermatrix_digests(df).collect()} == want
    assert {r.taxon: r.seq for r in A.supermatrix(df).collect()} == line and A.supermatrix_digests(df.limit(0)).count() == 0


def test_two_sequences_of_one_marker_are_refused(spark):
    with pytest.raises(Exception, match="two sequences of one marker"):
        A.supermatrix_digests(spark.createDataFrame([("m", 1, "AC"), ("m", 1, "GT")], "marker_id string, taxon int, seq string")).collect()


@pytest.mark.parametrize("kind", ["own", "odd"])
def test_parts_of_runs_and_of_rows(spark, drawn, kind):
    """The markers' own parts, and parts that begin and end anywhere and overlap."""
    rows, df = drawn
    line, parts = full(rows)
    r = random.Random(8)
    sites = len(next(iter(line.values())))
    if kind == "odd":
        parts = [(f"p{k}", a, min(sites, a + r.randint(0, 60))) for k in range(12) for a in [r.randint(1, sites)]]
    table = spark.createDataFrame(parts, "marker_id string, start long, stop long")
    got = {(x.marker_id, x.taxon): x.seq for x in A.split_concatenated(A.supermatrix(df), table).collect()}
    want = {(m, t): s[a - 1 : b] for m, a, b in parts for t, s in line.items()}
    assert got == {k: s for k, s in want.items() if s}
    runs = {(x.marker_id, x.taxon): x.seq for x in A.split_concatenated(A.concatenated(df), table).collect()}
    assert {k: s.rstrip("-") for k, s in runs.items() if s.rstrip("-")} == {k: s.rstrip("-") for k, s in want.items() if s.rstrip("-")}


def test_no_query_writes_the_gaps_out(spark, monkeypatch):
    """Rows times sites of text are made by neither query."""
    monkeypatch.setattr(marker_queries.A, "supermatrix", None)
    assert registry.QUERIES["supermatrix"](spark, SF).count() == 200 and registry.QUERIES["split_concatenated"](spark, SF).count() > 100
