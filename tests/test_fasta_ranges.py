"""FASTA files read in ranges, against a plain reader."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from cladeworks.sources import readers

RANGE = "spark.sql.files.maxPartitionBytes"


def plain(text):
    """(id, sequence) of each record."""
    out = []
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        if line.startswith(">"):
            out.append([line[1:].strip().split()[0] if line[1:].strip() else "", ""])
        elif out:
            out[-1][1] += "".join(line.split())
    return [tuple(x) for x in out]


@pytest.fixture
def ranges(spark):
    before = spark.conf.get(RANGE)
    yield lambda size: spark.conf.set(RANGE, size)
    spark.conf.set(RANGE, before)


@pytest.mark.parametrize("size", [64, 100, 1000, 1 << 20])
def test_ranges_and_odd_files(spark, tmp_path, ranges, size):
    """Ranges that end inside a name, a sequence, between a line end and the next record's mark; text before records, empty records, all line ends."""
    r = random.Random(size)
    texts = {f"f{k}.fa": "".join(f">s{i % 17} d > e{end}" + "".join("".join(r.choices("ACGT", k=r.randrange(1, 40))) + end for _ in range(r.randrange(4))) for i in range(60)) for k, end in enumerate(["\n", "\r\n", "\r"])}
    texts |= {"head.fa": "; a note\n\n>a\nAC\n>b\n>c x\nG T\nA", "none.fa": "no record\nat all\n", "blank.fa": "\n\n>a\nAC\n", "one.fa": ">lone\nACGT"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    ranges(size)
    found = readers.fasta_records(spark, str(tmp_path)).collect()
    for name, text in texts.items():
        rows = sorted((r for r in found if r.path.endswith("/" + name)), key=lambda r: tuple(r.ordinal))
        assert [(r.seq_id, r.seq) for r in rows] == plain(text), name
    last = {(r.path.rsplit("/", 1)[1], r.seq_id): r.seq for r in readers.fasta(spark, str(tmp_path)).collect()}
    assert last == {(name, i): s for name, text in texts.items() for i, s in plain(text)}


def test_a_large_file_is_many_tasks(spark, tmp_path, ranges):
    """64 MB in ranges of 4 MB: every record once, whatever range its bytes lie in."""
    r = random.Random(1)
    line = ["".join(r.choices("ACDEFGHIKLMNPQRSTVWY", k=80)) for _ in range(500)]
    with open(tmp_path / "big.fa", "w") as f:
        counts = Counter()
        for i in range(60_000):
            n = r.choice([1, 5, 12, 40])
            f.write(f">s{i} of many\n" + "\n".join(line[(i + k) % 500] for k in range(n)) + "\n")
            counts["n"] += 1
            counts["letters"] += 80 * n
    ranges(4 << 20)
    rows = readers.fasta_records(spark, str(tmp_path / "big.fa"))
    got = rows.selectExpr("count(*) n", "count(distinct seq_id) ids", "sum(length(seq)) letters", "count(distinct ordinal.range) tasks").first()
    assert (got.n, got.ids, got.letters) == (counts["n"], counts["n"], counts["letters"]) and got.tasks >= 15
