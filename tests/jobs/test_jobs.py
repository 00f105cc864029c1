"""The jobs over copies of the given tables: equal to SQL, safe to repeat, incremental over growing input, and by command line."""

from __future__ import annotations

import logging
import os
import pathlib
import subprocess
import sys

import duckdb
import pytest

from jobs import clade_panels, sequence_ledger
from jobs import queries as J
from jobs.common import configured

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).parents[2]


def rows(df):
    columns = sorted(df.columns)
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def sql(text, folder=SF):
    c = duckdb.connect()
    for name in os.listdir(SF):
        path = f"{folder}/{name}" if os.path.exists(f"{folder}/{name}") else f"{SF}/{name}"
        c.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    found = c.sql(text)
    return sorted(map(repr, found.select(*sorted(found.columns)).fetchall()))


def files(path):
    return {str(p.relative_to(path)) for p in pathlib.Path(path).rglob("*.parquet")}


def test_panels_equal_sql_and_repeat(spark, tmp_path, caplog):
    out, config = str(tmp_path / "out"), configured("clade_panels")
    with caplog.at_level(logging.INFO, "jobs"):
        first = rows(clade_panels.run(spark, SF, out, config))
    assert "read" in caplog.text and "wrote" in caplog.text and len(first) > 20
    assert rows(clade_panels.run(spark, SF, out, config)) == first == sql(J.ORACLES["job1_clade_panels"])


def test_panels_of_one_clade_leave_the_others(spark, tmp_path):
    """A refreshed clade is replaced, with what an interrupted run left in it; the others keep their files. A whole run clears what is no clade."""
    out, config = str(tmp_path / "out"), configured("clade_panels")
    whole = rows(clade_panels.run(spark, SF, out, config))
    clades = sorted(p.name for p in pathlib.Path(out).glob("clade=*"))
    assert len(clades) > 1
    name = clades[0].removeprefix("clade=")
    stray = spark.read.parquet(f"{out}/{clades[1]}").limit(1)
    stray.write.parquet(f"{out}/{clades[0]}", mode="append")
    stray.write.parquet(f"{out}/clade=GONE")
    others = {f for f in files(out) if not f.startswith(clades[0])}
    again = clade_panels.run(spark, SF, out, config | {"only": [name]})
    assert {f for f in files(out) if not f.startswith(clades[0])} == others and rows(again.where("clade <> 'GONE'")) == whole
    assert rows(clade_panels.run(spark, SF, out, config)) == whole


def test_panels_of_empty_tables(spark, tmp_path):
    for name in ("supplier", "lineitem", "nation", "region"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert clade_panels.run(spark, str(tmp_path), str(tmp_path / "out"), configured("clade_panels")).count() == 0


@pytest.fixture
def growing(spark, tmp_path):
    """Adds rows of the documents to a copied table, a file each time."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = tmp_path / "in" / "documents.parquet"

    def add(condition, extra=()):
        part = docs.where(condition).unionByName(spark.createDataFrame(list(extra), docs.schema))
        part.coalesce(1).write.mode("append").parquet(str(folder))
        return part.count()

    return add


def ledger(spark, tmp_path):
    return sequence_ledger.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), configured("sequence_ledger"))


ODD = [(10_001, None, "en", None, None), (10_002, "‮GATTACA\x01nnx", None, "src0", 3), (None, "", "en", "", 0), (10_004, "AC" * 60_000, "de", "src0", 1), (10_004, "AC" * 60_000, "de", "src0", 1)]


def test_ledger_takes_only_what_is_new(spark, tmp_path, growing, caplog):
    n = growing("doc_id % 3 = 0", ODD)
    assert ledger(spark, tmp_path).count() == n
    before = files(tmp_path / "out" / "profiles")
    with caplog.at_level(logging.INFO, "jobs"):
        growing("doc_id % 3 = 1 and source <> 'src1'")
        m = ledger(spark, tmp_path).count() - n
    assert f"read {m} new rows" in caplog.text and before < files(tmp_path / "out" / "profiles")
    assert {f.split("/")[0] for f in files(tmp_path / "out" / "profiles")} == {"batch_id=0", "batch_id=1"}
    made = files(tmp_path / "out" / "profiles")
    found = ledger(spark, tmp_path)  # nothing new
    assert files(tmp_path / "out" / "profiles") == made and found.count() == n + m
    assert rows(found.drop("last_batch")) == [x for x in sql(f"SELECT * EXCLUDE (last_batch) FROM ({J.ORACLES['job2_sequence_ledger']})", str(tmp_path / "in"))]
    assert {(r.marker_id, r.last_batch) for r in found.select("marker_id", "last_batch").distinct().where("marker_id in ('src0', 'src1')").collect()} == {("src0", 1), ("src1", 0)}
    assert found.where("taxon = 10004").count() == 2 and found.where("taxon = 10002").first().control_chars


def test_ledger_of_an_empty_table(spark, tmp_path, growing):
    growing("false")
    assert ledger(spark, tmp_path).count() == 0
    n = growing("doc_id < 20")
    assert ledger(spark, tmp_path).count() == n


def test_ledger_after_a_lost_batch(spark, tmp_path, growing):
    """A batch whose commit was lost is taken again, into the same partition."""
    growing("doc_id % 2 = 0")
    ledger(spark, tmp_path)
    growing("doc_id % 2 = 1")
    whole = rows(ledger(spark, tmp_path))
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    assert rows(ledger(spark, tmp_path)) == whole


def test_ledger_fingerprint_is_of_content_alone(spark, tmp_path, growing):
    """The same rows in one file or in three, in any order."""
    prints = []
    for parts in (["true"], ["doc_id % 3 = 2", "doc_id % 3 = 0", "doc_id % 3 = 1"]):
        for condition in parts:
            growing(condition)
            out = ledger(spark, tmp_path).select("marker_id", "n_sequences", "fingerprint").distinct()
        prints.append(rows(out))
        for name in ("in", "out", "checkpoint"):
            os.rename(tmp_path / name, tmp_path / f"{name}{len(prints)}")
    assert prints[0] == prints[1]


def test_command_line(tmp_path):
    config = tmp_path / "own.json"
    config.write_text('{"only": ["ASIA"]}')
    done = subprocess.run([sys.executable, "-m", "jobs.clade_panels", "--input", SF, "--output", str(tmp_path / "out"), "--config", str(config)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "wrote extraction list" in done.stderr and [p.name for p in (tmp_path / "out").glob("clade=*")] in ([], ["clade=ASIA"])
    lost = subprocess.run([sys.executable, "-m", "jobs.sequence_ledger", "--input", SF], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert lost.returncode == 2 and "--output" in lost.stderr


def test_jobs_use_no_corpus_operators():
    code = "import sys, jobs.queries; print([m for m in sys.modules if 'llm' in m.split('.') or m == 'corpus_pipeline'])"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True).stdout.strip() == "[]"
