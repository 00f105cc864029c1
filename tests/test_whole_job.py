"""Registered queries cover whole inputs: plain Python over every row and letter beside them."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from cladeworks.functions.scalars import AMINO
from cladeworks.operators import trees
from cladeworks.plans import engine, proxy, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sequences():
    """All letters of every document: {source: {doc_id: letters}}."""
    out = defaultdict(dict)
    for source, doc_id, text in duckdb.sql(f"SELECT source, doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall():
        out[source][doc_id] = re.sub("[^A-Za-z]", "", text or "").upper()
    return out


def rows(spark, name):
    return registry.QUERIES[name](spark, SF).collect()


def padded(seqs):
    width = max(map(len, seqs.values()))
    return {k: s.ljust(width, "-") for k, s in seqs.items()}


def test_columns_of_whole_sequences(spark, sequences):
    pis = {m: sum(sum(n >= 2 for c, n in Counter(col).items() if c not in "-.~XBZJUO?* ") >= 2 for col in zip(*padded(q).values())) for m, q in sequences.items()}
    assert {r.marker_id: r.pis for r in rows(spark, "pis")} == pis
    gapped = {m: padded({k: s.replace("T", "-") if k % 3 == 0 else s for k, s in q.items()}) for m, q in sequences.items()}
    gaps = {m: round(sum(s.count("-") for s in q.values()) / sum(map(len, q.values())), 6) for m, q in gapped.items()}
    assert {r.marker_id: r.gap_fraction for r in rows(spark, "gap_fraction")} == pytest.approx(gaps, abs=2e-6)
    solid = {m: sum(set(col) != {"-"} for col in zip(*q.values())) for m, q in gapped.items()}
    assert {r.marker_id: r.effective_columns for r in rows(spark, "effective_columns")} == solid


def test_composition_of_whole_sequences(spark, sequences):
    share = lambda s, some, of: sum(map(s.count, some)) / sum(map(s.count, of)) if sum(map(s.count, of)) else None
    gc = {(m, t): share(s, "GC", "ACGTUN") for m, q in sequences.items() for t, s in q.items()}
    got = {(r.marker_id, r.taxon): r.gc for r in rows(spark, "gc_content")}
    assert got.keys() == gc.keys() and all(got[k] is v is None or got[k] == pytest.approx(v, abs=2e-6) for k, v in gc.items())
    for r in rows(spark, "rcv"):
        freq = [[s.count(a) / sum(map(s.count, AMINO)) for a in AMINO] for s in sequences[r.marker_id].values() if sum(map(s.count, AMINO))]
        mean = [sum(c) / len(freq) for c in zip(*freq)]
        assert r.n_sequences == len(freq) and r.rcv == pytest.approx(max(sum(abs(x - y) for x, y in zip(f, mean)) / 2 for f in freq), abs=2e-6)


@pytest.mark.parametrize(("name", "step"), [("kmer_signature", 1), ("codon_usage", 3)])
def test_kmers_of_whole_sequences(spark, sequences, name, step):
    want = {}
    for m, q in sequences.items():
        for t, s in q.items():
            s = s.translate(str.maketrans("EIONRSLDH", "ACGTACGTA"))
            n = Counter(k for i in range(0, len(s) - 2, step) if not (k := s[i : i + 3]).strip("ACGT"))
            want |= {(f"{m}:{t}", k): c / n.total() for k, c in n.items()}
    assert {(r.id, r.kmer): r.freq for r in rows(spark, name)} == pytest.approx(want, abs=2e-6)


def test_hashes_and_lengths_of_whole_sequences(spark, sequences):
    want = {m: hashlib.sha256("".join(sorted(f"{t}\0{s}\n" for t, s in q.items())).encode()).hexdigest() for m, q in sequences.items()}
    assert {r.marker_id: r.sha for r in rows(spark, "content_hash")} == want
    at = 1
    for r in sorted(rows(spark, "partition_coords"), key=lambda r: r.marker_id):
        n = max(map(len, sequences[r.marker_id].values())) + len(sequences[r.marker_id]) % 7
        assert (r.start, r.stop) == (at, at + n - 1)
        at += n


def test_trees_hold_every_supplier(spark, tmp_path):
    s = duckdb.sql(f"SELECT * FROM read_parquet('{SF}/supplier.parquet')")
    duckdb.sql(f"COPY (SELECT * REPLACE (s_suppkey + 10 * k AS s_suppkey) FROM s, range(100) r(k)) TO '{tmp_path}/supplier.parquet'")
    for name in ("nation", "region"):
        duckdb.sql(f"COPY (SELECT * FROM read_parquet('{SF}/{name}.parquet')) TO '{tmp_path}/{name}.parquet'")
    keys = [k + 10 * j for (k,) in s.project("s_suppkey").fetchall() for j in range(100)]
    want = {(t, f"t{k}") for t in range(6) for k in keys if t == 0 or k % 9 != t}
    assert len(keys) == 1000 and {(r.tree_id, r.tip) for r in registry.QUERIES["tree_tips"](spark, str(tmp_path)).collect()} == want
    assert all(r.n_quartets == 200 for r in registry.QUERIES["quartet_stride"](spark, str(tmp_path)).collect())


def test_combinations_by_place():
    assert [trees.unrank(7, i) for i in range(35)] == [list(q) for q in itertools.combinations(range(7), 4)]


def test_screen_draws_quartets_over_all_tips(spark):
    """24 shared tips: gene tree m1 swaps two tips late in the alphabet, so quartets of the first tip alone say something else."""
    tips = [f"t{i:02}" for i in range(24)]
    ladder = lambda ts: "(" * (len(ts) - 1) + ts[0] + "".join(f",{t})" for t in ts[1:]) + ";"
    other = [*tips[:8], *tips[23:7:-1]]
    gene = spark.createDataFrame([("m1", ladder(other))], "marker_id string, newick string")
    reference = spark.createDataFrame([(ladder(tips),)], "newick string")
    hits, genomes, quality = (f(spark, SF) for f in (proxy.hits, proxy.genomes, proxy.quality))
    got = engine.run(hits, genomes, quality, proxy.lineage(spark, SF), None, gene, reference)["evaluations"].first().quartet

    def shape(order, q):  # in a ladder the two first of four are joined
        a = sorted(q, key=order.index)
        return frozenset([frozenset(a[:2]), frozenset(a[2:])])

    every = list(itertools.combinations(tips, 4))
    agree = lambda some: sum(shape(tips, q) == shape(other, q) for q in some) / len(some)
    want = agree([every[i] for i in sorted(random.Random(0).sample(range(len(every)), 1000))])
    assert want != agree(every[:1000]) and got == pytest.approx(want)


def test_gene_trees_hold_every_sequence(spark, sequences):
    assert {r.marker_id: r.n_tips for r in rows(spark, "gene_trees_nj")} == {m: len(q) for m, q in sequences.items()}


def test_scopes_of_all_lineitems(spark):
    """The narrowest rank at which all members of a tree agree, by hand from whole tables."""
    read = lambda t: f"read_parquet('{SF}/{t}.parquet')"
    lineage = {k: (None if k % 7 == 0 else f"{n}-{k % 3}", n, r) for k, n, r in duckdb.sql(f"SELECT s_suppkey, n_name, r_name FROM {read('supplier')} JOIN {read('nation')} ON s_nationkey = n_nationkey JOIN {read('region')} ON n_regionkey = r_regionkey").fetchall()}
    members = defaultdict(set)
    for t, k in duckdb.sql(f"SELECT l_partkey % 500, l_suppkey FROM {read('lineitem')}").fetchall():
        members[t].add(k)
    want = {}
    for t, keys in members.items():
        for rank, taxa in zip(("genus", "phylum", "domain"), zip(*(lineage[k] for k in keys if k in lineage))):
            if None not in taxa and len(set(taxa)) == 1:
                want[t] = (rank, taxa[0])
                break
    got = {r.tree_id: (r.scope, r.taxon) for r in rows(spark, "scope_rank")}
    assert got == want


def test_supermatrix_of_all_taxa(spark, sequences):
    panel = [(m, max(map(len, sequences[m].values()))) for m in sorted(sequences)]
    want = {}
    for t in {t for q in sequences.values() for t in q}:
        line = "".join(sequences[m].get(t, "").ljust(n, "-") for m, n in panel)
        want[t] = (hashlib.sha256(line.encode()).hexdigest(), len(line))
    assert {r.taxon: (r.sha, r.sites) for r in rows(spark, "supermatrix")} == want
    back = {(r.marker_id, r.taxon): r.seq for r in rows(spark, "split_concatenated")}
    assert back == {(m, t): s for m, q in sequences.items() for t, s in q.items() if s}
