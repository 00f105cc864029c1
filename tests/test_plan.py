"""The whole plan on proxy tables, the label readers, tools that are not there, and provenance."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cladeworks.functions import labels, scalars
from cladeworks.operators import provenance, selection
from cladeworks.operators import trees as R
from cladeworks.plans import engine, proxy
from cladeworks.sources import readers, sinks, tools

SF = "/root/testdata/sf0.001"


def inputs(spark):
    trees = proxy.trees(spark, SF).select(F.col("tree_id").alias("marker_id"), "newick")
    lineages = proxy.lineage(spark, SF).withColumn("tip", F.concat(F.lit("t"), F.col("tip").cast("string")))
    return proxy.hits(spark, SF), proxy.genomes(spark, SF), proxy.quality(spark, SF), lineages, proxy.alignment(spark, SF), trees


def test_plan_by_taxonomy_and_by_reference(spark):
    hits, genomes, quality, lineages, aln, trees = inputs(spark)
    got = engine.run(hits, genomes, quality, lineages, aln, trees, options=engine.Options(score_floor=15.0, min_occupancy=0.2, rules=(("r1", "monophyletic", "domain", 2),)))
    assert got["selected"].count() > 0 and got["evaluations"].count() == proxy.N_TREES and got["report"].first().n_markers == proxy.N_TREES
    assert engine.exit_code(got) in (0, 4, 5)
    other = engine.run(hits, genomes, quality, lineages, None, trees.where("marker_id > 0"), trees.where("marker_id = 0"))
    assert {(r.state, r.reason, r.level) for r in other["evaluations"].collect()} == {("rejected", "polytomy", "unknown")}  # the stand-in species tree is not binary


def test_screens_end_to_end(spark):
    """A binary species tree: equal, reversed, foreign, short and unreadable gene trees; and both screens together."""
    hits, genomes, quality, _, _, _ = inputs(spark)
    tips = [f"t{i}" for i in range(8)]
    ladder = lambda ts: "(" * (len(ts) - 1) + ts[0] + "".join(f",{t})" for t in ts[1:]) + ";"
    far = [tips[i] for i in (0, 4, 2, 6, 1, 5, 3, 7)]
    gene = spark.createDataFrame([("equal", ladder(tips)), ("other", ladder(far)), ("foreign", ladder([*tips[:7], "alien"])), ("short", ladder(tips[:3])), ("broken", "((t0,t1),(t2")], "marker_id string, newick string")
    species, concat = (spark.createDataFrame([(ladder(ts),)], "newick string") for ts in (tips, tips))
    lineages = spark.createDataFrame([(t, "d__A;p__P") for t in tips], "tip string, lineage string")
    letters = ["WK", "WK", "KW", "KW"]
    aln = spark.createDataFrame([(m, f"t{i}", letters[i % 4] * 3) for m in ("equal", "other") for i in range(8)], "marker_id string, taxon string, seq string")
    options = engine.Options(min_occupancy=0.2, score_floor=15.0, pis_floor=3, stringency=1, rules=(("r1", "monophyletic", "phylum", 2),))
    got = engine.run(hits, genomes, quality, lineages, aln, gene, species, options, concat)
    e = {r.marker_id: (r.state, r.reason, r.risk, r.level) for r in got["evaluations"].collect()}
    assert e["equal"] == ("measured", None, 0.0, "level_1") and e["other"][0] == "measured" and e["other"][2] > 0.25
    assert e["foreign"][:2] == ("rejected", "tipset_mismatch") and e["broken"][:2] == ("rejected", "gene_tree_malformed") and e["short"][3] == "unknown"
    assert {r.marker_id: r.grade for r in got["consistency"].collect()} == {"equal": "consistent", "other": "inconclusive", "foreign": "inconclusive", "short": "inconclusive", "broken": "inconclusive"}
    assert {r.marker_id for r in got["hybrid"].where("verdict = 'passes_both'").collect()} == {"equal"}
    pair, advice = got["conflict"].first(), got["recommendation"].first()
    assert (pair.verdict, pair.nrf, pair.agreement, pair.note) == ("LEGAL", 0.0, 1.0, "concordant") and (advice.tree, advice.confidence) == ("concat", "medium") and got["independence"].first().shared_ratio == 1.0
    assert {r.informativeness for r in got["scores"].collect()} == {None}  # no gene tree has support values
    assert [(r.tree_id, r.result) for r in got["must_pass"].where("tree_id = 'broken'").collect()] == [("broken", "not_checked")]
    done = {r.assertion_id: r.result for r in got["assertions"].collect()}
    assert done["A-12"] == done["A-03"] == done["A-05"] == "pass" and done["A-08"] == "not_checked"
    table = sinks.hgt_evaluation(got["evaluations"], options.level1_max, options.level2_max)
    rows = {r.marker_id: r for r in table.collect()}
    assert len(table.columns) == 24 and rows["equal"].rf_state == "measured" and rows["foreign"].rf_state == "rejected" and rows["foreign"].overall_risk == "NA" and rows["equal"].n_signals_used == "2"
    assert '"pis_floor": 3' in sinks.run_config(options, {"engine": "1"})
    with pytest.raises(ValueError, match="alignment"):
        engine.run(hits, genomes, quality, lineages, None, gene, species, options, concat)
    with pytest.raises(selection.NoMarkerError):
        engine.run(hits, genomes, quality, lineages, options=engine.Options(min_occupancy=1.1))


def test_informativeness_is_the_gene_trees_own_support(spark):
    hits, genomes, quality, lineages, _, _ = inputs(spark)
    marker = str(hits.where("score >= 15").first().marker_id)
    gene = spark.createDataFrame([(marker, "(((t1,t2)90,t3)70,t4);"), ("no such marker", "((t1,t2)10,t3);")], "marker_id string, newick string")
    out = engine.run(hits, genomes, quality, lineages, None, gene, options=engine.Options(score_floor=15.0, min_occupancy=0.01))
    assert {r.marker_id: round(r.informativeness, 9) for r in out["scores"].where("informativeness is not null").collect()} == {marker: 0.8}
    assert out["recommendation"].first().tree == "concat" and "conflict" not in out


def test_tree_questions(spark):
    trees_ = spark.createDataFrame([(1, "(((a,b),c),((d,e),f));")], "tree_id int, newick string")
    c = R.clades(trees_)
    taxa = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "Y"), ("d", "Z"), ("f", "Z"), ("q", "W")], "tip string, taxon string")
    assert {(r.taxon, r.monophyletic) for r in R.is_monophyletic(R.nodes(trees_), taxa).collect()} == {("X", True), ("Y", True), ("Z", False)}
    asked = spark.createDataFrame([(1, ["a", "b"], ["d", "f"]), (1, ["a", "d"], ["b", "e"])], "tree_id int, left array<string>, right array<string>")
    assert {(tuple(r.left), r.present) for r in R.has_bipartition(c, asked).collect()} == {(("a", "b"), True), (("a", "d"), False)}
    pairs = spark.createDataFrame([(1, ["a", "b"], ["c"]), (1, ["d"], ["f"]), (1, ["a", "b", "c"], ["d", "e", "f"])], "tree_id int, x array<string>, y array<string>")
    assert {(tuple(r.x), r.sister) for r in R.sisters(c, pairs).collect()} == {(("a", "b"), True), (("d",), False), (("a", "b", "c"), True)}
    wanted = spark.createDataFrame([(1, "ab", "a"), (1, "ab", "b"), (1, "ad", "a"), (1, "ad", "d"), (1, "c", "c")], "tree_id int, name string, tip string")
    assert {(r.name, r.depth) for r in R.mrca_depth(R.nodes(trees_), c, wanted).collect()} == {("ab", 2), ("ad", 0), ("c", 2)}


def test_labels_and_letters(spark, tmp_path):
    df = spark.createDataFrame([("x;d__B;p__P",), ("g_d_B_p_Q_g_G_x",), ("plain",)], "label string").select("label", *scalars.read_lineage(F.col("label"), "dpg"))
    assert {(r.domain, r.phylum, r.genus) for r in df.collect()} == {("B", "P", None), ("B", "Q", "G_x"), (None, None, None)}
    (tmp_path / "a.fa").write_text(">x\nACGT\n>y\nAC-N\n")
    (tmp_path / "b.fa").write_text(">x\nMKL\n>x\nMK\n")
    seqs = readers.unique_fasta(spark, str(tmp_path / "a.fa"))
    assert readers.molecule(seqs) == "DNA" and [(r.seq_id, r.letters) for r in readers.wrong_letters(seqs, "RNA").collect()] == [("x", ["T"])]
    with pytest.raises(Exception, match="occurs twice"):
        readers.unique_fasta(spark, str(tmp_path / "b.fa")).collect()
    page = sinks.html_page("t", {"n": spark.range(5)}, rows=2)
    assert "The first 2 of 5 rows" in page and "first" not in sinks.html_page("t", {"n": spark.range(2)}, rows=2)


def test_stricter_floor_selects_a_subset(spark):
    hits, genomes, quality, lineages, _, _ = inputs(spark)
    pick = lambda low: {r.marker_id for r in engine.run(hits, genomes, quality, lineages, options=engine.Options(min_occupancy=low, max_markers=10_000))["selected"].collect()}
    assert pick(0.4) <= pick(0.3) <= pick(0.2)


def test_label_readers(spark):
    assert labels.by_last_marker("g_d_Bact_p_Prot_x_y")["phylum"] == "Prot_x_y" and labels.by_last_marker("a_d_X_d_Y") is None
    assert labels.greedy("a_d_X_d_Y_q_p_Z") == {"domain": "X", "phylum": "Z"} or labels.greedy("a_d_X_d_Y_q_p_Z")["domain"] == "X"
    df = spark.createDataFrame([("g_d_B_g_Foo_bar",), (None,)], "label string").select(labels.embedded_lineage_column("label").alias("r"))
    assert [(r.r.domain, r.r.genus) for r in df.collect()] == [("B", "Foo_bar"), (None, None)]
    assert labels.custom_levels("kingdom:k__, clade:x") == {"k": "kingdom", "x": "clade"}


def test_missing_tools_are_not_measurable(spark):
    df = spark.createDataFrame([("m1", ">a\nAC\n")], "key string, text string")
    r = tools.run_tool(df, "no-such-aligner", lambda key: ["no-such-aligner"]).first()
    assert (r.state, r.output) == ("not_measurable", None) and "not installed" in r.reason
    assert tools.run_tool(df, "cat", lambda key: ["cat"]).first().output == ">a\nAC\n" and tools.missing(["cat", "no-such-aligner"]) == ["no-such-aligner"]


def test_provenance(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    (tmp_path / "b").write_text("y")
    h = provenance.file_hashes(spark, str(tmp_path))
    assert provenance.folder_hash(h).first().sha and {r.result for r in provenance.compare(h, h).collect()} == {"ok"}
    now, old = spark.createDataFrame([("m1", "1"), ("m2", "2")], "marker_id string, sha string"), spark.createDataFrame([("m1", "1"), ("m2", "9")], "marker_id string, sha string")
    assert [r.marker_id for r in provenance.to_rebuild(now, old).collect()] == ["m2"]
    rec = spark.createDataFrame([("tool", "TODO"), ("other", None)], "name string, version string")
    assert [(r.field, r.n) for r in provenance.incomplete(rec).collect()] == [("version", 2)]
