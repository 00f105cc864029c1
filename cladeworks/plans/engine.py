"""The whole analysis as one plan over tables: quality, selection, screening, inference, reports. Lazy but for one-row decisions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mean_support, na
from ..scratch import saved
from ..operators import alignment as A
from ..operators import assertions as C
from ..operators import decisions as D
from ..operators import occupancy as O
from ..operators import quality as Q
from ..operators import selection as M
from ..operators import taxonomy as T
from ..operators import trees as R

# Presets (min_occupancy, max_markers, strategy), phases, and exit codes.
PRESETS = {"conservative": (0.90, 30, "info_max"), "standard": (0.75, 60, "greedy"), "expanded": (0.50, 120, "rate_balanced"), "mag_adaptive": (0.40, 150, "sparse_optimized")}
PHASES = ("quality", "selection", "screening", "inference", "reports")
EXIT = {"ok": 0, "error": 1, "usage": 2, "input": 3, "must_pass": 4, "unusable": 5, "interrupted": 130}


def preset(name: str) -> dict:
    """Options of a preset; values given beside it win."""
    low, most, strategy = PRESETS[name]
    return {"min_occupancy": low, "max_markers": most, "strategy": strategy}


@dataclass(frozen=True)
class Options:
    strategy: str = "greedy"
    min_occupancy: float | None = None  # None: from the genomes' quality
    max_markers: int | None = None
    score_floor: float | None = None
    level1_max: float = D.LEVEL1_MAX
    level2_max: float = D.LEVEL2_MAX
    rank: str | None = None
    stringency: int = 1
    bands: tuple = ((0.2, 0.5), (0.3, 0.6), (0.4, 0.7))
    rules: tuple = field(default_factory=tuple)
    far: bool | None = None  # None: from the spread of the lineages
    pis_floor: int = 0


def screen_steps(trees: DataFrame, references: DataFrame) -> DataFrame:
    """reference, marker_id, verdict, n_shared, nrf, quartet of each gene tree (marker_id, newick) against each reference tree
    (reference, newick; a configured few). Every tree is parsed once, all pairs are one plan; only legal pairs are measured."""
    gene = trees.select(F.concat(F.lit("g:"), F.col("marker_id").cast("string")).alias("tree_id"), "newick")
    known = references.select(F.concat(F.lit("r:"), "reference").alias("tree_id"), "newick")
    pairs = gene.select(F.col("tree_id").alias("b")).crossJoin(F.broadcast(known.select(F.col("tree_id").alias("a")))).select("a", "b")
    nodes = saved(R.nodes(gene.unionByName(known)), "nodes")
    readable = nodes.where("parent_id is null").select(F.col("tree_id").alias("b"), F.lit(True).alias("readable"))
    verdict = F.when(F.col("readable"), F.col("verdict")).when(F.col("verdict") == "MALFORMED", "MALFORMED").otherwise("GENE_TREE_MALFORMED")
    verdicts = saved(R.legality(nodes, pairs).join(readable, "b", "left").withColumn("verdict", verdict).drop("readable"), "verdicts")  # read many times below
    legal = verdicts.where("verdict = 'LEGAL'").select("a", "b")
    measured = R.rf_distance(legal, nodes).join(R.quartet_agreement(legal, nodes, drawn=1000).select("a", "b", "agreement"), ["a", "b"])
    out = verdicts.join(measured, ["a", "b"], "left")
    name = lambda c: F.substr(F.col(c), F.lit(3))
    out = out.select(name("a").alias("reference"), name("b").alias("marker_id"), "verdict", "n_shared", F.col("normalized_rf").alias("nrf"), F.col("agreement").alias("quartet"))
    return saved(out, "steps")  # a row a marker and reference, read by many products


def consistency_screen(steps: DataFrame, sites: DataFrame, stringency: int, min_pis: int) -> DataFrame:
    """marker_id, grade, strengths of both legs, from the steps against the references "coalescent" and "concat"."""
    leg = lambda which, x: F.max(F.when(F.col("reference") == which, F.struct("nrf", "quartet"))).alias(x)
    legs = steps.groupBy("marker_id").agg(leg("coalescent", "a"), leg("concat", "b"))
    legs = legs.select("marker_id", *[F.col(x)[m].alias(f"{m}_{x}") for x in "ab" for m in ("nrf", "quartet")])
    return D.consistency(legs.join(sites.select(F.col("marker_id").cast("string").alias("marker_id"), "pis"), "marker_id", "left"), stringency, min_pis)


def conflict(measured: DataFrame) -> DataFrame:
    """tree_id, verdict, n_shared, nrf, agreement, note of species trees that judge each other (trees.conflicts)."""
    note = F.when(F.col("verdict") == "LEGAL", D.conflict_note(F.col("nrf"))).otherwise(F.concat(F.lit("not performed: "), "verdict"))
    return measured.withColumn("note", note)


def unreadable(named: DataFrame, clades: DataFrame, rules: DataFrame) -> DataFrame:
    """Must-pass rows of the trees that have no clades: every rule not_checked."""
    lost = named.select("tree_id").join(clades.select("tree_id").distinct(), "tree_id", "left_anti")
    none = F.lit(None).cast("string")
    return lost.crossJoin(F.broadcast(rules)).select("tree_id", "rule", "relation", F.col("level").alias("rank"), none.alias("taxon"), F.lit(0).alias("members"), F.lit("not_checked").alias("result"))  # rules are a short configured list


def run(
    hits: DataFrame, genomes: DataFrame, quality: DataFrame, lineages: DataFrame, aln: DataFrame | None = None, trees: DataFrame | None = None, reference: DataFrame | None = None, options: Options = Options(), concat: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Products by name. hits are read by three products: give a stored table. trees: marker_id, newick; reference, concat: one newick
    (the species tree, and the concatenated one for the consistency screen); lineages: tip, lineage.

    A reference that is no legal tree for a marker rejects it: rejected is neither measured nor guessed.
    """
    spark = hits.sparkSession
    out: dict[str, DataFrame] = {"strata": Q.strata_counts(quality), "params": Q.adaptive_params(quality)}
    row = out["params"].first()  # one row; values given by the user win
    floor = row.score_floor if options.score_floor is None else options.score_floor
    low = row.min_occupancy if options.min_occupancy is None else options.min_occupancy
    most = row.max_markers if options.max_markers is None else options.max_markers
    states = O.gene_states(hits, floor)
    occ = O.occupancy(states, genomes)
    pick = {"greedy": lambda: M.greedy(occ, None, low, most), "rate_balanced": lambda: M.rate_balanced(occ, low, most), "sparse_optimized": lambda: M.sparse_optimized(occ, most), "info_max": lambda: M.info_max(states, occ, low, most)}
    out |= {"occupancy": occ, "selected": M.required(pick[options.strategy]().select("marker_id")), "best_hits": M.best_hits(hits)}
    if aln is not None:
        out |= {"sites": saved(A.site_counts(aln), "sites"), "composition": A.composition_report(aln), "supermatrix": A.supermatrix(aln)}
    if trees is not None:
        named = trees.select(F.col("marker_id").alias("tree_id"), "newick")
        clades = R.clades(named)
        taxa = T.parse_table(lineages)
        spread = [c for c in ("genus", "order") if c in taxa.columns]
        far = bool(len(spread) == 2 and T.far_distance(taxa, *spread).first().far) if options.far is None else options.far
        lacking = D.prerequisites({"coalescent tree": reference is not None, "alignment": aln is not None})
        if concat is not None and lacking:  # refused before anything is measured
            raise ValueError(f"the consistency screen lacks: {', '.join(lacking)}")
        if reference is not None:
            named_as = lambda df, name: df.select(F.lit(name).alias("reference"), "newick")
            every = named_as(reference, "coalescent")
            measured = screen_steps(trees, every if concat is None else every.unionByName(named_as(concat, "concat")))
            out["steps"] = steps = measured.where("reference = 'coalescent'").drop("reference")
            out["evaluations"] = D.evaluate(steps, options.level1_max, options.level2_max, far)
        else:  # without a species tree the taxonomy decides
            screen = D.taxonomy_screen(R.monophyly(R.nodes(named), T.long(taxa)), T.scope_rank(R.tips(clades), taxa), options.rank)
            reason = F.when(F.col("risk").isNull(), "no_informative_rank").when(F.col("cross_rank"), "cross_rank")
            risk = F.when(~F.col("cross_rank"), F.col("risk"))
            out["evaluations"] = screen.select(F.col("tree_id").alias("marker_id"), risk.alias("risk"), reason.alias("reason"), "test_rank", "n_total", "n_mono").withColumns(
                {"level": D.level(F.col("risk"), options.level1_max, options.level2_max, far), "confidence": D.confidence(F.col("risk"), options.level1_max, options.level2_max, F.lit("monophyly_only"))}
            )
        out["evaluations"] = saved(out["evaluations"], "evaluations")  # a row a marker, read by all that follows
        out["report"] = D.report(out["evaluations"])
        out["reasons"] = D.reasons(out["evaluations"])
        out["threshold_scan"] = D.threshold_scan(out["evaluations"], D.bands(spark, list(options.bands)))
        out["consensus"] = R.consensus(clades)
        if options.rules:
            rules = spark.createDataFrame(list(options.rules), "rule string, relation string, level string, min_taxa int")
            out["must_pass"] = T.must_pass(clades, R.tips(clades), taxa, rules).unionByName(unreadable(named, clades, rules))
        if concat is not None:
            out["consistency"] = consistency_screen(measured, out["sites"], options.stringency, options.pis_floor)
            out["hybrid"] = D.hybrid(out["evaluations"].withColumn("marker_id", F.col("marker_id").cast("string")), out["consistency"])
            species = lambda df: df.select(F.lit("species").alias("tree_id"), "newick")
            out["conflict"] = saved(conflict(R.conflicts(species(concat), species(reference))), "conflict")
        cached = F.col("cached") if "cached" in trees.columns else F.lit(True)  # a gene tree that the screen and the inference share
        out["independence"] = D.independence(trees.select(cached.alias("cached")))
        told = out["conflict"].select("tree_id", "nrf") if "conflict" in out else spark.createDataFrame([("species", None)], "tree_id string, nrf double")
        shared = out["independence"].select((F.col("shared_ratio") > 0).alias("shared"))
        kinds = told.select(F.col("tree_id").alias("id"), F.lit(reference is not None).alias("has_coalescent"), F.lit("conflict" in out).alias("has_report"), "nrf")
        out["recommendation"] = D.recommend(kinds.crossJoin(shared))  # one row each
        text = F.col("marker_id").cast("string").alias("marker_id")
        judged = out["evaluations"].withColumn("marker_id", text)
        if "sites" in out:
            out["evaluations"] = judged = D.pis_floor(judged.join(out["sites"].select(text, "pis"), "marker_id", "left"), options.pis_floor)
        out["evaluations"] = judged
        lengths = Q.length_coherence(out["best_hits"])
        scores = occ.join(Q.hmm_score(hits), "marker_id").join(lengths, "marker_id").withColumn("marker_id", text)
        support = trees.select(text, mean_support(F.col("newick")).alias("informativeness"))  # of the marker's own gene tree; the screen's measures are in the risk already
        scores = D.backfill(scores, judged).join(support, "marker_id", "left").withColumn("score", Q.overall_score())
        out["scores"] = scores.withColumn("level", Q.quality_level(F.col("score")))
        out["assertions"] = C.run(spark, state(out, options, far))
    return out


def state(out: dict[str, DataFrame], options: Options, far: bool) -> dict[str, DataFrame]:
    """The tables that the assertions read, as far as the run has them."""
    e = out["evaluations"]
    spark = e.sparkSession
    graded = F.count_if(F.col("level") != "unknown") / F.nullif(F.count(F.lit(1)), F.lit(0))
    whole = e.agg(graded.alias("coverage"), F.count(F.lit(1)).alias("n_markers")).withColumns(
        {"level1_max": F.lit(options.level1_max), "level2_max": F.lit(options.level2_max), "far_active": F.lit(far), "n_far_cards": F.when(F.lit(far), F.col("n_markers")).otherwise(0)}
    )
    fields = e.select(F.col("risk").alias("value"), na(F.col("risk")).alias("rendered"))
    probe = D.evaluate(spark.createDataFrame([("conflict", 1.0, 0.0), ("identical", 0.0, 1.0)], "marker_id string, nrf double, quartet double"))
    risk = lambda k: F.max(F.when(F.col("marker_id") == k, F.col("risk"))).alias(f"{k}_risk")
    found = {"fields": fields, "evaluations": e, "run": whole, "probe": probe.agg(risk("conflict"), risk("identical"))}
    if "steps" in out:
        rejected = F.when(F.col("verdict") == "LEGAL", "measured").otherwise("rejected")
        found["steps"] = out["steps"].select(F.col("marker_id").alias("gene_id"), "nrf", "quartet", rejected.alias("quartet_state"), "n_shared")
    if "sites" in out:
        found["alignments"] = out["sites"].select("marker_id", "effective_columns")
    return found


def exit_code(products: dict[str, DataFrame]) -> int:
    """4 for a violated rule or rules that tested nothing, 5 without a graded marker, else 0."""
    if "must_pass" in products:
        tally = {r["result"]: r["count"] for r in products["must_pass"].groupBy("result").count().collect()}
        if tally.get("violation") or not tally.get("pass"):
            return EXIT["must_pass"]
    if "report" in products and not (products["report"].first().coverage or 0):
        return EXIT["unusable"]
    return EXIT["ok"]
