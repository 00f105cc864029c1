"""Decisions: transfer risk, levels, reports, scans, consistency, conflict and recommendation. Unmeasured stays null, with a state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import weighted

# Fixed values: (largest normalised RF, least quartet agreement) of each stringency, and the risk levels' upper bounds.
BOUNDS = {1: (0.05, 0.90), 2: (0.10, 0.80), 3: (0.15, 0.70), 4: (0.20, 0.60), 5: (0.25, 0.50)}
LEVEL1_MAX, LEVEL2_MAX, FAR_LEVEL2_MAX = 0.25, 0.6, 0.95


def species_tree_risk(nrf: str = "nrf", quartet: str = "quartet", rf_weight: float = 0.5) -> Column:
    """Weighted mean of normalised RF and quartet disagreement; both must be measured."""
    mean, n = weighted([(F.col(nrf), rf_weight), (1 - F.col(quartet), 1 - rf_weight)])
    return F.when(n == 2, mean)


def level(risk: Column, level1_max: float = LEVEL1_MAX, level2_max: float = LEVEL2_MAX, far: bool = False) -> Column:
    top = max(level2_max, FAR_LEVEL2_MAX) if far else level2_max
    return F.when(risk.isNull(), "unknown").when(risk < level1_max, "level_1").when(risk < top, "level_2").otherwise("level_3")


def confidence(risk: Column, level1_max: float = LEVEL1_MAX, level2_max: float = LEVEL2_MAX, basis: Column | None = None) -> Column:
    """By the distance to the nearer threshold; monophyly alone is never high."""
    d = F.least(F.abs(risk - level1_max), F.abs(risk - level2_max)) / max(level2_max, 1e-9)
    out = F.when(risk.isNull(), None).when(d >= 0.4, "high").when(d >= 0.15, "medium").otherwise("low")
    return out if basis is None else F.when((basis == "monophyly_only") & (out == "high"), "medium").otherwise(out)


def evaluate(steps: DataFrame, level1_max: float = LEVEL1_MAX, level2_max: float = LEVEL2_MAX, far: bool = False) -> DataFrame:
    """steps (marker_id, nrf, quartet[, verdict, basis, cross_rank]) with risk, state, reason, level, confidence. A verdict but LEGAL rejects."""
    risk = F.round(species_tree_risk(), 9)
    cross = F.col("cross_rank") if "cross_rank" in steps.columns else F.lit(False)
    refused = F.col("verdict") != "LEGAL" if "verdict" in steps.columns else F.lit(False)
    why = F.lower("verdict") if "verdict" in steps.columns else F.lit(None).cast("string")
    reason = F.when(refused, why).when(F.col("nrf").isNull() & F.col("quartet").isNull(), "no_evidence").when(F.col("nrf").isNull(), "rf_unmeasured").when(F.col("quartet").isNull(), "quartet_unmeasured").when(cross, "cross_rank")
    out = steps.withColumns({"reason": reason, "risk": F.when(~cross & ~refused, risk)})
    basis = F.col("basis") if "basis" in steps.columns else None
    return out.withColumns({"state": F.when(refused, "rejected").when(F.col("risk").isNull(), "not_measurable").otherwise("measured"), "level": level(F.col("risk"), level1_max, level2_max, far), "confidence": confidence(F.col("risk"), level1_max, level2_max, basis)})


def taxonomy_screen(monophyly: DataFrame, scopes: DataFrame, requested: str | None = None) -> DataFrame:
    """tree_id, scope, test_rank, proportion, n_total, n_mono, risk, cross_rank: monophyly at the requested rank, else one below
    the scope, else genus; where that has no value, the other ranks from species upwards are tried in turn."""
    from ..functions.scalars import RANKS

    ranks = F.array(*map(F.lit, RANKS))
    place = F.array_position(ranks, F.col("scope"))
    auto = F.when(F.col("scope").isNull(), "genus").otherwise(F.element_at(ranks, F.least(place + 1, F.lit(len(RANKS))).cast("int")))
    wanted = F.lit(requested) if requested else auto
    all_trees = monophyly.select("tree_id").unionByName(scopes.select("tree_id")).distinct()
    base = all_trees.join(scopes.select("tree_id", "scope"), "tree_id", "left").withColumn("wanted", wanted)
    order = F.when(F.col("rank") == F.col("wanted"), 0).otherwise(len(RANKS) + 1 - F.array_position(ranks, F.col("rank")))
    tried = base.join(monophyly, "tree_id", "left").withColumn("turn", order)
    first = tried.groupBy("tree_id", "scope", "wanted").agg(F.min_by(F.struct("rank", "proportion", "n_total", "n_mono"), "turn").alias("m"))
    return first.select(
        "tree_id", "scope", F.col("m.rank").alias("test_rank"), "m.proportion", "m.n_total", "m.n_mono", (1 - F.col("m.proportion")).alias("risk"), (F.lit(requested is not None) & (F.col("m.rank") != F.col("wanted"))).alias("cross_rank")
    )


def report(evaluations: DataFrame) -> DataFrame:
    """One row: counts by level, coverage, high-confidence count, and the mean risk with unknown counted as 0."""
    n = F.count(F.lit(1))
    return evaluations.agg(
        *[F.count_if(F.col("level") == x).alias(f"n_{x}") for x in ("level_1", "level_2", "level_3", "unknown")], n.alias("n_markers"), F.avg(F.coalesce("risk", F.lit(0.0))).alias("mean_risk"),
        F.count_if(F.col("confidence") == "high").alias("n_high_confidence"), (F.count_if(F.col("level") != "unknown") / F.nullif(n, F.lit(0))).alias("coverage"),
    )


def tally(evaluations: DataFrame, keys: list[str], sets: list[list[str]]) -> DataFrame:
    """keys, grouping_id, n, mean_risk for each of the grouping sets, in one pass; grouping_id has a bit for each key that a row sums over."""
    counted = evaluations.groupingSets([[F.col(k) for k in one] for one in sets], *keys)
    return counted.agg(F.grouping_id(*keys).alias("grouping_id"), F.count(F.lit(1)).alias("n"), F.avg("risk").alias("mean_risk"))


def reasons(evaluations: DataFrame) -> DataFrame:
    """reason, n, first: why markers are unknown, with the first eight ids."""
    return evaluations.where("level = 'unknown'").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set(F.col("marker_id").cast("string"))), 1, 8), ",").alias("first"))


def backfill(scores: DataFrame, evaluations: DataFrame) -> DataFrame:
    """scores with hgt_risk, null where the level is unknown or there is no evaluation."""
    return scores.join(evaluations.select("marker_id", F.when(F.col("level") != "unknown", F.col("risk")).alias("hgt_risk")), "marker_id", "left")


def bands(spark, pairs: list[tuple[float, float]]) -> DataFrame:
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pairs)], "band int, l1 double, l2 double")


def threshold_scan(evaluations: DataFrame, band_table: DataFrame) -> DataFrame:
    """Per band: markers by level, selected (not level 3), on a threshold, mean risk of the graded. Stored risks are graded anew."""
    rows = evaluations.select("marker_id", "risk").crossJoin(F.broadcast(band_table))  # a configured handful of bands
    r = F.col("risk")
    at = (r == F.col("l1")) | (r == F.col("l2"))
    return rows.groupBy("band", "l1", "l2").agg(
        F.count_if(r < F.col("l1")).alias("n_l1"), F.count_if((r >= F.col("l1")) & (r < F.col("l2"))).alias("n_l2"), F.count_if((r >= F.col("l2")) & (r >= F.col("l1"))).alias("n_l3"), F.count_if(r.isNull()).alias("n_unknown"),
        F.count_if(r.isNull() | (r < F.col("l2"))).alias("n_selected"), F.count_if(at).alias("n_at_boundary"), F.avg("risk").alias("mean_risk"),
    )


def scan_jaccard(evaluations: DataFrame, band_table: DataFrame) -> DataFrame:
    """a, b, jaccard of the selected sets of each two bands; two empty sets are equal. Counted, sets are never gathered."""
    x, y = band_table.select(F.col("band").alias("a"), F.col("l2").alias("la")), band_table.select(F.col("band").alias("b"), F.col("l2").alias("lb"))
    pairs = x.crossJoin(F.broadcast(y)).where("a < b")
    rows = evaluations.select("risk").crossJoin(F.broadcast(pairs))
    a, b = F.col("risk").isNull() | (F.col("risk") < F.col("la")), F.col("risk").isNull() | (F.col("risk") < F.col("lb"))
    counted = rows.groupBy("a", "b").agg(F.count_if(a & b).alias("both"), F.count_if(a | b).alias("either"))
    return counted.select("a", "b", F.when(F.col("either") == 0, 1.0).otherwise(F.col("both") / F.col("either")).alias("jaccard"))


def scan_stability(jaccard: DataFrame, floor: float = 0.5) -> DataFrame:
    return jaccard.agg(F.min("jaccard").alias("min_jaccard")).withColumn("stable", F.coalesce(F.col("min_jaccard") >= floor, F.lit(True)))


def agrees(nrf: Column, quartet: Column, stringency: int) -> Column:
    most, least = BOUNDS[stringency]
    return F.when(nrf.isNotNull() & quartet.isNotNull(), (nrf <= most) & (quartet >= least))


def consistency(legs: DataFrame, stringency: int = 1, min_pis: int = 0) -> DataFrame:
    """legs (marker_id, nrf_a, quartet_a, nrf_b, quartet_b, pis) with grade and strength of both legs.

    Both agree: consistent; exactly one: inconsistent; none, an unmeasured leg or too few sites: inconclusive.
    """
    a, b = agrees(F.col("nrf_a"), F.col("quartet_a"), stringency), agrees(F.col("nrf_b"), F.col("quartet_b"), stringency)
    grade = F.when(F.coalesce(F.col("pis") < min_pis, F.lit(False)), "inconclusive").when(a.isNull() | b.isNull(), "inconclusive").when(a & b, "consistent").when(a | b, "inconsistent").otherwise("inconclusive")
    return legs.select("marker_id", grade.alias("grade"), (F.col("quartet_a") - F.col("nrf_a")).alias("strength_a"), (F.col("quartet_b") - F.col("nrf_b")).alias("strength_b"))


def grade_tally(grades: DataFrame) -> DataFrame:
    return grades.agg(*[F.count_if(F.col("grade") == g).alias(g) for g in ("consistent", "inconsistent", "inconclusive")])


def hybrid(evaluations: DataFrame, grades: DataFrame) -> DataFrame:
    """marker_id, verdict: both screens must pass."""
    joined = evaluations.select("marker_id", "level").join(grades.select("marker_id", "grade"), "marker_id", "left")
    return joined.select("marker_id", F.when(F.col("level") == "level_3", "excluded_by_transfer").when(F.col("grade") == "consistent", "passes_both").otherwise("excluded_by_consistency").alias("verdict"))


def pis_floor(evaluations: DataFrame, floor: int) -> DataFrame:
    """evaluations with note: graded markers with fewer informative sites are inconclusive; the level stays."""
    low = (F.col("pis") < floor) & (F.col("level") != "unknown")
    return evaluations.withColumn("note", F.when(low, "inconclusive"))


def prerequisites(have: dict[str, bool]) -> list[str]:
    """Names of what the consistency screen lacks; it refuses to run unless none."""
    return sorted(k for k, ok in have.items() if not ok)


def conflict_note(nrf: Column) -> Column:
    return F.when(nrf.isNull(), "not_measurable").when(nrf < 0.1, "concordant").when(nrf < 0.3, "minor_conflict").otherwise("major_conflict")


def recommend(reports: DataFrame) -> DataFrame:
    """reports (id, has_coalescent, has_report, nrf, shared) with tree and confidence."""
    nrf = F.col("nrf")
    tree = F.when(~F.col("has_coalescent"), "concat").when(~F.col("has_report"), "unknown").when(nrf.isNull(), "none").when(nrf < 0.1, "concat").otherwise("coalescent")
    conf = (
        F.when(~F.col("has_coalescent"), "medium").when(~F.col("has_report"), "unknown").when(nrf.isNull(), "inconclusive").when(nrf < 0.1, F.when(F.col("shared"), "medium").otherwise("high"))
        .when(nrf < 0.3, "medium").otherwise("low")
    )
    return reports.withColumns({"tree": tree, "confidence": conf})


def independence(trees: DataFrame) -> DataFrame:
    """One row: the share of gene trees that the screen and the inference share (cached)."""
    return trees.agg((F.count_if("cached") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("shared_ratio"), F.lit(True).alias("ref_built_from_tested_markers"))


def reciprocal_best(hits: DataFrame) -> DataFrame:
    """q, s (q < s): each the other's best by score, then smallest id. hits: q, s, score."""
    best = hits.where("q <> s").groupBy("q").agg(F.max_by("s", F.struct(F.col("score"), -F.col("s"))).alias("s"))
    return best.alias("x").join(best.alias("y"), (F.col("x.q") == F.col("y.s")) & (F.col("x.s") == F.col("y.q"))).where("x.q < y.q").select(F.col("x.q").alias("q"), F.col("x.s").alias("s"))


def length_representative(seqs: DataFrame) -> DataFrame:
    """marker_id, median, id: the sequence nearest to the upper median length, smallest id first."""
    w = Window.partitionBy("marker_id")
    ranked = seqs.select("marker_id", "id", "length").withColumns({"i": F.row_number().over(w.orderBy("length", "id")), "n": F.count(F.lit(1)).over(w)})
    median = ranked.where(F.col("i") == F.floor(F.col("n") / 2) + 1).select("marker_id", F.col("length").alias("median"))
    return seqs.join(median, "marker_id").groupBy("marker_id", "median").agg(F.min_by("id", F.struct(F.abs(F.col("length") - F.col("median")), F.col("id"))).alias("id"))
