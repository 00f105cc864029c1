"""Marker selection strategies and the extraction of the chosen sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Resolution presets (min_occupancy, max_markers, strategy).
STRATEGIES = ("greedy", "info_max", "rate_balanced", "sparse_optimized")


class NoMarkerError(ValueError):
    """No marker satisfies the strategy."""


def required(chosen: DataFrame) -> DataFrame:
    """chosen, unless it is empty: a plan without markers is an error, found at once and not by its reports."""
    if chosen.isEmpty():
        raise NoMarkerError("no marker satisfies the strategy")
    return chosen


def greedy(occ: DataFrame, params: DataFrame | None = None, min_occupancy: float = 0.35, max_markers: int = 150) -> DataFrame:
    """Markers of min_occupancy or more, most occupied first, max_markers at most. params: one row that overrides both."""
    if params is None:
        return occ.where(F.col("occupancy") >= min_occupancy).orderBy(F.col("occupancy").desc(), "marker_id").limit(max_markers)
    from .occupancy import occupancy_rank

    joined = occ.crossJoin(F.broadcast(params.select("min_occupancy", "max_markers"))).where("occupancy >= min_occupancy")  # params is one row
    ranked = occupancy_rank(joined.select("marker_id", "occupancy"))
    return ranked.crossJoin(F.broadcast(params.select("max_markers"))).where("rank <= max_markers").select("marker_id", "occupancy", "rank")


def greedy_by(occ: DataFrame, params: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """greedy() in each group: `by`, marker_id, occupancy, rank. params: min_occupancy and max_markers, a row a group. A group's rows are its markers, one each."""
    order = Window.partitionBy(*by).orderBy(F.col("occupancy").desc(), "marker_id")
    able = occ.join(params.select(*by, "min_occupancy", "max_markers"), list(by)).where("occupancy >= min_occupancy")
    return able.withColumn("rank", F.row_number().over(order)).where("rank <= max_markers").select(*by, "marker_id", "occupancy", "rank")


def rate_balanced(occ: DataFrame, min_occupancy: float = 0.35, max_markers: int = 150) -> DataFrame:
    """0.6 occupancy + 0.4 single-copy rate discounted by the multi-copy rate's distance from 5 %."""
    balance = F.col("occupancy") * F.greatest(F.lit(0.0), 1 - F.abs(F.col("multi_rate") - 0.05) / F.lit(0.05 + 0.01))
    scored = occ.where(F.col("occupancy") >= min_occupancy).withColumn("composite", F.round(0.6 * F.col("occupancy") + 0.4 * balance, 9))
    return scored.orderBy(F.col("composite").desc(), "marker_id").limit(max_markers).select("marker_id", "occupancy", "composite")


def sparse_optimized(occ: DataFrame, max_markers: int = 150) -> DataFrame:
    """Any marker that occurs, most occupied first; the floor is ignored."""
    return occ.where("occupancy > 0").orderBy(F.col("occupancy").desc(), "marker_id").limit(max_markers).select("marker_id", "occupancy")


def from_files(occ: DataFrame, min_occupancy: float, max_markers: int) -> DataFrame:
    """Selection over per-marker files (marker_id, occupancy, position): file order unless the list must be trimmed."""
    ok = occ.where(F.col("occupancy") >= min_occupancy)
    if ok.count() > max_markers:
        return ok.orderBy(F.col("occupancy").desc(), "position").limit(max_markers)
    return ok.orderBy("position")


def single_copy_overlap(states: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """a, b (a < b), shared: genomes that have both markers once; only pairs that share one."""
    one = states.where("state = 'single_copy'").select("genome_id", "marker_id")
    if markers is not None:
        one = one.join(markers.select("marker_id"), "marker_id", "left_semi")
    x, y = one.select("genome_id", F.col("marker_id").alias("a")), one.select("genome_id", F.col("marker_id").alias("b"))
    return x.join(y, "genome_id").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def info_max(states: DataFrame, occ: DataFrame, min_occupancy: float = 0.35, max_markers: int = 150) -> DataFrame:
    """Greedy by gain: occupancy less half the mean Jaccard overlap with the chosen; stops at no gain.

    Spark counts the overlaps; the loop runs on the driver over the eligible markers' pairs (a marker panel has
    hundreds, PANEL at most, or it is refused).
    """
    eligible = occ.where(F.col("occupancy") >= min_occupancy)
    rows = eligible.orderBy(F.col("occupancy").desc(), "marker_id").limit(PANEL + 1).collect()
    if not rows:
        raise NoMarkerError("no marker reaches the occupancy floor")
    if len(rows) > PANEL:
        raise ValueError(f"more than {PANEL} eligible markers: raise the floor")
    size = {r.marker_id: r.n_single for r in rows}
    occ_of = {r.marker_id: r.occupancy for r in rows}
    shared = {(r.a, r.b): r.shared for r in single_copy_overlap(states, eligible).collect()}

    def jaccard(a, b):
        both = shared.get((a, b) if a < b else (b, a), 0)
        union = size[a] + size[b] - both
        return both / union if union else 0.0

    left, chosen, overlap = [r.marker_id for r in rows], [], dict.fromkeys(size, 0.0)
    while left and len(chosen) < max_markers:
        gain = {m: occ_of[m] - (0.5 * overlap[m] / len(chosen) if chosen else 0.0) for m in left}
        best = max(left, key=lambda m: gain[m])
        if gain[best] <= 0:
            break
        chosen.append(best)
        left.remove(best)
        for m in left:
            overlap[m] += jaccard(m, best)
    kind = occ.schema["marker_id"].dataType.simpleString()
    return occ.sparkSession.createDataFrame([(m, float(occ_of[m]), i + 1) for i, m in enumerate(chosen)], f"marker_id {kind}, occupancy double, rank int")


PANEL = 5000


def best_hits(hits: DataFrame) -> DataFrame:
    """The best row of each genome and marker: highest score, then smallest target, then first row."""
    key = F.struct(F.col("score"), -F.col("target"), -F.col("ordinal"), -F.col("length"))
    return hits.groupBy("genome_id", "marker_id").agg(F.max_by(F.struct("target", "score", "length", "ordinal"), key).alias("b")).select("genome_id", "marker_id", "b.*")


def extract_slices(best: DataFrame, sequences: DataFrame) -> DataFrame:
    """best (target, ali_start, ali_end) with the aligned part of its sequence; a missing target gives the empty sequence, a bad range the whole."""
    joined = best.join(sequences.select("target", "seq"), "target", "left")
    ok = (F.col("ali_start") > 0) & (F.col("ali_end") > 0) & (F.col("ali_end") <= F.length("seq"))
    cut = F.substring(F.col("seq"), F.col("ali_start"), F.greatest(F.col("ali_end") - F.col("ali_start") + 1, F.lit(0)))
    return joined.withColumn("seq", F.coalesce(F.when(ok, cut).otherwise(F.col("seq")), F.lit("")))
