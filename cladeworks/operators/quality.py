"""Genome quality strata, adaptive parameters, and marker quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What each share of high-quality genomes sets (score floor, min occupancy, max markers, trimming, allow partial).
ADAPTIVE = {"high": (30.0, 0.75, 60, "strict_gap", False), "medium": (20.0, 0.55, 80, "gap", False), "low": (15.0, 0.35, 150, "gap", True)}


def stratum(completeness: str = "completeness", contamination: str = "contamination") -> Column:
    c, x = F.col(completeness), F.col(contamination)
    return F.when(x >= 10, "contaminated").when((c > 90) & (x < 5), "high").when((c >= 70) & (x < 10), "medium").otherwise("low")


def quality_score() -> Column:
    return F.col("completeness") - 5 * F.col("contamination")


def default_quality(source_type: str = "source_type") -> DataFrame:
    """completeness, contamination, quality_score of a genome that was not measured, by source type."""
    mag = F.lower(F.col(source_type)).isin("mag", "sag")
    return F.struct(F.when(mag, 75.0).otherwise(98.0).alias("completeness"), F.when(mag, 5.0).otherwise(1.0).alias("contamination"), F.when(mag, 50.0).otherwise(93.0).alias("quality_score"))


def strata_counts(quality: DataFrame) -> DataFrame:
    return quality.groupBy(stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


def adaptive_params(quality: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A row of thresholds (a row a group with `by`) by the share of high-quality genomes; no genomes count as low."""
    row = quality.groupBy(*by).agg((F.count_if(stratum() == "high") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("high_ratio"))
    branch = F.when(F.col("high_ratio") > 0.7, "high").when(F.col("high_ratio") > 0.3, "medium").otherwise("low")
    names = ("score_floor", "min_occupancy", "max_markers", "trimming", "allow_partial")

    def pick(i):
        out = F.lit(ADAPTIVE["low"][i])
        return F.when(branch == "high", F.lit(ADAPTIVE["high"][i])).when(branch == "medium", F.lit(ADAPTIVE["medium"][i])).otherwise(out)

    return row.select(*by, F.round("high_ratio", 6).alias("high_ratio"), branch.alias("branch"), *[pick(i).alias(n) for i, n in enumerate(names)])


def hmm_score(hits: DataFrame) -> DataFrame:
    """marker_id, hmm_score: mean over genomes with hits of their best score, no floor."""
    best = hits.groupBy("marker_id", "genome_id").agg(F.max("score").alias("s"))
    return best.groupBy("marker_id").agg(F.avg("s").alias("hmm_score"))


def length_coherence(best: DataFrame) -> DataFrame:
    """marker_id, length_ratio: 1 - spread of lengths, in 0 to 1; one length is 1."""
    out = F.when(F.count("length") == 1, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.stddev_pop("length") / F.avg("length"))))
    return best.groupBy("marker_id").agg(out.alias("length_ratio"))


def overall_score(hmm: str = "hmm_score", occ: str = "occupancy", length: str = "length_ratio", info: str = "informativeness", risk: str = "hgt_risk") -> Column:
    """Weighted quality, null while informativeness or risk is unmeasured."""
    ratio = F.when(F.col(length) <= 1.5, F.least(F.col(length), F.lit(1.0))).otherwise(0.5)
    raw = 0.25 * F.least(F.col(hmm) / 100, F.lit(1.0)) + 0.25 * F.col(occ) + 0.10 * ratio + 0.20 * F.col(info) + 0.20 * (1 - F.col(risk))
    return F.when(F.col(info).isNotNull() & F.col(risk).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def quality_level(score: Column) -> Column:
    return F.when(score.isNull(), "unknown").when(score >= 0.8, "level_1").when(score >= 0.5, "level_2").otherwise("level_3")
